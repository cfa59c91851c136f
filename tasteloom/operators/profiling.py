"""Dataset profiling: density, popularity tail, activity and volume over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.functions.scalars import is_positive, ms_to_timestamp
from tasteloom.operators.ordering import global_index


def matrix_density(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    sizes = df.agg(
        F.count("*").alias("n_rows"), count("user_id").alias("n_users"), count("item_id").alias("n_items")
    )
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    density = F.try_divide(F.col("n_rows").cast("double"), cells)
    return sizes.withColumn("density", density).withColumn("sparsity", F.lit(1.0) - density)


def rating_distribution(df: DataFrame) -> DataFrame:
    """Count and share per rating; ratings are few, so the total is a tiny window."""
    counts = df.groupBy("rating").agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    return counts.select(
        "rating",
        "n",
        (F.col("n") / F.sum("n").over(whole)).alias("share"),
        is_positive("rating").alias("positive"),
        (F.sum(F.when(is_positive("rating"), F.col("n")).otherwise(0)).over(whole)
         / F.sum("n").over(whole)).alias("positive_share"),
    )


def long_tail_curve(df: DataFrame) -> DataFrame:
    """Items ranked by row count."""
    counts = df.groupBy("item_id").agg(F.count("*").alias("n"))
    return global_index(counts, [F.desc("n"), F.asc("item_id")], "pos").select(
        (F.col("pos") + 1).alias("pop_rank"), "item_id", "n"
    )


def head_share(df: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Share of rows held by the most popular ``fraction`` of items.

    Works on the histogram of counts: which of several equally popular items is in
    the head does not change the sum, so no item has to be ranked.
    """
    per_item = df.groupBy("item_id").agg(F.count("*").alias("c"))
    histogram = per_item.groupBy("c").agg(F.count("*").alias("items"))
    whole = Window.partitionBy()
    above = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    sized = histogram.select(
        "c",
        "items",
        F.sum("items").over(whole).alias("n_items"),
        F.coalesce(F.sum("items").over(above), F.lit(0)).alias("before"),
    ).withColumn("head_items", F.greatest(F.lit(1), F.floor(F.lit(fraction) * F.col("n_items")).cast("bigint")))
    taken = F.greatest(F.lit(0), F.least(F.col("items"), F.col("head_items") - F.col("before")))
    return sized.agg(
        F.max("head_items").alias("head_items"),
        F.sum(taken * F.col("c")).alias("head_rows"),
        F.sum(F.col("items") * F.col("c")).alias("n_rows"),
    ).withColumn("head_share", F.col("head_rows") / F.col("n_rows"))


def activity_histogram(df: DataFrame, key: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of rows per key; the last bin includes the maximum."""
    counts = df.groupBy(key).agg(F.count("*").alias("c")).groupBy("c").agg(F.count("*").alias("keys"))
    whole = Window.partitionBy()
    ranged = counts.select(
        "c", "keys", F.min("c").over(whole).alias("lo"), F.max("c").over(whole).alias("hi")
    )
    return _binned(ranged, F.col("c"), bins).groupBy("bin").agg(F.sum("keys").alias("n"))


def _binned(df: DataFrame, value, bins: int) -> DataFrame:
    span = F.greatest(F.col("hi") - F.col("lo"), F.lit(1))
    place = F.floor((value - F.col("lo")) * F.lit(bins) / span).cast("bigint")
    return df.withColumn("bin", F.least(place, F.lit(bins - 1).cast("bigint")))


def median_activity(df: DataFrame) -> DataFrame:
    """Median rows per user and per item, from counts of counts."""

    def median(key: str) -> DataFrame:
        counts = df.groupBy(key).agg(F.count("*").alias("c")).groupBy("c").agg(F.count("*").alias("f"))
        return counts.agg(F.percentile("c", F.lit(0.5), F.col("f")).alias("median_rows")).select(
            F.lit(key).alias("key"), "median_rows"
        )

    return median("user_id").unionByName(median("item_id"))


def monthly_volume(df: DataFrame) -> DataFrame:
    month = F.date_trunc("month", ms_to_timestamp("ts")).cast("date")
    return df.groupBy(month.alias("month")).agg(F.count("*").alias("n"))


def ts_range(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("split").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        "split",
        ms_to_timestamp("lo").cast("date").alias("first_day"),
        ms_to_timestamp("hi").cast("date").alias("last_day"),
    )


def split_histogram(labelled: DataFrame, bins: int = 60) -> DataFrame:
    """Rows per split and equal-width time bin over the whole timeline."""
    lo, hi = labelled.agg(F.min("ts"), F.max("ts")).first()
    ranged = labelled.withColumn("lo", F.lit(lo)).withColumn("hi", F.lit(hi))
    return _binned(ranged, F.col("ts"), bins).groupBy("split", "bin").agg(F.count("*").alias("n"))


def retention_report(before: DataFrame, after: DataFrame) -> DataFrame:
    def sizes(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"rows_{side}"),
            F.countDistinct("user_id").alias(f"users_{side}"),
            F.countDistinct("item_id").alias(f"items_{side}"),
        ).withColumn("one", F.lit(1))

    joined = sizes(before, "before").join(sizes(after, "after"), "one")  # one row each
    return joined.select(
        *(F.try_divide(F.col(f"{n}_after").cast("double"), F.col(f"{n}_before")).alias(f"{n}_kept")
          for n in ("rows", "users", "items"))
    )


def meta_coverage(interactions: DataFrame, items: DataFrame) -> DataFrame:
    used = interactions.select("item_id").distinct()
    known = items.select("item_id", F.lit(1).alias("hit")).dropDuplicates(["item_id"])
    return used.join(known, "item_id", "left").agg(
        F.count("hit").alias("with_metadata"), F.count("*").alias("n_items")
    )
