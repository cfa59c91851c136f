"""Feature store and the twelve ranking features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.ordering import first_per_group

DAY_MS = 86_400_000.0

FEATURES = (
    "retriever_score", "item_pop", "item_avg_rating", "item_price", "item_age_days", "user_activity",
    "user_avg_rating", "days_since_user_last", "cat_match", "brand_match", "price_gap", "rating_vs_user_mean",
)


@dataclass(frozen=True)
class FeatureStore:
    users: DataFrame
    items: DataFrame
    global_avg_rating: float
    now_ts: int


def item_features(train: DataFrame, items: DataFrame) -> DataFrame:
    stats = train.groupBy("item_id").agg(
        F.count("*").alias("item_pop"), F.avg("rating").alias("item_avg_rating"), F.max("ts").alias("item_last_ts")
    )
    return stats.join(
        items.select("item_id", F.col("price").alias("item_price"), F.col("brand").alias("item_brand"),
                     F.col("category").alias("item_cat")),
        "item_id", "full_outer",
    )


def _favourite(pairs: DataFrame, column: str, name: str) -> DataFrame:
    """Most frequent non-null value per user, smallest value on ties."""
    counts = pairs.where(F.col(column).isNotNull()).groupBy("user_id", column).agg(F.sum("n").alias("n"))
    return first_per_group(counts, ["user_id"], [F.desc("n"), F.asc(column)]).select(
        "user_id", F.col(column).alias(name)
    )


def user_features(train: DataFrame, items: DataFrame) -> DataFrame:
    """Rows are first reduced to (user, item) pairs; the catalog is joined once."""
    pairs = train.groupBy("user_id", "item_id").agg(
        F.count("*").alias("n"), F.sum("rating").alias("rating_sum"), F.count("rating").alias("rated"),
        F.max("ts").alias("ts"),
    ).join(items.select("item_id", "category", "brand", "price"), "item_id", "left")
    priced = F.when(F.col("price").isNotNull(), F.col("n"))
    base = pairs.groupBy("user_id").agg(
        F.sum("n").alias("user_activity"),
        (F.sum("rating_sum") / F.sum("rated")).alias("user_avg_rating"),
        F.max("ts").alias("user_last_ts"),
        F.try_divide(F.sum(F.col("price") * F.col("n")), F.sum(priced)).alias("user_avg_price"),
    )
    return (
        base.join(_favourite(pairs, "category", "user_top_cat"), "user_id", "left")
        .join(_favourite(pairs, "brand", "user_top_brand"), "user_id", "left")
    )


def feature_store(train: DataFrame, items: DataFrame) -> FeatureStore:
    average, now = train.agg(F.avg("rating"), F.max("ts")).first()
    return FeatureStore(user_features(train, items), item_features(train, items), average, now)


def featurize(pairs: DataFrame, store: FeatureStore) -> DataFrame:
    """Add the features to (user_id, item_id, retriever_score): two joins, defaults
    for unknown users and items, zero for anything still missing."""
    joined = pairs.join(store.items, "item_id", "left").join(store.users, "user_id", "left")
    now, mean = F.lit(store.now_ts), F.lit(store.global_avg_rating)

    def days_since(ts: str):
        return (now - F.coalesce(ts, now)) / F.lit(DAY_MS)

    def same(a: str, b: str):
        return F.coalesce((F.col(a) == F.col(b)).cast("double"), F.lit(0.0))

    item_rating, user_rating = F.coalesce("item_avg_rating", mean), F.coalesce("user_avg_rating", mean)
    values = {
        "retriever_score": F.col("retriever_score"),
        "item_pop": F.col("item_pop"),
        "item_avg_rating": item_rating,
        "item_price": F.col("item_price"),
        "item_age_days": days_since("item_last_ts"),
        "user_activity": F.col("user_activity"),
        "user_avg_rating": user_rating,
        "days_since_user_last": days_since("user_last_ts"),
        "cat_match": same("user_top_cat", "item_cat"),
        "brand_match": same("user_top_brand", "item_brand"),
        "price_gap": F.abs(F.col("item_price") - F.col("user_avg_price")),
        "rating_vs_user_mean": item_rating - user_rating,
    }
    return joined.select(
        *pairs.columns[:2],
        *(F.coalesce(values[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES),
        *(c for c in pairs.columns[2:] if c != "retriever_score"),
    )


def rank_to_score(candidates: DataFrame) -> DataFrame:
    """Default retriever score: minus the 0-based rank."""
    return candidates.withColumn("retriever_score", -(F.col("rank") - 1).cast("double"))


def label_candidates(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """0/1 label per candidate; lists without a positive are dropped."""
    positive = truth.select("user_id", "item_id", F.lit(1).alias("label")).distinct()
    labelled = candidates.join(positive, ["user_id", "item_id"], "left").withColumn(
        "label", F.coalesce("label", F.lit(0))
    )
    hits = candidates.select("user_id", "item_id").join(positive, ["user_id", "item_id"], "left_semi")
    return labelled.join(hits.select("user_id").distinct(), "user_id", "left_semi")


def build_ranker_data(candidates: DataFrame, truth: DataFrame, store: FeatureStore) -> DataFrame:
    """Labelled and featurized ranker rows; the user is the query id."""
    scored = candidates if "score" in candidates.columns else rank_to_score(candidates)
    if "retriever_score" not in scored.columns:
        scored = scored.withColumnRenamed("score", "retriever_score")
    rows = label_candidates(scored.select("user_id", "item_id", "retriever_score"), truth)
    return featurize(rows.select("user_id", "item_id", "retriever_score", "label"), store)


def label_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("user_id").alias("n_groups"),
        F.avg(F.col("label").cast("double")).alias("positive_rate"),
    )
