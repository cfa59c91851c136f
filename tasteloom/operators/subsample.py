"""k-core subsampling and the recency cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS
from tasteloom.operators.ordering import global_index, order_statistics
from tasteloom.session import drop_stage, write_stage


def kcore(df: DataFrame, k_user: int = DEFAULTS.kcore_user, k_item: int = DEFAULTS.kcore_item) -> DataFrame:
    """Largest subset in which every item has >= k_item and every user >= k_user rows.

    The loop runs on pre-aggregated (user, item, count) pairs, not on the rows; each
    round is written once to the shared folder. The full rows are filtered once, at
    the end, by the ids that fell out.
    """
    pairs = write_stage(df.groupBy("user_id", "item_id").agg(F.count("*").alias("n")), "kcore")
    rows = pairs.agg(F.sum("n")).first()[0] or 0
    while rows:
        kept = pairs
        for key, k in (("item_id", k_item), ("user_id", k_user)):
            # ids below the threshold are never hot, so this side has no skew
            weak = kept.groupBy(key).agg(F.sum("n").alias("_n")).where(F.col("_n") < k).select(key)
            kept = kept.join(weak, key, "left_anti")
        before, pairs = pairs, write_stage(kept, "kcore")
        drop_stage(before)
        left = pairs.agg(F.sum("n")).first()[0] or 0
        if left == rows:
            break
        rows = left
    users = pairs.select("user_id").distinct()
    items = pairs.select("item_id").distinct()
    return df.join(users, "user_id", "left_semi").join(items, "item_id", "left_semi").select(*df.columns)


def recency_cap(df: DataFrame, max_rows: int = DEFAULTS.max_interactions,
                tie_break: tuple[str, ...] = ("user_id", "item_id", "rating")) -> DataFrame:
    """Most recent ``max_rows`` rows: everything newer than the exact cut timestamp,
    plus as many rows at the cut as fit, in ``tie_break`` order. No global sort. The input
    is read several times, so it is written once first."""
    df = write_stage(df, "uncapped")
    total = df.count()
    if total <= max_rows:
        return df
    cut = order_statistics(df, "ts", [total - max_rows])[0]
    newer = df.where(F.col("ts") > cut)
    room = max_rows - newer.count()
    at_cut = global_index(df.where(F.col("ts") == cut), tie_break, "_pos")
    return newer.unionByName(at_cut.where(F.col("_pos") < room).drop("_pos"))


def subsample(df: DataFrame, k_user: int = DEFAULTS.kcore_user, k_item: int = DEFAULTS.kcore_item,
              max_rows: int = DEFAULTS.max_interactions) -> DataFrame:
    return recency_cap(kcore(df, k_user, k_item), max_rows)


def size_report(df: DataFrame, stage: str, approximate: bool = False) -> DataFrame:
    """Rows, users and items of one stage as a one-row table."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.count("*").alias("n_rows"), count("user_id").alias("n_users"), count("item_id").alias("n_items")
    ).select(F.lit(stage).alias("stage"), "n_rows", "n_users", "n_items")


def subsample_report(df: DataFrame, k_user: int, k_item: int, max_rows: int) -> DataFrame:
    core = write_stage(kcore(df, k_user, k_item), "core")
    capped = recency_cap(core, max_rows)
    return (
        size_report(df, "start")
        .unionByName(size_report(core, "core"))
        .unionByName(size_report(capped, "cap"))
    )
