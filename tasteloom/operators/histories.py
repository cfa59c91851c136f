"""User histories: ordered sequences, training windows and pooled vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS, Settings
from tasteloom.functions.vectors import mean_vectors
from tasteloom.operators.ordering import first_per_group, group_positions

_CHUNK = 8192  # positions per chunk, at least


def history_sequence(train: DataFrame, item: str = "item_id", user: str = "user_id") -> DataFrame:
    """Time-ordered history as rows (user, pos, item), ties by item. Long form: a
    history of any length never becomes one value."""
    rows = train.select(user, item, "ts")
    return group_positions(rows, [user], ["ts", item], "pos").select(user, "pos", item, "ts")


def history_windows(train: DataFrame, max_history: int = DEFAULTS.max_history,
                    item: str = "item_id", user: str = "user_id") -> DataFrame:
    """For every row but a user's first: the ``max_history`` items before it.

    Long histories are cut into chunks of positions; each chunk also gets the last
    ``max_history`` rows of the chunk before it, so windows stay whole while a hot
    user is spread over many tasks.
    """
    chunk = max(_CHUNK, max_history)  # a window never reaches beyond the chunk before
    seq = history_sequence(train, item, user).withColumn("_chunk", F.floor(F.col("pos") / chunk))
    carried = F.col("pos") % chunk >= chunk - max_history
    placed = seq.withColumn(
        "_place",
        F.explode(
            F.when(
                carried,
                F.array(
                    F.struct(F.col("_chunk").alias("chunk"), F.lit(False).alias("context")),
                    F.struct((F.col("_chunk") + 1).alias("chunk"), F.lit(True).alias("context")),
                ),
            ).otherwise(F.array(F.struct(F.col("_chunk").alias("chunk"), F.lit(False).alias("context"))))
        ),
    ).select(user, "pos", item, F.col("_place.chunk").alias("_c"), F.col("_place.context").alias("_x"))
    before = Window.partitionBy(user, "_c").orderBy("pos").rowsBetween(-max_history, -1)
    return (
        placed.withColumn("history", F.collect_list(item).over(before))
        .where(~F.col("_x") & (F.col("pos") > 0))
        .select(user, "pos", "history", F.col(item).alias("target"))
    )


def pad_mask(windows: DataFrame, batch: str) -> DataFrame:
    """Right-pad ``history`` to the longest one of its batch and add a 0/1 ``mask``.
    Lengths are bounded by the window size, so the padded arrays are too."""
    longest = windows.groupBy(batch).agg(F.max(F.size("history")).alias("_len"))
    size = F.size("history")
    return windows.join(longest, batch).select(
        *windows.columns,
        F.concat("history", F.array_repeat(F.lit(0).cast("bigint"), F.col("_len") - size)).alias("padded"),
        F.concat(F.array_repeat(F.lit(1.0), size), F.array_repeat(F.lit(0.0), F.col("_len") - size)).alias("mask"),
    )


def recent_rows(train: DataFrame, n: int = DEFAULTS.max_history) -> DataFrame:
    """Last ``n`` rows per user, duplicates kept (offline history)."""
    return first_per_group(
        train.select("user_id", "item_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("item_id")], n
    )


def user_history(log: DataFrame, n: int = DEFAULTS.max_history) -> DataFrame:
    """Last ``n`` distinct items per user, latest first (online history), 1-based rank."""
    latest = log.groupBy("user_id", "item_id").agg(F.max("ts").alias("ts"))
    return first_per_group(latest, ["user_id"], [F.desc("ts"), F.asc("item_id")], n, "rank")


def mean_pool(history: DataFrame, vectors: DataFrame, dim: int, opts: Settings = DEFAULTS) -> DataFrame:
    """Mean vector of the history items that have one: (user_id, vec).

    Vectors are broadcast while their counted size is under ``opts.broadcast_bytes``: a history
    that is dealt by user then stays where it is, and sums are not shuffled.
    """
    if vectors.count() * dim * 8 <= opts.broadcast_bytes:
        vectors = F.broadcast(vectors)
    return history.select("user_id", "item_id").join(vectors, "item_id").groupBy("user_id").agg(
        mean_vectors("vec", dim).alias("vec")
    )


def recently_viewed(log: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """History with item metadata; unknown items keep their row."""
    return user_history(log, n).join(items, "item_id", "left")
