"""Structured Streaming form of the behaviour loop: events in, states and feeds out.

Windows and watermarks bound the state; per-user states hold a fixed number of
entries. ``drain`` runs a stream over what is available and returns what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tasteloom.config import DEFAULTS
from tasteloom.functions.scalars import event_rating
from tasteloom.operators.ordering import first_per_group
from tasteloom.session import configure, stage_path
from tasteloom.streaming.keyed import cart_changes, login_flags, rocksdb_state


def read_events(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Event files of a folder as a stream."""
    configure(spark)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def typed_events(raw: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Raw rows (event_id, ts, user_id, event_type, props) as behaviour rows with event time ``at``."""
    pairs = [F.lit(x) for kv in kinds.items() for x in kv]
    kind = F.try_element_at(F.create_map(*pairs), F.col("event_type"))
    return raw.select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        kind.alias("event_type"), event_rating(kind).alias("rating"), F.col("ts").cast("timestamp").alias("at"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )


def _folders(spark: SparkSession, name: str, folder: str | None) -> tuple[str, str]:
    """Output and checkpoint of a stream: below ``folder``, where the next run goes on, or new ones."""
    out = f"{folder.rstrip('/')}/{name}" if folder else stage_path(spark, name)
    return out, f"{out}-checkpoint"


def _written(spark: SparkSession, out: str, empty: Callable[[], DataFrame]) -> DataFrame:
    """All rows of the micro-batches below ``out`` with their ``batch``; if there were none, an empty table."""
    try:
        found = spark.read.option("basePath", out).parquet(out)
        return found.withColumn("batch", F.col("batch").cast("bigint"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty().withColumn("batch", F.lit(0).cast("bigint"))


def drain(stream: DataFrame, name: str, mode: str = "append",
          each: Callable[[DataFrame, int], DataFrame] | None = None, folder: str | None = None) -> DataFrame:
    """Process everything available and return the written rows.

    With ``folder`` the output and the checkpoint keep their place: a later call reads
    only what is new, goes on from the stored state and returns the rows of all runs.

    Append output without ``each`` goes to a file sink (exactly once). Other output is
    written per micro-batch into its own folder, so a retried batch overwrites itself;
    column ``batch`` tells the rows apart.
    """
    spark = stream.sparkSession
    out, checkpoint = _folders(spark, name, folder)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append" and each is None:
        writer.format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def save(batch: DataFrame, number: int) -> None:
        rows = each(batch, number) if each else batch
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer.foreachBatch(save).start().awaitTermination()
    nothing = spark.createDataFrame([], stream.schema)
    return _written(spark, out, lambda: each(nothing, -1) if each else nothing)


def latest(rows: DataFrame, *keys: str) -> DataFrame:
    """Last written row per key."""
    return first_per_group(rows, list(keys), [F.desc("batch")]).drop("batch")


# ---------------------------------------------------------------- windows
def dedup_views(events: DataFrame, keep: str = "60 days") -> DataFrame:
    """One view per user and item while the pair is remembered."""
    return (
        events.where(F.col("event_type") == "view").withWatermark("at", keep)
        .dropDuplicatesWithinWatermark(["user_id", "item_id"])
    )


def event_counts(events: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events per type in closed tumbling windows."""
    counts = (
        events.where(F.col("event_type").isNotNull()).withWatermark("at", delay)
        .groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"))
    )
    return counts.select(F.unix_millis("window.start").alias("window_start"), "event_type", "n")


def active_users(events: DataFrame, width: str = "24 hours", slide: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Distinct users per closed sliding window: one state row per window and user,
    then a count per window."""
    per_user = events.withWatermark("at", delay).groupBy(F.window("at", width, slide), "user_id").agg(F.count("*").alias("_n"))
    counts = per_user.groupBy("window").agg(F.count("*").alias("active_users"))
    return counts.select(F.unix_millis("window.start").alias("window_start"), "active_users")


def active_users_sketch(events: DataFrame, hours: int = 24, delay: str = "10 minutes", lg_k: int = 14) -> DataFrame:
    """Distinct users per closed sliding window of ``hours``, from one mergeable sketch per hour.

    Unlike ``active_users`` no event is counted once per window: an event goes into the
    sketch of its hour, and a window unites the sketches of its hours. The standard error
    is 1.04 / sqrt(2^lg_k), 0.8 % with 14; null users are not counted.
    """
    panes = events.withWatermark("at", delay).groupBy(F.window("at", "1 hour")).agg(F.hll_sketch_agg("user_id", lg_k).alias("users"))
    wide = panes.groupBy(F.window(F.window_time("window"), f"{hours} hours", "1 hour")).agg(F.hll_union_agg("users").alias("users"))
    return wide.select(F.unix_millis("window.start").alias("window_start"), F.hll_sketch_estimate("users").alias("active_users"))


def trending(events: DataFrame, width: str = "1 day", delay: str = "10 minutes") -> DataFrame:
    """Views per item in closed windows; rank them per micro-batch with ``rank_trending``."""
    views = events.where(F.col("event_type") == "view").withWatermark("at", delay)
    counts = views.groupBy(F.window("at", width), "item_id").agg(F.count("*").alias("views"))
    return counts.select(F.unix_millis("window.start").alias("window_start"), "item_id", "views")


def rank_trending(batch: DataFrame, n: int = 10) -> DataFrame:
    return first_per_group(batch, ["window_start"], [F.desc("views"), F.asc("item_id")], n, "rank")


def popularity(events: DataFrame) -> DataFrame:
    """Running item counts for the popularity list (complete mode)."""
    return events.groupBy("item_id").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- per-user state
def user_history_stream(events: DataFrame, n: int = DEFAULTS.max_history) -> DataFrame:
    """Last ``n`` distinct items per user after every micro-batch (update mode).

    State: ``n`` items with their latest time.
    """
    kinds = dict(events.dtypes)

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items, times = state.get if state.exists else ([], [])
        best = dict(zip(items, times))
        for frame in frames:
            for item, ts in frame.groupby("item_id")["ts"].max().items():
                best[item] = max(ts, best.get(item, ts))
            best = dict(sorted(best.items(), key=lambda kv: (-kv[1], kv[0]))[:n])
        state.update((list(best), list(best.values())))
        yield pd.DataFrame({
            "user_id": key[0], "item_id": list(best), "ts": list(best.values()), "rank": range(1, len(best) + 1),
        })

    return events.select("user_id", "item_id", "ts").groupBy("user_id").applyInPandasWithState(
        update,
        f"user_id {kinds['user_id']}, item_id {kinds['item_id']}, ts bigint, rank int",
        f"items array<{kinds['item_id']}>, times array<bigint>",
        "update", GroupStateTimeout.NoTimeout,
    )


def newest_lists(rows: DataFrame) -> DataFrame:
    """Rows of each user's last micro-batch."""
    last = rows.groupBy("user_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["user_id", "batch"], "left_semi").drop("batch")


# ---------------------------------------------------------------- keyed state
def cart_stream(actions: DataFrame, folder: str | None = None) -> DataFrame:
    """Current cart lines after everything available was folded: the last change of each line that left it open."""
    with rocksdb_state(actions.sparkSession):
        changes = drain(cart_changes(actions), "cart", "update", folder=folder)
    return latest(changes, "user_id", "item_id").where("open").drop("open")


def throttle_stream(logins: DataFrame, window_s: float = 600, limit: int = 5, delay_s: float = 600,
                    folder: str | None = None) -> DataFrame:
    """Blocked flag per login attempt, over as many runs as ``folder`` has seen."""
    with rocksdb_state(logins.sparkSession):
        flags = drain(login_flags(logins, window_s, limit, delay_s), "throttle", "update", folder=folder)
    return flags.where("forgotten = 0").drop("forgotten", "batch")


def recommend_stream(events: DataFrame, feed: Callable[[DataFrame, DataFrame], DataFrame], n: int = DEFAULTS.max_history,
                     folder: str | None = None) -> DataFrame:
    """Refresh the feed of the users of each micro-batch.

    ``feed(users, log)`` is the batch plan. Its log is what the keyed state holds of the
    users that the micro-batch touched, their latest ``n`` items, so the work follows those
    users and no older event is read again. ``folder`` works as in ``drain``.
    """
    spark = events.sparkSession
    histories, _checkpoint = _folders(spark, "histories", folder)

    def each(batch: DataFrame, number: int) -> DataFrame:
        if number < 0:
            return feed(batch.select("user_id"), batch)
        batch.write.mode("overwrite").parquet(f"{histories}/batch={number}")      # once: the state is not read again
        touched = batch.sparkSession.read.schema(batch.schema).parquet(f"{histories}/batch={number}")
        return feed(touched.select("user_id").distinct(), touched)

    stream = user_history_stream(events.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()), n)
    return newest_lists(drain(stream, "feed", "update", each, folder))
