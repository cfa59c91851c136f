"""Queries: streams drained over the event table."""

from pyspark.sql import functions as F

from tasteloom.plans.feed import FeedModels, recommend_batch
from tasteloom.operators.popularity import popularity_head
from tasteloom.plans.registry import query
from tasteloom.session import stage_path
from tasteloom.sources.warehouse import CART_ACTIONS, EVENT_KINDS
from tasteloom.streaming import behaviour as S


def raw_stream(w, parts=4, late=False):
    """The events by ``parts`` ranges of time, one micro-batch each, so carried state counts.

    Each range is dealt to the same number of files, which follows the size of the table,
    so that a micro-batch takes one range. Rows without a time are in the first. With ``late`` the rows of the first half come once
    more, long after their time.
    """
    table, folder = w.table("events"), stage_path(w.spark, "events")
    at = F.col("ts").cast("timestamp").cast("double")
    low, high = table.agg(F.min(at), F.max(at)).first()
    if low is None:
        return S.read_events(w.spark, w.folder, table.schema, "events.parquet")
    step = (high - low) / parts
    number = F.coalesce(F.least(F.floor((at - F.lit(low)) / F.lit(step or 1.0)), F.lit(parts - 1)), F.lit(0))
    ranges = [table.where(number == n) for n in range(parts)]
    if late:
        ranges.append(table.where(at < low + (high - low) / 2))
    files = max(1, -(-table.rdd.getNumPartitions() // parts))
    for k, rows in enumerate(ranges, 1):
        rows.repartition(files).write.mode("append").parquet(folder)
        made = len(w.spark.read.schema(table.schema).parquet(folder).inputFiles())
        for _ in range(k * files - made):       # a range of very few rows leaves files out
            table.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return S.read_events(w.spark, folder, table.schema, files_per_trigger=files)


def events(w):
    return S.typed_events(raw_stream(w), EVENT_KINDS)


def _log(w, mapping, column):
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    raw = raw_stream(w)
    kind = F.try_element_at(F.create_map(*pairs), F.col("event_type"))
    return raw.select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), kind.alias(column),
        F.when(kind == "set", F.floor("value") % 4).cast("bigint").alias("qty"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").alias("seq"),
    ).where(F.col(column).isNotNull())


@query("stream_events", "SELECT event_id, user_id, item_id, event_type, rating, ts FROM live_events")
def _(w):
    return S.drain(events(w), "events").drop("at")


@query("stream_view_dedup", "SELECT DISTINCT user_id, item_id FROM live_events WHERE event_type = 'view'")
def _(w):
    return S.drain(S.dedup_views(events(w)), "views").select("user_id", "item_id")


_COUNTS = """
SELECT ts // 3600000 * 3600000 AS window_start, event_type, count(*) AS n FROM live_events GROUP BY 1, 2
HAVING ts // 3600000 * 3600000 + 3600000 <= (SELECT max(ts) FROM live_events) - 600000"""


@query("stream_event_counts", _COUNTS)
def _(w):
    return S.drain(S.event_counts(events(w)), "counts")


@query("stream_late_rows", _COUNTS)
def _(w):
    """Rows later than the watermark change nothing."""
    return S.drain(S.event_counts(S.typed_events(raw_stream(w, late=True), EVENT_KINDS)), "late")


@query("stream_active_users", """
SELECT window_start, count(DISTINCT user_id) AS active_users FROM (
  SELECT user_id, (ts // 3600000 - h) * 3600000 AS window_start FROM live_events, range(0, 24) r(h))
GROUP BY 1 HAVING window_start + 86400000 <= (SELECT max(ts) FROM live_events) - 600000""")
def _(w):
    return S.drain(S.active_users(events(w)), "active")


@query("stream_active_users_sketch")
def _(w):
    return S.drain(S.active_users_sketch(events(w)), "active-sketch")


@query("stream_trending", """
SELECT window_start, item_id, views, rank FROM (
  SELECT ts // 86400000 * 86400000 AS window_start, item_id, count(*) AS views,
         row_number() OVER (PARTITION BY ts // 86400000 ORDER BY count(*) DESC, item_id) AS rank
  FROM live_events WHERE event_type = 'view' GROUP BY ts // 86400000, item_id)
WHERE rank <= 10 AND window_start + 86400000 <= (SELECT max(ts) FROM live_events WHERE event_type = 'view') - 600000""")
def _(w):
    out = S.drain(S.trending(events(w)), "trending", "append", lambda b, _n: S.rank_trending(b))
    return out.select("window_start", "item_id", "views", F.col("rank").cast("bigint").alias("rank"))


@query("stream_popularity", "SELECT item_id, count(*) AS n FROM live_events GROUP BY item_id")
def _(w):
    return S.latest(S.drain(S.popularity(events(w)), "popularity", "complete"), "item_id")


@query("stream_user_history", "SELECT user_id, item_id, ts, rank FROM history")
def _(w):
    rows = S.newest_lists(S.drain(S.user_history_stream(events(w)), "history", "update"))
    return rows.select("user_id", "item_id", "ts", F.col("rank").cast("bigint").alias("rank"))


@query("stream_cart_state", "SELECT user_id, item_id, qty, added_at FROM cart")
def _(w):
    return S.cart_stream(_log(w, CART_ACTIONS, "action"))


@query("stream_throttle", """
WITH RECURSIVE a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS n FROM login_log),
f AS (
  SELECT user_id, seq, ts, result, n, false AS blocked, CASE WHEN result = 'failed' THEN [ts] ELSE [] END AS q FROM a WHERE n = 1
  UNION ALL
  SELECT user_id, seq, ts, result, n, len(k) >= 3 AS blocked,
         CASE WHEN len(k) >= 3 THEN k WHEN result = 'success' THEN [] ELSE list_append(k, ts) END AS q
  FROM (SELECT a.*, list_filter(f.q, lambda t: a.ts - t <= 432000000) AS k FROM f JOIN a ON a.user_id = f.user_id AND a.n = f.n + 1))
SELECT user_id, seq, ts, result, blocked FROM f""")
def _(w):
    logins = _log(w, {"error": "failed", "signup": "success"}, "result")
    return S.throttle_stream(logins, 432_000, 3).select("user_id", "seq", "ts", "result", "blocked")


@query("stream_recommend")
def _(w):
    models = FeedModels(popularity_head(w.train, 60), w.vectors)
    feed = S.recommend_stream(
        events(w), lambda users, log: recommend_batch(users, log, w.items, models)
    )
    return feed.withColumn("rank", F.col("rank").cast("bigint"))
