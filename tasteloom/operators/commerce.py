"""Carts, wishlists, orders, sessions and behaviour statistics, folded from logs.

A log row is (user_id, item_id, action, ts, seq); ``seq`` orders rows of equal ``ts``.
Current states come from partially aggregated maxima and minima joined back to the
log, so a user with very many rows is never one group in one task. Histories that
need the order of rows use ``group_running_sum``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.functions.scalars import event_rating, line_total
from tasteloom.operators.ordering import group_positions, group_running_sum
from tasteloom.session import write_stage

_PAIR = ["user_id", "item_id"]


def _at(ts: str = "ts", seq: str = "seq") -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))


def _lines(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cart lines of action rows that follow one another without a reset.

    A line starts at the first add; sets before it have no line to change. Its
    quantity is the last set after the start plus the adds after that set, or the
    number of adds when there is no set.
    """
    start = rows.where(F.col("action") == "add").groupBy(*keys).agg(F.min("at").alias("_start"))
    after = rows.join(start, keys).where(F.col("at") >= F.col("_start"))
    last_set = after.where(F.col("action") == "set").groupBy(*keys).agg(F.max(F.struct("at", "qty")).alias("_set"))
    counted = after.join(last_set, keys, "left").groupBy(*keys).agg(
        F.min("_start").alias("_start"),
        F.max("_set.qty").alias("_base"),
        F.sum(
            ((F.col("action") == "add") & (F.col("_set").isNull() | (F.col("at") > F.col("_set.at")))).cast("bigint")
        ).alias("_adds"),
    )
    return counted.select(
        *keys, (F.coalesce("_base", F.lit(0)) + F.col("_adds")).cast("bigint").alias("qty"),
        F.col("_start.ts").alias("added_at"),
    )


def _is_reset() -> Column:
    return (F.col("action") == "remove") | ((F.col("action") == "set") & (F.col("qty") <= 0))


def cart_state(log: DataFrame) -> DataFrame:
    """Current cart (user_id, item_id, qty, added_at) after folding all actions.

    ``checkout`` rows empty the whole cart of the user; ``set`` to zero or below
    removes the line.
    """
    rows = log.withColumn("at", _at())
    checkouts = rows.where(F.col("action") == "checkout").groupBy("user_id").agg(F.max("at").alias("_out"))
    removals = rows.where(_is_reset()).groupBy(*_PAIR).agg(F.max("at").alias("_gone"))
    live = (
        rows.where(F.col("action").isin("add", "set") & ~F.coalesce(_is_reset(), F.lit(False)))
        .join(checkouts, "user_id", "left")
        .where(F.col("_out").isNull() | (F.col("at") > F.col("_out")))
        .join(removals, _PAIR, "left")
        .where(F.col("_gone").isNull() | (F.col("at") > F.col("_gone")))
        .drop("_out", "_gone")
    )
    return _lines(live, _PAIR)


def checkout_lines(log: DataFrame) -> DataFrame:
    """Cart lines present at every checkout: (user_id, item_id, checkout_seq, qty, purchased_at).

    The number of checkouts seen so far splits a user's log into baskets; a basket's
    lines are its rows after the last removal of the item in that basket.
    """
    rows = log.select("user_id", "item_id", "action", "qty", "ts", "seq")
    numbered = write_stage(group_running_sum(
        rows, ["user_id"], ["ts", "seq"], {"_done": (F.col("action") == "checkout").cast("bigint")}
    ), "baskets")
    # the checkout row itself counts already, so it closes basket _done - 1
    closing = numbered.where(F.col("action") == "checkout").select(
        "user_id", (F.col("_done") - 1).alias("basket"), F.col("ts").alias("purchased_at"), F.col("seq").alias("checkout_seq")
    )
    keys = [*_PAIR, "basket"]
    inside = numbered.where(F.col("action") != "checkout").withColumnRenamed("_done", "basket").withColumn("at", _at())
    removals = inside.where(_is_reset()).groupBy(*keys).agg(F.max("at").alias("_gone"))
    live = (
        inside.where(F.col("action").isin("add", "set") & ~F.coalesce(_is_reset(), F.lit(False)))
        .join(removals, keys, "left")
        .where(F.col("_gone").isNull() | (F.col("at") > F.col("_gone")))
        .drop("_gone")
    )
    return _lines(live, keys).join(closing, ["user_id", "basket"]).select(
        "user_id", "item_id", "checkout_seq", "qty", "purchased_at"
    )


def checkout_orders(log: DataFrame, items: DataFrame) -> DataFrame:
    """One order row per known cart line of each checkout, at the catalog price."""
    return checkout_lines(log).join(items.select("item_id", "price"), "item_id").select(
        "user_id", "item_id", "checkout_seq", "qty", "price", "purchased_at"
    )


def purchase_events(orders: DataFrame) -> DataFrame:
    kind = F.lit("purchase")
    return orders.select(
        "user_id", "item_id", event_rating(kind).alias("rating"), F.col("purchased_at").alias("ts"), kind.alias("event_type")
    )


def buy_item(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Single-item orders of quantity one; unknown items yield no order."""
    return requests.join(items.select("item_id", "price"), "item_id").select(
        "user_id", "item_id", F.lit(1).cast("bigint").alias("qty"), "price", F.col("ts").alias("purchased_at")
    )


def wishlist_state(log: DataFrame) -> DataFrame:
    """Current wishlist: pairs added after their last removal, with the first such add."""
    rows = log.withColumn("at", _at())
    removed = rows.where(F.col("action") == "remove").groupBy(*_PAIR).agg(F.max("at").alias("_gone"))
    return (
        rows.where(F.col("action") == "add").join(removed, _PAIR, "left")
        .where(F.col("_gone").isNull() | (F.col("at") > F.col("_gone")))
        .groupBy(*_PAIR).agg(F.min("ts").alias("added_at"))
    )


def move_to_cart(wishlist: DataFrame) -> DataFrame:
    """Action rows that move wishlist lines to the cart: (target, action) per line."""
    moves = F.array(
        F.struct(F.lit("cart").alias("target"), F.lit("add").alias("action")),
        F.struct(F.lit("wishlist").alias("target"), F.lit("remove").alias("action")),
    )
    return wishlist.select("user_id", "item_id", F.inline(moves))


def cart_view(cart: DataFrame, items: DataFrame) -> DataFrame:
    return cart.join(items, "item_id").withColumn("line_total", line_total("price", "qty"))


def cart_totals(lines: DataFrame) -> DataFrame:
    """Amount and piece count per user."""
    return lines.groupBy("user_id").agg(
        F.sum(line_total("price", "qty")).alias("total"), F.sum(F.coalesce("qty", F.lit(1))).cast("bigint").alias("n_items")
    )


def order_history(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with current metadata; the stored unit price is kept. Rank 1 is the newest."""
    meta = items.select("item_id", "title", "category", "brand", "avg_rating")
    newest = group_positions(orders, ["user_id"], [F.desc("purchased_at"), F.asc("order_id")], "_pos")
    return newest.join(meta, "item_id").select(
        "user_id", (F.col("_pos") + 1).alias("rank"), "order_id", "item_id", "title", "category", "brand", "avg_rating",
        "qty", "price", F.timestamp_millis("purchased_at").cast("date").alias("purchased_on"),
    )


def user_badges(users: DataFrame, wishlist: DataFrame, cart: DataFrame, orders: DataFrame) -> DataFrame:
    """Sizes of wishlist, cart and orders per user, zero when empty. One aggregation."""
    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select("user_id", F.lit(name).alias("kind"))

    counts = (
        tagged(wishlist, "w").unionByName(tagged(cart, "c")).unionByName(tagged(orders, "o"))
        .groupBy("user_id").agg(*(F.count_if(F.col("kind") == k).alias(n) for k, n in
                                  (("w", "n_wishlist"), ("c", "n_cart"), ("o", "n_orders"))))
    )
    zero = F.lit(0).cast("bigint")
    return users.select("user_id").join(counts, "user_id", "left").select(
        "user_id", *(F.coalesce(n, zero).alias(n) for n in ("n_wishlist", "n_cart", "n_orders"))
    )


# ---------------------------------------------------------------- event log
LOGGED_KINDS = ("view", "like", "cart")  # fixed values: kinds the event endpoint accepts


def log_events(log: DataFrame, new: DataFrame) -> DataFrame:
    """Append behaviour rows (user_id, item_id, event_type, ts) with their mapped rating."""
    rows = new.where(F.col("event_type").isin(*LOGGED_KINDS)).select(
        "user_id", "item_id", event_rating("event_type").alias("rating"), "ts", "event_type"
    )
    return log.unionByName(rows, allowMissingColumns=True)


def user_counters(users: DataFrame, log: DataFrame) -> DataFrame:
    """Live events per user; imported rows (no event type) do not count."""
    counts = log.where(F.col("event_type").isNotNull()).groupBy("user_id").agg(F.count("*").alias("n"))
    return users.select("user_id").join(counts, "user_id", "left").select(
        "user_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_interactions")
    )


def session_view_dedup(views: DataFrame, session: str = "session") -> DataFrame:
    """One view per session and item: the earliest."""
    return views.groupBy(session, "item_id").agg(F.min("ts").alias("ts"))


def onboarding_seed(choices: DataFrame, items: DataFrame, per_category: int = 2, max_categories: int = 5) -> DataFrame:
    """Like events for a new user's chosen categories: ``choices`` is (user_id, category, pos)."""
    from tasteloom.operators.catalog import category_top

    picked = choices.where(F.col("pos") <= max_categories).select("user_id", "category")
    best = category_top(items, limit=per_category).select("category", "item_id")
    return picked.join(best, "category").select(
        "user_id", "item_id", event_rating(F.lit("like")).alias("rating"), F.lit("like").alias("event_type")
    )


def admin_kpis(users: DataFrame, log: DataFrame, orders: DataFrame, now_ms: int) -> DataFrame:
    """One row: users, users active in the last day, orders and revenue."""
    one = F.lit(1).alias("_one")
    parts = [
        users.agg(F.count("*").alias("users")).select(one, "users"),
        log.where(F.col("ts") > now_ms - 86_400_000).agg(F.countDistinct("user_id").alias("active_24h")).select(one, "active_24h"),
        orders.agg(
            F.count("*").alias("orders"),
            F.coalesce(F.sum(F.col("price") * F.col("qty")), F.lit(0.0)).cast("double").alias("revenue"),
        ).select(one, "orders", "revenue"),
    ]
    return parts[0].join(parts[1], "_one").join(parts[2], "_one").drop("_one")  # one row each


def events_by_type(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_type").isNotNull()).groupBy("event_type").agg(F.count("*").alias("n"))


def top_viewed(log: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Titles by views. Views are counted per item before the catalog join."""
    views = log.where(F.col("event_type") == "view").groupBy("item_id").agg(F.count("*").alias("v"))
    titles = views.join(items.select("item_id", "title"), "item_id").groupBy("title").agg(F.sum("v").alias("views"))
    return titles.orderBy(F.desc("views"), "title").limit(n)


def view_sketches(log: DataFrame, part: Column, tracked: int = 10_000) -> DataFrame:
    """Frequent-items sketches of viewed items, one row (part, sketch) per value of ``part``.

    A sketch is of fixed size and can be stored and united with others, say one per day.
    """
    views = log.where((F.col("event_type") == "view") & F.col("item_id").isNotNull())
    return views.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k_accumulate(item_id, {int(tracked)})").alias("sketch"))


def top_viewed_sketch(sketches: DataFrame, items: DataFrame, n: int = 10, tracked: int = 10_000, most: int = 1000) -> DataFrame:
    """Titles by views from united sketches: the ``most`` most viewed items, summed up by title.

    With no more than three quarters of ``tracked`` different items the counts are exact;
    beyond that an item's count is off by 3.5 / ``tracked`` of all views at most.
    ``top_viewed`` counts all of them exactly.
    """
    united = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))
    heavy = united.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {int(most)})"))).toDF("item_id", "v")
    titles = heavy.join(items.select("item_id", "title"), "item_id").groupBy("title").agg(F.sum("v").alias("views"))
    return titles.orderBy(F.desc("views"), "title").limit(n)


def top_event_categories(log: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    events = log.where(F.col("event_type").isNotNull()).groupBy("item_id").agg(F.count("*").alias("e"))
    kinds = items.where(F.col("category").isNotNull()).select("item_id", "category")
    return events.join(kinds, "item_id").groupBy("category").agg(F.sum("e").alias("events")).orderBy(
        F.desc("events"), "category"
    ).limit(n)


def active_sessions(sessions: DataFrame, users: DataFrame, now_ms: int, ttl_days: float = 30) -> DataFrame:
    """Sessions younger than the time to live, with a known user."""
    fresh = sessions.where(F.col("created_at") > now_ms - int(ttl_days * 86_400_000))
    return fresh.join(users.select("user_id"), "user_id", "left_semi")


def latency_summary(log: DataFrame) -> DataFrame:
    """Mean and lower-rank 95th percentile per component of a map column.

    Equal values are counted before anything is ordered, and the counts are summed up
    along a range sort, so neither a component nor a value with most of the rows ends up
    in one task.
    """
    values = log.select(F.explode("latency_ms").alias("component", "ms"))
    counted = write_stage(values.groupBy("component", "ms").agg(F.count("*").alias("_n")), "latency")
    means = counted.groupBy("component").agg(
        (F.sum(F.col("ms") * F.col("_n")) / F.sum(F.when(F.col("ms").isNotNull(), F.col("_n")))).alias("mean_ms"),
        F.sum("_n").alias("calls"))
    placed = group_running_sum(counted, ["component"], ["ms"], {"_upto": F.col("_n")})
    at = F.floor(F.lit(0.95) * (F.col("calls") - 1))
    return (
        placed.join(means, "component").where((F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto")))
        .select("component", "calls", "mean_ms", F.col("ms").alias("p95_ms"))
    )


# ---------------------------------------------------------------- login throttle
def throttle_segments(log: DataFrame, window_ms: int) -> DataFrame:
    """Split each user's attempts where nothing happened for longer than the window.

    All remembered failures have expired across such a pause, so segments are
    independent. Pauses are found on distinct (user, time slot) pairs: an empty slot
    between two active ones is a pause.
    """
    slotted = log.withColumn("_slot", F.floor(F.col("ts") / window_ms))
    slots = slotted.select("user_id", "_slot").distinct()
    by_time = Window.partitionBy("user_id").orderBy("_slot")
    starts = F.when(F.col("_slot") - F.lag("_slot").over(by_time) <= 1, 0).otherwise(1)
    numbered = slots.withColumn("_new", starts).withColumn("segment", F.sum("_new").over(by_time)).drop("_new")
    return slotted.join(numbered, ["user_id", "_slot"]).drop("_slot")


def throttle_flags(log: DataFrame, window_s: float = 600, limit: int = 5) -> DataFrame:
    """Blocked flag per login attempt (user_id, result, ts, seq).

    Blocked attempts are not recorded; a failure is forgotten when older than the
    window; an accepted success clears the user. The fold streams over rows sorted by
    (user, segment, time) and remembers at most ``limit`` failures.
    """
    window_ms = int(window_s * 1000)
    kinds = dict(log.dtypes)
    attempts = throttle_segments(log.select("user_id", "result", "ts", "seq"), window_ms)
    failures = attempts.groupBy("user_id", "segment").agg(
        F.count_if(~F.coalesce(F.col("result") == "success", F.lit(False))).alias("_failed"))
    attempts = write_stage(attempts.join(failures, ["user_id", "segment"]), "attempts")
    # only a segment with so many failures can block; all others are done
    free = attempts.where(F.col("_failed") < limit).select("user_id", "seq", "ts", "result", F.lit(False).alias("blocked"))
    ordered = (
        attempts.where(F.col("_failed") >= limit).drop("_failed")
        .repartition("user_id", "segment")
        .sortWithinPartitions("user_id", "segment", "ts", "seq")
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, recent = None, []
        for batch in batches:
            blocked = np.zeros(len(batch), dtype=bool)
            rows = zip(batch["user_id"], batch["segment"], batch["result"], batch["ts"])
            for n, (user, segment, result, ts) in enumerate(rows):
                if key != (user, segment):
                    key, recent = (user, segment), []
                recent = [t for t in recent if ts - t <= window_ms]
                blocked[n] = len(recent) >= limit
                if not blocked[n]:
                    recent = [] if result == "success" else [*recent, ts]
            yield pd.DataFrame({
                "user_id": batch["user_id"], "seq": batch["seq"], "ts": batch["ts"],
                "result": batch["result"], "blocked": blocked,
            })

    return free.unionByName(ordered.mapInPandas(
        fold, f"user_id {kinds['user_id']}, seq {kinds['seq']}, ts bigint, result string, blocked boolean"
    ))
