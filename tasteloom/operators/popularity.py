"""Popularity and random baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS
from tasteloom.functions.seeded import draw_int
from tasteloom.operators.ordering import first_per_group, global_index, unseen_at
from tasteloom.session import write_stage


def popularity_rank(train: DataFrame) -> DataFrame:
    """All items, most rows first, ties by item id: (pop_rank, item_id, n)."""
    counts = train.groupBy("item_id").agg(F.count("*").alias("n"))
    return global_index(counts, [F.desc("n"), F.asc("item_id")], "pos").select(
        (F.col("pos") + 1).alias("pop_rank"), "item_id", "n"
    )


def popularity_head(train: DataFrame, size: int) -> DataFrame:
    """First ``size`` items only: a bounded top-k, no full ranking."""
    counts = train.groupBy("item_id").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("item_id")).limit(size)
    return top.select(
        F.row_number().over(Window.orderBy(F.desc("n"), F.asc("item_id"))).cast("bigint").alias("pop_rank"),
        "item_id",
        "n",
    )


def popularity_recommend(
    users: DataFrame, ranking: DataFrame, seen: DataFrame, n: int = 50, head: int = 1000
) -> DataFrame:
    """Per user the ``n`` most popular unseen items, 1-based ``rank``.

    Users x items is never formed. Each user carries only the ranks they have seen
    inside a head of ``n + head`` items; the answer is the head minus those ranks.
    The few users who have seen so much of the head that ``n`` may not
    remain are solved exactly on deeper ranks, spread by (user, rank). ``seen`` may
    hold repeated pairs: it is filtered by the head before anything is shuffled.
    """
    size = n + head
    ranked = ranking.select("item_id", "pop_rank")
    top = ranked.where(F.col("pop_rank") <= size)
    wanted = users.select("user_id").distinct()
    seen_top = (
        seen.join(F.broadcast(top), "item_id")  # at most `size` rows
        .groupBy("user_id")
        .agg(F.collect_set("pop_rank").alias("_seen"))  # at most `size` values
    )
    none = F.array().cast("array<bigint>")
    state = write_stage(
        wanted.join(seen_top, "user_id", "left").withColumn("_seen", F.coalesce("_seen", none)), "seen_head"
    )
    fits = F.size("_seen") + n <= size
    needed = F.sequence(F.lit(1).cast("bigint"), (F.size("_seen") + n).cast("bigint"))
    ready = state.where(fits).withColumn("_free", F.array_except(needed, F.col("_seen")))
    shallow = ready.select(
        "user_id", F.posexplode(F.slice("_free", 1, n)).alias("_p", "pop_rank")
    ).join(F.broadcast(top), "pop_rank").select(
        "user_id", "item_id", (F.col("_p") + 1).alias("rank"), "pop_rank"
    )

    deep_users = state.where(~fits).select("user_id")
    if deep_users.isEmpty():
        return shallow
    deep_seen = seen.join(deep_users, "user_id", "left_semi").select("user_id", "item_id").distinct().join(ranked, "item_id")
    need = deep_seen.groupBy("user_id").agg((F.count("*") + n).alias("_upto"))
    catalog = ranking.agg(F.max("pop_rank").alias("_items")).withColumn("_one", F.lit(1))
    ranks = (
        need.withColumn("_one", F.lit(1))
        .join(F.broadcast(catalog), "_one")  # single row
        .select("user_id", F.explode(F.sequence(F.lit(1), F.least("_upto", "_items"))).alias("pop_rank"))
    )
    free = ranks.join(deep_seen.select("user_id", "pop_rank"), ["user_id", "pop_rank"], "left_anti")
    deep = first_per_group(free, ["user_id"], ["pop_rank"], n, "rank").join(ranked, "pop_rank")
    return shallow.unionByName(deep.select("user_id", "item_id", "rank", "pop_rank"))


def random_recommend(
    users: DataFrame, items: DataFrame, seen: DataFrame, n: int = 50, seed: int = DEFAULTS.seed,
    draws: int = 64,
) -> DataFrame:
    """Per user ``n`` unseen items in seeded random order, 1-based ``rank``.

    ``items`` is an encoder (item_id, i). Users draw item codes by hash instead of
    being paired with the catalog: draw number d of a user is one code; repeats and
    seen items are dropped; the first ``n`` survivors are a uniform sample without
    replacement. Users left short draw ranks among the items they have not seen
    instead, which is the same distribution; if few are unseen, all of them, in hash
    order. So lists are whole where the catalog allows it.
    """
    n_items = items.count()
    coded_seen = seen.join(items, "item_id").select("user_id", "i")
    wanted = users.select("user_id").distinct()
    drawn = wanted.select(
        "user_id", F.explode(F.sequence(F.lit(0), F.lit(n + draws - 1))).alias("d")
    ).withColumn("i", F.pmod(draw_int(seed, "user_id", "d"), F.lit(n_items)).cast("int"))
    first_draw = drawn.groupBy("user_id", "i").agg(F.min("d").cast("bigint").alias("key"))
    fresh = first_draw.join(coded_seen, ["user_id", "i"], "left_anti")
    top = write_stage(first_per_group(fresh, ["user_id"], ["key"], n, "rank"), "random-first")

    have = top.groupBy("user_id").agg(F.count("*").alias("_have"))
    short = write_stage(
        wanted.join(have, "user_id", "left").where(F.coalesce("_have", F.lit(0)) < n).select("user_id"), "random-short")
    if short.isEmpty():
        return top.join(items, "i").select("user_id", "item_id", "rank")
    own = coded_seen.join(short, "user_id", "left_semi").distinct()
    unseen = short.join(own.groupBy("user_id").agg(F.count("*").alias("_seen")), "user_id", "left").select(
        "user_id", (F.lit(n_items) - F.coalesce("_seen", F.lit(0))).cast("bigint").alias("_left")).where("_left > 0")
    tries = F.least(F.col("_left"), F.lit(3 * n + 64).cast("bigint"))
    picks = unseen.select("user_id", "_left", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(
        F.col("_left") <= 4 * n, F.col("_left")).otherwise(tries) - 1)).alias("d"))
    hashed = draw_int(seed, "user_id", F.lit("rest"), "d")
    few = F.col("_left") <= 4 * n
    ranks = picks.select("user_id", F.when(few, F.col("d")).otherwise(F.pmod(hashed, F.col("_left"))).alias("at"),
                         F.when(few, hashed).otherwise(F.col("d")).alias("key"))
    ranks = ranks.groupBy("user_id", "at").agg(F.min("key").alias("key"))
    chosen = first_per_group(ranks, ["user_id"], ["key", "at"], n, "rank")
    completed = unseen_at(chosen, own, "user_id")
    full = top.join(short, "user_id", "left_anti").select("user_id", "i", "rank").unionByName(
        completed.select("user_id", "i", "rank"))
    return full.join(items, "i").select("user_id", "item_id", "rank")
