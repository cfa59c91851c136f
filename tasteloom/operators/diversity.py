"""Diversification of ranked lists: MMR, seeded sampling, brand caps, reasons."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS, Settings
from tasteloom.functions.scalars import reason_text
from tasteloom.functions.seeded import draw_unit
from tasteloom.functions.vectors import dot, l2_normalize, sum_vectors
from tasteloom.operators.lists import pack_lists
from tasteloom.operators.metrics import evaluate
from tasteloom.operators.ordering import first_per_group
from tasteloom.operators.retrieval import vector_dim

_DIGITS = 9


def min_max_normalize(df: DataFrame, score: str = "score", name: str = "rel", user: str = "user_id") -> DataFrame:
    """Score scaled to [0, 1] inside each list; constant lists keep their values."""
    w = Window.partitionBy(user)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return df.withColumn(name, F.when(high > low, (F.col(score) - low) / (high - low)).otherwise(F.col(score)))


def rank_relevance(df: DataFrame, name: str = "rel", user: str = "user_id") -> DataFrame:
    """1 - rank / length with a 0-based rank."""
    size = F.count("*").over(Window.partitionBy(user))
    return df.withColumn(name, 1.0 - (F.col("rank") - 1) / size)


def mmr_order(relevance: np.ndarray, unit: np.ndarray, k: int, lam: float) -> list[int]:
    """Greedy picks; ``closest`` keeps each row's highest cosine to the picks so far."""
    low, high = relevance.min(), relevance.max()
    rel = (relevance - low) / (high - low) if high > low else relevance
    closest = np.full(len(rel), -np.inf)
    open_ = np.ones(len(rel), bool)
    picks: list[int] = []
    while len(picks) < min(k, len(rel)):
        value = rel if not picks else lam * rel - (1.0 - lam) * closest
        best = int(np.argmax(np.where(open_, np.round(value, _DIGITS), -np.inf)))
        picks.append(best)
        open_[best] = False
        closest = np.maximum(closest, unit @ unit[best])
    return picks


def mmr_rerank(candidates: DataFrame, vectors: DataFrame, k: int, lambdas: Sequence[float] = (0.7,),
               opts: Settings = DEFAULTS) -> DataFrame:
    """MMR order of every list for every lambda: (user_id, lambda, item_id, rank, score).

    ``candidates``: (user_id, item_id, rank, score), bounded lists; ``vectors``:
    (item_id, vec), an id once. Items without a vector are dropped; a list with none at
    all keeps its head unchanged. Lists carry ids only and vectors are broadcast while
    their counted size is under ``opts.broadcast_bytes``; beyond it they are joined.
    """
    levels = [float(x) for x in lambdas]
    rows = candidates.select("user_id", "item_id", "rank", F.col("score").cast("double").alias("score"))
    kinds = dict(candidates.dtypes)
    made = f"user_id {kinds['user_id']}, lambda double, item_id {kinds['item_id']}, rank int, score double"
    n = vectors.count()
    if n * (vector_dim(vectors) if n else 0) * 8 <= opts.broadcast_bytes:
        found = vectors.select("item_id", "vec").toArrow()
        flat = np.array(found["vec"].combine_chunks().flatten(), dtype=float).reshape(n, -1) if n else np.zeros((0, 1))
        flat /= np.linalg.norm(flat, axis=1, keepdims=True) + 1e-9
        shared = candidates.sparkSession.sparkContext.broadcast((pd.Index(found["item_id"].to_pandas()), flat))

        def looked_up(batch: pd.DataFrame) -> Iterator[tuple]:
            index, unit = shared.value
            for ids, ranks, rel in zip(batch["item_id"], batch["rank"], batch["score"]):
                at = index.get_indexer(ids)
                has = at >= 0
                yield (ids[has], rel[has], unit[at[has]]) if has.any() else (ids[ranks <= k], rel[ranks <= k], None)

        return pack_lists(rows, "user_id", "rank", ["item_id", "score"]).mapInPandas(_mmr_kernel(looked_up, k, levels), made)

    known = rows.join(vectors.select("item_id", "vec"), "item_id")
    packed = pack_lists(known, "user_id", "rank", ["item_id", "score", "vec"]).withColumn("vec", F.flatten("vec"))

    def carried(batch: pd.DataFrame) -> Iterator[tuple]:
        for ids, rel, vec in zip(batch["item_id"], batch["score"], batch["vec"]):
            v = np.asarray(vec, np.float64).reshape(len(rel), -1)
            yield ids, rel, v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-9)

    picked = packed.mapInPandas(_mmr_kernel(carried, k, levels), made)
    unknown = rows.join(known.select("user_id").distinct(), "user_id", "left_anti").where(F.col("rank") <= k)
    plain = unknown.withColumn("lambda", F.explode(F.array(*(F.lit(x) for x in levels)))).select(
        "user_id", "lambda", "item_id", F.col("rank").cast("int").alias("rank"), "score")
    return picked.unionByName(plain)


def _mmr_kernel(lists_of, k: int, levels: Sequence[float]):
    """MMR of packed lists; ``lists_of`` gives (ids, relevance, unit vectors) of each row, no vectors to keep a list."""
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            items, scores, sizes = [], [], []
            for ids, rel, unit in lists_of(batch):
                for lam in levels:
                    picks = list(range(len(ids))) if unit is None else mmr_order(rel, unit, k, lam)
                    items.append(ids[picks])
                    scores.append(rel[picks])
                    sizes.append(len(picks))
            yield pd.DataFrame({
                "user_id": np.repeat(np.repeat(batch["user_id"].to_numpy(), len(levels)), sizes),
                "lambda": np.repeat(np.tile(levels, len(batch)), sizes),
                "item_id": np.concatenate(items),
                "rank": np.concatenate([np.arange(1, n + 1) for n in sizes]),
                "score": np.concatenate(scores),
            })

    return kernel


def list_similarity(lists: DataFrame, vectors: DataFrame, group: Sequence[str] = ("user_id",),
                    opts: Settings = DEFAULTS) -> DataFrame:
    """Mean pairwise cosine of each list without forming pairs.

    For unit vectors the pair sum is (|sum v|^2 - sum |v|^2) / 2, so one vector sum
    per list is enough. Lists with a single item have no pairs and are left out. While the
    vectors are under ``opts.broadcast_bytes`` they are broadcast and lists carry ids only;
    beyond it every list row is joined with its vector.
    """
    dim, count = vector_dim(vectors), vectors.count()
    unit = vectors.select("item_id", l2_normalize("vec").alias("vec"))
    if count and dim and 0 < count * dim * 8 <= opts.broadcast_bytes:
        return _packed_similarity(lists, unit, group, dim)
    sums = lists.join(unit, "item_id").groupBy(*group).agg(
        sum_vectors("vec", dim).alias("s"), F.sum(dot("vec", "vec")).alias("q"), F.count("*").alias("n")
    ).where(F.col("n") > 1)
    return sums.select(*group, "n", ((dot("s", "s") - F.col("q")) / (F.col("n") * (F.col("n") - 1))).alias("similarity"))


def _packed_similarity(lists: DataFrame, unit: DataFrame, group: Sequence[str], dim: int) -> DataFrame:
    """``list_similarity`` of packed ids against a broadcast table; an id with several vectors counts with all of them."""
    found = unit.where(F.col("item_id").isNotNull()).toArrow()
    codes, ids = pd.factorize(found["item_id"].to_pandas())
    has = found["vec"].is_valid().to_numpy()
    flat = found["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    sums, squares = np.zeros((len(ids), dim)), np.zeros(len(ids))
    np.add.at(sums, codes[has], flat)
    np.add.at(squares, codes[has], (flat * flat).sum(1))
    counts, filled = np.bincount(codes, minlength=len(ids)), np.bincount(codes[has], minlength=len(ids))
    shared = lists.sparkSession.sparkContext.broadcast((pd.Index(ids), sums, squares, counts, filled))
    keys = [f.name for f in lists.select(*group).schema.fields]
    packed = lists.groupBy(*group).agg(F.sort_array(F.collect_list("item_id")).alias("_ids")).where(F.size("_ids") > 0)
    kinds = dict(packed.dtypes)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums, squares, counts, filled = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(len(keys))
            at = index.get_indexer(column.flatten().to_pandas())
            starts = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())[:-1]])
            known = (at >= 0).astype(float)
            n = np.add.reduceat(counts[at] * known, starts).astype(np.int64)
            q = np.add.reduceat(squares[at] * known, starts)
            total = np.add.reduceat(sums[at] * known[:, None], starts, axis=0)
            some = np.add.reduceat(filled[at] * known, starts) > 0
            value = ((total * total).sum(1) - q) / np.maximum(n * (n - 1), 1)
            made = [*batch.columns[: len(keys)], pa.array(n), pa.array(value, mask=~some)]
            yield pa.RecordBatch.from_arrays(made, names=[*keys, "n", "similarity"]).filter(pa.array(n > 1))

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "n bigint", "similarity double"])
    return packed.select(*keys, "_ids").mapInArrow(kernel, schema)


def intra_list_similarity(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    return list_similarity(lists, vectors).agg(F.avg("similarity").alias("intra_list_similarity"))


def mmr_sweep(candidates: DataFrame, vectors: DataFrame, truth: DataFrame, catalog_size: int, k: int = 10,
              lambdas: Sequence[float] = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5)) -> DataFrame:
    """NDCG, recall, coverage and intra-list similarity per lambda, one MMR pass for all."""
    from tasteloom.session import write_stage

    orders = write_stage(mmr_rerank(candidates, vectors, k, lambdas), "mmr")
    similarity = list_similarity(orders, vectors, ["lambda", "user_id"]).groupBy("lambda").agg(
        F.avg("similarity").alias("intra_list_similarity")
    )
    table = None
    for lam in lambdas:
        row = evaluate(orders.where(F.col("lambda") == lam), truth, catalog_size, [k]).select(
            F.lit(float(lam)).alias("lambda"), f"ndcg_{k}", f"recall_{k}", f"coverage_{k}"
        )
        table = row if table is None else table.unionByName(row)
    return table.join(similarity, "lambda", "left")


def race_key(rank: Column, seed: int, temperature: float, half_life: float, *keys: Column | str) -> Column:
    weight = F.exp(-(rank - 1) / F.lit(max(temperature * half_life, 1e-6)))
    return F.round(-F.log(draw_unit(seed, *keys)) / weight, _DIGITS)


def temperature_sample(lists: DataFrame, n: int, temperature: float = 1.0, seed: int = DEFAULTS.seed,
                       half_life: float = 40.0, user: str = "user_id") -> DataFrame:
    """Seeded weighted sample without replacement, output in rank order.

    Weight exp(-rank / (temperature * half_life)); the ``n`` smallest -ln(u) / weight
    are such a sample. Temperature 0, or a list of at most ``n``, keeps the head.
    """
    by_rank = Window.partitionBy(user).orderBy("rank")
    if temperature <= 0:
        return lists.where(F.col("rank") <= n)
    keyed = lists.withColumn("_key", race_key(F.col("rank"), seed, temperature, half_life, user, "item_id"))
    chosen = first_per_group(keyed, [user], ["_key", "rank"], n).drop("_key")
    return chosen.withColumn("rank", F.row_number().over(by_rank))


def brand_cap(lists: DataFrame, n: int, cap: int = 2, user: str = "user_id") -> DataFrame:
    """At most ``cap`` items per brand in the first ``n``; blank brands are free;
    capped items return only to fill a short page."""
    brand = F.lower(F.coalesce("brand", F.lit("")))
    in_brand = F.row_number().over(Window.partitionBy(user, brand).orderBy("rank"))
    over = F.when((brand != "") & (in_brand > cap), 1).otherwise(0)
    flagged = lists.withColumn("_over", over).withColumnRenamed("rank", "_raw")
    return first_per_group(flagged, [user], ["_over", "_raw"], n, "rank").drop("_over", "_raw")


def prior_items_rank(history: DataFrame, items: DataFrame) -> DataFrame:
    """Most recent history item per user and category."""
    known = history.select("user_id", "item_id", F.col("rank").alias("hist_rank")).join(
        items.select("item_id", "title", "category"), "item_id"
    ).where(F.coalesce("category", F.lit("")) != "")
    return first_per_group(known, ["user_id", "category"], ["hist_rank"]).select(
        "user_id", "category", "item_id",
        F.coalesce(F.nullif("title", F.lit("")), F.col("item_id").cast("string")).alias("title"), "hist_rank",
    )


def attach_reasons(lists: DataFrame, history: DataFrame, items: DataFrame) -> DataFrame:
    """Column ``reason`` from the latest history item of the same category, unless the
    recommended item is itself in the history."""
    source = prior_items_rank(history, items).select("user_id", "category", F.col("title").alias("_title"))
    mine = history.select("user_id", "item_id", F.lit(True).alias("_known"))
    return (
        lists.join(source, ["user_id", "category"], "left")
        .join(mine, ["user_id", "item_id"], "left")
        .withColumn("reason", F.when(F.col("_known").isNull(), reason_text("_title")))
        .select(*lists.columns, "reason")
    )


def popular_pool(head: DataFrame, n: int) -> DataFrame:
    """Popularity pool of max(3n, 60) items as a list with rank-based relevance."""
    size = max(3 * n, 60)
    return head.where(F.col("pop_rank") <= size).select("item_id", F.col("pop_rank").cast("int").alias("rank"))


def popular_feed(users: DataFrame, head: DataFrame, vectors: DataFrame, n: int, temperature: float = 1.0,
                 seed: int = DEFAULTS.seed, mmr_lambda: float = 1.0, half_life: float = 40.0) -> DataFrame:
    """Popularity feed per user: pool, optional MMR (once, the pool is shared), sample.

    The pool has max(3n, 60) rows whatever the data, so each user carries it as one
    small array and draws from it inside the row: no shuffle after ``users``.
    """
    pool = popular_pool(head, n).withColumn("user_id", F.lit(0))
    if mmr_lambda < 0.999:
        scored = rank_relevance(pool).select("user_id", "item_id", "rank", F.col("rel").alias("score"))
        pool = mmr_rerank(scored, vectors, max(3 * n, 60), [mmr_lambda]).select("user_id", "item_id", "rank")
    packed = pool.agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("_pool"))
    lists = (
        users.select("user_id").distinct().withColumn("_one", F.lit(1))
        .join(F.broadcast(packed.withColumn("_one", F.lit(1))), "_one")  # single row
    )
    chosen = F.slice("_pool", 1, n)
    if temperature > 0:
        def keyed(p: Column) -> Column:
            return F.struct(race_key(p["rank"], seed, temperature, half_life, "user_id", p["item_id"]).alias("key"), p["rank"], p["item_id"])

        raced = F.slice(F.array_sort(F.transform("_pool", keyed)), 1, n)
        chosen = F.array_sort(F.transform(raced, lambda p: F.struct(p["rank"], p["item_id"])))
    return lists.select("user_id", F.posexplode(chosen).alias("_n", "_p")).select(
        "user_id", F.col("_p.item_id").alias("item_id"), (F.col("_n") + 1).alias("rank")
    )


def similar_guarded(seeds: DataFrame, similar: DataFrame, items: DataFrame, fallback: DataFrame,
                    n: int = 10) -> DataFrame:
    """Neighbours of each seed kept to its own category and topped up from that
    category's best-rated items.

    ``similar``: (item_id, neighbor_id, rank) at least 3n deep; ``fallback``: ranked
    (rank, item_id) for seeds without neighbours. Top-up needs only the first 2n + 1
    of a category, because at most n + 1 of them can be excluded.
    """
    kinds = items.select("item_id", "category")
    seeded = seeds.select("item_id").distinct().join(kinds, "item_id", "left")
    near = similar.where(F.col("rank") <= 3 * n).select("item_id", "neighbor_id", F.col("rank").alias("r"))
    popular = fallback.where(F.col("rank") <= 3 * n).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), F.col("item_id").alias("neighbor_id")))).alias("_p")
    ).withColumn("_one", F.lit(1))
    without = seeded.join(near.select("item_id").distinct(), "item_id", "left_anti").withColumn("_one", F.lit(1)).join(
        F.broadcast(popular), "_one"  # single row of at most 3n entries
    ).select("item_id", F.inline("_p")).select("item_id", "neighbor_id", "r")
    raw = near.join(seeded.select("item_id"), "item_id", "left_semi").unionByName(without)
    with_kind = raw.join(seeded, "item_id").join(
        kinds.select(F.col("item_id").alias("neighbor_id"), F.col("category").alias("_nc")), "neighbor_id", "left"
    )
    same = with_kind.where((F.col("category") != "") & (F.col("_nc") == F.col("category")))
    best = first_per_group(
        items.where(F.col("category").isNotNull()).select("item_id", "category", "avg_rating"),
        ["category"], [F.desc_nulls_last("avg_rating"), F.asc("item_id")], 2 * n + 1, "cr",
    ).select(F.col("item_id").alias("neighbor_id"), "category", "cr")
    kept = same.select("item_id", "neighbor_id", F.lit(0).alias("prio"), F.col("r").cast("int").alias("r"))
    fill = (
        seeded.where(F.col("category") != "").join(best, "category")
        .where(F.col("neighbor_id") != F.col("item_id"))
        .join(kept.select("item_id", "neighbor_id"), ["item_id", "neighbor_id"], "left_anti")
        .select("item_id", "neighbor_id", F.lit(1).alias("prio"), F.col("cr").cast("int").alias("r"))
    )
    guarded = kept.unionByName(fill)
    no_neighbours = without.select("item_id").distinct().withColumn("_pop", F.lit(True))
    plain = raw.join(guarded.select("item_id").distinct(), "item_id", "left_anti").select(
        "item_id", "neighbor_id", F.lit(2).alias("prio"), F.col("r").cast("int").alias("r")
    )
    top = first_per_group(guarded.unionByName(plain), ["item_id"], ["prio", "r"], n, "rank")
    return top.join(no_neighbours, "item_id", "left").select(
        "item_id", "neighbor_id", "rank",
        F.when(F.col("prio") < 2, "Similar items (embedding + category)")
        .when(F.col("_pop"), "Popular right now")
        .otherwise("Similar items (embedding cosine)").alias("model_label"),
    )


def because_you_liked(history: DataFrame, users: DataFrame, similar: DataFrame, fallback: DataFrame,
                      n: int = 10) -> DataFrame:
    """Neighbours of each user's latest item. Users without history, or whose latest
    item has no neighbours, get the popularity list."""
    latest = history.where(F.col("rank") == 1).select("user_id", F.col("item_id").alias("seed_item"))
    near = similar.where(F.col("rank") <= n).select(
        F.col("item_id").alias("seed_item"), F.col("neighbor_id").alias("item_id"), F.col("rank").cast("int").alias("rank")
    )
    liked = latest.join(near, "seed_item").select(
        "user_id", "item_id", "rank", F.lit("Because you liked this").alias("model_label")
    )
    popular = fallback.where(F.col("rank") <= n).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").cast("int").alias("rank"), "item_id"))).alias("_p")
    ).withColumn("_one", F.lit(1))
    has_history = latest.select("user_id", F.lit(True).alias("_seen"))
    rest = (
        users.select("user_id").distinct()
        .join(liked.select("user_id").distinct(), "user_id", "left_anti")
        .join(has_history, "user_id", "left")
        .withColumn("_one", F.lit(1)).join(F.broadcast(popular), "_one")  # single row of n entries
        .withColumn("model_label", F.when(F.col("_seen"), "Because you liked this").otherwise("Popular right now"))
        .select("user_id", "model_label", F.inline("_p"))
    )
    return liked.unionByName(rest.select("user_id", "item_id", "rank", "model_label"))
