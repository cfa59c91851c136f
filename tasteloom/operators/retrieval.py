"""Top-N vector retrieval: exact, cell-partitioned, and item-to-item.

Scores come from block matrix products inside Arrow batches; only ``n`` rows per
query and block leave a task, so query x item pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.config import DEFAULTS, Settings
from tasteloom.functions.vectors import l2_normalize, mean_vectors
from tasteloom.operators.ordering import first_per_group
from tasteloom.operators.splitting import exclude_seen
from tasteloom.session import drop_stage, write_stage

_DIGITS = 9  # scores are compared after rounding, so block shapes cannot reorder ties
_GROUP = 8  # scores whose maximum stands for them while the weakest score of a list is sought
_SINGLE = 1e15  # longest vectors whose products are surely within single precision
_TASK_PAIRS = 1 << 31  # (query, item) pairs of one task: some ten seconds
_TILE_ITEMS = 2048  # items of one tile of scores, for short lists
_TILE_SCORES = 1 << 20  # scores of one tile
_CROWDED = 16  # places for each one wanted, beyond which they are ranked before going on
_RANKED_AT_ONCE = 1 << 16  # vectors gathered at once to be ranked
_MOST_PARTS = 16  # item matrices of so many broadcast bounds are searched part by part
_ID_BYTES = 32  # of one id in a broadcast table
_ASKED_AT_ONCE = 2048  # queries whose lists of all their cells are held at once
_FEW_ITEMS = 1024  # a query over so few costs no more than reading it, however many there are


def vector_dim(vectors: DataFrame, column: str = "vec") -> int:
    row = vectors.select(F.size(column).alias("d")).first()
    return row["d"] if row else 0


def matrix_of(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _keys_of(column) -> np.ndarray:
    return np.asarray(column.to_pylist() if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)
                      if isinstance(column, pa.Array) else column.to_numpy())


def _hopeful(queries: np.ndarray, items: np.ndarray, take: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, item) places of all scores that may be among the best ``take`` of a query when scores are off by half of ``slack``.

    The ``take``-th largest of the maxima of groups of scores is not above the ``take``-th
    largest score, and costs an eighth of its search; only groups that reach it are read again.
    """
    scores = queries @ items.T
    width = scores.shape[1]
    if take >= width:
        return np.divmod(np.arange(scores.size), width)
    groups = width // _GROUP if take * 2 <= width // _GROUP else 0
    body = groups * _GROUP
    tops = scores if not groups else np.concatenate(
        [scores[:, :body].reshape(len(scores), _GROUP, groups).max(axis=1), scores[:, body:]], axis=1)
    place = tops.shape[1] - take
    floor = np.partition(tops, place, axis=1)[:, place] - slack
    rows, cols = np.nonzero(tops >= floor[:, None])
    if not groups:
        return rows, cols
    grouped = cols < groups
    wide = cols[grouped, None] + groups * np.arange(_GROUP)
    own = rows[grouped, None]
    hit = scores[own, wide] >= floor[own]
    rest = ~grouped
    return (np.concatenate([np.broadcast_to(own, wide.shape)[hit], rows[rest]]),
            np.concatenate([wide[hit], cols[rest] - groups + body]))


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that hold; several times faster than ``np.nonzero`` of a matrix with few of them."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def _wide(take: int) -> int:
    """Items of one tile: at least four groups for each place of a list, so that its first bound is not far below."""
    return max(_TILE_ITEMS, 4 * _GROUP * take)


def _ranked(queries: np.ndarray, items: np.ndarray, take: int, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``take`` of the named (query, item) places of each query, scored in double precision."""
    order = np.argsort(rows, kind="stable")
    cols, ends = cols[order], np.searchsorted(rows[order], np.arange(len(queries) + 1))
    kept, vals = [], []
    for query, start, end in zip(queries, ends[:-1], ends[1:]):
        own = np.sort(cols[start:end])
        score = np.concatenate([np.einsum("ij,j->i", items.take(own[at: at + _RANKED_AT_ONCE], axis=0), query)
                                for at in range(0, max(1, len(own)), _RANKED_AT_ONCE)]).round(_DIGITS)
        best = np.argsort(-score, kind="stable")[:take]
        kept.append(own[best])
        vals.append(score[best])
    return np.repeat(np.arange(len(queries)), [len(k) for k in kept]), np.concatenate(kept), np.concatenate(vals)


def _best_of_tiles(queries: np.ndarray, items: np.ndarray, rough: np.ndarray, take: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``take`` items of each query, the items read in tiles whose scores stay in the processor's cache.

    The ``take``-th largest maximum of the groups read so far bounds each query's weakest score from
    below. It is sought again whenever the tiles read have doubled, so a query keeps some ``take``
    places for each doubling; where more come together, they are ranked and cut to ``take`` at once.
    """
    wide, near = _wide(take), queries.astype(rough.dtype, copy=False)
    most = 4 * _GROUP * take
    tops = np.empty((len(near), most + wide // _GROUP + _GROUP), rough.dtype)
    room = np.empty(len(near) * wide, rough.dtype)  # fresh memory for each tile is slow
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    done = held = 0

    def weakest() -> np.ndarray:
        return (np.partition(tops[:, :done], done - take, axis=1)[:, done - take] - slack).astype(rough.dtype)

    def cut(floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, cols, vals = (np.concatenate(x) for x in zip(*found))
        keep = vals >= floor[rows]
        return rows[keep], cols[keep], vals[keep]

    for tile, at in enumerate(range(0, len(rough), wide)):
        width = len(rough[at : at + wide])
        flat = room[: len(near) * width]
        scores = np.matmul(near, rough[at : at + wide].T, out=flat.reshape(-1, width))
        groups = width // _GROUP
        body = groups * _GROUP
        rest, own = scores[:, body:], tops[:, done : done + groups]
        if groups:
            scores[:, :body].reshape(len(near), _GROUP, groups).max(axis=1, out=own)
        tops[:, done + groups : done + groups + width - body] = rest
        done += groups + width - body
        if not tile & (tile + 1):  # 1, 2, 4 ... tiles
            floor = weakest()
        for top, first, size in ((own, 0, _GROUP), (rest, body, 1)):
            if not top.shape[1]:
                continue
            rows, cols = _places(top >= floor[:, None])
            if size > 1:  # members of a group lie ``groups`` apart
                places = (rows * width + cols)[:, None] + groups * np.arange(size)
                vals = flat.take(places)
                hit, member = _places(vals >= floor.take(rows)[:, None])
                rows, cols, vals = rows.take(hit), cols.take(hit) + groups * member, vals[hit, member]
            else:
                vals = top[rows, cols]
            found.append((rows, cols + (first + at), vals))
            held += len(rows)
        while done > most:  # larger groups bound almost as well
            half, odd = divmod(done, 2)
            np.maximum(tops[:, :half], tops[:, half : 2 * half], out=tops[:, :half])
            if odd:
                tops[:, half] = tops[:, done - 1]
            done = half + odd
        if held > _CROWDED * take * len(near):
            floor = weakest()
            rows, cols, vals = cut(floor)
            if 2 * len(rows) > _CROWDED * take * len(near):
                rows, cols, _ = _ranked(queries, items, take, rows, cols)
                vals = np.full(len(rows), np.inf, rough.dtype)  # to be ranked again at the end
            found, held = [(rows, cols, vals)], len(rows)
    rows, cols, _ = cut(weakest())
    return _ranked(queries, items, take, rows, cols)


def best_of_block(queries: np.ndarray, items: np.ndarray, n: int, score_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of queries and items with their scores, best ``n`` per query.

    ``items`` must be in ascending key order: equal scores then resolve to the
    smaller key. All pairs are scored in single precision; those that may be among the
    best, given its error bound, are scored again in double precision and ranked by that.
    """
    take = min(n, len(items))
    if not len(queries) or not take:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    step = max(1, score_bytes // (8 * len(items)))
    sizes, longest = np.sqrt(np.einsum("ij,ij->i", queries, queries)), np.sqrt(np.einsum("ij,ij->i", items, items).max())
    if not (np.isfinite(longest) and np.isfinite(sizes).all()):
        return _best_plain(queries, items, take, step)
    kind = np.float32 if max(longest, sizes.max()) < _SINGLE else np.float64
    error = (items.shape[1] + 8) * float(np.finfo(kind).eps) * longest * sizes
    slack = 2 * error + 2 * 10.0**-_DIGITS
    rough = items.astype(kind, copy=False)
    tiled = len(items) > _wide(take)
    if tiled:
        step = max(1, min(_TILE_SCORES // _wide(take), score_bytes * _GROUP // (8 * len(items))))
    rows, cols, vals = [], [], []
    for start in range(0, len(queries), step):
        part, off = queries[start : start + step], slack[start : start + step]
        if tiled:
            r, c, score = _best_of_tiles(part, items, rough, take, off)
        else:
            r, c, score = _ranked(part, items, take, *_hopeful(part.astype(kind, copy=False), rough, take, off))
        rows.append(start + r)
        cols.append(c)
        vals.append(score)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def _best_plain(queries: np.ndarray, items: np.ndarray, take: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by full double precision, for vectors with places that are not finite."""
    rows, cols, vals = [], [], []
    for start in range(0, len(queries), step):
        scores = np.round(queries[start : start + step] @ items.T, _DIGITS)
        if take < scores.shape[1]:
            floor = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
        else:
            floor = np.full(len(scores), -np.inf)
        for r, line in enumerate(scores):
            hit = np.flatnonzero(line >= floor[r])
            hit = hit[np.argsort(-line[hit], kind="stable")[:take]]
            rows.append(np.full(len(hit), start + r))
            cols.append(hit)
            vals.append(line[hit])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def _output(key: str, queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField(key, queries.schema[key].dataType),
        T.StructField("item_id", items.schema["item_id"].dataType),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _unseen(rows: np.ndarray, cols: np.ndarray, lists: pa.Array, item_keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which (query, item) places are of items that the query's list does not hold; ``first``: the place of an equal key."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    held = _keys_of(lists.flatten())
    if not len(held):
        return np.ones(len(rows), bool)
    at = np.minimum(np.searchsorted(item_keys, held), len(item_keys) - 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    known = item_keys[at] == held
    return np.isin(rows * len(item_keys) + first[cols], owner[known] * len(item_keys) + at[known], invert=True)


def _shared_items(items: DataFrame, dim: int) -> tuple[np.ndarray, Broadcast]:
    """Ids in ascending order, and a broadcast of them with their vectors."""
    table = items.select("item_id", "vec").toArrow()
    keys = _keys_of(table.column("item_id"))
    order = np.argsort(keys, kind="stable")
    return keys[order], items.sparkSession.sparkContext.broadcast((keys[order], matrix_of(table.column("vec"), dim)[order]))


def _ids_of(items: DataFrame, count: int, opts: Settings) -> DataFrame:
    """Distinct ids; within the broadcast bound a semi join with them comes before any shuffle of the other side."""
    ids = items.select("item_id").distinct()
    return F.broadcast(ids) if count * _ID_BYTES <= opts.broadcast_bytes else ids


def _with_seen(queries: DataFrame, items: DataFrame, count: int, key: str, seen: DataFrame, opts: Settings) -> DataFrame:
    """(key, vec, _seen): the ids of a query's seen items that have a vector, which are no more than these ids."""
    listed = seen.select(key, "item_id").join(_ids_of(items, count, opts), "item_id", "left_semi")
    held = F.collect_list(F.col("item_id").cast(items.schema["item_id"].dataType))
    return queries.select(key, "vec").join(listed.groupBy(key).agg(held.alias("_seen")), key, "left").select(key, "vec", "_seen")


def _search_small(queries: DataFrame, items: DataFrame, n: int, key: str, dim: int, opts: Settings,
                  seen: DataFrame | None = None, kept: int | None = None) -> DataFrame:
    """Items under the broadcast bound: one map over the queries, cut into tasks of a bounded number of pairs.

    With ``seen`` a query carries the ids of its seen items that have a vector, which are no more than the
    broadcast ids; they leave its list where it is made, so no list is shuffled. Other seen items go
    where they are read, before they are made distinct: the ids are within the broadcast bound.
    """
    keys, shared = _shared_items(items, dim)
    schema = _output(key, queries, items)
    out, drops = _arrow_schema(schema), seen is not None

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_keys, matrix = shared.value
        first = np.searchsorted(item_keys, item_keys)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, cols, vals = best_of_block(matrix_of(batch.column(1), dim), matrix, n, opts.score_bytes)
            if drops:
                new = _unseen(rows, cols, batch.column(2), item_keys, first)
                rows, cols, vals = rows[new], cols[new], vals[new]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
            if kept is not None:
                head = rank <= kept
                rows, cols, vals, rank = rows[head], cols[head], vals[head], rank[head]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)).cast(out.field(0).type),
                    pa.array(item_keys[cols], type=out.field(1).type),
                    pa.array(vals),
                    pa.array(rank, type=pa.int32()),
                ],
                schema=out,
            )

    asked = queries.select(key, "vec")
    if seen is not None:
        asked = _with_seen(queries, items, len(keys), key, seen, opts)
    if len(keys) > _FEW_ITEMS:
        asked = write_stage(asked, "asked")
        tasks = -(-asked.count() * len(keys) // _TASK_PAIRS)
        if tasks > 1:
            asked = asked.repartition(max(tasks, asked.sparkSession.sparkContext.defaultParallelism), key)
    return asked.mapInArrow(search, schema)


def _search_parts(queries: DataFrame, items: DataFrame, n: int, key: str, dim: int, parts: int, opts: Settings,
                  seen: DataFrame | None = None, kept: int | None = None) -> DataFrame:
    """Items of a few broadcast bounds: one map over the queries for each part, which hands on the best ``n`` so far.

    A query's list is one row and never shuffled; the files of a step are deleted after the next one. With
    ``seen`` a query carries its seen ids as in ``_search_small``, and they leave the whole list at the end.
    """
    schema, drops = _output(key, queries, items), seen is not None
    ids_type = T.ArrayType(schema[1].dataType)
    carried = T.StructType([schema[0], T.StructField("vec", T.ArrayType(T.DoubleType())),
                            *([T.StructField("_seen", ids_type)] if drops else []),
                            T.StructField("ids", ids_type), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    out, flat = _arrow_schema(carried), _arrow_schema(schema)

    def step(shared: Broadcast):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            item_keys, matrix = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows, cols, vals = best_of_block(matrix_of(batch.column(1), dim), matrix, n, opts.score_bytes)
                ids = item_keys[cols]
                if batch.num_columns == len(out):
                    old, ids_before, vals_before = listed(batch)
                    rows, ids, vals = np.concatenate([old, rows]), np.concatenate([ids_before, ids]), np.concatenate([vals_before, vals])
                order = np.lexsort((ids, -vals, rows))
                rows, ids, vals = rows[order], ids[order], vals[order]
                head = np.arange(len(rows)) - np.searchsorted(rows, rows) < n
                rows, ids, vals = rows[head], ids[head], vals[head]
                ends = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)), type=pa.int32())
                found = [pa.ListArray.from_arrays(ends, pa.array(ids, type=out.field(at - 1).type.value_type)),
                         pa.ListArray.from_arrays(ends, pa.array(vals))]
                columns = [*batch.columns[:at - 1], *found]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

        return search

    at = len(out) - 1  # of the scores; the ids stand before them

    def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = batch.column(at).value_lengths().to_numpy(zero_copy_only=False)
        return (np.repeat(np.arange(len(sizes)), sizes), _keys_of(batch.column(at - 1).flatten()),
                batch.column(at).flatten().to_numpy())

    def fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, vals = listed(batch)
            if not len(rows):
                continue
            known, cols = np.unique(ids, return_inverse=True)
            new = _unseen(rows, cols, batch.column(2), known, np.arange(len(known)))
            rows, cols, vals = rows[new], cols[new], vals[new]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
            head = rank <= (n if kept is None else kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[head])).cast(flat.field(0).type), pa.array(known[cols[head]], type=flat.field(1).type),
                 pa.array(vals[head]), pa.array(rank[head], type=pa.int32())], schema=flat)

    items = write_stage(items.select("item_id", "vec"), "items")
    count = items.count()
    state = write_stage(_with_seen(queries, items, count, key, seen, opts) if drops else queries.select(key, "vec"), "asked")
    context = state.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-state.count() * count // (parts * _TASK_PAIRS)))
    spread = state.repartition(tasks, key)
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        keys, shared = _shared_items(own, dim)
        if len(keys):
            before, state = state, write_stage(spread.mapInArrow(step(shared), carried), "best")
            spread = state
            drop_stage(before)
        shared.destroy()
    drop_stage(items)
    if drops:
        return state.mapInArrow(fresh, schema)
    exploded = state.select(key, F.posexplode(F.arrays_zip("ids", "scores")).alias("_at", "_one"))
    return exploded.select(key, F.col("_one.ids").alias("item_id"), F.col("_one.scores").alias("score"),
                         (F.col("_at") + 1).alias("rank"))


def _search_grid(queries: DataFrame, items: DataFrame, n: int, key: str, dim: int, opts: Settings) -> DataFrame:
    """Cells of bounded blocks: (cell, query block, item block) is one task-sized product.

    Both sides carry ``_cell``. A crowded cell is cut into more blocks, so no group
    grows with the data. A vector is shuffled once per block of the other side, and each pair
    of blocks gives ``n`` rows per query, so blocks are as large as a task's memory allows:
    ``opts.vector_block`` vectors, or those that fill half of ``opts.score_bytes`` if more.
    """
    block = max(opts.vector_block, opts.score_bytes // (16 * max(1, dim)))

    def sized(df: DataFrame, name: str, most: int) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count("*") / most).cast("int").alias(name))

    sizes = sized(queries, "_nq", max(opts.vector_block, block // 2)).join(sized(items, "_ni", block), "_cell")  # one row per cell
    cells = F.broadcast(sizes)
    left = (
        queries.join(cells, "_cell")
        .withColumn("_qb", F.pmod(F.xxhash64(key), F.col("_nq")).cast("int"))
        .withColumn("_ib", F.explode(F.sequence(F.lit(0), F.col("_ni") - 1)))
        .select("_cell", "_qb", "_ib", key, "vec")
    )
    right = (
        items.join(cells, "_cell")
        .withColumn("_ib", F.pmod(F.xxhash64("item_id"), F.col("_ni")).cast("int"))
        .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_nq") - 1)))
        .select("_cell", "_qb", "_ib", "item_id", "vec")
    )
    schema = _output(key, queries, items)
    out = _arrow_schema(schema)

    def product(q: pa.Table, m: pa.Table) -> pa.Table:
        if not q.num_rows or not m.num_rows:
            return out.empty_table()
        keys = _keys_of(m.column("item_id"))
        order = np.argsort(keys, kind="stable")
        rows, cols, vals = best_of_block(
            matrix_of(q.column("vec"), dim), matrix_of(m.column("vec"), dim)[order], n, opts.score_bytes
        )
        return pa.Table.from_arrays(
            [
                q.column(key).take(pa.array(rows)).cast(out.field(0).type),
                pa.array(keys[order][cols], type=out.field(1).type),
                pa.array(vals),
                pa.array(np.zeros(len(rows)), type=pa.int32()),
            ],
            schema=out,
        )

    places = ["_cell", "_qb", "_ib"]
    partial = left.groupBy(*places).cogroup(right.groupBy(*places)).applyInArrow(product, schema)
    best = first_per_group(partial.drop("rank"), [key], [F.desc("score"), F.asc("item_id")], n, "rank")
    return best.select(key, "item_id", "score", "rank")


def topn_inner_product(queries: DataFrame, items: DataFrame, n: int, key: str = "user_id",
                       normalize: bool = False, opts: Settings = DEFAULTS) -> DataFrame:
    """Exact top ``n`` items per query vector by inner product (cosine when ``normalize``).

    ``queries``: (key, vec) with unique keys; ``items``: (item_id, vec). Returns
    (key, item_id, score, rank). The item matrix is broadcast only when its counted
    size is under ``opts.broadcast_bytes``. Up to ``_MOST_PARTS`` times that, parts of it are
    broadcast one after another; beyond, the block grid is used.
    """
    return _searched(queries, items, n, key, normalize, opts)


def _searched(queries: DataFrame, items: DataFrame, n: int, key: str, normalize: bool, opts: Settings,
              seen: DataFrame | None = None, kept: int | None = None) -> DataFrame:
    """The top ``n`` of all items; with ``seen`` those leave the list afterwards and its first ``kept`` stay, ranked anew."""
    dim = vector_dim(items)
    if normalize:
        queries = queries.withColumn("vec", l2_normalize("vec"))
        items = items.withColumn("vec", l2_normalize("vec"))
    size = items.count() * dim * 8
    if size <= opts.broadcast_bytes:
        return _search_small(queries, items, n, key, dim, opts, seen, kept)
    if size <= _MOST_PARTS * opts.broadcast_bytes:
        parts = -(-size * 9 // (8 * opts.broadcast_bytes))  # hashed parts are not quite equal
        return _search_parts(queries, items, n, key, dim, parts, opts, seen, kept)
    cell, asked = F.lit(0), write_stage(queries.select(key, "vec"), "asked")
    found = _search_grid(asked.withColumn("_cell", cell), items.withColumn("_cell", cell), n, key, dim, opts)
    if seen is None:
        return found
    fresh = exclude_seen(found.withColumnRenamed("rank", "_raw"), seen)
    return first_per_group(fresh, [key], ["_raw"], kept, "rank").select(key, "item_id", "score", "rank")


# ---------------------------------------------------------------- cells
def train_cells(items: DataFrame, nlist: int = 256, seed: int = DEFAULTS.seed, iterations: int = 10) -> DataFrame:
    """Cell centroids (item_id = cell number, vec) by MLlib k-means on unit vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = items.select(array_to_vector(l2_normalize("vec")).alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=iterations).fit(data)
    rows = [(n, [float(x) for x in center]) for n, center in enumerate(model.clusterCenters())]
    return items.sparkSession.createDataFrame(rows, "item_id bigint, vec array<double>")


def label_cells(labelled: DataFrame, label: str, dim: int) -> DataFrame:
    """Centroids from an existing grouping of the vectors."""
    return labelled.groupBy(F.col(label).cast("bigint").alias("item_id")).agg(mean_vectors("vec", dim).alias("vec"))


def topn_ivf(queries: DataFrame, items: DataFrame, cells: DataFrame, n: int, nprobe: int = 16,
             key: str = "user_id", opts: Settings = DEFAULTS) -> DataFrame:
    """Approximate cosine top ``n``: items live in their nearest cell, a query looks into
    its ``nprobe`` nearest cells. With nprobe = number of cells the result is exact."""
    dim = vector_dim(cells)
    queries = write_stage(queries.select(key, "vec").withColumn("vec", l2_normalize("vec")), "asked")
    items = items.withColumn("vec", l2_normalize("vec"))
    home = write_stage(topn_inner_product(
        items.select(F.col("item_id").alias("_id"), "vec"), cells, 1, "_id", opts=opts
    ).select(F.col("_id").alias("item_id"), F.col("item_id").alias("_cell")), "home")
    housed = items.join(home, "item_id").select("_cell", "item_id", "vec")
    if max(home.count(), cells.count()) * dim * 8 <= opts.broadcast_bytes:
        return _search_cells(queries.where(F.col(key).isNotNull()), housed, cells, n, nprobe, key, dim, opts)
    probes = write_stage(topn_inner_product(queries, cells, nprobe, key, opts=opts).select(
        key, F.col("item_id").alias("_cell")
    ), "probes")
    return _search_grid(queries.join(probes, key).select("_cell", key, "vec"), housed, n, key, dim, opts)


def _search_cells(queries: DataFrame, items: DataFrame, cells: DataFrame, n: int, nprobe: int, key: str, dim: int,
                  opts: Settings) -> DataFrame:
    """Items (_cell, item_id, vec) under the broadcast bound: a query looks into its cells in one task, so neither
    the query is copied to each cell nor are the lists of the cells shuffled."""
    table = items.select("_cell", "item_id", "vec").toArrow()
    keys, homes = _keys_of(table.column("item_id")), table.column("_cell").to_numpy()
    order = np.lexsort((keys, homes))
    numbers, centers = _shared_items(cells, dim)
    shared = items.sparkSession.sparkContext.broadcast((
        keys[order], np.argsort(np.argsort(keys[order], kind="stable")), matrix_of(table.column("vec"), dim)[order],
        np.searchsorted(homes[order], numbers), np.searchsorted(homes[order], numbers, "right")))
    schema = _output(key, queries, items)
    out = _arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_keys, places, matrix, low, high = shared.value
        _numbers, middle = centers.value
        for whole in batches:
            for batch in (whole.slice(at, _ASKED_AT_ONCE) for at in range(0, whole.num_rows, _ASKED_AT_ONCE)):
                asked = matrix_of(batch.column(1), dim)
                prober, probed, _score = best_of_block(asked, middle, nprobe, opts.score_bytes)
                found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
                for cell in np.unique(probed):
                    own = prober[probed == cell]
                    r, c, v = best_of_block(asked[own], matrix[low[cell]: high[cell]], n, opts.score_bytes)
                    found.append((own[r], low[cell] + c, v))
                rows, cols, vals = (np.concatenate(part) for part in zip(*found))
                best = np.lexsort((places[cols], -vals, rows))
                rank = np.arange(len(best)) - np.searchsorted(rows[best], rows[best]) + 1
                best, rank = best[rank <= n], rank[rank <= n]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[best])).cast(out.field(0).type),
                        pa.array(item_keys[cols[best]], type=out.field(1).type),
                        pa.array(vals[best]),
                        pa.array(rank, type=pa.int32()),
                    ],
                    schema=out,
                )

    tasks = -(-queries.count() * len(keys) // _TASK_PAIRS)
    if tasks > 1:
        queries = queries.repartition(max(tasks, queries.sparkSession.sparkContext.defaultParallelism), key)
    return queries.select(key, "vec").mapInArrow(search, schema)


# ---------------------------------------------------------------- uses
def similar_items(items: DataFrame, n: int = 10, seeds: DataFrame | None = None,
                  opts: Settings = DEFAULTS) -> DataFrame:
    """Cosine neighbours (item_id, neighbor_id, score, rank), the item itself excluded.
    Without ``seeds`` the whole catalog is searched in one job."""
    chosen = items if seeds is None else items.join(seeds.select("item_id"), "item_id", "left_semi")
    found = topn_inner_product(
        chosen.select(F.col("item_id").alias("_seed"), "vec"), items, n + 1, "_seed", normalize=True, opts=opts
    ).where(F.col("_seed") != F.col("item_id"))
    best = first_per_group(found.drop("rank"), ["_seed"], [F.desc("score"), F.asc("item_id")], n, "rank")
    return best.select(F.col("_seed").alias("item_id"), F.col("item_id").alias("neighbor_id"), "score", "rank")


def recommend_from_vectors(queries: DataFrame, items: DataFrame, seen: DataFrame, n: int = 50,
                           retrieve: int = DEFAULTS.retrieve, normalize: bool = True,
                           opts: Settings = DEFAULTS) -> DataFrame:
    """Take the top ``retrieve``, then drop seen items, then keep ``n`` (possibly fewer)."""
    return _searched(queries, items, retrieve, "user_id", normalize, opts, seen, n)


def batch_retrieve(queries: DataFrame, items: DataFrame, seen: DataFrame, n: int = DEFAULTS.candidates,
                   normalize: bool = True, opts: Settings = DEFAULTS) -> DataFrame:
    """Ranker candidates: at most ``n`` unseen of the top ``2n``, with their scores."""
    return recommend_from_vectors(queries, items, seen, n, 2 * n, normalize, opts)
