"""N-gram Jaccard join by a MinHash LSH forest and exact verification.

Documents with the same set of shingles are one class; everything after that is
about classes. Each of ``TREES`` trees is a prefix trie of ``DEPTH`` MinHash values
per class. The tries are matched from the whole paths upwards: a trie node whose
classes have several labels ties these to the smallest, never all to each other, and
a class takes the smallest it is tied to as its label for the next, shorter prefix.
Connected ties are the clusters. How far that goes depends on what is there and what
was found:

* a class takes part until the recall of a pair at the least similarity that its
  number of shingles allows reaches the target. A set too small for any partner
  takes no part, some small ones need whole paths only;
* paths whose shortest prefix no other class has are left out before the first level;
* paths whose shortest prefix holds one label only are settled and leave;
* the last prefix is the longest with the target recall at the threshold itself.

So the pairs found are those of the shortest prefix, and the shorter a prefix gets,
the fewer classes are still matched.

Clusters are verified exactly. A large cluster is parted by size of the sets
(similar sets differ by a factor of 1 / threshold at most, so only neighbouring
parts can match) and each part into blocks of bounded size; each pair of blocks is
a task of its own that compares shingle sets by block products and reports, for
each class, how many documents it is linked with and one tie to its linked group.
So neither pairs of a group nor a whole group ever meet in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage
from tasteloom.llm.graph import components

TREES, DEPTH = 32, 8
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK_CLASSES, _BLOCK_SHINGLES = 256, 300_000   # most of a block, about
_COLUMNS = 8192
_SMALL = 256                                     # shingles up to which the possible similarities are told apart
_LAST = 2**63 - 1
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 17)
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _powers = tuple(made)
    return _powers[0][:n], _powers[1][:n]


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` lower-cased words.

    A text of fewer words is one shingle, a text without words has none. The hash
    of a run is its bytes as a polynomial, taken from running sums over the text.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(" ".join(parts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    power, inverse = _power_table(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    blanks = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(raw))
    count = max(1, len(starts) - words + 1)
    start, end = starts[:count], ends[-count:]
    h = (sums[end] - sums[start]) * inverse[start]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(h ^ (h >> np.uint64(31)))


_draw = np.random.default_rng(20_240_229)
_FACTORS = (_draw.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) << 1 | 1)[:, None]
_MASKS = _draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)[:, None]


def signature(hashes: np.ndarray) -> bytes:
    """The low 16 bits of each MinHash value, tree by tree."""
    narrow = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(narrow), 2048):
        np.minimum(least, (((narrow[None, at: at + 2048] ^ _MASKS) * _FACTORS)).min(axis=1), out=least)
    return least.astype(">u2").tobytes()


def recall(similarity: float, trees: int, depth: int) -> float:
    """Chance that two sets of this similarity share a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def prefix_depth(threshold: float, target: float) -> int:
    """The longest prefix that still finds a pair at the threshold with the target chance."""
    depth = DEPTH
    while depth > 1 and recall(threshold, TREES, depth) < target:
        depth -= 1
    return depth


@lru_cache(maxsize=4096)
def stop_depth(n: int, threshold: float, target: float) -> int:
    """The prefix length at which a set of ``n`` shingles leaves the descent.

    A partner lacks some of the shingles and adds some; the least similarity of the
    threshold or more that whole numbers allow sets the length. ``DEPTH + 1`` if there
    can be no partner but an equal set. Large sets take the threshold for it.
    """
    if n > _SMALL:
        return prefix_depth(threshold, target)
    shares = []
    for gone in range(n):
        new = int((n - gone) / threshold + 1e-9) - n
        if new >= 0 and gone + new:
            shares.append((n - gone) / (n + new))
    return prefix_depth(min(shares), target) if shares else DEPTH + 1


def _cross(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(np.unique(flat_a), np.unique(flat_b), assume_unique=True)
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    if not len(shared):
        return out
    places = []
    for sets, flat in ((a, flat_a), (b, flat_b)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        hit = shared[column] == flat
        row, column = row[hit], column[hit]
        order = np.argsort(column, kind="stable")
        places.append((row[order], column[order]))
    for low in range(0, len(shared), _COLUMNS):
        blocks = []
        for (row, column), sets in zip(places, (a, b)):
            i, j = np.searchsorted(column, [low, low + _COLUMNS])
            block = np.zeros((len(sets), min(_COLUMNS, len(shared) - low)), dtype=np.float32)
            block[row[i:j], column[i:j] - low] = 1
            blocks.append(block)
        out += (blocks[0] @ blocks[1].T).astype(np.int64)
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of ``a`` and ``b`` have a Jaccard similarity of ``threshold`` or more."""
    both = _cross(a, b)
    sizes = np.add.outer([len(s) for s in a], [len(s) for s in b])
    return both >= threshold * (sizes - both) - 1e-9


def _ties(pairs: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest node that each node is connected with by the pairs (indexes into ``nodes``)."""
    root = np.arange(len(nodes))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        if i != j:
            if nodes[i] > nodes[j]:
                i, j = j, i
            root[j] = i
    return nodes[[find(i) for i in range(len(nodes))]]


def _verify(threshold: float, words: int):
    def unit(rows: pa.Table) -> pa.Table:
        seen, nodes, sizes, sides, sets = set(), [], [], [], []
        for node, size, side, text in zip(*(rows[c].to_pylist() for c in ("node", "size", "side", "text"))):
            if (node, side) not in seen:
                seen.add((node, side))
                nodes.append(node)
                sizes.append(size)
                sides.append(side)
                sets.append(shingles(text, words))
        nodes, sizes, sides = np.array(nodes, dtype=np.int64), np.array(sizes, dtype=np.int64), np.array(sides)
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        within = rows["i"][0].as_py() == rows["j"][0].as_py() and not rows["up"][0].as_py()
        if within:
            right = left
        if not len(left) or not len(right):
            return _EMPTY
        close = linked([sets[i] for i in left], [sets[i] for i in right], threshold)
        if within:
            np.fill_diagonal(close, False)
        links = np.zeros(len(nodes), dtype=np.int64)
        links[left] += close @ sizes[right]
        if not within:
            links[right] += close.T @ sizes[left]
        x, y = np.nonzero(close)
        roots = _ties(np.column_stack([left[x], right[y]]), nodes)
        some = links > 0
        return pa.table({"node": nodes[some], "links": links[some], "root": roots[some]})

    return unit


_EMPTY = pa.table({c: pa.array([], pa.int64()) for c in ("node", "links", "root")})


def _units(members: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``members`` (``root, node, n, ...``) once for each pair of blocks they take part in."""
    clusters = members.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    level = F.when((F.col("m") <= _BLOCK_CLASSES) & (F.col("total") <= _BLOCK_SHINGLES), 0).otherwise(
        1 + F.floor(F.log(F.col("n").cast("double")) / log(1 / threshold) + 1e-9)).cast("int")
    placed = members.join(clusters, "root").select(members["*"], level.alias("level"))
    parts = placed.groupBy("root", "level").agg(F.greatest(
        F.ceil(F.count("*") / _BLOCK_CLASSES), F.ceil(F.sum("n") / _BLOCK_SHINGLES)).cast("int").alias("blocks"))
    parts = write_stage(parts, "cluster-parts")

    def near(step: int, name: str) -> DataFrame:
        return parts.select("root", (F.col("level") - step).alias("level"), F.col("blocks").alias(name))

    placed = placed.join(parts, ["root", "level"]).join(near(1, "above"), ["root", "level"], "left").join(
        near(-1, "below"), ["root", "level"], "left")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def numbers(count) -> F.Column:
        return F.when(F.coalesce(count, F.lit(0)) > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>"))

    def unit(level, up, i, j, side):
        return F.struct(level.alias("at"), F.lit(up).alias("up"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    same = F.transform(numbers(F.col("blocks")), lambda k: unit(
        F.col("level"), False, F.least(k, F.col("block")), F.greatest(k, F.col("block")), F.col("block") > k))
    over = F.transform(numbers(F.col("above")), lambda k: unit(F.col("level"), True, F.col("block"), k, F.lit(0)))
    under = F.transform(numbers(F.col("below")), lambda k: unit(F.col("level") - 1, True, k, F.col("block"), F.lit(1)))
    return placed.withColumn("block", block).select(
        *members.columns, F.inline(F.concat(same, over, under)))


def forest(paths: DataFrame, lowest: int) -> DataFrame:
    """``node, root``: the clusters of classes that meet in a trie of ``paths``.

    ``paths`` has a row per class and tree: ``node``, the depth ``stop`` at which the
    class leaves, ``low`` (hash of the tree and the first ``lowest`` values) and ``rest``
    (the other values, two bytes each). Classes that meet no other are left out.
    """
    paths = write_stage(paths, "forest")
    met = paths.groupBy("low").agg(F.count("*").alias("m")).filter("m > 1").select("low")
    living = write_stage(paths.join(met, "low", "left_semi").withColumn("root", F.col("node")), "forest-living")
    edges = None
    for depth in range(DEPTH, lowest - 1, -1):
        here = living.filter(F.col("stop") <= depth).select("node", "root", F.xxhash64(
            "low", F.substring("rest", 1, 2 * (depth - lowest))).alias("prefix"))
        parted = here.groupBy("prefix").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least != most")
        ties = write_stage(here.join(parted.select("prefix", "least"), "prefix").filter("root != least").select(
            "node", "root", "least").distinct(), "forest-ties")
        own = ties.select("root", "least").distinct()
        edges = own if edges is None else edges.unionByName(own)
        if depth > lowest:
            moved = ties.groupBy("node").agg(F.min("least").alias("now"))
            living = living.filter(F.col("stop") < depth).join(moved, "node", "left").select(
                "node", "stop", "low", "rest", F.coalesce("now", "root").alias("root"))
            living = write_stage(living, "forest-moved")
            parted = living.groupBy("low").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter(
                "least != most").select("low")
            living = living.join(parted, "low", "left_semi")
    return components(edges, "root", "least")


def join(docs: DataFrame, threshold: float = 0.8, words: int = 5, target: float = 0.9999) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, key, class_id, n_links, kept``.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-
    word shingles is ``threshold`` or more; a pair at the threshold is found with
    probability ``target``, others more surely. ``class_id`` is the smallest
    ``doc_id`` of all that are connected by links, ``n_links`` the number of other
    rows that the row is linked with, and ``kept`` holds for one row of each
    class: the one with that id. ``key`` is xxhash64 of the text.

    A text of fewer than ``words`` words is one shingle; texts without words, null
    ones too, are linked with nothing. A null id counts as the largest, and is the
    ``class_id`` only where no other is. Rows that repeat an id are rows like any
    other. Columns other than the two are ignored.
    """
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text")).withColumn("key", F.xxhash64("text"))

    def signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            digests, sizes, stops, signatures = [], [], [], []
            for text in part["text"].to_pylist():
                own = shingles(text, words)
                sizes.append(len(own))
                stops.append(stop_depth(len(own), threshold, target) if len(own) else DEPTH + 1)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(signature(own) if len(own) else None)
            yield pa.record_batch(
                [part["doc_id"], part["key"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(stops, pa.int8()), pa.array(signatures, pa.binary())],
                ["doc_id", "key", "digest", "n", "stop", "signature"])

    made = rows.select("doc_id", "key", "text").mapInArrow(
        signed, "doc_id bigint, key bigint, digest binary, n bigint, stop tinyint, signature binary")
    made = write_stage(made.select(F.monotonically_increasing_id().alias("row_id"), "*"), "jaccard-rows")
    order = F.coalesce("doc_id", F.lit(_LAST))
    classes = made.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(order).alias("first_id"), F.min_by("row_id", order).alias("node"), F.min_by("key", order).alias("rep_key"),
        F.count("*").alias("size"), F.min("n").alias("n"))
    classes = write_stage(classes, "jaccard-classes")

    lowest, width = prefix_depth(threshold, target), 2 * DEPTH
    paths = made.filter(F.col("stop") <= DEPTH).join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi")
    paths = paths.select(F.col("row_id").alias("node"), "stop", F.inline(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
            F.xxhash64(t, F.col("signature").substr(t * width + 1, F.lit(2 * lowest))).alias("low"),
            F.col("signature").substr(t * width + 2 * lowest + 1, F.lit(width - 2 * lowest)).alias("rest")))))
    clusters = forest(paths, lowest)

    members = clusters.join(classes.select("node", "first_id", "rep_key", "size", "n"), "node")
    units = _units(members, threshold).withColumn("rep_doc", F.when(F.col("first_id") != _LAST, F.col("first_id")))
    texts = rows.select(F.col("doc_id").alias("t_doc"), F.col("key").alias("t_key"), "text")
    units = units.join(texts, F.col("rep_doc").eqNullSafe(F.col("t_doc")) & (F.col("rep_key") == F.col("t_key")))
    found = units.groupBy("root", "at", "up", "i", "j").applyInArrow(
        _verify(threshold, words), "node bigint, links bigint, root bigint")
    found = write_stage(found, "jaccard-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found, "node", "root")
    first = groups.join(classes.select("node", "first_id"), "node").groupBy("root").agg(
        F.min("first_id").alias("class_first"), F.min_by("node", "first_id").alias("class_node"))
    groups = groups.join(first, "root").select("node", "class_first", "class_node")

    known = classes.join(links, "node", "left").join(groups, "node", "left").select(
        "digest", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("class_first", "first_id").alias("class_first"), F.coalesce("class_node", "node").alias("class_node"))
    full = made.select("row_id", "doc_id", "key", "digest").join(known, "digest", "left")
    alone = F.col("digest").isNull()
    return full.select(
        "doc_id", "key",
        F.when(alone, F.col("doc_id")).when(F.col("class_first") != _LAST, F.col("class_first")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (alone | (F.col("row_id") == F.col("class_node"))).alias("kept"))
