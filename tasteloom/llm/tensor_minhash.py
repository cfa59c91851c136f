"""MinHash near-duplicate removal with tensored banding, and exact verification.

``HALVES`` short keys of ``HALF`` MinHash values each are computed per set of
shingles; every pair of them is the key of one table, so 16 keys (48 values)
serve 120 tables, which plain banding would need 720 values for. Two sets at a
similarity of 0.8 share no table with a chance of 0.0002. A short key that no
other set has is left out before the pairs are formed, as no table with it can
hold two sets.

Verification is exact and goes in two steps. First the members of each table
entry are compared with the smallest of them, each pair once, in units of one
hub and some hundred members; linked ones become groups. Only entries that still
hold several groups go on: their members are dealt into blocks, and each pair of
blocks is compared, unless both blocks lie in one group. So a large group of
copies costs a comparison with its hubs, not all its pairs, and no link between
different groups is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage
from tasteloom.llm.graph import components
from tasteloom.llm.jaccard_join import _ties, linked

HALVES, HALF = 16, 3
SHARE = 80                                       # least similarity, in hundredths
_UNIT = 256                                      # members compared with one hub in one task, about
_BLOCK_SETS, _BLOCK_SHINGLES = 256, 300_000      # most of a block, about
_LAST = 2**63 - 1
_FEW = np.uint64(0x9E3779B97F4A7C15)
_draw = np.random.default_rng(20_261_201)
_FACTORS = (_draw.integers(0, 1 << 31, HALVES * HALF, dtype=np.uint32) << 1 | 1)[:, None]
_MASKS = _draw.integers(0, 1 << 32, HALVES * HALF, dtype=np.uint32)[:, None]


def _mix(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def shingles(text: str, words: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words, with A-Z in lower case.

    Words are what lies between the six ASCII blanks. Fewer words are one shingle,
    none are no shingle.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()   # of bytes: ASCII letters and blanks only
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(p, len(known)) for p in parts])
    own = np.array([xxhash.xxh64_intdigest(p) for p in known], dtype=np.uint64)[ids]
    size = min(words, len(parts))
    h = np.full(len(parts) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = _mix(h * _FEW + own[k: k + len(h)])
    return np.unique(h)


def signature(hashes: np.ndarray) -> bytes:
    """The MinHash values, 32 bits each, one short key after the other."""
    narrow = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HALVES * HALF, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(narrow), 4096):
        np.minimum(least, ((narrow[None, at: at + 4096] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def missed(similarity: float, halves: int = HALVES, half: int = HALF) -> float:
    """Chance that two sets of this similarity share fewer than two short keys, and so no table entry."""
    p = similarity ** half
    return (1 - p) ** halves + halves * p * (1 - p) ** (halves - 1)


def _tables(classes: DataFrame) -> DataFrame:
    """``node, prefix``: the entries of each set in the tables whose two short keys others have, too."""
    width = 4 * HALF
    halves = classes.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(HALVES - 1)),
        lambda i: F.xxhash64(i, F.col("signature").substr(i * width + 1, F.lit(width))))).alias("half"))
    common = halves.groupBy("half").agg(F.count("*").alias("m")).filter("m > 1").select("half")
    own = halves.join(common, "half", "left_semi").groupBy("node").agg(F.sort_array(F.collect_list("half")).alias("h"))
    pairs = F.flatten(F.transform("h", lambda x, i: F.transform(
        F.slice("h", i + 2, F.size("h")), lambda y: F.xxhash64(x, y))))
    return own.filter("size(h) > 1").select("node", F.explode(pairs).alias("prefix"))


def _sets(rows: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    return (np.array(rows["node"].to_pylist(), dtype=np.int64), np.array(rows["side"].to_pylist()),
            [shingles(t, words) for t in rows["text"].to_pylist()])


def _star(words: int, share: int):
    """Which members of a unit are linked with its hub."""
    def unit(rows: pa.Table) -> pa.Table:
        nodes, sides, sets = _sets(rows, words)
        at = int(np.flatnonzero(sides == 0)[0])
        hub, close = sets[at], np.zeros(len(nodes), dtype=bool)
        for i, own in enumerate(sets):
            both = int((hub[np.minimum(np.searchsorted(hub, own), len(hub) - 1)] == own).sum())
            close[i] = i != at and 100 * both >= share * (len(hub) + len(own) - both)
        return pa.table({"node": nodes[close], "root": np.full(int(close.sum()), nodes[at])})

    return unit


def _blocks(words: int, share: int):
    """Ties of linked sets between the two blocks of a unit, or within its one block."""
    def unit(rows: pa.Table) -> pa.Table:
        nodes, sides, sets = _sets(rows, words)
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if not len(right):
            right = left
        x, y = np.nonzero(linked([sets[i] for i in left], [sets[i] for i in right], share / 100))
        roots = _ties(np.column_stack([left[x], right[y]]), nodes)
        some = nodes != roots
        return pa.table({"node": nodes[some], "root": roots[some]})

    return unit


def _stars(ties: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    pairs = ties.filter("node != least").select("least", "node").distinct()
    chunks = pairs.groupBy("least").agg(F.ceil(F.count("*") / _UNIT).cast("int").alias("chunks"))
    placed = pairs.join(chunks, "least").select(
        "least", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", F.lit(1).alias("side"))
    hubs = chunks.select("least", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                         F.col("least").alias("node"), F.lit(0).alias("side"))
    units = placed.unionByName(hubs).join(texts, "node")
    return write_stage(units.groupBy("least", "chunk").applyInArrow(_star(words, share), "node bigint, root bigint"), "star-links")


def _open_entries(ties: DataFrame, groups: DataFrame) -> DataFrame:
    """The ties of entries with three members or more that are not all in one group; with their groups."""
    own = ties.filter("m > 2").join(groups, "node", "left").withColumn("own", F.coalesce("root", "node"))
    parted = own.groupBy("prefix").agg(F.min("own").alias("x"), F.max("own").alias("y")).filter("x != y").select("prefix")
    return write_stage(own.join(parted, "prefix", "left_semi").select("node", "least", "own").distinct(), "open-entries")


def _crossed(opened: DataFrame, classes: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """Links between different groups that meet in an open entry."""
    members = components(opened, "node", "least").withColumnRenamed("root", "cluster")
    members = members.join(opened.groupBy("node").agg(F.min("own").alias("own")), "node").join(
        classes.select("node", "n"), "node")
    sizes = members.groupBy("cluster", "own").agg(F.count("*").alias("c"))
    part = F.when(F.col("c") >= _BLOCK_SETS, F.col("own")).otherwise(F.lit(-1))   # small groups share blocks
    level = F.floor(F.log(F.col("n").cast("double")) / log(100 / share) + 1e-9).cast("int")
    placed = write_stage(members.join(sizes, ["cluster", "own"]).select("cluster", "node", "n", part.alias("part"), level.alias("level")),
                         "members")
    counts = placed.groupBy("cluster", "part", "level").agg(F.greatest(
        F.ceil(F.count("*") / _BLOCK_SETS), F.ceil(F.sum("n") / _BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = placed.join(counts, ["cluster", "part", "level"]).select(
        "cluster", "node", "part", "level", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    placed = write_stage(placed, "placed")
    blocks = placed.select("cluster", "part", "level", "block").distinct().withColumn("id", F.xxhash64("part", "level", "block"))
    a, b = blocks.alias("a"), blocks.alias("b")
    pairs = a.join(b, (F.col("a.cluster") == F.col("b.cluster")) & (F.col("a.id") <= F.col("b.id"))
                   & (F.abs(F.col("a.level") - F.col("b.level")) <= 1)
                   & ((F.col("a.part") != F.col("b.part")) | (F.col("a.part") == -1)))
    sides = pairs.select(F.col("a.cluster").alias("cluster"), F.col("a.id").alias("i"), F.col("b.id").alias("j"))
    sides = sides.select("cluster", "i", "j", F.inline(F.when(F.col("i") == F.col("j"), F.array(
        F.struct(F.lit(0).alias("side"), F.col("i").alias("id")))).otherwise(F.array(
            F.struct(F.lit(0).alias("side"), F.col("i").alias("id")), F.struct(F.lit(1).alias("side"), F.col("j").alias("id"))))))
    units = placed.withColumn("id", F.xxhash64("part", "level", "block")).join(sides, ["cluster", "id"])
    units = units.select("cluster", "i", "j", "side", "node").join(texts, "node")
    return write_stage(units.groupBy("cluster", "i", "j").applyInArrow(_blocks(words, share), "node bigint, root bigint"), "cross-links")


def dedup(docs: DataFrame, share: int = SHARE, words: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if 100 times the number of shingles they share is at
    least ``share`` times the number that either has. ``component_id`` is the
    smallest ``doc_id`` of all that are connected by links, the row's own included;
    ``kept`` holds where that is the row's ``doc_id``.

    A text of fewer than ``words`` words is one shingle; texts without words, null
    ones too, have none and are linked with nothing. A null id counts as the
    largest and is a ``component_id`` only where no other is; it is kept then. Rows
    that repeat an id are rows like any other: those of the kept id are all kept.
    An empty table gives none. Columns other than the two are ignored.
    """
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))

    def signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            digests, sizes, signatures = [], [], []
            for text in part["text"].to_pylist():
                own = shingles(text, words)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(signature(own) if len(own) else None)
            yield pa.record_batch(
                [part["doc_id"], part["text"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(signatures, pa.binary())], ["doc_id", "text", "digest", "n", "signature"])

    made = rows.mapInArrow(signed, "doc_id bigint, text string, digest binary, n bigint, signature binary")
    made = write_stage(made.select(F.monotonically_increasing_id().alias("row_id"), "*"), "minhash-rows")
    order = F.coalesce("doc_id", F.lit(_LAST))
    classes = made.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(order).alias("first_id"), F.min("row_id").alias("node"), F.min("n").alias("n"),
        F.min("signature").alias("signature"))
    classes = write_stage(classes, "minhash-classes")

    tables = write_stage(_tables(classes), "tables")
    met = tables.groupBy("prefix").agg(F.min("node").alias("least"), F.count("*").alias("m")).filter("m > 1")
    ties = write_stage(tables.join(met, "prefix"), "entries")
    asked = ties.select("node").distinct()
    texts = write_stage(made.select(F.col("row_id").alias("node"), "text").join(asked, "node", "left_semi"), "texts")

    found = _stars(ties, texts, words, share)
    groups = write_stage(components(found, "node", "root"), "groups")
    opened = _open_entries(ties, groups)
    if not opened.isEmpty():
        more = _crossed(opened, classes, texts, words, share)
        if not more.isEmpty():
            groups = write_stage(components(more.unionByName(groups.filter("node != root")), "node", "root"), "groups")
    first = groups.join(classes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("first"))
    first = groups.join(first, "root").select("node", "first")
    known = classes.join(first, "node", "left").select("digest", F.coalesce("first", "first_id").alias("first"))
    full = made.select("doc_id", "n", "digest").join(known, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("first") != _LAST, F.col("first")).alias("component_id"))
    return full.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
