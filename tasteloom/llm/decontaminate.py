"""Benchmark decontamination: SimHash windows, a multi-index over Hamming blocks, exact verification.

A window has the words of one item's length. Only windows laid where a shingle of
the item meets the same shingle of the document can be similar to it at all, so
only those are fingerprinted, and each distinct window content once, however many
documents share it. A fingerprint is a 64-bit SimHash of the words. Two
fingerprints within ``radius`` bits differ by ``radius // BLOCKS`` bits at most in
one of ``BLOCKS`` blocks; the index has the items under every such variant of every
block, so no fingerprint within the radius is missed. Candidates are verified by
the weighted Jaccard similarity of their shingles, a shingle weighing as often as
it occurs. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage

BLOCKS = 6
# a word exchanged at an end costs one shingle, so up to a ninth of the words may differ at 0.8: their fingerprints are
# some 10 bits apart, seldom more than 17
RADIUS = 17
_BROADCAST_ROWS = 2_000_000  # most rows of (shingle, place, size) that are sent to every executor: some 48 MB
_WORD_BREAK = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), _WORD_BREAK), lambda w: w != "")


def shingle_hashes(words: Column, n: int) -> Column:
    """Hashes of the runs of ``n`` words, in order; none if there are fewer words. ``words`` is evaluated once."""
    return F.transform(F.array(words), lambda own: F.when(F.size(own) >= n, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(own) - (n - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(own, i, n)))).otherwise(F.array().cast("array<bigint>")))[0]


def simhash(words: Column) -> Column:
    """64-bit SimHash of an array of words, each occurrence one vote per bit.

    The votes for bits k and k + 32 are counted in the two halves of one number.
    """
    def votes(hashes: Column, k: Column) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda total, h: total + F.call_function(
            "shiftrightunsigned", h, k).bitwiseAND(0x0000000100000001))

    places = F.sequence(F.lit(0), F.lit(31))
    lanes = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))),
                        lambda hashes: F.transform(places, lambda k: F.struct(k.alias("k"), votes(hashes, k).alias("lane"))))[0]
    half = F.size(words).cast("bigint")

    def bit(won: Column, k: Column) -> Column:
        return F.when(won, F.call_function("shiftleft", F.lit(1).cast("bigint"), k)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(lanes, F.lit(0).cast("bigint"), lambda total, v: total.bitwiseOR(
        bit(v["lane"].bitwiseAND(0xFFFFFFFF) * 2 > half, v["k"])).bitwiseOR(
        bit(F.shiftrightunsigned(v["lane"], 32) * 2 > half, v["k"] + 32)))


def _block_bounds() -> list[tuple[int, int]]:
    cuts = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    return list(zip(cuts, cuts[1:]))


def block_keys(fingerprint: Column, flips: int) -> Column:
    """Array of (block, value): each block's value, with all changes of up to ``flips`` bits."""
    def changed(block: int, low: int, high: int) -> Column:
        value = F.shiftrightunsigned(fingerprint, low).bitwiseAND((1 << (high - low)) - 1)
        masks = F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << (high - low)) - 1).cast("bigint")), lambda m: F.bit_count(m) <= flips)
        return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value")))

    return F.concat(*(changed(block, low, high) for block, (low, high) in enumerate(_block_bounds())))


def near_fingerprints(left: DataFrame, right: DataFrame, radius: int = 11) -> DataFrame:
    """Pairs of rows of ``left`` (with ``fp``) and ``right`` (with ``item_fp``) within ``radius`` bits, each once per block.

    ``right`` is the side with the variants, so it should be the smaller one.
    """
    a = left.select("*", F.inline(block_keys(F.col("fp"), 0)))
    b = right.select("*", F.inline(block_keys(F.col("item_fp"), radius // BLOCKS)))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    return a.join(b, (a["block"] == b["block"]) & (a["value"] == b["value"]) & near).drop("block", "value")


def find(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, words: int = 5, radius: int = RADIUS) -> DataFrame:
    """``doc_id, key, item_id, similarity, start, n_words``: passages of ``docs`` that repeat an item of ``benchmark``.

    One row per document and item, for the closest window (then the first one);
    ``start`` counts the document's words from 0, ``key`` is xxhash64 of its text.
    Windows reach no further than the document. Items of fewer than ``words``
    words, null items and null texts match nothing; neither does an empty table.
    Items with the same text are reported each. Rows that repeat a ``doc_id`` with
    other text are searched each by itself, and reported once if the text repeats.
    """
    items = benchmark.select(benchmark["item_id"].cast("bigint").alias("item_id"),
                             words_of(F.coalesce(benchmark["text"].cast("string"), F.lit(""))).alias("w"))
    items = items.filter(F.size("w") >= words).select(
        "item_id", F.size("w").alias("size"), shingle_hashes(F.col("w"), words).alias("hashes"), simhash(F.col("w")).alias("item_fp"))
    items = write_stage(items, "benchmark-items")
    places = write_stage(items.select("size", F.posexplode("hashes").alias("place", "hash")).distinct(), "benchmark-places")
    if places.count() <= _BROADCAST_ROWS:
        places = F.broadcast(places)

    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), "text")
    # where a shingle of an item stands in a document, lay a window of the item's size
    held = F.transform(F.array(words_of(F.col("text"))), lambda w: F.struct(
        F.size(w).alias("n"), shingle_hashes(w, words).alias("hashes")))[0]
    hits = rows.select("doc_id", "key", held.alias("held")).select(
        "doc_id", "key", F.col("held.n").alias("n"), F.posexplode("held.hashes").alias("at", "hash")).join(places, "hash")
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("n") - F.col("size")))
    laid = hits.select("doc_id", "key", begin.alias("start"), F.least("size", "n").alias("size")).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "size")).alias("laid")).withColumnsRenamed({"doc_id": "l_doc", "key": "l_key"})
    cut = F.transform(F.array(words_of(F.col("text"))), lambda w: F.transform("laid", lambda p: F.struct(
        p["start"].alias("start"), p["size"].alias("n_words"), F.array_join(F.slice(w, p["start"] + 1, p["size"]), " ").alias("content"))))[0]
    windows = rows.join(laid, F.col("doc_id").eqNullSafe(F.col("l_doc")) & (F.col("key") == F.col("l_key"))).select(
        "doc_id", "key", F.inline(cut))
    windows = write_stage(windows.distinct(), "windows")

    contents = windows.select("content").distinct()
    own = F.transform(F.array(F.split("content", " ")), lambda w: F.struct(
        simhash(w).alias("fp"), shingle_hashes(w, words).alias("hashes")))[0]
    contents = write_stage(contents.select("content", own.alias("own")).select("content", "own.fp", "own.hashes"), "window-prints")
    pairs = near_fingerprints(contents.select("content", "fp"), items.select("item_id", "item_fp"), radius).select(
        "content", "item_id").distinct()

    def counted(frame: DataFrame, *names: str) -> DataFrame:
        return frame.select(*names, F.explode("hashes").alias("hash")).groupBy(*names, "hash").agg(F.count("*").alias("n"))

    a = counted(contents, "content").withColumnRenamed("n", "n_a")
    b = counted(items, "item_id").withColumnRenamed("n", "n_b")
    shared = pairs.join(a, "content").join(b, ["item_id", "hash"]).groupBy("content", "item_id").agg(
        F.sum(F.least("n_a", "n_b")).alias("both"))
    sized = shared.join(contents.select("content", F.size("hashes").alias("s_a")), "content").join(
        items.select("item_id", F.size("hashes").alias("s_b")), "item_id")
    similarity = F.col("both") / (F.col("s_a") + F.col("s_b") - F.col("both"))
    verified = sized.select("content", "item_id", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)
    best = windows.join(verified, "content").groupBy("doc_id", "key", "item_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "start", "n_words")).alias("b"))
    return best.select("doc_id", "key", "item_id", (-F.col("b.less")).alias("similarity"), "b.start", "b.n_words")
