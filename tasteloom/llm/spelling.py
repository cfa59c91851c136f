"""Grouping of spelling variants by a bit-sliced position index.

The vocabulary is dealt into blocks of some thousand words. Within a block, one
bitset for each (position, letter) says which words have that letter there. All
asked words of a block walk their letters at once: one set of words per asked word
holds those matched without an error so far, others hold those matched with one
replaced, one extra or one missing letter, for which the bitsets of the same, the
next and the previous position count. Each step is a few operations on whole machine
words, and what is left at the end are the words at exactly one error.

Two words at one error share their first half or their last half, halves taken by
the length of the shorter one. So words of these two lengths meet in blocks dealt
by either half, and no pair of the whole vocabulary is left out. A block that grows
too large, because many words share a half, is cut, and each pair of its parts is
a task of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
DROP = 97                                   # one in so many (document, word) pairs loses a letter
_FLUSH = 300_000                            # words counted in a worker before they are passed on
_BUCKET_WORDS, _BLOCK_WORDS = 2048, 4096    # in a block on average, and at most, about
_BUCKET_LETTERS = 1 << 17
_WIDTHS = 64                                # lengths told apart when buckets are counted
_BLOCKS_A_TASK = 48
_AT_ONCE = 1024                             # asked words
_PIECE = 1 << 20
_RUN, _GAP = re.compile(rb"[a-z\xc0-\xff]{5,}"), re.compile(rb"[^a-z\xc0-\xff]")


def runs(text: str) -> Iterator[list[bytes]]:
    """The runs of five letters or more, A-Z in lower case, as Latin-1 bytes; long texts in pieces."""
    raw = text.encode("latin-1", "replace").lower()   # of bytes: A-Z only
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + _PIECE) if len(raw) - at > _PIECE else None
        end = gap.start() if gap else len(raw)
        yield _RUN.findall(raw, at, end)
        at = end


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[bytes, int] = {}

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                pa.array(list(total.values()), pa.int64())], ["word", "n"])

    for part in parts:
        for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
            head = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
            own: Counter = Counter()
            for piece in runs(text):
                own.update(piece)
            for word, n in own.items():
                h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), head)
                if h % DROP == 0:
                    k = h % len(word)
                    word = word[:k] + word[k + 1:]
                    if len(word) < LEAST_LETTERS:
                        continue
                total[word] = total.get(word, 0) + n
            if len(total) > _FLUSH:
                yield batch()
                total.clear()
    yield batch()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of ``docs`` with five letters and three occurrences or more."""
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= LEAST_COUNT)


def _letters(words: list[str], width: int) -> np.ndarray:
    """A row of letters for each word, zeros after its end."""
    raw = b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words)
    return np.frombuffer(raw, dtype=np.uint8).reshape(len(words), width)


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    if short:
        packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)])
    return np.ascontiguousarray(packed).view(np.uint64)


class PositionIndex:
    """Bitsets over words of ``m`` and ``m + 1`` letters: which have a letter at a position."""

    def __init__(self, words: list[str], m: int):
        self.m, self.rows = m, _letters(words, m + 1)
        long = self.rows[:, m] != 0
        self.short_set, self.long_set = _packed(~long[None])[0], _packed(long[None])[0]
        self.kinds = np.unique(self.rows)
        self.none = np.zeros((len(self.kinds) + 1, len(self.long_set)), dtype=np.uint64)   # the last row: letters no word has
        self.kept: dict[int, np.ndarray] = {}

    def at(self, p: int) -> np.ndarray:
        """Bitsets by letter at position ``p``; those of the last few positions are kept."""
        if not 0 <= p <= self.m:
            return self.none
        if p not in self.kept:
            table = self.none.copy()
            table[:-1] = _packed(self.rows[None, :, p] == self.kinds[:, None])
            self.kept[p] = table
            self.kept.pop(p - 3, None)
        return self.kept[p]

    def near(self, asked: np.ndarray) -> np.ndarray:
        """For rows of letters, all of ``m`` or all of ``m + 1``, the sets of words at exactly one error.

        Words of ``m + 1`` letters are only matched with those of ``m``.
        """
        size = self.m + int(asked[0, self.m] != 0)
        found = np.minimum(np.searchsorted(self.kinds, asked), len(self.kinds) - 1)
        place = np.where(self.kinds[found] == asked, found, len(self.kinds))
        same = np.full((len(asked), len(self.long_set)), ~np.uint64(0))
        other, extra, missing = (np.zeros_like(same) for _ in range(3))
        self.kept.clear()
        for p in range(size):
            here = self.at(p)[place[:, p]]
            if size == self.m:
                other = (other & here) | (same & ~here)
                extra = (extra | same) & self.at(p + 1)[place[:, p]]
            else:
                missing = same | (missing & self.at(p - 1)[place[:, p]])
            same &= here
        if size == self.m:
            return (other & self.short_set) | ((extra | same) & self.long_set)
        return missing & self.short_set


def _pairs(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row, column = np.nonzero(sets)
    bits = np.unpackbits(sets[row, column][:, None].view(np.uint8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    return row[k], column[k] * 64 + bit


def _ask(asked: list[str], n_words: np.ndarray, words: list[str], m: int, head: bool) -> list[tuple]:
    """``word, near, minus_n, best`` of the asked words that have near words in this block."""
    if not asked or not words:
        return []
    index, half = PositionIndex(words, m), m // 2
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.lexsort(index.rows.T[::-1])] = np.arange(len(words))

    def tails(rows: np.ndarray) -> np.ndarray:
        return np.where((rows[:, m] != 0)[:, None], rows[:, half + 1: m + 1], rows[:, half: m])

    rows, out = _letters(asked, m + 1), []
    long = rows[:, m] != 0
    for which in (np.flatnonzero(~long), np.flatnonzero(long)):
        for at in range(0, len(which), _AT_ONCE):
            some = which[at: at + _AT_ONCE]
            i, j = _pairs(index.near(rows[some]))
            i = some[i]
            heads = (rows[i, :half] == index.rows[j, :half]).all(axis=1)
            keep = heads if head else ~heads & (tails(rows[i]) == tails(index.rows[j])).all(axis=1)
            i, j = i[keep], j[keep]
            order = np.lexsort((rank[j], -n_words[j], i))
            i, j = i[order], j[order]
            first = np.flatnonzero(np.diff(i, prepend=-1))
            counts = np.diff(np.append(first, len(i)))
            out += [(asked[i[f]], int(c), -int(n_words[j[f]]), words[j[f]]) for f, c in zip(first, counts)]
    return out


_FOUND = pa.schema([("word", pa.string()), ("near", pa.int64()), ("minus_n", pa.int64()), ("best", pa.string())])


def _block(rows: pa.Table) -> pa.Table:
    m, head = rows["m"][0].as_py(), rows["head"][0].as_py()
    sides = np.array(rows["side"].to_pylist())
    words, n = rows["word"].to_pylist(), np.array(rows["n"].to_pylist(), dtype=np.int64)
    parts = [([words[k] for k in np.flatnonzero(sides == s)], n[sides == s]) for s in (0, 1)]
    (left, n_left), (right, n_right) = parts
    if rows["i"][0].as_py() == rows["j"][0].as_py():
        found = _ask(left, n_left, left, m, head)
    else:
        found = _ask(left, n_right, right, m, head) + _ask(right, n_left, left, m, head)
    return pa.table(list(map(list, zip(*found))) or [[]] * 4, schema=_FOUND)


def _dealt(words: DataFrame) -> DataFrame:
    """Each word once for each block, or pair of parts of a block, that it takes part in."""
    size = F.length("word")

    def half(m: Column, head: bool) -> Column:
        key = F.substr("word", F.lit(1), F.floor(m / 2).cast("int")) if head else F.substr(
            "word", (size - (m - F.floor(m / 2)) + 1).cast("int"), (m - F.floor(m / 2)).cast("int"))
        return F.struct(m.alias("m"), F.lit(head).alias("head"), F.xxhash64(m, F.lit(head), key).alias("key"))

    ways = F.filter(F.array(*(half(m, head) for m in (size, size - 1) for head in (True, False))),
                    lambda w: w["m"] >= LEAST_LETTERS)
    keyed = words.select("word", "n", F.inline(ways))
    keyed = keyed.withColumn("width", F.least("m", F.lit(_WIDTHS)))
    letters = F.sum("m")
    counts = keyed.groupBy("width", "head").agg(F.greatest(
        F.ceil(F.count("*") / _BUCKET_WORDS), F.ceil(letters / _BUCKET_LETTERS)).alias("buckets"))
    # two rows for each width up to _WIDTHS at most
    dealt = keyed.join(F.broadcast(counts), ["width", "head"]).select(
        "word", "n", "m", "head", F.pmod(F.col("key"), F.col("buckets").cast("bigint")).alias("bucket"))
    parts = write_stage(dealt.groupBy("m", "head", "bucket").agg(F.greatest(
        F.ceil(F.count("*") / _BLOCK_WORDS), F.ceil(letters / (2 * _BUCKET_LETTERS))).cast("int").alias("parts")), "blocks")
    dealt = dealt.join(parts, ["m", "head", "bucket"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least(k, F.col("part")).alias("i"), F.greatest(k, F.col("part")).alias("j"),
        (F.col("part") > k).cast("int").alias("side")))
    tasks = parts.agg(F.ceil(F.sum(F.col("parts") * (F.col("parts") + 1) / 2) / _BLOCKS_A_TASK)).first()[0] or 1
    return dealt.select("word", "n", "m", "head", "bucket", F.inline(units)).repartition(int(tasks), "m", "head", "bucket", "i", "j")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of each word of ``words`` (``word, n``, distinct) that has near words.

    Near words differ by exactly one inserted, deleted or replaced letter; ``best``
    is the one of the largest ``n``, of ties the smallest. Words have letters up to
    U+00FF; those of fewer than five letters are left out.
    """
    found = _dealt(words).groupBy("m", "head", "bucket", "i", "j").applyInArrow(
        _block, "word string, near bigint, minus_n bigint, best string")
    best = F.min(F.struct("minus_n", "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.minus_n")).alias("best_n"), F.col("top.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms lead. Counts double along the way, so steps of double length soon end."""
    done, now = None, write_stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = now.alias("a").join(now.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word").alias("word"), F.coalesce("b.root", "a.root").alias("root"), F.col("b.word").isNotNull().alias("more"))
        done = write_stage(step, "roots")
        if done.filter("more").isEmpty():
            return done.select("word", "root")
        now = done.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root`` string, ``n, n_near, form_n`` bigint.

    Words are the runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts with
    A-Z in lower case. Where 97 divides the crc32 of ``<doc_id>:<run>`` the letter
    at crc32 modulo length is deleted. Words of five letters and three occurrences
    (``n``) or more remain. ``form`` is the near word of the largest ``n`` (of ties
    the smallest), if its ``n`` (``form_n``) is at least twice the word's, else null.
    ``root`` is where the forms lead from the word, itself if nowhere.

    A null text has no words, a null id counts as the empty text. Repeated rows
    count as often as they stand there. No words give no rows. Columns other than
    the two are ignored.
    """
    words = write_stage(vocabulary(docs), "vocabulary")
    near = near_words(words)
    has = F.col("best_n") >= 2 * F.col("n")
    known = write_stage(words.join(near, "word", "left").select(
        "word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n")), "near-words")
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
