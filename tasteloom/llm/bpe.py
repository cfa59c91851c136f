"""BPE encoding and decoding of whole texts with a given vocabulary file.

A text up to ``leaf`` characters is encoded in one piece. A longer one is halved
until the pieces fit; the pieces are encoded in parallel tasks and joined pairwise
up the tree. At each join a window around the seam is encoded again and grown
until it agrees with both sides: until two neighbouring tokens of the window, with
their places, are also neighbours on the left, and two are on the right. A token
sequence is the encoding of its text exactly if all its neighbours are, so what
comes out equals the encoding of the text in one go.

Words of texts in plain Latin script are encoded once per worker and looked up
afterwards; any other text goes through the tokenizer as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty

LEAF = 32_768          # characters encoded in one piece
_CACHED_WORDS = 200_000
_ROWS, _CHARS = 500, 2_000_000   # rows, and about so many characters, encoded at once
_WINDOW = 64

# fixed values: letters and numbers of the scripts that are looked up by word, and the word pattern of the vocabulary
_LETTERS = "a-zªµºß-öø-ÿœ"
_NUMBERS = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ÿŒœ–—‘’“”…€]*")
_PROBE = "Der Café-Besuch von 1234 Ärzten, it's naïve: we'll pay 50% (œuvre)...\n\tX9 don't ÀÉ--õ ½ l'été!? _a_b_"
_WORD = re.compile(f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^ \t\n\r{_LETTERS}{_NUMBERS}]+")


class WordTable:
    """What words are encoded to, in two generations: once the young one is full, it is the old one,
    and words of the old one that come again move back."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def learn(self, words: set[str], make) -> None:
        """Have all of ``words`` in ``young``; ``make`` encodes a list of new ones."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        new = words - self.young.keys()
        back = new & self.old.keys()
        for word in back:
            self.young[word] = self.old[word]
        new = list(new - back)
        if new:
            self.young.update(zip(new, make(new)))


class Codec:
    """One worker's tokenizer with its word table."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size()
        self.tokens = np.array([self.tokenizer.id_to_token(i) or "" for i in range(size)], dtype=object)
        self.ids, self.places = WordTable(_CACHED_WORDS), WordTable(_CACHED_WORDS // 4)
        self.by_word = self._same_by_word()

    def _plain(self, text: str) -> bool:
        return self.by_word and _PLAIN.fullmatch(text) is not None and "<|" not in text

    def _same_by_word(self) -> bool:
        """Whether this vocabulary lower-cases and parts texts as the word table does."""
        words = _WORD.findall(_PROBE.lower())
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        return whole == [i for w in words for i in self.tokenizer.encode(w, add_special_tokens=False).ids]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text; words not met before go to the tokenizer in one call for all."""
        parted = [_WORD.findall(t.lower()) if self._plain(t) else None for t in texts]
        self.ids.learn(set().union(*(w for w in parted if w)), self._ids_of)
        known = self.ids.young.__getitem__
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() if words is None
                else b"".join(map(known, words)) for t, words in zip(texts, parted)]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        return [np.array(made.ids, dtype="<u4").tobytes()
                for made in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _rows_of(self, words: list[str]) -> list[bytes]:
        return [np.column_stack([np.array(made.ids, dtype="<i8"), np.array(made.offsets, dtype="<i8").reshape(-1, 2)]).tobytes()
                for made in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def encode_places(self, text: str) -> np.ndarray:
        """Rows of (id, start, end) in characters of ``text``."""
        if not self._plain(text):
            made = self.tokenizer.encode(text, add_special_tokens=False)
            return np.column_stack([np.array(made.ids, dtype=np.int64),
                                    np.array(made.offsets, dtype=np.int64).reshape(-1, 2)])
        found = [(m.start(), m.group()) for m in _WORD.finditer(text.lower())]
        if not found:
            return np.empty((0, 3), dtype=np.int64)
        self.places.learn({w for _, w in found}, self._rows_of)
        parts = [self.places.young[w] for _, w in found]
        rows = np.frombuffer(b"".join(parts), dtype="<i8").reshape(-1, 3).copy()
        rows[:, 1:] += np.repeat(np.array([s for s, _ in found]), np.array([len(p) for p in parts]) // 24)[:, None]
        return rows

    def decode(self, ids: bytes) -> str:
        return " ".join(self.tokens[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=2)
def _codec(definition: str) -> Codec:
    return Codec(definition)


def _neighbours(rows: np.ndarray) -> dict[tuple, int]:
    """Index of the first of each two neighbouring tokens that meet between characters."""
    listed = rows.tolist()
    return {(*a, *b): i for i, (a, b) in enumerate(zip(listed, listed[1:])) if a[2] <= b[1] and b[2] > b[1]}


def join_pieces(encode_places, text: str, left: np.ndarray, right: np.ndarray, low: int, seam: int, high: int):
    """Tokens of ``text[low:high]`` from those of its parts before and after ``seam``.

    ``left`` and ``right`` hold (id, start, end) with places in ``text``.
    """
    reach = _WINDOW
    while True:
        start, stop = max(low, seam - reach), min(high, seam + reach)
        window = encode_places(text[start:stop]).copy()
        window[:, 1:] += start
        pairs = _neighbours(window)
        head, first = left[:0], 0
        tail, last = right[:0], len(window) - 1
        agreed = True
        if start > low:
            offset = int(np.searchsorted(left[:, 1], start))
            own = _neighbours(left[offset:])
            both = [(k, own[p]) for p, k in pairs.items() if p in own]
            if both:
                first, at = min(both)
                head, first = left[: offset + at + 1], first + 1
            else:
                agreed = False
        if agreed and stop < high:
            near = right[: int(np.searchsorted(right[:, 1], stop))]
            own = _neighbours(near)
            both = [(k, own[p]) for p, k in pairs.items() if p in own]
            if both:
                last, at = max(both)
                tail = right[at + 1:]
            else:
                agreed = False
        if agreed and first <= last + 1:
            return np.concatenate([head, window[first: last + 1], tail])
        reach *= 2


def join_tree(encode_places, text: str, pieces: list[np.ndarray], cuts: list[int]) -> np.ndarray:
    """Join neighbours pairwise until one piece is left; ``cuts`` are the pieces' ends, 0 in front."""
    spans = list(zip(cuts, cuts[1:]))
    while len(pieces) > 1:
        joined, wider = [], []
        for i in range(0, len(pieces) - 1, 2):
            (low, seam), (_, high) = spans[i], spans[i + 1]
            joined.append(join_pieces(encode_places, text, pieces[i], pieces[i + 1], low, seam, high))
            wider.append((low, high))
        if len(pieces) % 2:
            joined.append(pieces[-1])
            wider.append(spans[-1])
        pieces, spans = joined, wider
    return pieces[0]


def halves(length: int, leaf: int) -> list[int]:
    """Ends of the pieces, 0 in front, when halving goes on until a piece has ``leaf`` characters at most."""
    n = 1
    while length > n * leaf:
        n *= 2
    return [length * i // n for i in range(n + 1)]


def vocabulary(path: str) -> str:
    """The vocabulary file's content; read by the driver, so executors need no copy of the file."""
    return Path(path).read_text(encoding="utf-8")


def encode(docs: DataFrame, definition: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each row's whole text and the text that they decode to.

    Ids are little-endian unsigned 32-bit integers in one binary. One row per row of
    ``docs``, also where ids repeat or are null; null text counts as empty and gives no
    ids, an empty table gives no rows. ``definition`` is a tokenizer definition in JSON
    (see :func:`vocabulary`), used with its padding and truncation off and without added
    special tokens; one that parts texts in another way than the word table has all
    texts encoded as they are. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(definition)
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for part in batches:
            texts, at = part["text"].to_pylist(), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and end < at + _ROWS and (end == at or chars + len(texts[end]) <= _CHARS):
                    chars += len(texts[end])
                    end += 1
                some, ids = part.slice(at, end - at), codec.encode_all(texts[at:end])
                at = end
                yield pa.record_batch([some["doc_id"], pa.array(ids, pa.binary()),
                                       pa.array(map(codec.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for doc, key, copies, text in zip(*(part[c].to_pylist() for c in ("doc_id", "key", "copies", "text"))):
                ends = halves(len(text), leaf)
                n = len(ends) - 1
                yield pa.record_batch(
                    [pa.array([doc] * n, pa.int64()), pa.array([key] * n, pa.string()), pa.array([copies] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array([text[a:b] for a, b in zip(ends, ends[1:])], pa.string())],
                    ["doc_id", "key", "copies", "piece", "text"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value)
        for part in batches:
            places = [codec.encode_places(t).astype("<i8").tobytes() for t in part["text"].to_pylist()]
            yield part.append_column("places", pa.array(places, pa.binary()))

    def joined(part: pa.Table) -> pa.Table:
        by_piece = {}
        for piece, text, places in zip(*(part[c].to_pylist() for c in ("piece", "text", "places"))):
            by_piece[piece] = text, np.frombuffer(places, dtype="<i8").reshape(-1, 3).copy()
        texts = [by_piece[i][0] for i in range(len(by_piece))]
        cuts = [0, *np.cumsum([len(t) for t in texts]).tolist()]
        pieces = [by_piece[i][1] for i in range(len(by_piece))]
        for rows, at in zip(pieces, cuts):
            rows[:, 1:] += at
        codec = _codec(held.value)
        ids = join_tree(codec.encode_places, "".join(texts), pieces, cuts)[:, 0].astype("<u4").tobytes()
        return pa.table({"doc_id": part["doc_id"].slice(0, 1), "copies": part["copies"].slice(0, 1), "ids": pa.array([ids], pa.binary()),
                         "decoded": pa.array([codec.decode(ids)], pa.string())})

    made = "doc_id bigint, ids binary, decoded string"
    short = rows.filter(F.length("text") <= leaf).mapInArrow(whole, made)
    # rows that repeat an id and its long text are encoded once
    long = rows.filter(F.length("text") > leaf).withColumn("key", F.sha2(F.col("text").cast("binary"), 256)).groupBy(
        "doc_id", "key", "text").agg(F.count("*").alias("copies"))
    pieces = long.mapInArrow(cut, "doc_id bigint, key string, copies bigint, piece int, text string")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(tasks, "doc_id", "key", "piece").mapInArrow(
        leaves, "doc_id bigint, key string, copies bigint, piece int, text string, places binary")
    whole_again = pieces.groupBy("doc_id", "key").applyInArrow(joined, "doc_id bigint, copies bigint, ids binary, decoded string")
    return short.unionByName(whole_again.select(
        "doc_id", "ids", "decoded", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).drop("_copy"))


def decode(rows: DataFrame, definition: str) -> DataFrame:
    """``rows`` with ``ids`` as ``decoded`` text: the tokens with a space between, as the vocabulary has no decoder."""
    held = rows.sparkSession.sparkContext.broadcast(definition)

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        codec = _codec(held.value)
        return pd.Series([codec.decode(x) if x is not None else None for x in column], dtype=object)

    return rows.withColumn("decoded", text_of("ids"))
