"""Language-model scores by prediction by partial matching over bytes, beside a word-count baseline.

One pass over the documents counts, per task, the byte sequences of the training
rows (a symbol with the three bytes before it: the deepest level of the context
trie; its upper levels are sums of it) and numbers, per block of documents, the
words. Both counts are summed by Spark over the whole corpus.

The trie becomes one table of log probabilities: a row per context, a column per
byte, with escapes by method C (as many chances as the context has symbols) and
symbols excluded that a longer context has offered already. Every context of the
training rows has a row. Those shorter than three bytes (65,793 at most) and the
``nodes`` most frequent of three bytes are in a table of fixed bound that all workers
hold. If there are more, the rows of the others are made on executors, a group for
each last two bytes (256 contexts at most), and joined to the counts of the documents
that use them; what the table gave for these is taken back.

Words are joined with their counts once per block, not once per occurrence: a word
that every document has costs one row per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, stage_path, text_or_empty, write_stage

START, END = b"\0\0\0", b"\xff"   # before a text, and the symbol that ends it (no byte of UTF-8)
_BLOCK = 8 << 20                  # bytes of text per block of documents whose words are numbered together
_GATHER = "kind string, batch bigint, token binary, place int, total bigint, ids array<bigint>, keys array<bigint>, words binary"


def lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower()


def _counts(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable") if weights is not None else None
    values = values[order] if weights is not None else np.sort(values)
    first = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=bool)
    begin = np.nonzero(first)[0]
    if weights is None:
        return values[begin], np.diff(np.append(begin, len(values)))
    return values[begin], np.add.reduceat(weights[order], begin) if len(begin) else np.zeros(0, dtype=np.int64)


def grams(text: bytes) -> np.ndarray:
    """Every byte of ``text`` and its end, each with the three bytes before it, as one unsigned number."""
    b = np.frombuffer(START + text + END, dtype=np.uint8).astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def _block_rows(block: list[tuple], number: int) -> Iterator[pa.RecordBatch]:
    """The words of a block of (doc_id, key, train, words), numbered, and its documents in terms of the numbers."""
    words = pa.array([w for _, _, _, doc in block for w in doc], pa.binary()).dictionary_encode()
    owner = np.repeat(np.arange(len(block)), [len(doc) for _, _, _, doc in block])
    pair, n = _counts(owner << 32 | words.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    owner, code = pair >> 32, pair & 0xFFFFFFFF
    train = np.array([t for _, _, t, _ in block], dtype=bool)
    total = np.bincount(code, np.where(train[owner], n, 0), len(words.dictionary)).astype(np.int64)
    for at in range(0, len(total), 50_000):
        some = words.dictionary.slice(at, 50_000)
        yield _named("word", len(some), batch=pa.array(np.full(len(some), number)), token=some,
                     place=pa.array(np.arange(at, at + len(some), dtype=np.int32)), total=pa.array(total[at: at + 50_000]))
    packed = np.concatenate([np.bincount(owner, minlength=len(block)), np.diff(code, prepend=0), n]).astype("<i4")
    yield _named("docs", 1, batch=pa.array([number], pa.int64()), ids=pa.array([[d for d, _, _, _ in block]], pa.list_(pa.int64())),
                 keys=pa.array([[k for _, k, _, _ in block]], pa.list_(pa.int64())),
                 words=pa.array([zlib.compress(packed.tobytes(), 1)], pa.binary()))


def _named(kind: str, rows: int, **columns) -> pa.RecordBatch:
    kinds = {"batch": pa.int64(), "token": pa.binary(), "place": pa.int32(), "total": pa.int64(),
             "ids": pa.list_(pa.int64()), "keys": pa.list_(pa.int64()), "words": pa.binary()}
    return pa.record_batch({"kind": pa.array([kind] * rows)} | {
        c: columns[c] if c in columns else pa.nulls(rows, t) for c, t in kinds.items()})


def _unpack(words: bytes, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, word number and count of each distinct word of each document of a block."""
    flat = np.frombuffer(zlib.decompress(words), dtype="<i4")
    pairs = (len(flat) - docs) // 2
    owner = np.repeat(np.arange(docs), flat[:docs])
    return owner, flat[docs: docs + pairs].astype(np.int64).cumsum(), flat[docs + pairs:]


def _gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, size, blocks = [], 0, 0
    seen, counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    first = TaskContext.get().partitionId() << 32

    def flush():
        nonlocal block, size, blocks
        yield from _block_rows(block, first + blocks)
        block, size, blocks = [], 0, blocks + 1

    def count():
        nonlocal seen, counts, found, held
        if found:
            new, n = _counts(np.concatenate(found))
            seen, counts = _counts(np.concatenate([seen, new]), np.concatenate([counts, n]))
        found, held = [], 0

    found, held = [], 0
    for part in parts:
        for doc, key, train, text in zip(*(part[c].to_pylist() for c in ("doc_id", "key", "train", "text"))):
            raw = lower_bytes(text)
            block.append((doc, key, train, [*raw.split(), b""]))  # the empty word is the end
            size += len(raw)
            if train:
                found.append(grams(raw))
                held += len(raw)
            if size > _BLOCK:
                yield from flush()
            if held > _BLOCK:
                count()
    count()
    if block:
        yield from flush()
    for a in range(0, len(seen), 50_000):
        part = seen[a: a + 50_000]
        yield _named("gram", len(part), batch=pa.array(part.astype(np.int64)),
                     total=pa.array(counts[a: a + 50_000].astype(np.int64)))


@dataclass
class Trie:
    """Log10 probabilities: ``table[row_of[context], byte]``."""

    table: np.ndarray
    pairs: np.ndarray     # two-byte contexts with a row, in row order
    singles: np.ndarray
    triples: np.ndarray

    def row_of(self) -> np.ndarray:
        """Row of every three-byte context: its own, else that of its longest ending that has one."""
        rows = np.zeros((256, 256, 256), dtype=np.int32)
        at = 1
        for last in self.singles:
            rows[:, :, last] = at
            at += 1
        for pair in self.pairs:
            rows[:, pair >> 8, pair & 255] = at
            at += 1
        flat = rows.reshape(-1)
        flat[self.triples] = at + np.arange(len(self.triples), dtype=np.int32)
        return flat


def _rows(levels: list[np.ndarray]) -> np.ndarray:
    """Log10 probabilities by method C with exclusion; ``levels`` are symbol counts, the longest context first."""
    shape = levels[0].shape
    made, left = np.zeros(shape), np.ones((shape[0], 1))
    excluded = np.zeros(shape, dtype=bool)
    for counts in levels:
        n = np.where(excluded, 0, counts)
        kinds = (n > 0).sum(axis=1, keepdims=True)
        whole = n.sum(axis=1, keepdims=True) + kinds
        made += left * n / np.maximum(whole, 1)
        left = np.where(whole > 0, left * kinds / np.maximum(whole, 1), left)
        excluded |= n > 0
    free = (~excluded).sum(axis=1, keepdims=True)
    made += np.where(excluded, 0, left / np.maximum(free, 1))
    return np.log10(np.maximum(made, 1e-300)).astype(np.float32)


def build_trie(three: tuple[np.ndarray, np.ndarray], four: tuple[np.ndarray, np.ndarray]) -> Trie:
    """From counts of (two bytes, symbol) and of (three bytes, symbol) of the contexts with a row."""
    code, n = three
    pairs, at = np.unique(code >> 8, return_inverse=True)
    second = np.zeros((len(pairs), 256), dtype=np.int64)
    second[at, code & 255] = n
    first = np.zeros((256, 256), dtype=np.int64)
    np.add.at(first, pairs & 255, second)
    zero = first.sum(axis=0)[None, :]
    singles = np.nonzero(first.sum(axis=1))[0]
    parts = [_rows([zero]), _rows([first[singles], np.repeat(zero, len(singles), 0)])]
    for a in range(0, len(pairs), 4096):
        p = pairs[a: a + 4096]
        parts.append(_rows([second[a: a + 4096], first[p & 255], np.repeat(zero, len(p), 0)]))
    code, n = four
    triples, at = np.unique(code >> 8, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, symbol, n = at[order], (code & 255)[order], n[order]
    for a in range(0, len(triples), 4096):
        t = triples[a: a + 4096]
        low, high = np.searchsorted(at, [a, a + len(t)])
        counts = np.zeros((len(t), 256), dtype=np.int64)
        counts[at[low:high] - a, symbol[low:high]] = n[low:high]
        parts.append(_rows([counts, second[np.searchsorted(pairs, t & 0xFFFF)], first[t & 255], np.repeat(zero, len(t), 0)]))
    return Trie(np.concatenate(parts), pairs, singles, triples)


def _other_rows(summed: DataFrame, chosen: DataFrame, three: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``context, logs`` (256 floats) of each three-byte context that is not ``chosen``, made on executors."""
    code, n = three
    first = np.zeros((256, 256), dtype=np.int64)
    np.add.at(first, ((code >> 8) & 255, code & 255), n)

    def rows_of(part: pa.Table) -> pa.Table:
        code, n = part["batch"].to_numpy(), part["n"].to_numpy()
        other = np.asarray(part["top"].is_null())
        context, at = np.unique(code[other] >> 8, return_inverse=True)
        second = np.bincount(code & 255, n, 256).astype(np.int64)
        counts = np.zeros((len(context), 256), dtype=np.int64)
        counts[at, code[other] & 255] = n[other]
        shorter = [np.repeat(x[None, :], len(context), 0) for x in (second, first[int(part["pair"][0].as_py()) & 255], first.sum(axis=0))]
        return pa.table({"context": context, "logs": pa.array([r.tobytes() for r in _rows([counts, *shorter])], pa.binary())})

    context = F.shiftright("batch", 8)
    marked = summed.withColumn("context", context).join(
        F.broadcast(chosen.select("context", F.lit(True).alias("top"))), "context", "left")    # ``nodes`` rows at most
    return marked.select("batch", "n", "top", F.col("context").bitwiseAND(0xFFFF).alias("pair")).groupBy("pair").applyInArrow(
        rows_of, "context bigint, logs binary")


def _taken_back(rows: DataFrame, held, others: DataFrame) -> DataFrame:
    """``doc_id, key, change``: what the rows of ``others`` change in the score of a document."""
    def asked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row_of = _held(held.value)
        own = len(table) - len(held.value.triples)
        for part in parts:
            for doc, key, text in zip(*(part[c].to_pylist() for c in ("doc_id", "key", "text"))):
                code = grams(lower_bytes(text))
                code, n = _counts(code[row_of[code >> 8] < own])
                yield pa.record_batch(
                    [pa.array([doc] * len(code), pa.int64()), pa.array([key] * len(code), pa.int64()), (code >> 8).astype(np.int64),
                     (code & 255).astype(np.int32), n.astype(np.int64), table[row_of[code >> 8], code & 255].astype(np.float64)],
                    ["doc_id", "key", "context", "symbol", "n", "had"])

    uses = rows.mapInArrow(asked, "doc_id bigint, key bigint, context bigint, symbol int, n bigint, had double")
    # rows that repeat an id and its text have one score
    uses = uses.groupBy("doc_id", "key", "context", "symbol").agg(F.min("n").alias("n"), F.min("had").alias("had"))

    def changes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            logs = np.frombuffer(b"".join(part["logs"].to_pylist()), dtype=np.float32).reshape(-1, 256)
            symbol = part["symbol"].to_numpy()
            change = part["n"].to_numpy() * (logs[np.arange(len(logs)), symbol].astype(np.float64) - part["had"].to_numpy())
            yield pa.record_batch([part["doc_id"], part["key"], change], ["doc_id", "key", "change"])

    met = uses.join(others, "context").mapInArrow(changes, "doc_id bigint, key bigint, change double")
    return met.groupBy("doc_id", "key").agg(F.sum("change").alias("change"))


_HELD: dict[int, tuple] = {}


def _held(trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """The table and its row numbers, made once per worker."""
    if id(trie) not in _HELD:
        _HELD.clear()
        _HELD[id(trie)] = trie, trie.row_of()
    return trie.table, _HELD[id(trie)][1]


def log_probability(text: bytes, table: np.ndarray, row_of: np.ndarray) -> float:
    """Log10 probability of the bytes and their end."""
    code = grams(text)
    return float(table[row_of[code >> 8], code & 255].sum(dtype=np.float64))


def _keyed(docs: DataFrame, train: Column) -> DataFrame:
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("key"), F.coalesce(train, F.lit(False)).alias("train"))


def score(docs: DataFrame, train: Column, nodes: int = 65_536) -> DataFrame:
    """Scores of each row of ``docs`` by what the rows where ``train`` (over ``doc_id``) holds have taught.

    ``doc_id, train, n_tokens, n_known, train_tokens, base_score, score``. A null
    text is an empty one: its only token is the end. Rows that repeat an id are
    scored each by its own text. Without training rows every byte is as likely
    as any other and ``base_score`` is 0. ``nodes`` bounds the three-byte contexts
    in the table that workers hold; the others count just as much, by a join.
    """
    spark = docs.sparkSession
    rows = _keyed(docs, train)
    path = stage_path(spark, "ppm-counts")
    rows.mapInArrow(_gather, _GATHER).write.partitionBy("kind").parquet(path)
    gathered = spark.read.schema(_GATHER).parquet(path)

    summed = write_stage(gathered.filter("kind = 'gram'").groupBy("batch").agg(F.sum("total").alias("n")), "ppm-grams")
    context = F.shiftright("batch", 8)
    contexts = write_stage(summed.groupBy(context.alias("context")).agg(F.sum("n").alias("w")), "ppm-contexts")
    chosen = contexts.orderBy(F.desc("w"), "context").limit(nodes)
    four = summed.join(F.broadcast(chosen.select("context")), context == F.col("context"), "left_semi")
    three = summed.groupBy((F.col("batch").bitwiseAND(0xFFFFFF)).alias("batch")).agg(F.sum("n").alias("n"))

    def columns(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = frame.select("batch", "n").toArrow()
        return found["batch"].to_numpy().astype(np.int64), found["n"].to_numpy().astype(np.int64)

    pairs = columns(three)
    held = spark.sparkContext.broadcast(build_trie(pairs, columns(four)))

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row_of = _held(held.value)
        for part in parts:
            made = [log_probability(lower_bytes(t), table, row_of) for t in part["text"].to_pylist()]
            yield pa.record_batch([part["doc_id"], part["key"], part["train"], pa.array(made, pa.float64())],
                                  ["doc_id", "key", "train", "score"])

    words = gathered.filter("kind = 'word'").select("batch", "place", "token", "total")
    known = write_stage(words.groupBy("token").agg(F.sum("total").alias("c")), "ppm-words")
    whole, kinds = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    counted = words.join(known, "token").select("batch", "place", "c", *(
        F.lit(None).cast(t).alias(c) for c, t in (("ids", "array<bigint>"), ("keys", "array<bigint>"), ("words", "binary"))))
    named = gathered.filter("kind = 'docs'").select("batch", "place", F.col("total").alias("c"), "ids", "keys", "words")

    def summed_up(block: pa.Table) -> pa.Table:
        at = block.filter(pa.compute.is_valid(block["ids"]))
        ids, keys, packed = (at[c][0].as_py() for c in ("ids", "keys", "words"))
        some = block.filter(pa.compute.is_null(block["ids"]))
        count = np.zeros(len(some), dtype=np.int64)
        count[some["place"].to_numpy()] = some["c"].to_numpy()
        owner, code, n = _unpack(packed, len(ids))
        weight = np.log10((count + 1) / (whole + kinds + 1))
        sums = [np.bincount(owner, weights=x, minlength=len(ids)) for x in (n, n * (count[code] > 0), n * weight[code])]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()),
                         "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64),
                         "base_score": sums[2]})

    base = counted.unionByName(named).groupBy("batch").applyInArrow(
        summed_up, "doc_id bigint, key bigint, n_tokens bigint, n_known bigint, base_score double")
    base = base.groupBy("doc_id", "key").agg(*(F.first(c).alias(c) for c in ("n_tokens", "n_known", "base_score")))
    base = base.withColumnsRenamed({"doc_id": "b_doc", "key": "b_key"})
    made = rows.mapInArrow(scored, "doc_id bigint, key bigint, train boolean, score double")
    if contexts.count() > nodes:
        change = _taken_back(rows, held, _other_rows(summed, chosen, pairs)).withColumnsRenamed({"doc_id": "c_doc", "key": "c_key"})
        made = made.join(change, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("key") == F.col("c_key")), "left").select(
            "doc_id", "key", "train", (F.col("score") + F.coalesce("change", F.lit(0.0))).alias("score"))
    return made.join(base, F.col("doc_id").eqNullSafe(F.col("b_doc")) & (F.col("key") == F.col("b_key"))).select(
        "doc_id", "train", "n_tokens", "n_known", F.lit(int(whole)).cast("bigint").alias("train_tokens"), "base_score", "score")
