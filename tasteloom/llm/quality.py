"""Document quality by histogram gradient-boosted trees over document statistics.

The trees are grown level by level on binned statistics of a bounded sample of
labelled rows, then flattened: a tree is an array of features, one of thresholds
and one of leaf values, so a batch of documents walks every tree with a few numpy
look-ups per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty
from tasteloom.llm.labels import labelled_sample

BINS = 64
_KINDS = 10


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 8, dtype=np.uint8)          # other ASCII: symbols and controls
    for kind, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r",
                                  b"\n", b".,;:'\"-?()", b"!", b"|")):
        kinds[list(chars)] = kind
    kinds[128:192] = 9                               # continuation bytes: no character of their own
    kinds[192:] = 0                                  # letters beyond ASCII count as lower case
    return kinds


_BYTE_KINDS = _byte_kinds()
STATISTICS = ("lower", "upper", "digit", "blank", "newline", "punctuation", "shout", "bar", "symbol", "log_chars",
              "log_words", "word_mean", "word_spread", "word_max", "short_words", "distinct_words", "distinct_triples",
              "repeated_next", "distinct_lines", "words_per_line")


def statistics(text: str) -> np.ndarray:
    """The statistics of a whole text; all defined for the empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_BYTE_KINDS[np.frombuffer(raw, dtype=np.uint8)], minlength=_KINDS)[: _KINDS - 1]
    words, lines = raw.split(), raw.split(b"\n")
    chars, n = max(int(kinds.sum()), 1), max(len(words), 1)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    triples = max(len(words) - 2, 1)
    return np.array([
        *(kinds / chars), np.log1p(chars), np.log1p(len(words)), sizes.mean(), sizes.std(), min(sizes.max(), 1000.0),
        (sizes <= 3).mean(), len(set(words)) / n, len(set(zip(words, words[1:], words[2:]))) / triples,
        sum(map(eq, words, words[1:])) / n, len(set(lines)) / len(lines), n / len(lines)])


@dataclass
class Forest:
    """``trees`` complete trees of one depth; nodes of a level lie next to each other."""

    feature: np.ndarray     # trees x (2**depth - 1)
    threshold: np.ndarray   # go right if the value is larger
    leaf: np.ndarray        # trees x 2**depth
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row of ``x`` reaches."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(threshold)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, ridge: float = 1.0,
         least_weight: float = 1.0) -> Forest:
    """Boosted trees for the log loss of 0/1 labels by Newton steps on histograms."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)] if n else []
    binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]) if n else x
    positive = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(positive / (1 - positive)))
    inner = 2 ** depth - 1
    forest = Forest(np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf),
                    np.zeros((trees, 2 ** depth)), start)
    if not n or y.min() == y.max():
        return forest
    flat_feature = np.arange(width) * BINS
    margin = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (width * BINS) + flat_feature + binned).ravel()
            g, h = (np.bincount(at, np.repeat(v, width), count * width * BINS).reshape(count, width, BINS).cumsum(axis=2)
                    for v in (gradient, curvature))
            gl, hl, gt, ht = g[..., :-1], h[..., :-1], g[..., -1:], h[..., -1:]
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain = np.where((hl >= least_weight) & (ht - hl >= least_weight), gain, 0.0).reshape(count, -1)
            best = gain.argmax(axis=1)
            for k in np.nonzero(gain[np.arange(count), best] > 1e-9)[0]:
                f, cut = divmod(int(best[k]), BINS - 1)
                forest.feature[t, first + k] = f
                forest.threshold[t, first + k] = cuts[f][cut] if cut < len(cuts[f]) else np.inf
            node = 2 * node + 1 + (x[np.arange(n), forest.feature[t, node]] > forest.threshold[t, node])
        leaf = node - inner
        g, h = (np.bincount(leaf, v, 2 ** depth) for v in (gradient, curvature))
        forest.leaf[t] = rate * g / (h + ridge)
        margin += forest.leaf[t, leaf]
    return forest


def fit(docs: DataFrame, labels: DataFrame, where: Column, most: int = 20_000, label: str = "quality", **options) -> Forest:
    """Trees fitted to about ``most`` labelled rows for which ``where`` (over ``doc_id``) holds."""
    sample = labelled_sample(docs, labels, label, where, most)

    def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [statistics(t) for t in part["text"].to_pylist()]
            yield pa.record_batch([part["doc_id"], part["y"], pa.array(made, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = sample.mapInArrow(measured, "doc_id bigint, y int, x array<double>").orderBy("doc_id", "y").toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return grow(x, rows["y"].to_numpy().astype(np.float64), **options)


def score(docs: DataFrame, forest: Forest, *more: Column) -> DataFrame:
    """``doc_id, more, score, predicted`` of each row; reads nothing but the text, null as empty."""
    held = docs.sparkSession.sparkContext.broadcast(forest)

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        for part in parts:
            x = np.array([statistics(t) for t in part["text"].to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.record_batch([part["doc_id"], pa.array(trees.probability(x))], ["doc_id", "score"])

    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))
    found = rows.mapInArrow(scored, "doc_id bigint, score double")
    return found.select("doc_id", *more, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
