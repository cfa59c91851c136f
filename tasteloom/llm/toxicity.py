"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are words and their beginnings of 3 to 8 letters, one count per distinct
word of a document; the model keeps the ``width`` features whose presence differs
most between toxic and clean labelled rows. Labels only say toxic or not; the
grade of a toxic training row is how dense such features are in it, cut at the
quantiles of the toxic rows: 0 clean, 1 .. ``grades`` by severity. One weight
vector serves all thresholds: P(grade > k) = logistic(w.x - t_k), t_0 < t_1 < ...;
the expected severity is the sum of these.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, write_stage
from tasteloom.llm.labels import labelled_sample

_WORD = re.compile(r"[^\W\d_]+")
_CACHED = 300_000


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings (marked by a trailing *)."""
    return [word, *(word[:k] + "*" for k in range(3, min(8, len(word)) + 1))]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray   # ascending; one less than there are grades
    bias: float              # weight of the logarithm of the number of distinct words

    def __post_init__(self):
        self.cache: dict[str, tuple] = {}

    def counts(self, text: str) -> tuple[dict[int, int], int]:
        """How many distinct words of the text have each known feature, and how many words there are."""
        words, cache = words_of(text), self.cache
        if len(cache) > _CACHED:
            cache.clear()
        found: Counter = Counter()
        for w in words:
            ids = cache.get(w)
            if ids is None:
                known = self.features
                ids = cache[w] = tuple(known[f] for f in features_of(w) if f in known)
            if ids:
                found.update(ids)
        return found, len(words)

    def linear(self, text: str) -> float:
        found, n = self.counts(text)
        return sum(self.weights[i] * value(c, n) for i, c in found.items()) + self.bias * np.log1p(n)

    def above(self, texts: list[str]) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        line = np.array([self.linear(t) for t in texts]).reshape(-1, 1)
        return _logistic(line - self.thresholds[None, :])


def value(count, words):
    """Feature value: grows with the count, less in a text of many words."""
    return np.log1p(20.0 * count / np.sqrt(20.0 + words))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_link(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, extra: np.ndarray, grade: np.ndarray, width: int,
             grades: int, ridge: float = 0.5, toxic_weight: float = 3.0, steps: int = 400,
             rate: float = 0.05) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, thresholds and extra weight of the cumulative logit model by Adam on the whole sample.

    ``rows, cols, x`` is a sparse matrix, ``extra`` a dense column, ``grade`` 0 .. ``grades``. Toxic
    rows are few: each counts ``toxic_weight`` times.
    """
    n = len(grade)
    params = np.zeros(width + 1 + grades)
    params[width + 1] = 1.0
    first, second = np.zeros_like(params), np.zeros_like(params)
    weight = np.where(grade > 0, toxic_weight, 1.0)
    weight /= weight.sum()
    for step in range(1, steps + 1):
        w, b, raw = params[:width], params[width], params[width + 1:]
        gaps = np.exp(raw[1:])
        theta = np.concatenate([[raw[0]], raw[0] + np.cumsum(gaps)])
        line = np.bincount(rows, w[cols] * x, n) + b * extra
        up = _logistic(line[:, None] - theta[None, :])                    # P(grade > k)
        edge = np.column_stack([np.ones(n), up, np.zeros(n)])             # P(grade >= k)
        here = np.maximum(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1], 1e-9)
        slope = np.column_stack([np.zeros(n), up * (1 - up), np.zeros(n)])
        low, high = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        d_line = -(low - high) / here * weight
        d_theta = np.zeros(grades)
        for k in range(grades):   # threshold k parts grades k and k + 1
            d_theta[k] = ((slope[:, k + 1] * ((grade == k + 1).astype(float) - (grade == k)) / here * weight).sum())
        grad = np.empty_like(params)
        grad[:width] = np.bincount(cols, d_line[rows] * x, width) + ridge * w / max(n, 1)
        grad[width] = (d_line * extra).sum()
        tail = d_theta[::-1].cumsum()[::-1]
        grad[width + 1] = tail[0]
        grad[width + 2:] = tail[1:] * gaps
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        params -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    raw = params[width + 1:]
    return params[:width], np.concatenate([[raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))]), float(params[width])


def presence(texts: list[str], toxic: list[int]) -> dict[str, list[int]]:
    """Per feature the number of texts, and of toxic texts, that have it."""
    found: dict[str, list[int]] = {}
    for text, y in zip(texts, toxic):
        for f in {f for w in words_of(text) for f in features_of(w)}:
            n = found.setdefault(f, [0, 0])
            n[0] += 1
            n[1] += y
    return found


def contrast(n, t, toxic: int, clean: int) -> tuple:
    """How strongly a feature in ``n`` texts, ``t`` of them toxic, parts the two kinds; and the gap of its shares."""
    gap = t / toxic - (n - t) / clean
    share = n / (toxic + clean)
    return gap * gap / (share * (1 - share) + 1e-9), gap


def fit_chosen(chosen: list[tuple[str, float]], toxic: np.ndarray, sparse: list[tuple[list[int], list[int], int]],
               grades: int = 2) -> Model:
    """The model over ``chosen`` (feature, gap), from each text's (features, counts, number of words)."""
    leaning = np.array([gap > 0 for _, gap in chosen], dtype=bool)
    sizes = np.array([n for *_, n in sparse], dtype=np.float64)
    rows = np.repeat(np.arange(len(sparse)), [len(i) for i, *_ in sparse])
    cols = np.array([i for own, *_ in sparse for i in own], dtype=np.int64)
    counts = np.array([c for _, own, _ in sparse for c in own], dtype=np.float64)
    dense = np.bincount(rows, counts * leaning[cols], len(sparse)) / (1 + sizes)
    cuts = np.quantile(dense[toxic == 1], np.linspace(0, 1, grades + 1)[1:-1])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, dense, side="right"), 0).astype(np.int64)
    w, theta, bias = fit_link(rows, cols, value(counts, sizes[rows]), np.log1p(sizes), grade, len(chosen), grades)
    return Model({f: i for i, (f, _) in enumerate(chosen)}, w, theta, bias)


def _nothing_toxic(grades: int) -> Model:
    return Model({}, np.zeros(0), np.arange(grades) + 20.0, 0.0)


def sparse_rows(texts: list[str], features: dict[str, int]) -> list[tuple[list[int], list[int], int]]:
    reader = Model(features, np.zeros(len(features)), np.zeros(1), 0.0)
    made = [reader.counts(t) for t in texts]
    return [(sorted(found), [found[i] for i in sorted(found)], n) for found, n in made]


def fit_texts(texts: list[str], toxic: np.ndarray, width: int = 2048, grades: int = 2, least_rows: int = 3) -> Model:
    """The model of a few labelled texts; without both kinds of label it calls nothing toxic."""
    n_toxic, n_clean = int(toxic.sum()), int((1 - toxic).sum())
    if not n_toxic or not n_clean:
        return _nothing_toxic(grades)
    scored = [(*contrast(n, t, n_toxic, n_clean), f) for f, (n, t) in presence(texts, toxic.tolist()).items() if n >= least_rows]
    chosen = [(f, gap) for _, gap, f in sorted(scored, key=lambda x: (-x[0], x[2]))[:width]]
    return fit_chosen(chosen, toxic, sparse_rows(texts, {f: i for i, (f, _) in enumerate(chosen)}), grades)


def fit(docs: DataFrame, labels: DataFrame, where: Column, most: int = 8_000, label: str = "toxic", width: int = 2048,
        grades: int = 2, least_rows: int = 3) -> Model:
    """The model of about ``most`` labelled rows for which ``where`` (over ``doc_id``) holds.

    Features are counted and the chosen ones gathered by Spark; the driver sees the
    ``width`` chosen features and their counts in the sampled rows.
    """
    sample = write_stage(labelled_sample(docs, labels, label, where, most), "toxicity-sample")
    totals = sample.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if not totals[0] or not totals[1]:
        return _nothing_toxic(grades)

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, len(part), 500):
                some = part.slice(at, 500)
                found = presence(some["text"].to_pylist(), some["y"].to_pylist())
                yield pa.record_batch([pa.array(found, pa.string()), pa.array([n for n, _ in found.values()], pa.int64()),
                                       pa.array([t for _, t in found.values()], pa.int64())], ["feature", "n", "t"])

    toxic, clean = totals
    gap = F.col("t") / toxic - (F.col("n") - F.col("t")) / clean
    share = F.col("n") / (toxic + clean)
    counts = sample.mapInArrow(counted, "feature string, n bigint, t bigint").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")).filter(F.col("n") >= least_rows)
    best = counts.select("feature", gap.alias("gap"), (gap * gap / (share * (1 - share) + 1e-9)).alias("force"))
    chosen = [(r["feature"], r["gap"]) for r in best.orderBy(F.desc("force"), "feature").limit(width).collect()]
    features = {f: i for i, (f, _) in enumerate(chosen)}

    def gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = sparse_rows(part["text"].to_pylist(), features)
            yield pa.record_batch(
                [part["doc_id"], part["y"], pa.array([i for i, *_ in rows], pa.list_(pa.int32())),
                 pa.array([c for _, c, _ in rows], pa.list_(pa.int32())), pa.array([n for *_, n in rows], pa.int64())],
                ["doc_id", "y", "ids", "counts", "words"])

    rows = sample.mapInArrow(gathered, "doc_id bigint, y int, ids array<int>, counts array<int>, words bigint")
    rows = rows.orderBy("doc_id", "y").toArrow()
    sparse = list(zip(rows["ids"].to_pylist(), rows["counts"].to_pylist(), rows["words"].to_pylist()))
    return fit_chosen(chosen, rows["y"].to_numpy().astype(np.int64), sparse, grades)


def grade(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """``columns`` of each row (``doc_id`` by default) with ``severity``, ``toxic_score`` and ``toxic``.

    ``severity`` is the expected grade, ``toxic_score`` P(grade > 0), ``toxic``
    whether that is 0.5 or more. Texts are read whole; a null text is an empty one.
    Nothing but the text is read. Columns named like the results are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, toxic_score double")
    def graded(texts):
        import pandas as pd

        above = held.value.above(texts.tolist())
        return pd.DataFrame({"severity": above.sum(axis=1), "toxic_score": above[:, 0]})

    kept = [docs[c] for c in columns] or [doc_rows(docs)["doc_id"]]
    made = (docs if columns else doc_rows(docs)).select(*(kept if columns else ["doc_id"]), graded(
        F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_graded"))
    return made.select("*", "_graded.severity", "_graded.toxic_score",
                       (F.col("_graded.toxic_score") >= 0.5).alias("toxic")).drop("_graded")
