"""List-wise boosted trees: LambdaRank gradients on packed lists, leaf-wise trees from histograms.

Candidate lists (bounded by the retrieval depth) are packed once, one row per user, with
features as bin numbers. A boosting round is a map over the packed lists and a few small
aggregations of (leaf, feature, bin) sums; no round shuffles or writes the lists again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS
from tasteloom.functions.seeded import draw_unit
from tasteloom.operators.features import FEATURES
from tasteloom.operators.lists import pack_lists
from tasteloom.operators.ordering import first_per_group
from tasteloom.session import drop_stage, write_stage


def list_gradients(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LambdaRank gradient and curvature per row of one list.

    Rows must be in item order: equal scores rank in that order.
    """
    order = np.argsort(-scores, kind="stable")
    discount = np.empty(len(scores))
    discount[order] = 1.0 / np.log2(np.arange(2, len(scores) + 2))
    gain = np.exp2(labels.astype(float))
    ideal = np.sum(np.sort(gain - 1)[::-1] / np.log2(np.arange(2, len(scores) + 2)))
    grad, hess = np.zeros(len(scores)), np.zeros(len(scores))
    if ideal <= 0:
        return grad, hess
    for level in np.unique(labels)[1:]:
        high, low = np.flatnonzero(labels == level), np.flatnonzero(labels < level)
        delta = np.abs(gain[high][:, None] - gain[low]) * np.abs(discount[high][:, None] - discount[low]) / ideal
        rho = 1.0 / (1.0 + np.exp(scores[high][:, None] - scores[low]))
        push, curve = rho * delta, rho * (1 - rho) * delta
        grad[high] += push.sum(axis=1)
        grad[low] -= push.sum(axis=0)
        hess[high] += curve.sum(axis=1)
        hess[low] += curve.sum(axis=0)
    return grad, hess


def list_ndcg(scores: np.ndarray, labels: np.ndarray, k: int = 10) -> float:
    top = labels[np.argsort(-scores, kind="stable")][:k]
    ideal = np.sort(labels)[::-1][:k]
    discount = 1.0 / np.log2(np.arange(2, len(top) + 2))
    best = float(np.sum(ideal * discount))
    return float(np.sum(top * discount)) / best if best else 0.0


def lambda_gradients(rows: DataFrame, score: str = "score") -> DataFrame:
    """(user_id, item_id, lambda, weight) for one round on (user_id, item_id, score, label)."""
    packed = pack_lists(rows, "user_id", "item_id", [score, "label"])

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            out = [list_gradients(np.asarray(s, float), np.asarray(y)) for s, y in zip(batch[score], batch["label"])]
            yield pd.DataFrame({
                "user_id": np.repeat(batch["user_id"].to_numpy(), [len(g) for g, _h in out]),
                "item_id": np.concatenate(batch["item_id"].to_list()),
                "lambda": np.concatenate([g for g, _h in out]),
                "weight": np.concatenate([h for _g, h in out]),
            })

    kinds = dict(rows.dtypes)
    return packed.mapInPandas(
        kernel, f"user_id {kinds['user_id']}, item_id {kinds['item_id']}, lambda double, weight double"
    )


# ---------------------------------------------------------------- trees as arrays
@dataclass
class Tree:
    """Flat tree: feature -1 marks a leaf; ``leaf`` numbers leaves in the order of their nodes.

    ``bin`` is the place of ``threshold`` among the cut points of its feature.
    """

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)

    def _walk(self, x: np.ndarray, cut: list) -> np.ndarray:
        feature, cut, left, right = (np.asarray(a) for a in (self.feature, cut, self.left, self.right))
        node = np.zeros(len(x), dtype=int)
        while True:
            f = feature[node]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return node
            go_left = x[inner, f[inner]] <= cut[node[inner]]
            node[inner] = np.where(go_left, left[node[inner]], right[node[inner]])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self._walk(x, self.threshold)]

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf node of each row of bin numbers."""
        return self._walk(bins, self.bin)

    def add(self) -> int:
        for name, empty in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("leaf", -1), ("value", 0.0), ("bin", -1)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, bin_: int, threshold: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node] = feature, bin_, threshold
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]


@dataclass
class LambdaMart:
    trees: list[Tree]
    importance: dict[str, float]
    history: list[dict]
    features: tuple[str, ...] = FEATURES

    def score(self, rows: DataFrame, output: str = "ranker_score") -> DataFrame:
        """Add the ensemble score; the forest is bounded by rounds x leaves."""
        shared = rows.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            matrix = np.stack(x.to_numpy()) if len(x) else np.empty((0, len(FEATURES)))
            return pd.Series(sum((t.predict(matrix) for t in shared.value), np.zeros(len(x))))

        return rows.withColumn(output, predict(F.array(*self.features)))

    def importance_table(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.importance.items(), key=lambda kv: (-kv[1], kv[0]))
        return spark.createDataFrame(rows, "feature string, gain double")

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t, n, tree.feature[n], tree.threshold[n], tree.left[n], tree.right[n], tree.leaf[n], tree.value[n])
            for t, tree in enumerate(self.trees) for n in range(len(tree.feature))
        ]
        return spark.createDataFrame(
            rows, "tree int, node int, feature int, threshold double, left int, right int, leaf int, value double"
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> LambdaMart:
        trees: dict[int, Tree] = {}
        for r in table.orderBy("tree", "node").collect():  # bounded: rounds x nodes
            t = trees.setdefault(r["tree"], Tree())
            for name in ("feature", "threshold", "left", "right", "leaf", "value"):
                getattr(t, name).append(r[name])
        return cls([trees[k] for k in sorted(trees)], {}, [])


# ---------------------------------------------------------------- histograms
MAX_BINS = 255
_SCALE = float(1 << 24)   # gradients are summed as whole numbers: sums do not depend on the order of tasks


def cut_points(rows: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cut points of each feature, ``bins`` - 1 at most: a bin ends with its cut point.

    Quantiles from one mergeable sketch per feature, all in one scan.
    """
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f) for f in features)).first()
    return [np.unique(np.asarray(found[f] or [], dtype=float)) for f in features]


def bin_rows(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers: bin ``b`` of a feature holds what is at most its cut point ``b`` and above the one before."""
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def histogram(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, size: int) -> np.ndarray:
    """Sums of gradient and curvature and number of rows: (feature, bin, 3), whole numbers."""
    width = bins.shape[1]
    at = (bins + np.arange(width, dtype=np.int64) * size).ravel()
    columns = [np.bincount(at, None if w is None else np.repeat(w, width), width * size) for w in (grad, hess, None)]
    return np.stack(columns, axis=1).astype(np.int64).reshape(width, size, 3)


def best_split(hist: np.ndarray, features: Sequence[int], min_rows: int, min_curvature: float = 1e-3):
    """``(gain, feature, bin)`` of the best cut of a leaf by the second-order gain, None without one.

    The gain of a cut is G^2 / H of both sides less that of the leaf. Equal gains go to the
    lower feature, then the lower bin.
    """
    total = hist[features[0]].sum(axis=0)
    left = np.cumsum(hist[list(features)], axis=1)[:, :-1]
    right = total - left
    parts = [(s[..., 0] / _SCALE, s[..., 1] / _SCALE, s[..., 2]) for s in (left, right)]
    good = np.logical_and(*((n >= min_rows) & (h >= min_curvature) for _g, h, n in parts))
    if not good.any():
        return None
    gains = sum(np.divide(g * g, h, out=np.zeros_like(g), where=good) for g, h, _n in parts)
    g, h = total[:2] / _SCALE
    gains = np.where(good, gains - g * g / h, -np.inf)
    f, b = np.unravel_index(int(gains.argmax()), gains.shape)
    return (float(gains[f, b]), int(features[f]), int(b)) if gains[f, b] > 0 else None


class Growth:
    """Best-first growth of one tree from histograms that ``measure`` returns.

    ``measure(tree, nodes)`` sums the rows of the asked leaf nodes in one pass over the
    data. Of two siblings the smaller is measured, the other is its parent less it. A
    pass measures the children of all leaves that may still be split, so the number of
    passes follows the depth of the tree, not its leaves; splits are then taken in the
    order of their gain.
    """

    def __init__(self, measure, cuts: Sequence[np.ndarray], features: Sequence[int], leaves: int, min_rows: int):
        self.measure, self.cuts, self.features, self.leaves, self.min_rows = measure, cuts, features, leaves, min_rows
        self.tree, self.hists, self.best, self.passes = Tree(), {}, {}, 0
        self.gains: dict[int, float] = {}

    def _note(self, node: int, hist: np.ndarray) -> None:
        self.hists[node] = hist
        found = best_split(hist, self.features, self.min_rows)
        if found:
            self.best[node] = found

    def _look_ahead(self, leaves: set[int], most: int) -> None:
        """Measure the children of the ``most`` best leaves that have none yet."""
        order = sorted((n for n in leaves if n in self.best and self.tree.left[n] < 0), key=lambda n: (-self.best[n][0], n))[:most]
        asked = {}
        for node in order:
            _gain, f, b = self.best[node]
            a, c = self.tree.split(node, f, b, float(self.cuts[f][b]))
            fewer = 2 * self.hists[node][f, : b + 1, 2].sum() <= self.hists[node][f, :, 2].sum()
            asked[node] = (a, c) if fewer else (c, a)
        made = self.measure(self.tree, [small for small, _ in asked.values()])
        self.passes += 1
        for node, (small, large) in asked.items():
            self._note(small, made[small])
            self._note(large, self.hists[node] - made[small])

    def grow(self) -> Tree:
        root = self.tree.add()
        self._note(root, self.measure(self.tree, [root])[root])
        self.passes += 1
        leaves = {root}
        while len(leaves) < self.leaves:
            open_ = [n for n in leaves if n in self.best]
            if not open_:
                break
            node = min(open_, key=lambda n: (-self.best[n][0], n))
            if self.tree.left[node] < 0:
                self._look_ahead(leaves, self.leaves - len(leaves))
            leaves.remove(node)
            leaves |= {self.tree.left[node], self.tree.right[node]}
            self.gains[self.best[node][1]] = self.gains.get(self.best[node][1], 0.0) + self.best[node][0]
            del self.best[node]
        return self._cut_back(leaves)

    def _cut_back(self, leaves: set[int]) -> Tree:
        """The tree without what was measured ahead of its leaves."""
        out = Tree()

        def copy(node: int) -> int:
            at = out.add()
            if node in leaves:
                g, h = self.hists[node][self.features[0]].sum(axis=0)[:2] / _SCALE
                out.leaf[at] = sum(1 for n in out.leaf if n >= 0)
                out.value[at] = float(g / h) if h else 0.0
                return at
            out.feature[at], out.bin[at], out.threshold[at] = self.tree.feature[node], self.tree.bin[node], self.tree.threshold[node]
            out.left[at] = copy(self.tree.left[node])
            out.right[at] = copy(self.tree.right[node])
            return at

        copy(0)
        return out


def measured(rows: DataFrame, width: int, size: int):
    """``measure`` for ``Growth`` over rows of ``bins`` binary (``width`` bytes a candidate), ``g`` and ``h``
    array<bigint>: one aggregation, of one histogram for each worker and asked node."""
    def measure(tree: Tree, nodes: list[int]) -> dict[int, np.ndarray]:
        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(nodes), width, size, 3), dtype=np.int64)
            place = np.full(len(tree.feature), -1)
            place[nodes] = np.arange(len(nodes))
            for b in batches:
                if not b.num_rows:
                    continue
                bins = np.frombuffer(b"".join(b["bins"].to_pylist()), dtype=np.uint8).reshape(-1, width)
                g, h = (b[c].flatten().to_numpy() for c in "gh")
                own = place[tree.nodes_of(bins)]
                for k in np.unique(own[own >= 0]):
                    some = own == k
                    sums[k] += histogram(bins[some], g[some], h[some], size)
            k, f, c = np.nonzero(sums[..., 2])
            part = sums[k, f, c]
            if len(k):
                yield pa.record_batch([k.astype(np.int32), (f * size + c).astype(np.int32), *np.ascontiguousarray(part.T)],
                                      ["k", "at", "g", "h", "n"])

        parts = rows.mapInArrow(local, "k int, at int, g bigint, h bigint, n bigint")
        found = parts.groupBy("k", "at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
        sums = np.zeros((len(nodes), width * size, 3), dtype=np.int64)   # nodes x features x bins, whatever the data
        for c, name in enumerate("ghn"):
            sums[found["k"].to_numpy(), found["at"].to_numpy(), c] = found[name].to_numpy()
        return {node: sums[i].reshape(width, size, 3) for i, node in enumerate(nodes)}

    return measure


# ---------------------------------------------------------------- boosting
def _lists(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """One row per list: ``part``, ``bins`` (a byte for each candidate and feature), ``label``, ``base`` score."""
    flat = rows.select("user_id", "item_id", "part", F.col("label").cast("int").alias("label"),
                       F.array(*(F.col(f).cast("double") for f in FEATURES)).alias("x"))
    keyed = flat.withColumn("_key", F.struct("user_id", "part"))     # the part is a property of the user
    packed = pack_lists(keyed, "_key", "item_id", ["x", "label"]).select("_key.part", F.flatten("x").alias("x"), "label")

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows_of = [bin_rows(x.values.to_numpy(zero_copy_only=False).reshape(-1, len(cuts)), cuts).tobytes() for x in b["x"]]
            zeros = pa.array([[0.0] * len(labels) for labels in b["label"]], pa.list_(pa.float64()))
            yield pa.record_batch([b["part"], pa.array(rows_of, pa.binary()), b["label"], zeros], ["part", "bins", "label", "base"])

    return packed.mapInArrow(binned, "part string, bins binary, label array<int>, base array<double>")


def _scored(trees: list[Tree], bins: bytes, base: np.ndarray) -> np.ndarray:
    x = np.frombuffer(bins, dtype=np.uint8).reshape(len(base), -1)
    return base + sum((np.asarray(t.value)[t.nodes_of(x)] for t in trees), np.zeros(len(base)))


def _gradients(packed: DataFrame, trees: list[Tree]) -> DataFrame:
    """Gradient and curvature of each list under the ensemble, as whole numbers, and its NDCG@10."""
    shared = packed.sparkSession.sparkContext.broadcast(trees)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grads, curves, ndcg = [], [], []
            for bins, labels, base in zip(b["bins"].to_pylist(), b["label"].to_pylist(), b["base"].to_pylist()):
                labels, scores = np.asarray(labels), _scored(shared.value, bins, np.asarray(base))
                g, h = list_gradients(scores, labels)
                grads.append(np.rint(g * _SCALE).astype(np.int64))
                curves.append(np.rint(h * _SCALE).astype(np.int64))
                ndcg.append(list_ndcg(scores, labels))
            kind = pa.list_(pa.int64())
            yield pa.record_batch([b["part"], b["bins"], pa.array(grads, kind), pa.array(curves, kind), pa.array(ndcg, pa.float64())],
                                  ["part", "bins", "g", "h", "ndcg"])

    return packed.mapInArrow(kernel, "part string, bins binary, g array<bigint>, h array<bigint>, ndcg double")


def _folded(packed: DataFrame, trees: list[Tree]) -> DataFrame:
    """The lists with the trees added to their base scores."""
    shared = packed.sparkSession.sparkContext.broadcast(trees)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base = [_scored(shared.value, bins, np.asarray(s)) for bins, s in zip(b["bins"].to_pylist(), b["base"].to_pylist())]
            yield pa.record_batch([b["part"], b["bins"], b["label"], pa.array(base, pa.list_(pa.float64()))],
                                  ["part", "bins", "label", "base"])

    return packed.mapInArrow(kernel, "part string, bins binary, label array<int>, base array<double>")


def lambdamart_fit(
    rows: DataFrame,
    rounds: int = 500,
    learning_rate: float = 0.05,
    leaves: int = 63,
    min_rows: int = 50,
    feature_fraction: float = 0.9,
    early_stop: int = 50,
    seed: int = DEFAULTS.seed,
    restage_every: int = 20,
) -> LambdaMart:
    """Boost on (user_id, item_id, part, label, features...); part is fit or holdout.

    Trees grow leaf by leaf, the best gain first, to ``leaves`` leaves of ``min_rows``
    candidates at least. Without usable holdout lists the fit runs all rounds. The
    gradients of a round are cached, not written; a lost block is computed again from
    the staged lists. Every ``restage_every`` rounds the trees so far are folded into
    the lists' base scores and the older lists deleted. Importance is the sum of gains.
    """
    cuts = cut_points(rows.where(F.col("part") == "fit"), FEATURES)
    size = max(len(c) for c in cuts) + 1
    packed = write_stage(_lists(rows, cuts), "lists")
    trees: list[Tree] = []
    open_trees: list[Tree] = []
    gains = dict.fromkeys(FEATURES, 0.0)
    history: list[dict] = []
    best_round, best_ndcg = 0, -1.0
    count = max(1, round(feature_fraction * len(FEATURES)))
    for number in range(rounds + 1):
        current = _gradients(packed, open_trees).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            means = {r["part"]: r["ndcg"] for r in current.groupBy("part").agg(F.avg("ndcg").alias("ndcg")).collect()}
            history.append({"round": number, "fit": means.get("fit"), "holdout": means.get("holdout")})
            watched = means.get("holdout")
            if watched is not None and watched > best_ndcg:
                best_round, best_ndcg = number, watched
            if number == rounds or (watched is not None and number - best_round >= early_stop):
                break
            picks = sorted(np.random.default_rng([seed, number]).permutation(len(FEATURES))[:count].tolist())
            fit = current.where(F.col("part") == "fit").select("bins", "g", "h")
            growth = Growth(measured(fit, len(FEATURES), size), cuts, picks, leaves, min_rows)
            tree = growth.grow()
        finally:
            current.unpersist()
        tree.value = [learning_rate * v for v in tree.value]
        for feature, gain in growth.gains.items():
            gains[FEATURES[feature]] += gain
        trees.append(tree)
        open_trees.append(tree)
        if len(open_trees) >= restage_every:
            spent, packed = packed, write_stage(_folded(packed, open_trees), "lists")
            drop_stage(spent)
            open_trees = []
    drop_stage(packed)
    kept = trees[:best_round] if best_ndcg >= 0 else trees
    return LambdaMart(kept, gains, history)


def rerank(scored: DataFrame, score: str = "ranker_score", k: int = 10) -> DataFrame:
    """Best ``k`` per user by score, ties by item id."""
    return first_per_group(scored, ["user_id"], [F.desc(score), F.asc("item_id")], k, "rank").select(
        "user_id", "item_id", F.col(score).alias("score"), "rank"
    )


def fit_holdout(rows: DataFrame, seed: int = DEFAULTS.seed, fit_share: float = 0.85) -> DataFrame:
    return rows.withColumn("part", F.when(draw_unit(seed, "user_id") < fit_share, "fit").otherwise("holdout"))
