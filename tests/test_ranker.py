import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import ranker as L
from tasteloom.operators.features import FEATURES


def test_gradients_match_pair_loops():
    rng = np.random.default_rng(0)
    s, y = np.round(rng.normal(size=30), 1), rng.integers(0, 2, 30)
    grad, hess = L.list_gradients(s, y)
    order = sorted(range(30), key=lambda i: (-s[i], i))
    rank = {i: r for r, i in enumerate(order, 1)}
    ideal = sum(1 / np.log2(r + 1) for r in range(1, y.sum() + 1))
    g, h = np.zeros(30), np.zeros(30)
    for a in range(30):
        for b in range(30):
            if y[a] > y[b]:
                d = abs(1 / np.log2(rank[a] + 1) - 1 / np.log2(rank[b] + 1)) / ideal
                rho = 1 / (1 + np.exp(s[a] - s[b]))
                g[a] += rho * d
                g[b] -= rho * d
                h[a] += rho * (1 - rho) * d
                h[b] += rho * (1 - rho) * d
    assert np.allclose(grad, g) and np.allclose(hess, h)
    assert not np.any(L.list_gradients(s, np.zeros(30, int))[0])


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(5)
    rows = []
    for u in range(120):
        x = rng.normal(size=(20, len(FEATURES)))
        label = np.zeros(20, int)
        label[np.argsort(-(x[:, 3] + 0.1 * rng.normal(size=20)))[:2]] = 1
        rows += [(u, i, "holdout" if u % 5 == 0 else "fit", int(label[i]), *map(float, x[i])) for i in range(20)]
    return spark.createDataFrame(rows, "user_id int, item_id int, part string, label int, " + ", ".join(f"{f} double" for f in FEATURES))


def plain_tree(x, g, h, leaves, min_rows, cuts):
    """Best-first growth by trying every cut of every leaf on the rows themselves."""
    def score(some):
        return g[some].sum() ** 2 / h[some].sum()

    def best(some):
        found = None
        for f, points in enumerate(cuts):
            for c in points:
                left, right = some & (x[:, f] <= c), some & (x[:, f] > c)
                if min(left.sum(), right.sum()) >= min_rows and min(h[left].sum(), h[right].sum()) >= 1e-3:
                    gain = score(left) + score(right) - score(some)
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = gain, f, c, left, right
        return found

    open_, done, gains = [(np.ones(len(x), bool),)], [], []
    open_ = [(open_[0][0], best(open_[0][0]))]
    while len(open_) + len(done) < leaves and any(b for _s, b in open_):
        k = max((i for i, (_s, b) in enumerate(open_) if b), key=lambda i: open_[i][1][0])
        _some, (gain, f, _c, left, right) = open_.pop(k)
        gains.append((f, gain))
        open_ += [(left, best(left)), (right, best(right))]
    return {(int(s.sum()), round(float(g[s].sum() / h[s].sum()), 6)) for s, _b in open_}, gains


def test_leaf_wise_tree_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(2000, len(FEATURES))), 2)
    x[:, 3] = np.round(x[:, 3])
    g = np.sin(2 * x[:, 0]) + (x[:, 1] > 0.3) * x[:, 2] + 0.2 * rng.normal(size=2000)
    h = rng.uniform(0.05, 0.25, 2000)
    g, h = np.rint(g * L._SCALE), np.rint(h * L._SCALE)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], list(FEATURES))
    cuts = L.cut_points(frame, FEATURES, 40)
    assert all(len(c) <= 39 and (np.diff(c) > 0).all() for c in cuts)
    bins = L.bin_rows(x, cuts)
    for f, c in enumerate(cuts):
        for b in (0, len(c) // 2, len(c) - 1):
            assert np.array_equal(bins[:, f] <= b, x[:, f] <= c[b])
    lists = [(bins[i: i + 20].tobytes(), [int(v) for v in g[i: i + 20]], [int(v) for v in h[i: i + 20]]) for i in range(0, 2000, 20)]
    rows = spark.createDataFrame(lists, "bins binary, g array<bigint>, h array<bigint>").repartition(7)
    growth = L.Growth(L.measured(rows, len(FEATURES), 41), cuts, range(len(FEATURES)), 63, 20)
    tree = growth.grow()
    want, gains = plain_tree(x, g / L._SCALE, h / L._SCALE, 63, 20, cuts)
    at = tree.nodes_of(bins)
    got = {(int((at == n).sum()), round(tree.value[n], 6)) for n in range(len(tree.feature)) if tree.leaf[n] >= 0}
    assert got == want and len(want) == len([n for n in tree.leaf if n >= 0]) > 30
    assert np.array_equal(tree.predict(x), np.asarray(tree.value)[at])
    total = {}
    for f, gain in gains:
        total[f] = total.get(f, 0.0) + gain
    assert growth.gains == pytest.approx(total)
    assert growth.passes < len(gains) / 2      # fewer aggregations than splits


def test_growth_stops_without_gain(spark):
    rows = spark.createDataFrame([(bytes(20 * len(FEATURES)), [5] * 20, [1 << 20] * 20)], "bins binary, g array<bigint>, h array<bigint>")
    growth = L.Growth(L.measured(rows, len(FEATURES), 1), [np.zeros(0)] * len(FEATURES), range(len(FEATURES)), 63, 1)
    tree = growth.grow()
    assert tree.feature == [-1] and tree.leaf == [0] and growth.gains == {}


def test_boosting_learns_and_round_trips(spark, training):
    model = L.lambdamart_fit(training, rounds=6, learning_rate=0.3, leaves=8, min_rows=5, restage_every=2)
    assert model.history[-1]["fit"] > model.history[0]["fit"] + 0.2
    assert max(model.importance, key=model.importance.get) == FEATURES[3]
    again = L.LambdaMart.from_table(model.to_table(spark))
    both = again.score(model.score(training, "a"), "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0
    top = L.rerank(model.score(training), k=2).join(training, ["user_id", "item_id"])
    assert top.agg(F.avg("label")).first()[0] > 0.8


def test_without_holdout_all_rounds_are_kept(training):
    model = L.lambdamart_fit(training.withColumn("part", F.lit("fit")), rounds=2, leaves=4, min_rows=5)
    assert len(model.trees) == 2
    assert sum(model.importance.values()) > 0


def test_fit_does_not_depend_on_partitions(training):
    a, b = (L.lambdamart_fit(training.repartition(n), rounds=3, leaves=6, min_rows=5) for n in (1, 9))
    assert a.trees == b.trees and a.importance == b.importance
