import numpy as np
from pyspark.sql import functions as F

from tasteloom.llm import quality, queries
from tasteloom.llm.common import table


def test_flat_walk_equals_a_plain_walk():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.grow(x, y, trees=30, depth=3)
    assert (((forest.probability(x) >= 0.5) == y).mean()) > 0.97
    for row in x[:40]:
        total = forest.start
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(threshold):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(threshold)]
        assert abs(total - forest.margin(row[None, :])[0]) < 1e-9


def test_first_split_is_the_best_one():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 10, size=(200, 3)).astype(float)
    y = (x[:, 2] + draw.normal(size=200) > 5).astype(float)
    forest = quality.grow(x, y, trees=1, depth=1, ridge=1.0, least_weight=0.0)
    p = y.mean()
    g, h = y - p, np.full(200, p * (1 - p))

    def gain(f, c):
        left = x[:, f] <= c
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
        return part(left) + part(~left)

    best = max(((gain(f, c), f, c) for f in range(3) for c in range(9)))
    assert forest.feature[0, 0] == best[1]
    assert ((x[:, best[1]] <= best[2]) == (x[:, best[1]] <= forest.threshold[0, 0])).all()


def test_small_cases(spark):
    forest = quality.grow(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    rows = [(1, None, 2.0), (2, "", 3.0), (None, "Some words.", 4.0), (4, "a " * 100_000, 5.0), (4, "a " * 100_000, 5.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    got = quality.score(docs, forest).collect()
    assert len(got) == 5 and {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert quality.score(docs.limit(0), forest).collect() == []
    assert all(np.isfinite(quality.statistics(t)).all() for t in ("", " ", "\n", "é", "a b c", "🙂" * 9))


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    got = queries.QUERIES["op8_quality"](spark, folder).filter("held_out").join(labels, "doc_id")
    n, right = got.agg(F.count("*"), F.sum((F.col("y") == F.col("predicted")).cast("int"))).first()
    assert n > 500 and right / n > 0.98
