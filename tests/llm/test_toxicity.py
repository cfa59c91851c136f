import numpy as np
from pyspark.sql import functions as F

from tasteloom.llm import queries, toxicity
from tasteloom.llm.common import table


def test_gradient_agrees_with_likelihood():
    """The fitted point is a minimum: moving any parameter raises the penalised loss."""
    draw = np.random.default_rng(5)
    n, width = 300, 6
    dense = (draw.random((n, width)) < 0.4) * draw.random((n, width))
    extra = draw.random(n)
    line = dense @ np.array([3.0, -2, 0, 1, 0, 2]) + draw.logistic(size=n)
    grade = np.digitize(line, [1.5, 3.0])
    rows, cols = np.nonzero(dense)
    w, theta, bias = toxicity.fit_link(rows, cols, dense[rows, cols], extra, grade, width, 2, ridge=0.0,
                                       toxic_weight=1.0, steps=3000, rate=0.02)
    assert theta[0] < theta[1]

    def loss(w, theta, bias):
        up = 1 / (1 + np.exp(theta[None, :] - (dense @ w + bias * extra)[:, None]))
        edge = np.column_stack([np.ones(n), up, np.zeros(n)])
        return -np.log(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1]).mean()

    best = loss(w, theta, bias)
    for i in range(width):
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(width)[i], theta, bias) > best - 1e-6
    for d in ([0.05, 0], [-0.05, 0], [0, 0.05], [0, -0.05]):
        assert loss(w, theta + np.array(d), bias) > best - 1e-6


def test_small_cases(spark):
    texts = [f"good plain word number{i} here" for i in range(20)] + [f"nasty vile word number{i} here" for i in range(20)]
    y = np.array([0] * 20 + [1] * 20)
    model = toxicity.fit_texts(texts, y)
    rows = [(1, "a nasty vile thing", "k"), (2, None, "k"), (3, "", "k"), (None, "vile nasty", "k"), (5, "good plain word", "k"),
            (5, "good plain word", "k"), (6, "plain here " * 20_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, severity string")
    got = sorted(((r.doc_id, r.toxic) for r in toxicity.grade(docs, model).collect()), key=str)
    assert got == sorted([(1, True), (2, False), (3, False), (None, True), (5, False), (5, False), (6, False)], key=str)
    kept = toxicity.grade(docs, model, "doc_id", "text")
    assert kept.columns == ["doc_id", "text", "severity", "toxic_score", "toxic"]
    assert toxicity.grade(docs.limit(0), model).collect() == []
    above = model.above(["a nasty vile thing"])
    assert above[0, 0] >= above[0, 1]


def test_one_kind_of_label_calls_nothing_toxic():
    model = toxicity.fit_texts(["a", "b"], np.array([1, 1]))
    assert model.above(["a"]).max() < 0.01
    assert toxicity.fit_texts([], np.zeros(0, dtype=int)).above(["a"]).max() < 0.01


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("y"))
    got = queries.QUERIES["op7_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id")
    caught, wrong, toxic, clean = got.agg(
        F.sum(F.expr("int(toxic and y = 1)")), F.sum(F.expr("int(toxic and y = 0)")), F.sum("y"), F.sum(1 - F.col("y"))).first()
    assert caught / toxic > 0.88 and wrong / clean < 0.01
