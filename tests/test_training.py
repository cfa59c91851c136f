import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import bpr as B
from tasteloom.operators import towers as T


def test_bpr_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    p, qi, qj = rng.normal(size=(3, 4)), rng.normal(size=(3, 5)), rng.normal(size=(3, 5))
    _loss, gp, gi, gj = B.triplet_gradients(p, qi, qj, 0.01)
    for base, grad, pos in ((p, gp, 0), (qi, gi, 1), (qj, gj, 2)):
        for r in range(base.shape[0]):
            for c in range(base.shape[1]):
                parts = [p.copy(), qi.copy(), qj.copy()]
                parts[pos][r, c] += 1e-6
                up = B.triplet_gradients(*parts, 0.01)[0].sum()
                parts[pos][r, c] -= 2e-6
                down = B.triplet_gradients(*parts, 0.01)[0].sum()
                assert grad[r, c] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_tower_gradients_by_finite_differences():
    rng = np.random.default_rng(1)
    w = T.Weights.initial(4, 6, 0)
    x, y = rng.normal(size=(5, 4)), rng.normal(size=(5, 4))
    _loss, gx, gy, gw = T.batch_gradients(x, y, w, 0.5)

    def loss(a, b, flat):
        return T.batch_gradients(a, b, w.like(flat), 0.5)[0]

    flat = w.flat()
    for n in range(0, len(flat), 7):
        step = np.zeros_like(flat)
        step[n] = 1e-6
        assert gw[n] == pytest.approx((loss(x, y, flat + step) - loss(x, y, flat - step)) / 2e-6, abs=1e-5)
    for grad, place in ((gx, 0), (gy, 1)):
        for r in range(5):
            step = np.zeros((5, 4))
            step[r, r % 4] = 1e-6
            args = [(x + step, y), (x - step, y)] if place == 0 else [(x, y + step), (x, y - step)]
            diff = (loss(*args[0], flat) - loss(*args[1], flat)) / 2e-6
            assert grad[r, r % 4] == pytest.approx(diff, abs=1e-5)


@pytest.fixture(scope="module")
def encoded(spark):
    """Two taste groups of users over two item groups."""
    rng = np.random.default_rng(4)
    rows = []
    for u in range(60):
        liked = rng.permutation(np.arange(0, 30) if u % 2 else np.arange(30, 60))[:12]
        rows += [(u, int(i), 5.0, t) for t, i in enumerate(liked)]
    return spark.createDataFrame(rows, "u int, i int, rating double, ts bigint")


def test_triplets_on_a_dense_user(spark):
    rows = [(0, i, 1.0, 0) for i in range(98)] + [(1, 0, 1.0, 0)] + [(2, i, 1.0, 0) for i in range(100)]
    positives = B.index_positives(spark.createDataFrame(rows, "u int, i int, rating double, ts bigint"))
    got = B.sample_triplets(positives, 3000, 100, proposals=2).toPandas()
    drawn = got[got["u"] == 0]["j"]
    assert set(drawn) == {98, 99} and 0.4 < (drawn == 98).mean() < 0.6
    assert 0 not in set(got[got["u"] == 1]["j"]) and 2 not in set(got["u"])
    assert got["t"].is_unique


def test_bpr_learns_groups(spark, encoded):
    model = B.mf_bpr_fit(encoded, 60, 60, dim=8, lr=0.5, epochs=6, triplets_per_epoch=6000, batch_size=16, seed=1)
    losses = [h["loss"] for h in model.history]
    assert losses[-1] < losses[0] - 0.1
    assert model.loss_history(spark).count() == 6


def test_two_towers_learn_groups(spark, encoded):
    model = T.two_tower_fit(encoded, 60, dim=8, hidden=16, lr=0.02, epochs=6, batch_size=32, temperature=0.2, shard_samples=330)
    losses = [h["loss"] for h in model.history]
    assert losses[-1] < losses[0] - 0.1
    items = {r["item_id"]: np.array(r["vec"]) for r in model.item_vectors().collect()}
    assert all(np.linalg.norm(v) == pytest.approx(1) for v in items.values())
    history = encoded.select(F.col("u").alias("user_id"), "i")
    users = {r["user_id"]: np.array(r["vec"]) for r in model.user_vectors(history).collect()}
    own = np.mean([users[u] @ items[i] for u in users for i in items if (i < 30) == bool(u % 2)])
    other = np.mean([users[u] @ items[i] for u in users for i in items if (i < 30) != bool(u % 2)])
    assert own > other + 0.3
    again = T.Weights.from_table(model.weights.to_table(spark))
    assert np.allclose(again.flat(), model.weights.flat())
    zero = T.zero_for_empty(spark.range(1).withColumn("user_id", F.lit(99)), model.user_vectors(history), 8)
    assert list(zero.first()["vec"]) == [0.0] * 8


def test_one_shard_is_plain_mini_batch_training(spark, encoded):
    """The rounds against dense Adam written out over the whole table."""
    model = T.two_tower_fit(encoded, 60, dim=6, hidden=5, lr=0.01, epochs=2, batch_size=100, temperature=0.3)
    samples = [(r["u"], r["pos"], r["history"], r["target"]) for r in T.history_windows(encoded, 20, "i", "u").collect()]
    weights = T.Weights.initial(6, 5, 42)
    start = spark.range(60).select("id", B.hashed_normal(0.01, 6, 42, F.lit("e"), "id").alias("v")).orderBy("id").collect()
    table, flat = np.array([r["v"] for r in start]), weights.flat()
    state = [np.zeros_like(a) for a in (table, table, flat, flat)]
    t, losses = 0, []
    from tasteloom.functions.seeded import draw_int

    for epoch in (1, 2):
        drawn = {(r["u"], r["pos"]): r["o"] for r in T.history_windows(encoded, 20, "i", "u").select(
            "u", "pos", draw_int(f"42-{epoch}-0", "u", "pos").alias("o")).collect()}
        order = sorted(samples, key=lambda s: drawn[s[0], s[1]])
        own = []
        for at in range(0, len(order), 100):
            some = order[at: at + 100]
            pooled = np.array([table[h].mean(0) for _u, _p, h, _t in some])
            target = np.array([x[3] for x in some])
            loss, gp, gt, gw = T.batch_gradients(pooled, table[target], weights.like(flat), 0.3)
            grad = np.zeros_like(table)
            for k, (_u, _p, h, i) in enumerate(some):
                np.add.at(grad, h, gp[k] / len(h))
                grad[i] += gt[k]
            t += 1
            for value, g, (m, v) in ((table, grad, state[:2]), (flat, gw, state[2:])):
                m[:] = 0.9 * m + 0.1 * g
                v[:] = 0.999 * v + 0.001 * g * g
                value -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            own.append(loss)
        losses.append(np.mean(own))
    assert [h["loss"] for h in model.history] == pytest.approx(losses)
    assert [h["steps"] for h in model.history] == [7, 14]
    got = {r["i"]: r["vec"] for r in model.table.collect()}
    assert np.allclose([got[i] for i in range(60)], table, atol=1e-9) and np.allclose(model.weights.flat(), flat, atol=1e-9)


def test_steps_follow_samples_not_shards(encoded):
    model = T.two_tower_fit(encoded, 60, dim=4, hidden=4, epochs=1, batch_size=20, shard_samples=220, rounds_per_epoch=2)
    assert 6 <= model.history[0]["steps"] / 2 <= 12      # two rounds of some 330 samples in one or two shards
    with pytest.raises(ValueError):
        T.two_tower_fit(encoded.limit(0), 60)


def test_shards_of_one_task_share_their_start(spark, monkeypatch):
    """Three shards a task give what one shard a task gives; a row goes the mean of the ways of its shards."""
    triplets = spark.range(400).selectExpr("id AS t", "cast(id % 9 AS int) AS u", "cast(id % 7 AS int) AS i", "cast(id % 5 + 7 AS int) AS j")
    users, items = B.init_factors(spark, 10, 13, 4)
    monkeypatch.setattr(B, "_SHARD_TRIPLETS", 50)
    made = []
    for shared in (0, 1 << 20):
        monkeypatch.setattr(B, "_GROUP_BYTES", shared)
        u, i, loss = B.bpr_round(triplets, users, items, 4, batch_size=8)
        made.append(({r["u"]: r["vec"] for r in u.collect()}, {r["i"]: r["vec"] for r in i.collect()}, loss))
    for a, b in zip(made[0][:2], made[1][:2]):
        assert set(a) == set(b) and all(np.allclose(a[k], b[k], atol=1e-12) for k in a)
    assert made[0][2] == pytest.approx(made[1][2])


def test_neighbouring_windows_share_a_shard(spark):
    """20 users of 200 rows with items of their own: a shard needs an item once, not each item in nearly every shard."""
    samples = spark.range(4000).selectExpr(
        "cast(id / 200 AS int) AS u", "id % 200 AS pos", "transform(sequence(1, 20), k -> cast(id + k AS int)) AS history", "cast(id AS int) AS target")
    dealt = T._dealt(samples, 8, "s", 20)
    assert dealt.count() == 4000 and dealt.select("shard").distinct().count() == 8
    needed = dealt.selectExpr("shard", "explode(array_union(history, array(target))) AS i").distinct().count()
    assert needed < 2.2 * 4020
    met = dealt.groupBy("shard", "turn", (F.col("target") / 20).cast("int")).count()
    assert met.where("count > 1").isEmpty()


def test_the_fitted_towers_are_whole(spark, encoded, monkeypatch):
    """The query fits the published towers: 64 places, 128 hidden units, ten epochs."""
    from tasteloom.plans import registry
    from tasteloom.plans import training_queries as Q

    fit, made = T.two_tower_fit, []
    monkeypatch.setattr(Q, "encoded", lambda _w: (encoded, None, spark.range(60)))
    monkeypatch.setattr(T, "two_tower_fit", lambda *a, **k: made.append(fit(*a, **k)) or made[-1])
    assert registry.QUERIES["two_tower_fit"](spark, "/nowhere").count() == 10
    assert (made[0].weights.dim, made[0].weights.hidden) == (64, 128)


def test_rounds_follow_the_table_not_the_epoch(spark, encoded, monkeypatch):
    """Shards of an epoch that get more rows than a round may move take several rounds; all draws are used, once."""
    assert B.rounds_within(31, 16384 * 2.25, 20_000, 192, 8) == 1
    assert B.rounds_within(1813, 16384 * 2.25, 1_200_000, 192, 8) > 20
    assert B.rounds_within(18130, 16384 * 2.25, 12_000_000, 192, 8) < 40      # ten times the rows and the table
    assert B.rounds_within(1813, 16384 * 2.25, 1_200_000, 192, 400) <= 5      # each round still has a shard for every core
    bpr_round, drawn = B.bpr_round, []
    monkeypatch.setattr(B, "rounds_within", lambda *a: 4)
    monkeypatch.setattr(B, "bpr_round", lambda some, *a: (drawn.append([r["t"] for r in some.select("t").collect()]), bpr_round(some, *a))[1])
    model = B.mf_bpr_fit(encoded, 60, 60, dim=4, epochs=1, triplets_per_epoch=1000, batch_size=16)
    assert len(drawn) == 4 and sorted(t for some in drawn for t in some) == list(range(1000)) and model.items.count() == 60


def test_tower_rounds_use_every_sample_and_leave_no_stage(spark, encoded, monkeypatch):
    """Each epoch's samples are dealt to the rounds once, and what was dealt is deleted with its folders."""
    def there(file):
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    tower_round, drop, seen, kept = T.tower_round, T.drop_stage, [], []
    monkeypatch.setattr(T, "rounds_within", lambda *a: 3)
    monkeypatch.setattr(T, "tower_round", lambda some, *a: (seen.extend(tuple(r) for r in some.select("u", "pos").collect()), tower_round(some, *a))[1])
    monkeypatch.setattr(T, "drop_stage", lambda df: (drop(df), kept.extend(f for f in df.inputFiles() if there(f))))
    model = T.two_tower_fit(encoded, 60, dim=4, hidden=4, epochs=2, batch_size=20, shard_samples=50)
    assert len(model.history) == 2 and sorted(seen) == sorted(2 * [(u, p) for u in range(60) for p in range(1, 12)]) and not kept
