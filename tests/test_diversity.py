import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS
from tasteloom.operators import diversity as D
from tests.conftest import rows


def test_brand_cap(frame):
    df = frame([("u", n, b, n) for n, b in enumerate(["X", "x", "X", "Y", None], 1)], "user_id string, item_id int, brand string, rank int")
    assert [i for _r, i in rows(D.brand_cap(df, 4), "rank", "item_id")] == [1, 2, 4, 5]
    assert [i for _r, i in rows(D.brand_cap(df.where("rank <= 3"), 3), "rank", "item_id")] == [1, 2, 3]


@pytest.fixture(scope="module")
def lists(spark):
    rng = np.random.default_rng(2)
    vec = rng.normal(size=(40, 6))
    vectors = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vec)], "item_id int, vec array<double>")
    cands, raw = [], {}
    for u in range(5):
        items = rng.permutation(45)[:20]  # ids 40..44 have no vector
        score = np.sort(rng.normal(size=20))[::-1]
        raw[u] = [(int(i), float(s)) for i, s in zip(items, score)]
        cands += [(u, i, r, s) for r, (i, s) in enumerate(raw[u], 1)]
    cands += [(9, 41, 1, 0.5), (9, 42, 2, 0.4)]
    return vec, vectors, raw, spark.createDataFrame(cands, "user_id int, item_id int, rank int, score double")


def test_mmr_matches_the_greedy_definition(lists):
    vec, vectors, raw, cands = lists
    unit = vec / (np.linalg.norm(vec, axis=1, keepdims=True) + 1e-9)
    want = [(9, lam, i, r) for lam in (1.0, 0.6) for r, i in ((1, 41), (2, 42))]
    for u, items in raw.items():
        kept = [(i, s) for i, s in items if i < 40]
        rel = np.array([s for _i, s in kept])
        rel = (rel - rel.min()) / (rel.max() - rel.min())
        for lam in (1.0, 0.6):
            picked = []
            while len(picked) < 8:
                value = {n: rel[n] if not picked else lam * rel[n] - (1 - lam) * max(unit[kept[n][0]] @ unit[kept[p][0]] for p in picked)
                         for n in range(len(kept)) if n not in picked}
                picked.append(max(value, key=value.get))
            want += [(u, lam, kept[n][0], r) for r, n in enumerate(picked, 1)]
    got = D.mmr_rerank(cands, vectors, 8, (1.0, 0.6))
    assert rows(got, "user_id", "lambda", "item_id", "rank") == sorted(want)


def test_list_similarity_equals_pair_mean(lists):
    vec, vectors, raw, cands = lists
    unit = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    got = {r["user_id"]: r["similarity"] for r in D.list_similarity(cands, vectors).collect()}
    for u, items in raw.items():
        v = unit[[i for i, _s in items if i < 40]]
        assert got[u] == pytest.approx((v @ v.T)[np.triu_indices(len(v), 1)].mean())
    assert 9 not in got


def test_sampling(lists):
    _vec, vectors, _raw, cands = lists
    assert rows(D.temperature_sample(cands, 5, 0.0), "user_id", "rank") == rows(cands.where("rank <= 5"), "user_id", "rank")
    one = D.temperature_sample(cands, 5, seed=1)
    assert rows(one) == rows(D.temperature_sample(cands.repartition(3), 5, seed=1))
    assert rows(one) != rows(D.temperature_sample(cands, 5, seed=2))
    ordered = one.join(cands.select("user_id", "item_id", F.col("rank").alias("old")), ["user_id", "item_id"]).toPandas()
    assert all(g.sort_values("rank")["old"].is_monotonic_increasing for _u, g in ordered.groupby("user_id"))
    head = cands.where("user_id = 0").select(F.col("rank").alias("pop_rank"), "item_id")
    feed = D.popular_feed(cands, head, vectors, 5, seed=1)
    assert feed.count() == 6 * 5 and feed.groupBy("user_id").agg(F.max("rank").alias("m")).where("m <> 5").count() == 0
    assert D.popular_feed(cands, head, vectors, 5, seed=1, mmr_lambda=0.5).count() == 6 * 5


def test_guarded_neighbours(frame):
    items = frame([(1, "a", 5.0), (2, "a", 1.0), (3, "b", 4.0), (4, "a", 3.0), (5, None, 2.0)], "item_id int, category string, avg_rating double")
    similar = frame([(1, 3, 1), (1, 2, 2), (5, 1, 1)], "item_id int, neighbor_id int, rank int")
    popular = frame([(1, 2), (2, 3)], "rank int, item_id int")
    got = D.similar_guarded(items, similar, items, popular, 2)
    # 2 and 4 have no neighbours and start from the popular list (2, 3); 3 is alone in its category
    assert rows(got.where("item_id in (1, 5)"), "item_id", "rank", "neighbor_id") == [(1, 1, 2), (1, 2, 4), (5, 1, 1)]
    assert rows(got.where("item_id = 4"), "rank", "neighbor_id") == [(1, 2), (2, 1)]


def test_mmr_with_joined_vectors_equals_broadcast_ones(lists, frame):
    from dataclasses import replace

    from tasteloom.config import DEFAULTS

    _vec, vectors, _raw, cands = lists
    odd = frame([(999, 100_000 + n, n + 1, 1.0 - n / 10) for n in range(6)], cands.schema)    # a list without any vector
    both = cands.unionByName(odd)
    a = D.mmr_rerank(both, vectors, 4, (0.7, 0.3))
    b = D.mmr_rerank(both, vectors, 4, (0.7, 0.3), replace(DEFAULTS, broadcast_bytes=0))
    assert rows(a) == rows(b) and rows(a.where("user_id = 999 AND lambda = 0.7"), "item_id") == [(100_000 + n,) for n in range(4)]


def test_similarity_without_vectors_in_the_lists(spark):
    """Lists meet a broadcast table by id; repeated ids, unknown ids and null vectors count as in a join."""
    from dataclasses import replace

    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (2, [3.0, 3.0]), (3, [1.0, 1.0]), (4, None), (5, None), (None, [1.0, 1.0])],
        "item_id bigint, vec array<float>")
    lists = spark.createDataFrame(
        [(u, i) for u, ids in {"a": [1, 2, 3], "b": [1, 1, 9], "c": [4, 5], "d": [1], "e": [9, 8], "f": [3, 4, None], None: [1, 3]}.items() for i in ids],
        "user_id string, item_id bigint")
    got = {r["user_id"]: r for r in D.list_similarity(lists, vectors).collect()}
    want = {r["user_id"]: r for r in D.list_similarity(lists, vectors, opts=replace(DEFAULTS, broadcast_bytes=0)).collect()}
    assert set(got) == set(want) == {"a", "b", "c", "f", None}
    for u, r in want.items():
        assert got[u]["n"] == r["n"] and got[u]["similarity"] == (None if r["similarity"] is None else pytest.approx(r["similarity"]))
    assert "Join" not in D.list_similarity(lists, vectors)._jdf.queryExecution().executedPlan().toString()
