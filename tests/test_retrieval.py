from dataclasses import replace

import numpy as np
import pytest

from tasteloom.config import DEFAULTS
from tasteloom.operators import histories as H
from tasteloom.operators import retrieval as R
from tests.conftest import rows


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    items, users = rng.normal(size=(120, 8)), rng.normal(size=(40, 8))
    items[7] = items[3]  # a tie
    idf = spark.createDataFrame([(f"i{n:03d}", v.tolist()) for n, v in enumerate(items)], "item_id string, vec array<float>")
    udf = spark.createDataFrame([(f"u{n:03d}", v.tolist()) for n, v in enumerate(users)], "user_id string, vec array<float>")
    return users.astype("float32").astype(float), items.astype("float32").astype(float), udf, idf


def brute(users, items, n):
    scores = np.round(users @ items.T, 9)
    return sorted(
        (f"u{u:03d}", f"i{i:03d}", r) for u in range(len(users))
        for r, i in enumerate(sorted(range(len(items)), key=lambda i: (-scores[u, i], i))[:n], 1)
    )


@pytest.mark.parametrize("opts", [DEFAULTS, replace(DEFAULTS, broadcast_bytes=0, vector_block=16), replace(DEFAULTS, score_bytes=1)])
def test_topn_paths_agree(vectors, opts):
    users, items, udf, idf = vectors
    for n in (1, 5, 200):
        got = R.topn_inner_product(udf, idf, n, opts=opts)
        assert rows(got, "user_id", "item_id", "rank") == brute(users, items, n)


def test_ivf_with_all_probes_is_exact(vectors):
    _users, _items, udf, idf = vectors
    cells = R.train_cells(idf, 6)
    exact = R.topn_inner_product(udf, idf, 10, normalize=True)
    every = R.topn_ivf(udf, idf, cells, 10, nprobe=6, opts=replace(DEFAULTS, vector_block=7))
    assert rows(every, "user_id", "item_id", "rank") == rows(exact, "user_id", "item_id", "rank")
    some = R.topn_ivf(udf, idf, cells, 10, nprobe=3)
    hit = some.join(exact, ["user_id", "item_id"]).count() / exact.count()
    assert 0.4 < hit <= 1


def test_small_cells_are_searched_without_a_shuffle_of_lists(vectors):
    """Within the broadcast bound no query is copied to its cells; the lists are those of the grid, ties included."""
    _users, _items, udf, idf = vectors
    cells = R.train_cells(idf, 6)
    for n, nprobe in ((10, 3), (200, 6)):
        near = R.topn_ivf(udf, idf, cells, n, nprobe=nprobe)
        grid = R.topn_ivf(udf, idf, cells, n, nprobe=nprobe, opts=replace(DEFAULTS, broadcast_bytes=0, vector_block=7))
        assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
        got, want = (rows(x, "user_id", "rank", "item_id", "score") for x in (near, grid))
        assert got == want and got


def test_similar_excludes_itself_and_unknown_is_empty(vectors, frame):
    _users, items, _udf, idf = vectors
    found = R.similar_items(idf, 3, frame([("i003",), ("nope",)], "item_id string"))
    got = rows(found, "item_id", "rank", "neighbor_id")
    assert [g[0] for g in got] == ["i003"] * 3 and got[0][2] == "i007"


def test_retrieve_then_filter_may_fall_short(vectors, frame):
    users, items, udf, idf = vectors
    best = brute(users, items, 4)
    seen = frame([(u, i) for u, i, _r in best if u == "u000"], "user_id string, item_id string")
    got = R.recommend_from_vectors(udf, idf, seen, n=3, retrieve=4, normalize=False)
    counts = {r["user_id"]: r["count"] for r in got.groupBy("user_id").count().collect()}
    assert "u000" not in counts and set(counts.values()) == {3}


def test_single_precision_finds_what_double_precision_ranks():
    """Scores closer than single precision tells apart, ties, and lists longer than a group's maxima allow."""
    rng = np.random.default_rng(8)
    items = np.repeat(rng.normal(size=(90, 16)), 20, axis=0) * (1 + 1e-8 * rng.integers(0, 9, size=(1800, 1)))
    queries = rng.normal(size=(30, 16))
    scores = np.round(np.einsum("qd,id->qi", queries, items), 9)
    for n in (1, 15, 50, 400, 5000):
        rows_, cols, vals = R.best_of_block(queries, items, n, 1 << 16)
        want = np.argsort(-scores, axis=1, kind="stable")[:, :n]
        assert (cols.reshape(30, -1) == want).all() and (vals.reshape(30, -1) == np.take_along_axis(scores, want, 1)).all()
    assert len(R._hopeful(queries.astype("f"), items.astype("f"), 15, np.zeros(30))[0]) < 30 * 60


def test_tasks_hold_a_bounded_number_of_pairs(vectors, monkeypatch):
    users, items, udf, idf = vectors
    monkeypatch.setattr(R, "_FEW_ITEMS", 10)
    monkeypatch.setattr(R, "_TASK_PAIRS", 240)
    got = R.topn_inner_product(udf, idf, 5)
    assert got.rdd.getNumPartitions() == 20
    assert rows(got, "user_id", "item_id", "rank") == brute(users, items, 5)


def test_blocks_are_as_large_as_their_memory(vectors):
    """120 items in blocks of 16 by the bytes of a task, and in one block, where the setting alone would make blocks of one or two."""
    users, items, udf, idf = vectors
    for bytes_, vectors_a_block in ((16 * 8 * 16, 1), (1 << 20, 2)):
        opts = replace(DEFAULTS, broadcast_bytes=0, vector_block=vectors_a_block, score_bytes=bytes_)
        got = R.topn_inner_product(udf, idf, 5, opts=opts)
        assert rows(got, "user_id", "item_id", "rank") == brute(users, items, 5)


@pytest.mark.parametrize("items", ["drawn", "rising", "copies", "one"])
def test_tiles_against_plain(items, monkeypatch):
    """Tiles with a rest, items that get better and better, copies, and nothing but copies."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(5003, 6))
    if items == "rising":
        vectors = vectors[np.argsort(vectors[:, 0])]
    elif items == "copies":
        vectors = np.tile(vectors[:500], (10, 1))
    elif items == "one":
        vectors = np.repeat(vectors[:1], 5003, axis=0)
    queries = rng.normal(size=(30, 6)) + 3 * (items == "rising") * np.eye(6)[0]
    monkeypatch.setattr(R, "_RANKED_AT_ONCE", 100)
    for n in (1, 20, 100):
        for crowded in (1, 16):
            monkeypatch.setattr(R, "_CROWDED", crowded)
            got, want = R.best_of_block(queries, vectors, n, 1 << 20), R._best_plain(queries, vectors, n, 30)
            assert all(np.array_equal(g, w) for g, w in zip(got, want))


def test_seen_items_leave_before_any_shuffle(spark, vectors):
    users, items, udf, idf = vectors
    idf = idf.unionByName(idf.where("item_id = 'i005'"))  # an id may come twice
    seen = spark.createDataFrame([(f"u{u:03d}", f"i{i:03d}") for u in range(0, 40, 2) for i in range(u, 120, 3)]
                                 + [("u001", None), (None, "i001"), ("u003", "elsewhere")], "user_id string, item_id string")
    got = R.recommend_from_vectors(udf, idf, seen, n=6, retrieve=20, normalize=False)
    taken = {(r.user_id, r.item_id) for r in seen.collect()}
    want = []
    for user in range(40):
        ranked = sorted([*range(120), 5], key=lambda i: (-round(float(users[user] @ items[i]), 9), i))[:20]
        fresh = [i for i in ranked if (f"u{user:03d}", f"i{i:03d}") not in taken][:6]
        want += [(f"u{user:03d}", f"i{i:03d}", r) for r, i in enumerate(fresh, 1)]
    assert rows(got, "user_id", "item_id", "rank") == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")] and "Window" not in plan


def test_parts_of_the_items_agree(vectors):
    """Beyond the broadcast bound: lists of parts are carried on, not shuffled."""
    users, items, udf, idf = vectors
    opts = replace(DEFAULTS, broadcast_bytes=120 * 8 * 8 // 3)
    for n in (1, 5, 200):
        got = R.topn_inner_product(udf, idf, n, opts=opts)
        assert rows(got, "user_id", "item_id", "rank") == brute(users, items, n)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    seen = udf.select("user_id").crossJoin(idf.where("item_id < 'i060'").select("item_id"))
    few = R.recommend_from_vectors(udf, idf, seen, 5, 20, opts=opts)
    assert rows(few) == rows(R.recommend_from_vectors(udf, idf, seen, 5, 20))


def test_seen_items_without_vector_are_never_shuffled(spark, vectors):
    """They leave where they are read, before they are made distinct; the ids are within the broadcast bound."""
    _users, _items, udf, idf = vectors
    log = spark.createDataFrame([(f"u{n % 40:03d}", f"x{n}") for n in range(200)] + [("u001", "i001")] * 3, "user_id string, item_id string")
    listed = log.select("user_id", "item_id").distinct().join(R._ids_of(idf, 120, DEFAULTS), "item_id", "left_semi")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert rows(listed, "user_id", "item_id") == [("u001", "i001")]


def test_seen_items_leave_lists_of_parts_without_a_shuffle(spark, vectors):
    """Beyond the broadcast bound, with a user who has seen a whole list, null and unknown ids, and an id twice."""
    _users, _items, udf, idf = vectors
    idf = idf.unionByName(idf.where("item_id = 'i005'"))
    seen = spark.createDataFrame([(f"u{u:03d}", f"i{i:03d}") for u in range(0, 40, 2) for i in range(u, 120, 3)]
                                 + [("u001", f"i{i:03d}") for i in range(120)]
                                 + [("u003", None), (None, "i001"), ("u003", "elsewhere")], "user_id string, item_id string")
    opts = replace(DEFAULTS, broadcast_bytes=120 * 8 * 8 // 3)
    got = R.recommend_from_vectors(udf, idf, seen, 6, 20, opts=opts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    found = rows(got)
    assert found == rows(R.recommend_from_vectors(udf, idf, seen, 6, 20)) and "u001" not in {r[0] for r in found}


def test_pooled_history_stays_with_its_user(spark, vectors):
    """Vectors within the bound are broadcast, so their sums are not shuffled; beyond it, the same means."""
    _users, items, _udf, idf = vectors
    log = spark.createDataFrame([(u, f"i{(7 * u + n) % 130:03d}", n) for u in range(9) for n in range(30)],
                                "user_id bigint, item_id string, ts bigint")
    recent = H.recent_rows(log)
    pooled = H.mean_pool(recent, idf, 8)
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of the log, by user
    apart = H.mean_pool(recent, idf, 8, replace(DEFAULTS, broadcast_bytes=0))
    for got in (pooled, apart):
        for row in got.collect():
            own = [(7 * row.user_id + n) % 130 for n in range(10, 30)]
            assert np.allclose(row.vec, items[[i for i in own if i < 120]].mean(axis=0))
