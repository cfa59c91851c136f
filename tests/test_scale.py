"""Draws, windows and lists beyond the sizes that earlier limits allowed."""

import pytest
from pyspark.sql import functions as F

from tasteloom.functions.seeded import draw_int
from tasteloom.operators import catalog as G
from tasteloom.operators import commerce as O
from tasteloom.operators import histories as H
from tasteloom.operators import metrics as M
from tasteloom.operators import popularity as P
from tasteloom.plans import source_queries as Q
from tasteloom.session import write_stage
from tests.conftest import rows


def test_draws_reach_beyond_32_bits(spark):
    low, high = spark.range(2000).select(draw_int(1, "id").alias("d")).agg(F.min("d"), F.max("d")).first()
    assert 0 <= low and high > 2**59


def test_windows_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(H, "_CHUNK", 16)
    train = spark.range(100).select(F.lit(1).alias("user_id"), F.col("id").alias("item_id"), F.col("id").alias("ts"))
    sizes = {r["pos"]: len(r["history"]) for r in H.history_windows(train, 40).collect()}
    assert sizes == {n: min(n, 40) for n in range(1, 100)}


def test_random_completion_is_uniform(spark):
    """2,000 users, 40 unseen of 60 items, 5 picks each: about 250 per item."""
    users = spark.range(2000).select(F.col("id").alias("user_id"))
    items = spark.range(60).select((F.col("id") * 10).alias("item_id"), F.col("id").cast("int").alias("i"))
    seen = users.join(items.where("i % 3 = 0").select("item_id"))
    got = P.random_recommend(users, items, seen, n=5, draws=0)
    assert got.count() == 10_000 and got.where("item_id % 30 = 0").count() == 0
    counts = [r["count"] for r in got.groupBy("item_id").count().collect()]
    assert len(counts) == 40 and sum((c - 250) ** 2 / 250 for c in counts) < 80
    assert got.select("user_id", "item_id").distinct().count() == 10_000


def test_backslashes_in_a_search(frame):
    items = frame([(1, "a\\b", None, None, 1.0, 1.0), (2, "ab", None, None, 1.0, 1.0), (3, "50% off", "x", "y", 1.0, 1.0)],
                  "item_id int, title string, brand string, category string, price double, avg_rating double")
    assert [r["item_id"] for r in G.search_items(items, "a\\b").collect()] == [2]
    assert [r["item_id"] for r in G.search_items(items, "a\\\\b").collect()] == [1]
    assert [r["item_id"] for r in G.search_items(items, "50\\%").collect()] == [3]
    assert G.suggest_words(items, "ab\\").count() >= 0


@pytest.mark.parametrize("queries", [["red ring", "%", "r_d", "ring red", "zzz", "", "ri"], ["\\red", "r%g"]])
def test_search_table_equals_single_searches(frame, queries):
    items = frame([(n, f"{c} {k} {n}", b, k, 1.0, float(n % 7)) for n, (c, k, b) in enumerate(
        (c, k, b) for c in ("red", "blue") for k in ("ring", "watch", "tie") for b in ("acme", None))],
        "item_id int, title string, brand string, category string, price double, avg_rating double")
    asked = frame([(q,) for q in queries], "query string")
    got = {}
    for r in sorted(G.search_table(items, asked, 5).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append(r["item_id"])
    want = {q: [r["item_id"] for r in G.search_items(items, q, 5).collect()] for q in queries}
    assert got == {q: v for q, v in want.items() if v}


def test_a_thousand_short_searches(frame, monkeypatch):
    """Blocks of short and wildcard searches, one scan each and no join of all pairs."""
    monkeypatch.setattr(G, "_BLOCK_QUERIES", 300)
    items = frame([(n, f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)} x{n}", None, "k", 1.0, float(n % 7)) for n in range(200)],
                  "item_id int, title string, brand string, category string, price double, avg_rating double")
    queries = [f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}" for n in range(676)] + [f"x_{n}" for n in range(324)]
    found = G.search_table(items, frame([(q,) for q in queries], "query string"), 3)
    assert "CartesianProduct" not in found._jdf.queryExecution().toString() and "NestedLoop" not in found._jdf.queryExecution().toString()
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append(r["item_id"])
    for q in queries[::97]:
        assert got.get(q, []) == [r["item_id"] for r in G.search_items(items, q, 3).collect()]


def test_latency_of_a_hot_value(frame):
    log = frame([({"a": 5.0, "b": float(n)},) for n in range(100)] + [({"a": 9.0},)], "latency_ms map<string,double>")
    assert rows(O.latency_summary(log)) == [("a", 101, pytest.approx((500 + 9) / 101), 5.0), ("b", 100, 49.5, 94.0)]


def test_repetitive_lists_are_not_broadcast_by_file_size(spark):
    """A staged table of lists is far smaller than its rows; neither its join with the truth nor that of its users may broadcast it."""
    recs = write_stage(spark.range(200_000).select(
        (F.col("id") / 50).cast("bigint").alias("user_id"), (F.col("id") % 50).alias("item_id"), (F.col("id") % 50 + 1).cast("int").alias("rank")), "recs")
    truth = spark.range(4000).select(F.col("id").alias("user_id"), (F.col("id") % 60).alias("item_id"))
    scores = M.score_users(recs, truth, (10, 50))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert scores.count() == 4000


def test_saved_times_beyond_64_bits(spark, tmp_path):
    """The sum of the times of a large split is no 64-bit number."""
    day = 2**61
    rows = spark.createDataFrame([(1, n, 5.0, day) for n in range(9)], "user_id bigint, item_id bigint, rating double, ts bigint")

    class Small:
        train, val, test, items = rows, rows.limit(0), rows.limit(0), rows.select("item_id")

    w = Small()
    w.spark = spark
    got = {r["split"]: (r["n_rows"], r["ts_sum"]) for r in Q.saved_split_sums(w).collect()}
    assert got == {"train": (9, float(9 * day)), "val": (0, None), "test": (0, None), "items": (9, 36.0)}
