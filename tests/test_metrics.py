import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import metrics as M
from tasteloom.operators import popularity as B
from tasteloom.operators.splitting import build_encoder
from tests.conftest import rows
from tests.test_dataset import COLUMNS, skewed

RECS = "user_id string, item_id string, rank int"


def test_recall_and_ndcg_literals(frame):
    recs = frame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3)], RECS)
    truth = frame([("u", "b"), ("u", "z")], "user_id string, item_id string")
    got = M.score_users(recs, truth, [3]).first()
    assert got["recall_3"] == 0.5 and got["ndcg_3"] == pytest.approx(0.386853, abs=1e-6)


def test_recall_divides_by_all_relevant_and_duplicates(frame):
    truth = frame([("u", f"i{n}") for n in range(20)], "user_id string, item_id string")
    recs = frame([("u", "i0", 1), ("u", "i0", 2)], RECS)
    got = M.score_users(recs, truth, [10]).first()
    assert got["recall_10"] == pytest.approx(0.05)
    ideal = sum(1 / math.log2(r + 1) for r in range(1, 11))
    assert got["ndcg_10"] == pytest.approx((1 + 1 / math.log2(3)) / ideal)


def test_coverage_counts_everybody_and_nobody_scored_raises(frame):
    recs = frame([("u", "a", 1), ("v", "b", 1)], RECS)
    truth = frame([("u", "a")], "user_id string, item_id string")
    got = M.evaluate(recs, truth, 4, [1]).first()
    assert (got["coverage_1"], got["n_users_scored"]) == (0.5, 1)
    with pytest.raises(ValueError):
        M.require_scored(M.evaluate(recs, truth.where("user_id = 'none'"), 4, [1]))


def test_bucket_labels(frame):
    df = frame([(n,) for n in (0, 1, 4, 5, 19, 20)], "n int").select(M.bucket_label(F.col("n")).alias("b"))
    assert [r["b"] for r in df.collect()] == ["0", "1-4", "1-4", "5-19", "5-19", "20-+"]


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_popularity_matches_brute_force(spark, head):
    """head = 0 sends nearly every user through the deep path."""
    pdf = skewed()
    df = spark.createDataFrame(pdf, COLUMNS)
    order = pdf.groupby("item_id").size().reset_index(name="n").sort_values(["n", "item_id"], ascending=[False, True])["item_id"]
    seen = pdf.groupby("user_id")["item_id"].agg(set)
    want = [(u, i, r) for u, s in seen.items() for r, i in enumerate([i for i in order if i not in s][:10], 1)]
    recs = B.popularity_recommend(df, B.popularity_rank(df), df.select("user_id", "item_id"), 10, head)
    assert rows(recs, "user_id", "item_id", "rank") == sorted(want)


def test_random_lists_are_whole_and_unseen(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf, COLUMNS)
    items = build_encoder(df, "item_id", "i")
    seen = pdf.groupby("user_id")["item_id"].agg(set)
    recs = B.random_recommend(df, items, df.select("user_id", "item_id").distinct(), 60, draws=0)
    got = recs.toPandas().sort_values("rank").groupby("user_id")["item_id"].agg(list)
    n_items = pdf["item_id"].nunique()
    for user, have in seen.items():
        mine = got.get(user, [])
        assert len(mine) == len(set(mine)) == min(60, n_items - len(have)) and not set(mine) & have
    assert rows(recs.repartition(3)) == rows(recs)
    assert len({tuple(v[:5]) for v in got}) > len(got) // 2
    assert np.isfinite(len(got))
