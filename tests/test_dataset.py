import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import ordering as R
from tasteloom.operators import splitting as S
from tasteloom.operators import subsample as K
from tasteloom.operators.histories import history_windows
from tasteloom.schema import ContractError, assert_contract
from tests.conftest import rows

COLUMNS = "user_id string, item_id string, rating double, ts bigint"


def skewed(n=3000, seed=0):
    """A third of all rows belong to one user and one item."""
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < 0.33, 0, rng.integers(1, 60, n))
    items = np.where(rng.random(n) < 0.33, 0, rng.integers(1, 80, n))
    return pd.DataFrame({
        "user_id": [f"u{u:03d}" for u in users], "item_id": [f"i{i:03d}" for i in items],
        "rating": rng.integers(1, 6, n).astype(float), "ts": rng.integers(0, 400, n),
    })


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    return pdf, spark.createDataFrame(pdf, COLUMNS)


def test_kcore_cascade(frame):
    chain = [("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("c", "z")]
    df = frame([(u, i, 5.0, 1) for u, i in chain], COLUMNS)
    assert K.kcore(df, 2, 2).count() == 0


@pytest.mark.parametrize("k", [5, 30])
def test_kcore_matches_brute_force(data, k):
    pdf, df = data
    kept, size = pdf, None
    while size != len(kept):
        size = len(kept)
        kept = kept[kept.groupby("item_id")["item_id"].transform("size") >= k]
        kept = kept[kept.groupby("user_id")["user_id"].transform("size") >= k]
    assert rows(K.kcore(df, k, k)) == sorted(map(tuple, kept.to_numpy()))


@pytest.mark.parametrize("cap", [1, 700, 2999, 5000])
def test_recency_cap(data, cap):
    pdf, df = data
    want = pdf.sort_values(["ts", "user_id", "item_id", "rating"], ascending=[False, True, True, True]).head(cap)
    assert rows(K.recency_cap(df, cap)) == sorted(map(tuple, want.to_numpy()))


def test_exact_quantiles(data, spark):
    pdf, df = data
    got = R.exact_quantiles(df, "ts", [0.0, 0.5, 0.85, 0.9, 1.0])
    assert got == pytest.approx([pdf["ts"].quantile(q) for q in (0.0, 0.5, 0.85, 0.9, 1.0)])
    wide = pd.DataFrame({"ts": np.random.default_rng(1).integers(10**12, 10**12 + 10**11, 500)})
    got = R.exact_quantiles(spark.createDataFrame(wide), "ts", [0.85, 0.9])
    assert got == pytest.approx([wide["ts"].quantile(q) for q in (0.85, 0.9)])


def test_positions_and_running_sums_with_a_hot_group(data):
    pdf, df = data
    order = pdf.sort_values(["user_id", "ts", "item_id", "rating"], kind="stable").reset_index(drop=True)
    order["pos"] = order.groupby("user_id").cumcount()
    order["high"] = (order["rating"] >= 4).astype(int)
    order["run"] = order.groupby("user_id")["high"].cumsum()
    pos = R.group_positions(df, ["user_id"], ["ts", "item_id", "rating"])
    assert rows(pos, "user_id", "pos", "item_id") == sorted(map(tuple, order[["user_id", "pos", "item_id"]].to_numpy()))
    run = R.group_running_sum(df, ["user_id"], ["ts", "item_id", "rating"], {"run": (F.col("rating") >= 4)})
    assert rows(run, "user_id", "ts", "item_id", "rating", "run") == sorted(
        map(tuple, order[["user_id", "ts", "item_id", "rating", "run"]].to_numpy())
    )


def test_history_windows_across_chunks(data, monkeypatch):
    from tasteloom.operators import histories

    monkeypatch.setattr(histories, "_CHUNK", 50)
    pdf, df = data
    want = []
    for user, group in pdf.sort_values(["ts", "item_id"]).groupby("user_id"):
        items = group["item_id"].tolist()
        want += [(user, t, tuple(items[max(0, t - 20):t]), items[t]) for t in range(1, len(items))]
    got = [(r["user_id"], r["pos"], tuple(r["history"]), r["target"]) for r in history_windows(df).collect()]
    assert sorted(got) == sorted(want)


def test_split_encode_and_contract(data):
    _pdf, df = data
    train, val, test = S.time_split(df)
    assert train.count() + val.count() + test.count() == df.count()
    assert not S.leakage_check(train, test).first()["leakage"]
    users, items = S.build_encoder(train, "user_id", "u"), S.build_encoder(train, "item_id", "i")
    assert [r["user_id"] for r in users.orderBy("u").collect()] == sorted(r[0] for r in train.select("user_id").distinct().collect())
    encoded = S.encode_ids(df, users, items)
    assert_contract(encoded, users.count(), items.count(), 100)
    with pytest.raises(ContractError):
        assert_contract(encoded, users.count(), 3)


def test_unknown_ids_get_the_last_code(frame):
    train = frame([("b",), ("a",)], "user_id string").withColumn("item_id", F.col("user_id"))
    users, items = S.build_encoder(train, "user_id", "u"), S.build_encoder(train, "item_id", "i")
    other = frame([("a", "c"), ("c", "b")], "user_id string, item_id string")
    assert rows(S.encode_ids(other, users, items), "user_id", "u", "i") == [("a", 0, 2), ("c", 2, 1)]


def test_results_do_not_depend_on_partitions(spark, data):
    _pdf, df = data
    seen = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(rows(R.global_index(df, ["ts", "user_id", "item_id", "rating"]), "idx", "ts", "user_id", "item_id"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_sketched_cuts_are_close_in_rank(spark):
    df = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("ts"))
    n = df.count()
    for q, cut in zip((0.85, 0.90), S.split_cuts_sketch(df)):
        assert abs(df.where(F.col("ts") <= cut).count() / n - q) < 0.002
    parts = S.time_split(df, sketch=True)
    assert sum(p.count() for p in parts) == n
