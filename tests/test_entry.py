import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
CHECKED = (
    "kcore", "time_split", "encode_ids", "evaluate_popularity", "topn_block_grid", "featurize", "mmr_rerank",
    "cart_state", "checkout_orders", "suggest_index", "stream_event_counts",
)


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 180


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row["method"] == "popularity" and row["n_users_scored"] > 0


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) == ""
