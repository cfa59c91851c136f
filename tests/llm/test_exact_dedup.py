import pytest
from pyspark.sql import functions as F

from tasteloom.llm import exact_dedup, queries
from tasteloom.llm.common import stage_path
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ROWS = [(3, "a  b", "x"), (1, "a\tb", "y"), (2, "a b", "z"), (None, "a\n b", "w"), (5, None, "v"), (4, "", "u"),
        (7, "same", "t"), (7, "same", "s"), (8, "alone " * 5000, "r"), (9, " a b", "q")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id bigint, text string, digest string")


def weak(content):
    """Two digests for all contents: the bytes have to tell them apart."""
    return F.substring(F.sha2(content.cast("binary"), 256), 1, 1) > "7"


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: weak(c).cast("string")])
def test_small_cases(spark, digest):
    got = exact_dedup.deduplicate(frame(spark), digest).collect()
    assert len(got) == len(ROWS)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert {by_id[i][0].keep_id for i in (1, 2, 3, None)} == {1} and by_id[1][0].group_size == 4
    assert [by_id[i][0].kept for i in (1, 2, 3, None)] == [True, False, False, False]
    assert by_id[5][0].keep_id == 4 and by_id[9][0].group_size == 1
    assert sorted(r.kept for r in by_id[7]) == [False, True] and by_id[7][0].group_size == 2
    assert by_id[4][0].text_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_empty(spark):
    assert exact_dedup.deduplicate(frame(spark, [])).collect() == []


def test_state_goes_on_where_it_stopped(spark):
    folder, state = stage_path(spark, "t-source"), stage_path(spark, "t-state")
    first = spark.createDataFrame([(10, 5, "d"), (11, 6, "e")], "row_id bigint, doc_id bigint, digest string")
    first.write.parquet(folder)
    exact_dedup.advance_state(spark, folder, state)
    spark.createDataFrame([(12, 4, "d"), (13, 9, "e")], first.schema).write.mode("append").parquet(folder)
    exact_dedup.advance_state(spark, folder, state)
    assert {tuple(r) for r in exact_dedup.read_state(spark, state).collect()} == {("d", 4, 12, 2), ("e", 6, 11, 2)}


def test_against_sql(spark):
    name = "op1_exact_dedup"
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) == ""
