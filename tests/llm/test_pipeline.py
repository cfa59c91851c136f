import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tasteloom.llm import toxicity
from tasteloom.llm.common import table
from tests.llm.test_bpe import library
from tests.llm.test_decontaminate import plain as leaks
from tests.llm.test_jaccard_join import plain as near


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), F.lit(True))
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    kept = [r for r in rows if model.above([r[1]])[0, 0] < 0.5]
    assert len(kept) < len(rows)
    first = {}
    for doc, text in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), (doc, text))
    kept = list(first.values())
    classes = {doc: c for doc, c, _ in near(kept)}
    kept = [r for r in kept if classes[r[0]] == r[0]]
    leaked = {doc for doc, _ in leaks(kept, items)}
    want = {doc: library(text) for doc, text in kept if doc not in leaked}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in entry.queries()["pipeline"](spark, folder).collect()}
    assert got == want


def test_stages_take_nulls_repeats_and_nothing(spark):
    folder = "/root/testdata/sf0.001"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int"
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "a b c d e f g", None, "s", 13, 1),
            (None, "a b c d e f g", None, "s", 13, 1), (3, "word " * 30_000, "en", None, 150_000, 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        made = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert sorted(r.doc_id for r in made.collect()) == ([1, 2, 3] if some else [])


def test_near_copies_among_repeated_rows(spark):
    """The stage by itself, before exact copies are dropped: one row of each group stays, and all without words."""
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    rows = [(4, long), (4, long), (9, long), (5, long + " nineteen"), (7, ""), (7, ""), (None, None), (None, "a b c d e f"), (None, "a b c d e f"),
            (8, "something else that nobody wrote before this day")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "/root/testdata/sf0.001").collect()), key=str)
    assert got == sorted([(4, long), (7, ""), (7, ""), (None, None), (None, "a b c d e f"), (8, rows[-1][1])], key=str)
