import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tasteloom.llm import ppm, queries
from tasteloom.llm.common import crc_mod, table

WHITE = " \t\n\r\x0b\x0c"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    for c in WHITE[1:]:
        text = text.replace(c, " ")
    return [w for w in lower(text).split(" ") if w]


def plain_ppm(training, text):
    """Dictionary trie, walked symbol by symbol."""
    trie = defaultdict(Counter)
    for t in training:
        b = b"\0\0\0" + lower(t).encode() + b"\xff"
        for i in range(3, len(b)):
            for k in range(4):
                trie[b[i - k: i]][b[i]] += 1
    b, total = b"\0\0\0" + lower(text).encode() + b"\xff", 0.0
    for i in range(3, len(b)):
        left, excluded, p = 1.0, set(), None
        for k in (3, 2, 1, 0):
            offered = {s: n for s, n in trie[b[i - k: i]].items() if s not in excluded}
            if not offered:
                continue
            whole = sum(offered.values()) + len(offered)
            if b[i] in offered:
                p = left * offered[b[i]] / whole
                break
            left *= len(offered) / whole
            excluded |= set(offered)
        total += math.log10(p if p is not None else left / (256 - len(excluded)))
    return total


ROWS = [(1, "The cat sat on the mat. The cat!", 1.0), (2, "the dog sat\x0bon the CAT É é", 2.0), (3, None, 3.0), (4, "", 4.0),
        (None, "zebra the", 5.0), (5, "same same", 6.0), (5, "same same", 7.0), (5, "other text", 8.0), (9, "\t\n", 9.0),
        (11, "mat cat " * 400, 1.0)]


def expected(rows, trained):
    training = [t or "" for d, t, *_ in rows if trained(d)]
    counts = Counter(w for t in training for w in [*words_of(t), ""])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for d, t, *_ in rows:
        tokens = [*words_of(t or ""), ""]
        out.append((d, len(tokens), sum(counts[w] > 0 for w in tokens), total,
                    sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens), plain_ppm(training, t or "")))
    return out


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-5, abs=1e-5)


def test_against_a_plain_model(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, score double").repartition(3)
    got = ppm.score(docs, F.col("doc_id") != 2).drop("train").collect()
    close([tuple(r) for r in got], expected(ROWS, lambda d: d is not None and d != 2))


@pytest.mark.parametrize("nodes", [5, 0])
def test_contexts_beyond_the_table_count_as_much(spark, nodes):
    """More three-byte contexts than the bound, repeated and null ids among the rows: equal to the plain model."""
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, score double").repartition(3)
    got = ppm.score(docs, F.col("doc_id") != 2, nodes=nodes).drop("train").collect()
    close([tuple(r) for r in got], expected(ROWS, lambda d: d is not None and d != 2))


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, score double")
    got = {(r.doc_id, r.n_known, r.train_tokens, r.base_score) for r in ppm.score(docs, F.lit(False)).collect()}
    assert {x[1:] for x in got} == {(0, 0, 0.0)}
    assert ppm.score(docs.limit(0), F.lit(True)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = table(spark, folder, "documents").select("doc_id", "text", (crc_mod(7) != 2).alias("t")).collect()
    trained = {r.doc_id: r.t for r in rows}
    got = queries.QUERIES["op9_ppm"](spark, folder).collect()
    assert {r.doc_id: not r.held_out for r in got} == trained
    # the plain model is slow: it scores the shorter texts, trained on all
    short = {r.doc_id for r in rows if len(r.text) < 120}
    training = [r.text for r in rows if r.t]
    counts = Counter(w for t in training for w in [*words_of(t), ""])
    total, kinds = sum(counts.values()), len(counts)
    texts = {r.doc_id: r.text for r in rows}
    for r in got:
        tokens = [*words_of(texts[r.doc_id]), ""]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(tokens), total, sum(counts[w] > 0 for w in tokens))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens))
    picked = [r for r in got if r.doc_id in short][:3]
    for r in picked:
        assert r.score == pytest.approx(plain_ppm(training, texts[r.doc_id]), rel=1e-4)
