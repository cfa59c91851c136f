import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tasteloom.llm import bpe, queries
from tasteloom.llm.common import table

PATH = queries.word_bpe()
DEFINITION = bpe.vocabulary(PATH)
TOKENIZER = Tokenizer.from_file(PATH)
CODEC = bpe.Codec(DEFINITION)

pieces = st.sampled_from(["the", " ", "  ", "\n", "'", "'s", "'ll", "é", "é", "Éa", "ñ", "a" * 7, "ing", "<|endoftext|>",
                          "<|", "|>", "1", "²", "ß", "Σ", "日本", "🙂", "​", "...", "$$$", "İ", "J̌", "tion", "_"])
texts = st.lists(pieces, max_size=60).map("".join)


def library(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts)
def test_one_piece_equals_the_library(text):
    ids = library(text)
    made = CODEC.encode(text)
    assert np.frombuffer(made, "<u4").tolist() == ids
    assert CODEC.encode_places(text)[:, 0].tolist() == ids
    assert CODEC.decode(made) == TOKENIZER.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(1, 9))
def test_tree_equals_the_library(text, leaf):
    cuts = bpe.halves(len(text), leaf)
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        rows = CODEC.encode_places(text[a:b]).copy()
        rows[:, 1:] += a
        parts.append(rows)
    assert bpe.join_tree(CODEC.encode_places, text, parts, cuts)[:, 0].tolist() == library(text)


@pytest.mark.parametrize("text", ["ab" * 3000, "x" * 5000, "thequickbrown" * 900, "!?" * 2500, "é" * 3000, "日本語" * 900])
def test_long_unsplit_text(text):
    cuts = bpe.halves(len(text), 500)
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        rows = CODEC.encode_places(text[a:b]).copy()
        rows[:, 1:] += a
        parts.append(rows)
    assert bpe.join_tree(CODEC.encode_places, text, parts, cuts)[:, 0].tolist() == library(text)


def test_nulls_repeats_and_clashing_names(spark):
    big = "Thin the ating " * 40 + "z" * 300
    rows = [(1, "Hello world's", "x"), (2, None, "y"), (None, "", "z"), (3, big, "a"), (3, big, "a"), (None, big + "!", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    made = bpe.encode(docs, DEFINITION, leaf=64)
    got = sorted(((r.doc_id, bytes(r.ids)) for r in made.collect()), key=str)
    again = bpe.decode(made.withColumnRenamed("decoded", "first"), DEFINITION)
    assert again.filter("first != decoded").count() == 0
    want = sorted(((d, np.array(library(t or ""), "<u4").tobytes()) for d, t, _ in rows), key=str)
    assert got == want
    assert bpe.encode(docs.limit(0), DEFINITION).collect() == []


def test_many_repeats_of_a_long_text(spark):
    text = "Thin the ating " * 300
    docs = spark.range(10_000).selectExpr("CAST(NULL AS bigint) AS doc_id", f"'{text}' AS text")
    made = bpe.encode(docs, DEFINITION, leaf=1000)
    counts = made.groupBy("doc_id", "ids").count().collect()
    assert [(r["doc_id"], bytes(r["ids"]), r["count"]) for r in counts] == [
        (None, np.array(library(text), "<u4").tobytes(), 10_000)]


def test_words_come_back_from_the_old_generation():
    made = []
    table_ = bpe.WordTable(2)
    for words in ({"a", "b", "c"}, {"a", "d"}, {"b"}, {"c", "e"}, {"a"}):
        table_.learn(words, lambda new: made.extend(sorted(new)) or [w * 2 for w in new])
        assert all(table_.young[w] == w * 2 for w in words)
    assert made == ["a", "b", "c", "d", "c", "e"]     # "c" came too late


def test_other_tokenizers_do_not_use_the_word_table():
    import json

    definition = json.loads(DEFINITION)
    definition["normalizer"] = None
    other = bpe.Codec(json.dumps(definition))
    assert CODEC.by_word and not other.by_word
    plain = Tokenizer.from_str(json.dumps(definition))
    for text in ("Hello World's CAFÉ", "abc DEF 12"):
        assert np.frombuffer(other.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    got = {tuple(r) for r in queries.QUERIES["op5_bpe"](spark, folder).collect()}
    want = set()
    for d, t in table(spark, folder, "documents").select("doc_id", "text").collect():
        ids = library(t or "")
        text = TOKENIZER.decode(ids, skip_special_tokens=False)
        want.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    assert got == want
