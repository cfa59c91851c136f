import random

from pyspark.sql import functions as F

from tasteloom.llm import language, queries
from tasteloom.llm.common import table


def plain_pieces(text: str, known: str) -> int:
    """Greedy longest known pieces, by substring search."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at: at + size + 1] in known and text[at] in known:
            size += 1
        at += size
        n += 1
    return n


def test_cross_parse_equals_substring_search(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 50)
    draw = random.Random(3)
    known = ["".join(draw.choice("abc ") for _ in range(200)), "".join(draw.choice("bcd ") for _ in range(150))]
    model = language.Model(["x", "y"], list("abcd"), known)
    texts = [" ".join("".join(draw.choice("abcde ") for _ in range(n)).split()) for n in (0, 1, 7, 49, 50, 51, 300)]
    symbols = [model.encode(t) for t in texts]
    got = model.pieces(symbols)
    for i, codes in enumerate(symbols):
        text = "".join(chr(65 + c) for c in codes)
        for k, labelled in enumerate(known):
            own = "".join(chr(65 + c) for c in model.encode(labelled))
            assert got[i, k] == sum(plain_pieces(text[a: a + 50], own) for a in range(0, len(text), 50))


def test_undetermined_empty_and_clashing(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the hat", "en", 1), (2, "der hund und das haus", "de", 2), (3, None, "en", 3), (4, "12 $$", None, 4),
         (None, "das haus und der hund", None, 5), (5, "", "de", 6), (5, "the hat and the cat", None, 7)],
        "doc_id long, text string, lang string, score int")
    model = language.fit(docs)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    assert got == {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (None, "de"), (5, "und"), (5, "en")}
    assert language.identify(docs.limit(0), model).collect() == []
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_any_part_of_a_text_is_learnt(spark):
    """Only the last third of the texts tells the languages apart; one id for all rows; repeated rows."""
    draw = random.Random(5)

    def words(letters, n):
        return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(n))

    rows = [(1, words("mnopq", 600) + " " + words(letters, 300), lang) for lang, letters in (("x", "abcde"), ("y", "vwxyz")) for _ in range(40)]
    rows += rows[:5] * 30
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=30, chars=20_000)
    assert model.languages == ["x", "y"] and all(15_000 < len(t) < 40_000 for t in model.texts)
    asked = [(n, words("abcde" if n % 2 else "vwxyz", 20)) for n in range(40)]
    got = language.identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    assert all(r.lang_pred == ("x" if r.doc_id % 2 else "y") for r in got)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op4_language"](spark, folder)
    both = got.filter("held_out").join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    n, right = both.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 150 and right / n > 0.97
