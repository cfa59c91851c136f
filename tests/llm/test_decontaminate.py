import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tasteloom.llm import decontaminate, queries
from tasteloom.llm.common import table


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingle_counts(w):
    return Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def plain(docs, items):
    """Every window of every item's size in every document."""
    found = {}
    for doc, text in docs:
        w = words(text)
        for item, other in items:
            v = words(other)
            if len(v) < 5 or len(w) < 5:
                continue
            want, size = shingle_counts(v), min(len(v), len(w))
            if not any(s in want for s in shingle_counts(w)):
                continue
            best = max(similarity(shingle_counts(w[s: s + size]), want) for s in range(len(w) - size + 1))
            if best >= 0.8:
                found[doc, item] = best
    return found


def test_documents_against_all_windows(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    want = plain(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.QUERIES["op2_decontaminate"](spark, folder).collect()}
    assert len(want) > 5 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_edited_passages(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(20, 70)))) for i in range(30)]
    docs = []
    for n in range(120):
        w = words(draw.choice(items)[1])
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(w))
            w[at: at + 1] = draw.choice([[], ["new"], [w[at], "added"]])
        around = [[draw.choice(vocabulary) for _ in range(draw.randint(0, 60))] for _ in range(2)]
        docs.append((n, " ".join(around[0] + w + around[1])))
    want = plain(docs, items)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= want.keys() and len(want) > 40
    assert len(want.keys() - got) <= len(want) * 0.02


def test_index_misses_nothing_within_the_radius(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(20)]
    near = []
    for x in base:
        for bits in (0, 1, 6, 11, 12):
            y = x
            for b in draw.sample(range(64), bits):
                y ^= 1 << b
            near.append(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    left = spark.createDataFrame([(signed(x),) for x in near], "fp long")
    right = spark.createDataFrame([(signed(x),) for x in base], "item_fp long")
    got = {tuple(r) for r in decontaminate.near_fingerprints(left, right).collect()}
    assert got == {(signed(x), signed(y)) for x in near for y in base if (x ^ y).bit_count() <= 11}


def test_simhash_is_the_majority_of_word_hashes(spark):
    rows = spark.createDataFrame([(["a", "b", "a", "zz"],), (["q"],)], "w array<string>")
    for r in rows.select("w", F.transform("w", lambda w: F.xxhash64(w)).alias("h"), decontaminate.simhash(F.col("w")).alias("fp")).collect():
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r.h) > len(r.h))
        assert r.fp & (2 ** 64 - 1) == want


def test_small_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(1, passage, 0), (2, "short item", 0), (3, None, 0), (4, passage.upper(), 0)],
                                  "item_id bigint, text string, key int")
    rows = [(1, "x " * 30_000 + passage + ", y" * 9, 0), (2, None, 0), (3, "", 0), (None, passage, 0), (5, "one two three", 0), (6, passage, 0),
            (6, passage, 0), (6, "clean " * 9, 0), (7, "x one two three four five y", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hash int")
    got = sorted(((r.doc_id, r.item_id, r.similarity, r.start) for r in decontaminate.find(docs, items).collect()), key=str)
    assert got == sorted(((d, i, 1.0, s) for d, s in ((1, 30_000), (None, 0), (6, 0)) for i in (1, 4)), key=str)
    assert decontaminate.find(docs.limit(0), items).collect() == decontaminate.find(docs, items.limit(0)).collect() == []


def test_passages_cut_at_an_end(spark):
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    items, docs = [], []
    for i in range(400):
        w = [draw.choice(vocabulary) for _ in range(draw.choice([22, 31, 40, 49]))]
        items.append((i, " ".join(w)))
        most = (len(w) - 4) // 9  # words that may differ at 0.8
        new = [draw.choice(vocabulary) for _ in range(most)]
        docs.append((i, " ".join(w[:-most] + new if i % 2 else new + w[most:])))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(got & {(i, i) for i in range(400)}) >= 397


def test_fingerprints_are_short_expressions(spark):
    """The driver plans these expressions anew for every step: they have a loop for bits and changes, not a branch for each."""
    draw = random.Random(9)
    rows = [(n, [f"w{draw.randrange(40)}" for _ in range(n)]) for n in range(25)]
    docs = spark.createDataFrame(rows, "n bigint, w array<string>")
    made = docs.select("n", F.transform("w", lambda w: F.xxhash64(w)).alias("hashes"), decontaminate.simhash(F.col("w")).alias("fp"))
    for r in made.withColumn("keys", decontaminate.block_keys(F.col("fp"), 2)).collect():
        votes = [sum(h >> k & 1 for h in r.hashes) for k in range(64)]
        fp = sum(1 << k for k in range(64) if 2 * votes[k] > r.n)
        assert r.fp % (1 << 64) == fp
        want = []
        for block, (low, high) in enumerate(decontaminate._block_bounds()):
            value = fp >> low & (1 << high - low) - 1
            want += [(block, value ^ m) for m in range(1 << high - low) if m.bit_count() <= 2]
        assert Counter(map(tuple, r["keys"])) == Counter(want)
    assert len(str(decontaminate.simhash(F.col("w")))) + len(str(decontaminate.block_keys(F.col("fp"), 2))) < 5_000
