import random
import re

import numpy as np
import pytest

from tasteloom.llm import queries, tensor_minhash
from tasteloom.llm.common import table

LAST = 2**63 - 1


def plain_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or "")) if x]
    return {tuple(w[i: i + 2]) for i in range(max(1, len(w) - 1))} if w else set()


def plain(rows):
    """Every pair of sets compared, and what the links connect."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), LAST), LAST if doc is None else doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        c = first[find(i)] if sets[i] else (LAST if doc is None else doc)
        out.append((doc, len(sets[i]), None if c == LAST else c, c == (LAST if doc is None else doc)))
    return sorted(out, key=str)


def edited(n, size, edits, seed=5):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(size)]
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(size)] = f"x{draw.randrange(99)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("unit", [256, 7])
def test_groups_of_near_copies_and_odd_rows(spark, monkeypatch, unit):
    monkeypatch.setattr(tensor_minhash, "_UNIT", unit)
    monkeypatch.setattr(tensor_minhash, "_BLOCK_SETS", unit)
    texts = edited(80, 50, 7) + edited(20, 4, 1) + ["a b", "A  b", "a b", None, "", " ", "one", "One"]
    texts += ["Été chaud", "été chaud", "long " * 40_000, "long\n" * 40_000, " ".join(f"v{i}" for i in range(30_000))]
    rows = [(300 - i, t) for i, t in enumerate(texts)] + [(None, "a b"), (7, texts[0]), (7, texts[0]), (7, "quite another text"),
                                                           (None, "null id alone"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, node int, root string")
    got = sorted((tuple(r) for r in tensor_minhash.dedup(docs).collect()), key=str)
    assert got == plain(rows)
    assert tensor_minhash.dedup(docs.limit(0)).collect() == []


def test_blocks_find_links_that_no_hub_has(spark):
    """Chains of texts that share tables with a hub they are not linked with."""
    draw = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(60)]
        now = list(base)
        for step in range(6):
            now[draw.randrange(60)] = f"s{step}"
            now[draw.randrange(60)] = f"t{step}"
            rows += [(len(rows), " ".join(now)), (len(rows) + 1, " ".join(now[:-1] + ["end"]))]
    got = sorted((tuple(r) for r in tensor_minhash.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert got == plain(rows)


def test_documents_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op13_minhash_dedup"](spark, folder).collect()), key=str)
    want = plain(rows)
    assert got == want and sum(not k for *_, k in want) > 20


def test_recall_of_the_tables():
    """Pairs at exactly 0.8 share a table; 48 values take the place of 720."""
    draw = np.random.default_rng(8)
    width, lost = 4 * tensor_minhash.HALF, 0
    for _ in range(800):
        a = np.unique(draw.integers(0, 2**63, 90, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:80], draw.integers(0, 2**63, 10, dtype=np.uint64)]))
        x, y = tensor_minhash.signature(a), tensor_minhash.signature(b)
        lost += sum(x[i: i + width] == y[i: i + width] for i in range(0, len(x), width)) < 2
    assert lost <= 3 and tensor_minhash.missed(0.8) < 2e-4 and tensor_minhash.missed(0.9) < 1e-7
