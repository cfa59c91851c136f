import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tasteloom.llm import lexical_search
from tasteloom.llm.common import table


def plain_terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in found]


def plain(docs, items, k=50):
    """Every document scored for every item."""
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        own = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(plain_terms(text))}
        scored = []
        for d, c in counts:
            m = 100 - 50 + 50 * c.total() * n_docs // length
            s = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in own.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def texts(n, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "X9", "中文"]
    return [" ".join(draw.choice(words[: draw.randint(2, 63)]) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"_DOC_CELLS": 64 * 40, "_ITEMS": 7, "_PIECE": 50}, {"_CELLS": 200}])
def test_odd_rows(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    own = texts(400, 1) + [None, "", "...", "w1 " * 30_000, "É", "é"]
    docs = [(i if i % 50 else None, t) for i, t in enumerate(own)] + [(5, own[5]), (5, own[5]), (6, own[7])]
    items = [(i, t) for i, t in enumerate(texts(15, 2))] + [(3, "w1 W1 x9"), (None, "été Été"), (99, None), (98, "?!"), (97, "unheard of")]
    d = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id bigint, text string, n int, item_id string")
    i = spark.createDataFrame([(*r, 1.0) for r in items], "item_id bigint, text string, doc_id double")
    got = sorted((tuple(r) for r in lexical_search.search(d, i).collect()), key=str)
    assert got == plain(docs, items)
    assert lexical_search.search(d.limit(0), i).collect() == []
    assert lexical_search.search(d, i.limit(0)).collect() == []
    assert lexical_search.search(d, i.limit(0)).dtypes == lexical_search.search(d, i, 1).dtypes


def test_documents_against_all_scores(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    got = sorted((tuple(r) for r in lexical_search.search(docs, items).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_node_pairs_are_left_out_without_loss():
    draw = np.random.default_rng(4)
    groups = draw.integers(0, 20, 3000)
    rows = np.where(draw.random((3000, 200)) < 0.15, draw.integers(1, 1000, (3000, 200)), 0).astype(float)
    rows[np.arange(200)[None] // 10 != groups[:, None]] = 0      # each document uses one of 20 parts of the terms
    items = np.where(np.arange(200)[None] // 10 == np.arange(40)[:, None] // 2, draw.integers(1, 9, (40, 200)), 0).astype(float)
    tree = lexical_search.Tree(items, 4)
    best = lexical_search.Best(np.ones(40, dtype=np.int64), 10)
    scored = lexical_search.dual_search(items[tree.order], tree, rows, np.arange(3000), best)
    assert scored < 0.3 * 3000 * 40
    full = (items[tree.order] @ rows.T).astype(np.int64)
    for k in range(40):
        order = np.lexsort((np.arange(3000), -full[k]))[:10]
        order = order[full[k][order] > 0]
        assert best.docs[k].tolist() == order.tolist() and best.scores[k].tolist() == full[k][order].tolist()
