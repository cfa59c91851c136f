import random
from collections import Counter

import numpy as np
import pytest

from tasteloom.llm import graph, jaccard_join, queries
from tasteloom.llm.common import table


def plain_sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    """Links of all pairs that share a shingle, and the classes they connect."""
    sets = [plain_sets(t) for _, t in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    shared = Counter()
    for members in by.values():
        for k, i in enumerate(members):
            for j in members[k + 1:]:
                shared[i, j] += 1
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), n in shared.items():
        if n / (len(sets[i]) + len(sets[j]) - n) >= 0.8:
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), 2**63), 2**63 - 1 if doc is None else doc)
    return sorted(((doc, None if first[find(i)] == 2**63 - 1 else first[find(i)], links[i]) for i, (doc, _) in enumerate(rows)), key=str)


def near_copies(n, size=60):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(size)]
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(draw.randint(0, 2)):
            w[draw.randrange(size)] = f"x{draw.randrange(9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("most", [256, 6])
def test_group_of_near_copies(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "_BLOCK_CLASSES", most)
    texts = near_copies(60) + near_copies(10, 6) + ["a b", "A  b", None, "", " ", "one"] + ["long " * 40_000, "long\n" * 40_000]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "a b"), (7, texts[0]), (7, texts[0]), (7, "quite another text"), (None, "null id")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, key int")
    made = jaccard_join.join(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in made), key=str) == plain(rows)
    kept = Counter(r.class_id for r in made if r.kept and r.n_links)
    assert set(kept.values()) == {1} and kept.keys() == {r.class_id for r in made if r.n_links}
    assert jaccard_join.join(docs.limit(0)).collect() == []


def test_documents_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = queries.QUERIES["op6_jaccard_join"](spark, folder).collect()
    want = plain(rows)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == want
    assert sum(n > 0 for _, _, n in want) > 20


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        a = draw.integers(0, 2**63, 1000, dtype=np.uint64)
        n = int(1000 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], draw.integers(0, 2**63, 1000 - n, dtype=np.uint64)])
        x, y = (np.frombuffer(jaccard_join.signature(np.unique(s)), ">u2") for s in (a, b))
        assert abs((x == y).mean() - n / (2000 - n)) < 0.09


def test_prefix_is_shortened_until_the_recall_is_met():
    depth = jaccard_join.prefix_depth(0.8, 0.9999)
    assert jaccard_join.recall(0.8, jaccard_join.TREES, depth) >= 0.9999 > jaccard_join.recall(0.8, jaccard_join.TREES, depth + 1)
    assert jaccard_join.prefix_depth(0.99, 0.9) == jaccard_join.DEPTH


def test_small_sets_leave_at_the_depth_of_their_least_similarity():
    for n in range(1, 40):
        shares = [i / (n + m - i) for m in range(1, 60) for i in range(1, min(n, m) + 1) if (i, m) != (n, n)]
        able = [s for s in shares if s >= 0.8 - 1e-9]
        want = jaccard_join.prefix_depth(min(able), 0.9999) if able else jaccard_join.DEPTH + 1
        assert jaccard_join.stop_depth(n, 0.8, 0.9999) == want
    assert {jaccard_join.stop_depth(n, 0.8, 0.9999) for n in (3, 7, 8, 5000)} == {9, 8, 6}


def plain_clusters(paths, lowest):
    """Classes that share a prefix of some length at which both are still matched."""
    root = {n: n for n, *_ in paths}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for depth in range(lowest, jaccard_join.DEPTH + 1):
        first = {}
        for node, stop, low, rest in paths:
            if stop <= depth:
                x, y = find(node), find(first.setdefault((low, bytes(rest[:2 * (depth - lowest)])), node))
                root[max(x, y)] = min(x, y)
    out = {n: find(n) for n in root}
    size = Counter(out.values())
    return {n: r for n, r in out.items() if size[r] > 1}


@pytest.mark.parametrize("lowest", [8, 5])
def test_forest_finds_what_any_prefix_meets(spark, lowest):
    draw = random.Random(lowest)
    paths = []
    for node in range(300):
        stop = draw.choice([lowest, lowest, 7, 8]) if lowest < 7 else 8
        paths += [(node, stop, draw.randrange(700), bytearray(
            b for _ in range(8 - lowest) for b in (0, draw.randrange(2)))) for _ in range(3)]
    schema = "node long, stop byte, low long, rest binary"
    made = jaccard_join.forest(spark.createDataFrame(paths, schema), lowest)
    assert {r.node: r.root for r in made.collect()} == plain_clusters(paths, lowest)
    assert jaccard_join.forest(spark.createDataFrame([], schema), lowest).collect() == []


def test_recall_at_the_threshold(spark):
    """400 pairs of 90 and 81 shingles that share 76: a similarity of 0.8 exactly."""
    rows = []
    for i in range(400):
        w = [f"p{i}x{k}" for k in range(94)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:80] + [f"n{i}x{k}" for k in range(5)]))]
    want = plain(rows)
    linked = sum(n > 0 for *_, n in want)
    assert linked == 800
    made = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.n_links > 0 for r in made) >= 0.99 * linked


def test_block_products_equal_set_intersections(monkeypatch):
    monkeypatch.setattr(jaccard_join, "_COLUMNS", 7)
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 50), dtype=np.uint64)) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]
    assert jaccard_join._cross(sets[:5], sets[5:]).tolist() == want


def test_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
