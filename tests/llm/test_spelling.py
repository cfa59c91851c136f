import random
import re
import zlib
from collections import Counter

import pytest

from tasteloom.llm import queries, spelling
from tasteloom.llm.common import table


def plain_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda c: c[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain(n):
    """Every pair of words compared letter by letter."""
    words, near = sorted(n), {w: [] for w in n}
    for i, a in enumerate(words):
        for b in words[:i]:
            if abs(len(a) - len(b)) < 2 and one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants(count, seed):
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcàé") for _ in range(draw.randint(4, 9))) for _ in range(30)]
    out = []
    for _ in range(count):
        w = list(draw.choice(stems))
        for _ in range(draw.randint(0, 2)):
            k = draw.randrange(len(w))
            w[k: k + draw.randint(0, 1)] = draw.choice("abcàéz") * draw.randint(0, 1)
        out.append("".join(w))
    return out


@pytest.mark.parametrize("most", [4096, 20])
def test_words_of_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "_BLOCK_WORDS", most)
    monkeypatch.setattr(spelling, "_FLUSH", 50)
    monkeypatch.setattr(spelling, "_PIECE", 100)
    texts = [" ".join(variants(40, s)) for s in range(60)] + [None, "", "Été ÉTÉS Étés étés ÉTÉS×÷", "x" * 3000, "x" * 3001, "x" * 2999]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[7])]
    rows += [(900 + i, "y" * 200 + " " + "y" * 201 + " aaaaa aaaaaa aaaaaaa straße Straße 中文letters中文") for i in range(4)]
    rows += [(950, "lanternxy " * 3 + "lanternx " * 8 + "lantern " * 20)]
    docs = spark.createDataFrame([(*r, "w", 5) for r in rows], "doc_id bigint, text string, word string, n int")
    got = sorted(tuple(r) for r in spelling.group(docs).collect())
    want = plain(plain_words(rows))
    assert got == want and sum(r[1] != r[2] and r[1] is not None for r in want) > 0
    assert spelling.group(docs.limit(0)).collect() == []


def test_documents_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op12_spelling"](spark, folder).collect())
    want = plain(plain_words(rows))
    assert got == want and len(want) > 1000


def test_index_equals_letter_by_letter():
    for m in (5, 6, 9):
        words = sorted({w for w in variants(4000, m) if len(w) in (m, m + 1)})
        index = spelling.PositionIndex(words, m)
        for size in (m, m + 1):
            asked = [w for w in words if len(w) == size][:200]
            i, j = spelling._pairs(index.near(spelling._letters(asked, m + 1)))
            got = sorted((asked[x], words[y]) for x, y in zip(i, j))
            assert got == sorted((a, b) for a in asked for b in words if one_apart(a, b) and min(len(a), len(b)) == m)
            assert got
