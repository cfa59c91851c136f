import random
import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import functions as F

from tasteloom.llm import licenses, queries
from tasteloom.llm.common import table

V = licenses.Vectors()


def plain(unit):
    counts = Counter(w for w in re.split(r"[\W_]+", unit.lower()) if w)
    raw = {w: (1 + log(n)) * V.idf.get(w, V.other) for w, n in counts.items()}
    size = sqrt(sum(x * x for x in raw.values()))
    if not size:
        return None
    scored = [(-round(min(sum(x * v.get(w, 0) for w, x in raw.items()) / size, 1.0), 6), name, least) for name, least, v in V.vectors]
    scored = [(less, name) for less, name, least in scored if -less >= least]
    return (min(scored)[1], -min(scored)[0]) if scored else None


def plain_own(text):
    units = [plain(u) for u in re.split(r"\n+|(?<=[.!?])\s+", text)]
    notices = [u for u in units if u]
    whole = plain(text)
    best = whole or (min(notices, key=lambda u: (-u[1], u[0])) if notices else None)
    return (best[0] if best else None, "file" if whole else "notice" if notices else None, len(notices))


def test_documents_against_plain_scan(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_license_scan"](spark, folder).collect()}
    assert got.keys() == texts.keys()
    with_notice = 0
    for doc, text in texts.items():
        name, found, n = plain_own(text)
        with_notice += n > 0
        assert got[doc].n_notices == n
        if found:
            assert (got[doc].license, got[doc].found) == (name, found)
        else:
            assert got[doc].found in (None, "inherited")
        if "icensed under" in text or "MIT License" in text:
            assert found
    assert with_notice > 10


def test_inheritance_nulls_and_repeats(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [(1, apache, "a/LICENSE"), (2, "code", "a/b/c/x"), (3, "Released under the MIT License.", "a/b/LICENSE"), (4, "code", "a/y"),
            (5, "code", "z"), (6, None, "a/b/n"), (7, "", None), (None, "some more lines of code that nobody has seen\n" + apache, "q/r"), (8, "code", "q/s"), (9, "code", "ab/x"),
            (2, "code", "a/b/c/x"), (10, "word " * 50_000, "a/long")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, path string, license string")
    got = Counter((r.doc_id, r.license, r.found) for r in licenses.scan(docs, F.col("path")).collect())
    assert got == Counter([
        (1, "Apache-2.0", "file"), (2, "MIT", "inherited"), (2, "MIT", "inherited"), (3, "MIT", "file"), (4, "Apache-2.0", "inherited"),
        (5, None, None), (6, "MIT", "inherited"), (7, None, None), (None, "Apache-2.0", "notice"), (8, None, None), (9, None, None),
        (10, "Apache-2.0", "inherited")])
    assert licenses.scan(docs.limit(0), F.col("path")).collect() == []


def test_notices_a_little_off_the_templates(spark):
    texts = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0 by the authors.",
             "Apache-2.0": "Licensed under the Apache License, Version 2.0; see the LICENSE file.",
             "MIT": "The code is licensed under the MIT License.",
             "GPL-3.0": "This program is free software: you can redistribute it and/or modify"}
    docs = spark.createDataFrame([(n, "words before the notice\n" + t + "\nmore words of no use to anyone here", name)
                                  for n, (name, t) in enumerate(texts.items())], "doc_id bigint, text string, name string")
    got = {(r.doc_id, r.license, r.n_notices) for r in licenses.scan(docs, F.concat_ws("/", F.lit("d"), "doc_id")).collect()}
    assert got == {(n, name, 1) for n, name in enumerate(texts)}
    assert licenses.THRESHOLD == 0.75


def test_wrapped_headers_and_licence_files(spark):
    bodies = dict(licenses.BODIES)
    code = "\nint main(int argc, char **argv) {\n  return run(argc, argv);\n}\n" * 5
    gpl = """/* frob.c - frobnicate
 * Copyright (C) 2020 Some Body
 *
 * This program is free software: you can
 * redistribute it and/or modify it under the
 * terms of the GNU General Public License as
 * published by the Free Software Foundation,
 * either version 3 of the License, or (at your
 * option) any later version.
 */""" + code
    bsd = "".join(f"# {line}\n" for line in ("Copyright Some Body. Redistribution and use in", "source and binary forms, with or", "without modification, are permitted",
                                            "provided that the following", "conditions are met:")) + code
    rows = [(1, "The MIT License\n\nCopyright (c) 2020 Some Body\n\n" + bodies["MIT"], "m/LICENSE"), (2, code, "m/src/x.c"),
            (3, gpl, "g/frob.c"), (4, bsd, "b/x.py"), (5, "SPDX-License-Identifier: MPL-2.0", "p/x"), (6, code, "g/y.c"),
            *((10 + n, text, f"l{n}/COPYING") for n, (_, text) in enumerate(licenses.BODIES)),
            *((50 + n, code, f"l{n}/x.c") for n in range(len(bodies)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, path string")
    got = {r.doc_id: (r.license, r.found) for r in licenses.scan(docs, F.col("path")).collect()}
    assert len(bodies) >= 8
    assert got == {1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "notice"), 4: ("BSD-3-Clause", "notice"),
                   5: ("MPL-2.0", "file"), 6: (None, None),
                   **{10 + n: (name, "file") for n, (name, _) in enumerate(licenses.BODIES)},
                   **{50 + n: (name, "inherited") for n, (name, _) in enumerate(licenses.BODIES)}}


def test_wrapped_notices_are_counted_by_place(spark):
    wrapped = "This work\nis licensed\nunder the\nGNU General\nPublic\nLicense, version\n3.\n"
    docs = spark.createDataFrame([(1, wrapped + "some other words in between " * 9 + "\n" + wrapped)], "doc_id bigint, text string")
    r = licenses.scan(docs, F.lit("a/b")).first()
    assert (r.license, r.found, r.n_notices) == ("GPL-3.0", "notice", 2)


def test_other_licences_and_prose_do_not_match(spark):
    """A licence that is not listed, long prose and plain package texts have no licence; the listed ones only their own."""
    prose = ("The work of the library is to keep the books of the town and to lend them to any person who may ask for them. "
             "It is not the source of all terms under which the use of a book is free, but the copies are distributed as they are. ") * 60
    unlisted = ("Everyone is permitted to copy and distribute verbatim or modified copies of this licence document, and changing it is allowed "
                "as long as the name is changed. You just do what you want to, and nobody may be held liable for anything. ") * 8
    rows = [(1, prose, "p/README"), (2, unlisted, "u/COPYING"), (3, "int main() { return 0; }", "u/x.c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, path string")
    assert {r.license for r in licenses.scan(docs, F.col("path")).collect()} == {None}
    close = {(a, b): sum(x * w.get(k, 0) for k, x in v.items()) for a, _, v in V.vectors[-len(licenses.BODIES):]
             for b, _, w in V.vectors[-len(licenses.BODIES):] if a != b}
    assert close["GPL-2.0", "GPL-3.0"] < 0.7 and close["Apache-2.0", "MPL-2.0"] < 0.6 and max(close.values()) < licenses.BODY_THRESHOLD
    assert not V.anchors & licenses.COMMON


def test_long_licence_behind_code(spark):
    """A whole licence in the middle of other text is found by a window of its length."""
    code = "\n".join(f"int f{n}(int a{n}, int b{n}) {{ return c{n}; }}" for n in range(1500))
    rows = [(n, code + "\n" + text + "\n" + code, "x") for n, (_, text) in enumerate(licenses.BODIES)]
    got = {r.doc_id: (r.license, r.found) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string, path string"), F.col("path")).collect()}
    assert got == {n: (name, "notice") for n, (name, _) in enumerate(licenses.BODIES)}


def test_windows_against_brute_force(spark):
    """Every window of every template's length, laid at every word."""
    draw = random.Random(4)
    notice = licenses._words(licenses.TEMPLATES[9][1])
    rows = []
    for n in range(12):
        own = [w for w in notice if draw.random() > 0.08 * (n % 5)]
        text = [draw.choice("lorem ipsum dolor sit amet elit sed tempor".split()) for _ in range(30)]
        rows.append((n, "\n".join([*text, *own, *text]), "x"))
    sizes = sorted({s for p in V.places.values() for _, s in p if s <= 40})
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string, path string"), F.col("path")).collect()}
    for n, text, _ in rows:
        words = text.split("\n")
        best = [plain(" ".join(words[at: at + size])) for size in sizes for at in range(len(words) - size + 1)]
        best = [b for b in best if b]
        if max((s for _, s in best), default=0) >= 0.8:
            assert got[n] == min(best, key=lambda b: (-b[1], b[0]))[0]
        if not best:
            assert got[n] is None


def test_plan_names_the_templates(spark):
    """The driver keeps the text of every plan and of its changes, so the templates' words must not be spelt out in it."""
    docs = spark.createDataFrame([(1, "Released under the MIT License.", "x")], "doc_id bigint, text string, path string")
    found = licenses.scan(docs, F.col("path"))
    assert found.first().license == "MIT"
    plan = found._jdf.queryExecution().toString()
    assert len(plan) < 1_000_000
    assert "downstream" in V.idf and "downstream" not in plan
