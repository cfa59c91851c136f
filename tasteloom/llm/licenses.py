"""Licence scans: notices and licence files by TF-IDF cosine to templates, then inheritance down directories.

A unit is a line or sentence of a document (a notice), its whole text (a licence
file), or a window over its words of a template's length, aligned with three words in
a row of the template (a notice wrapped over lines, with or without comment marks; a
licence that follows a header or code). Of the long licences every eighth such run
that no other template has lays windows: a text close enough to match has hundreds of
the others' kind. Words weigh by how few templates have them, counts are damped, and
words that any English text has weigh next to nothing, so that a licence is told by
what it says and not by its "the" and "of". A whole licence must be closer to its
template than a notice, as licences quote each other.

A unit can reach the threshold with a template only if it holds one of the template's
anchor words, chosen so that without them what remains of the template is too
short a vector; and only if the template's words that it holds make up the
threshold's part of the template's vector. So units that fail either are left out
before words are counted and shuffled, without losing a match. A document without
a notice of its own takes the licence of the nearest directory above it that has a
licence file.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt
from pathlib import Path
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tasteloom.llm.common import doc_rows, text_or_empty

# fixed values: notices and openings of licence texts
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
# fixed values: more notices and headers of source files, and whole licences
HEADERS: tuple[tuple[str, str], ...] = (
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."),
    *((name, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
             f"License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
             f"later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
             f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License "
             "for more details.")
      for name, what, kind, version in (("GPL-3.0", "program", "", "3"), ("GPL-2.0", "program", "", "2"),
                                        ("LGPL-3.0", "library", "Lesser ", "3"), ("LGPL-2.1", "library", "Lesser ", "2.1"))),
)
_TEXTS = Path(__file__).with_name("licence_texts")
BODIES: tuple[tuple[str, str], ...] = tuple((p.stem, p.read_text("utf-8")) for p in sorted(_TEXTS.glob("*.txt")))
# fixed values: words that any English text has
COMMON = frozenset("""
a about above after again all also am an and any are as at be because been before being below between both but by can
code could did do does doing down during each few following for form free from further had has have having he her here hers
him his how i if in into is it its itself me more most my no nor not of off on once only or other our out over own person
same she should so some source such terms than that the their them then there these they this those through to too under
until up upon use very was we were what when where which while who whom why will with within without work would you your
""".split())
_COMMON_WEIGHT = 0.1     # of these words, against 1 of a word that all templates have
LONG, _EVERY = 400, 8    # templates of more words lay windows by every eighth of their own runs of three words
THRESHOLD, BODY_THRESHOLD = 0.75, 0.87
_SPLIT = r"[^\p{L}\p{N}]+"
_UNIT = r"\n+|(?<=[.!?])\s+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


class Vectors:
    """Unit vectors of the templates with their thresholds, the weights of words, and the anchor words."""

    def __init__(self, templates=TEMPLATES + HEADERS, threshold: float = THRESHOLD, bodies=BODIES, body_threshold: float = BODY_THRESHOLD):
        parted = [(name, _words(text), least) for group, least in ((templates, threshold), (bodies, body_threshold)) for name, text in group]
        seen = Counter(w for _, own, _ in parted for w in set(own))
        self.idf = {w: _COMMON_WEIGHT if w in COMMON else log((1 + len(parted)) / (1 + k)) + 1 for w, k in seen.items()}
        self.idf |= {w: _COMMON_WEIGHT for w in COMMON}
        self.other = log(1 + len(parted)) + 1
        self.vectors: list[tuple[str, float, dict[str, float]]] = []
        self.anchors: set[str] = set()
        self.longest = max((len(own) for _, own, _ in parted), default=0)
        runs = Counter(" ".join(own[at: at + 3]) for _, own, _ in parted for at in range(len(own) - 2))
        self.places: dict[str, set[tuple[int, int]]] = {}  # three words in a row: where they stand in templates of how many words
        for name, own, least in parted:
            for at in range(len(own) - 2):
                run = " ".join(own[at: at + 3])
                if len(own) <= LONG or (runs[run] == 1 and at % _EVERY == 0):
                    self.places.setdefault(run, set()).add((at, len(own)))
            raw = {w: (1 + log(k)) * self.idf[w] for w, k in Counter(own).items()}
            size = sqrt(sum(x * x for x in raw.values()))
            vector = {w: x / size for w, x in raw.items()}
            self.vectors.append((name, least, vector))
            rest = 1.0
            for w, x in sorted(vector.items(), key=lambda p: (p[0] in COMMON, len(p[0]) < 4, -p[1], p[0])):
                if rest < least ** 2:
                    break
                self.anchors.add(w)
                rest -= x * x


def _table(spark: SparkSession, schema: str, rows: list[dict]) -> DataFrame:
    """A small table of fixed values."""
    kind = T.StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(kind)), kind)


def _constant(spark: SparkSession, kind: str, value: list) -> Column:
    """A fixed array as a scalar subquery: a plan and its text, which the driver keeps, name it and do not spell it out."""
    return _table(spark, f"value {kind}", [{"value": value}]).scalar()


def _dealt(keyed: list[tuple[str, object]]) -> list[list]:
    """Values dealt by the checksum of their text, some one to a list."""
    lists: list[list] = [[] for _ in range(max(1, len(keyed)))]
    for text, value in keyed:
        lists[crc32(text.encode()) % len(lists)].append(value)
    return lists


def _place(lists: Column, text: Column) -> Column:
    """The list that ``_dealt`` gave the values of ``text``."""
    return F.element_at(lists, (F.crc32(text.cast("binary")) % F.size(lists)).cast("int") + 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def with_windows(rows: DataFrame, vectors: Vectors) -> DataFrame:
    """``doc_id, key`` of ``rows`` and ``laid``, an array of (start, size, text): the windows laid where three words of a template stand."""
    dealt = _dealt([(g, {"g": g, "p": [{"at": a, "size": n} for a, n in sorted(p)]}) for g, p in sorted(vectors.places.items())])
    places = _constant(rows.sparkSession, "array<array<struct<g:string,p:array<struct<at:int,size:int>>>>>", dealt)

    def own(lists: Column, gram: Column) -> Column:
        return F.filter(_place(lists, gram), lambda e: e["g"] == gram)

    def laid(own_row: Column) -> Column:
        w, lists = own_row["words"], own_row["places"]
        found = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.struct(
            i.alias("i"), F.array_join(F.slice(w, i + 1, 3), " ").alias("g"))), lambda h: F.size(own(lists, h["g"])) > 0)
        starts = F.array_distinct(F.flatten(F.transform(found, lambda h: F.transform(own(lists, h["g"])[0]["p"], lambda p: F.struct(
            F.greatest(F.lit(0), F.least(h["i"] - p["at"], F.size(w) - p["size"])).alias("start"), p["size"].alias("size"))))))
        return F.transform(starts, lambda s: F.struct(
            s["start"].alias("start"), s["size"].alias("size"), F.array_join(F.slice(w, s["start"] + 1, s["size"]), " ").alias("text")))

    # subqueries stand in a column of their own, not in higher-order functions
    one = F.struct(words_of(F.col("text")).alias("words"), F.col("_places").alias("places"))
    return rows.select("*", places.alias("_places")).select("doc_id", "key", F.transform(F.array(one), laid)[0].alias("laid"))


def _groups(spans: Column) -> Column:
    """How many groups spans (start, stop) make, those that overlap being in one."""
    state = F.struct(F.lit(-1).alias("stop"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(spans), state, lambda s, p: F.struct(
        F.greatest(s["stop"], p["stop"]).alias("stop"), (s["n"] + F.when(p["start"] >= s["stop"], 1).otherwise(0)).alias("n")),
        lambda s: s["n"])


def within_reach(units: DataFrame, vectors: Vectors) -> DataFrame:
    """The units whose words that a template has make up enough of the template to reach the threshold.

    A cosine is at most the length of the template's unit vector on the words that
    the unit has (Cauchy and Schwarz), so nothing that matches is refused. ``need``
    is the least number of words that can be enough.
    """
    rows = []
    for _, least, v in vectors.vectors:
        enough = least ** 2 * (1 - 1e-9)
        parts = sorted(((x * x, w) for w, x in v.items()), reverse=True)
        total, need = 0.0, 0
        while need < len(parts) and total < enough:
            total += parts[need][0]
            need += 1
        same = {}
        for x, w in parts:
            same.setdefault(round(x, 15), []).append(w)  # words that weigh alike are counted together
        rows.append({"need": need, "enough": enough, "words": [w for _, w in parts], "parts": [{"w": w, "x": x} for x, w in same.items()]})
    spark = units.sparkSession
    templates = _constant(spark, "array<struct<need:int,enough:double,words:array<string>,parts:array<struct<w:array<string>,x:double>>>>", rows)
    vocabulary = _constant(spark, "array<array<string>>", _dealt([(w, w) for w in sorted({w for *_, v in vectors.vectors for w in v})]))

    def reaches(t: Column, known: Column) -> Column:
        mass = F.aggregate(t["parts"], F.lit(0.0), lambda m, p: m + p["x"] * F.size(F.array_intersect(p["w"], known)))
        return (F.size(known) >= t["need"]) & (mass >= t["enough"])

    def known(u: Column) -> Column:
        return F.struct(F.filter(u["words"], lambda w: F.array_contains(_place(u["vocabulary"], w), w)).alias("words"),
                        u["templates"].alias("templates"))

    one = F.struct(F.array_distinct(words_of(F.col("text"))).alias("words"), F.col("_vocabulary").alias("vocabulary"),
                   F.col("_templates").alias("templates"))
    reach = F.exists(F.transform(F.array(one), known), lambda k: F.exists(k["templates"], lambda t: (F.size(k["words"]) >= t["need"]) & F.exists(
        F.array(F.array_intersect(t["words"], k["words"])), lambda own: reaches(t, own))))
    return units.select("*", vocabulary.alias("_vocabulary"), templates.alias("_templates")).filter(reach).drop("_vocabulary", "_templates")


def match_units(units: DataFrame, vectors: Vectors) -> DataFrame:
    """``doc_id, key, unit, license, score``: the best of the templates whose threshold each unit reaches.

    ``units`` has ``doc_id, key, unit, text``. Ties go to the licence first by name.
    """
    spark = units.sparkSession
    terms = units.select("doc_id", "key", "unit", F.explode(words_of(F.col("text"))).alias("word"))
    terms = terms.groupBy("doc_id", "key", "unit", "word").agg(F.count("*").alias("tf"))
    idf = _table(spark, "word:string,idf:double", [{"word": w, "idf": x} for w, x in sorted(vectors.idf.items())])
    terms = terms.join(F.broadcast(idf), "word", "left").select(
        "doc_id", "key", "unit", "word", ((1 + F.log("tf")) * F.coalesce("idf", F.lit(vectors.other))).alias("w"))
    entries = [{"template": n, "license": name, "least": least, "word": w, "x": x}
               for n, (name, least, v) in enumerate(vectors.vectors) for w, x in sorted(v.items())]
    templates = _table(spark, "template:int,license:string,least:double,word:string,x:double", entries)
    size = terms.groupBy("doc_id", "key", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dots = terms.join(F.broadcast(templates), "word").groupBy("doc_id", "key", "unit", "template", "license", "least").agg(
        F.sum(F.col("w") * F.col("x")).alias("dot"))
    size = size.withColumnsRenamed({"doc_id": "s_doc", "key": "s_key", "unit": "s_unit"})
    scored = dots.join(size, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("key") == F.col("s_key"))
                       & (F.col("unit") == F.col("s_unit"))).withColumn(
        "score", F.round(F.least(F.col("dot") / F.col("size"), F.lit(1.0)), 9))
    best = scored.filter("score >= least").groupBy("doc_id", "key", "unit").agg(
        F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("b"))
    return best.select("doc_id", "key", "unit", F.col("b.license").alias("license"), (-F.col("b.less")).alias("score"))


def scan(docs: DataFrame, path: Column, vectors: Vectors | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, path, license, found, score, n_notices``.

    ``path`` (over the columns of ``docs``) names the document's place, directories
    parted by ``/``. ``found`` is ``file`` (the whole text is a licence), ``notice``,
    ``inherited`` or null; of several notices the closest counts, then the licence
    first by name. A directory with several licence files has that of the closest.
    Null texts are empty, and have no notice; a null path has no directory to
    inherit from. Rows that repeat an id are scanned each by its own text.
    ``n_notices`` counts lines and sentences; where none of them matches, the places
    of windows that do, those that overlap being one.
    """
    vectors = vectors or Vectors()
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), path.cast("string").alias("path"),
                       docs["text"].cast("string").alias("text")).withColumn("text", text_or_empty())
    rows = rows.select("doc_id", "path", "text", F.xxhash64("text").alias("key"),
                       F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).alias("dir"))
    anchors = F.array(*map(F.lit, sorted(vectors.anchors)))

    def anchored(text: str) -> Column:
        return F.arrays_overlap(F.split(F.lower(text), _SPLIT), anchors)

    some = rows.filter(anchored("text")).select("doc_id", "key", "text")
    notices = some.select("doc_id", "key", F.posexplode(F.split("text", _UNIT)).alias("unit", "text")).filter(
        anchored("text"))
    units = notices.unionByName(some.select("doc_id", "key", F.lit(-1).alias("unit"), "text"))
    laid = with_windows(some, vectors).select("doc_id", "key", F.explode("laid").alias("l"))
    base = vectors.longest + 1       # a window's number tells its place and size
    windows = laid.select("doc_id", "key", (-2 - (F.col("l.start").cast("bigint") * base + F.col("l.size"))).alias("unit"), "l.text")
    units = units.withColumn("unit", F.col("unit").cast("bigint")).unionByName(windows)
    units = within_reach(units, vectors)
    found = match_units(units.dropDuplicates(["doc_id", "key", "unit"]), vectors)
    number = -2 - F.col("unit")
    size = (number % base).cast("int")
    start = ((number - size) / base).cast("int")
    own = found.groupBy("doc_id", "key").agg(
        F.min(F.struct(F.when(F.col("unit") == -1, 0).otherwise(1).alias("part"), (-F.col("score")).alias("less"), "license")).alias("b"),
        F.count_if(F.col("unit") >= 0).alias("lines"), _groups(F.collect_list(F.when(F.col("unit") < -1, F.struct(
            start.alias("start"), (start + size).alias("stop"))))).alias("places"))
    own = own.withColumn("n_notices", F.when(F.col("lines") > 0, F.col("lines")).otherwise(F.col("places")))
    own = own.select(F.col("doc_id").alias("o_doc"), F.col("key").alias("o_key"), F.col("b.license").alias("license"),
                     F.when(F.col("b.part") == 0, "file").otherwise("notice").alias("found"), (-F.col("b.less")).alias("score"), "n_notices")
    light = rows.select("doc_id", "path", "dir", "key")
    joined = light.join(own, F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("key") == F.col("o_key")), "left")

    files = joined.filter("found = 'file' AND dir IS NOT NULL").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("b")).select(
        F.col("dir").alias("above"), F.col("b.license").alias("dir_license"), (-F.col("b.less")).alias("dir_score"))
    dirs = light.filter("dir IS NOT NULL").select("dir").distinct()
    steps = F.split("dir", "/")
    ways = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)),
                                                    lambda n: F.array_join(F.slice(steps, 1, n), "/"))).alias("above"))
    nearest = ways.join(files, "above").groupBy("dir").agg(
        F.max_by(F.struct("dir_license", "dir_score"), F.length("above")).alias("n")).select(
        F.col("dir").alias("n_dir"), "n.dir_license", "n.dir_score")
    full = joined.join(nearest, F.col("dir") == F.col("n_dir"), "left")
    return full.select(
        "doc_id", "path", F.coalesce("license", "dir_license").alias("license"),
        F.coalesce("found", F.when(F.col("dir_license").isNotNull(), "inherited")).alias("found"),
        F.when(F.col("found").isNotNull(), F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"))
