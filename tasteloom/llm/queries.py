"""The corpus operators as named queries over the tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm import (bpe, decontaminate, exact_dedup, jaccard_join, language, lexical_search, licenses, ppm, quality,
                           secret_scan, spelling, tensor_minhash, toxicity)
from tasteloom.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_exact_dedup", r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(content) AS text_sha256
FROM d WINDOW w AS (PARTITION BY content)""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, folder, "documents"))


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_bpe")
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe.encode(table(spark, folder, "documents"), bpe.vocabulary(word_bpe()))
    return ids.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(crc_mod(5) != 0))
    return language.identify(docs, model, (crc_mod(5) == 0).alias("held_out"))


@query("op9_ppm")
def op9_ppm(spark: SparkSession, folder: str) -> DataFrame:
    scored = ppm.score(table(spark, folder, "documents"), crc_mod(7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), crc_mod(5) != 0)
    return toxicity.grade(docs, model).select(
        "doc_id", (crc_mod(5) == 0).alias("held_out"), F.col("toxic_score").alias("score"), "severity",
        F.col("toxic").cast("int").alias("predicted"), "toxic")


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    forest = quality.fit(docs, table(spark, folder, "labels"), crc_mod(3) != 1)
    return quality.score(docs, forest, (crc_mod(3) == 1).alias("held_out"))


def _secret_sql() -> str:
    """Matches and what lies before them, taken apart and counted up as in the operator; any rule by any other engine."""
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = f"(?s)(.*?)({rule.pattern}|\\z)".replace("'", "''")
        groups = ", ".join(f"unnest(regexp_extract_all(text, '{pattern}', {g})) AS {c}"
                           for g, c in ((1, "before"), (2, "found"), (2 + rule.group, "measured")))
        parts.append(f"SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, {groups}, "
                     f"generate_subscripts(regexp_extract_all(text, '{pattern}', 1), 1) AS i FROM d")
    base = "('assign', 'access', 'hex')"
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(parts)}),
ends AS (SELECT *, sum(length(before) + length(found)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM parts),
spans AS (SELECT doc_id, rank, kind, CAST(stop - length(found) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
          FROM ends WHERE length(found) > 0 AND length(measured) >= least),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
               count(*) FILTER (kind = 'hex') AS h, {joined} AS s, {joined} FILTER (kind IN {base}) AS b
        FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""


@query("op3_secret_scan", _secret_sql())
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in kinds),
                        F.sha2(secret_scan.as_text(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("spans")).alias("spans"))


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), F.concat_ws("/", F.col("source"), F.col("doc_id")))


@query("op6_jaccard_join", r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE k >= 0.8 * (nx.n + ny.n - k) - 1e-9),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.y, reach.root FROM reach JOIN e ON e.x = reach.doc_id),
c AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id),
k AS (SELECT x AS doc_id, count(*) AS links FROM e GROUP BY x)
SELECT c.doc_id, c.class_id, coalesce(k.links, 0) AS n_links, c.doc_id = c.class_id AS kept FROM c LEFT JOIN k USING (doc_id)""")
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "kept")


@query("op2_decontaminate", r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
            FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
       FROM benchmark),
ds AS (SELECT doc_id, len(w) AS n, unnest(range(0, len(w) - 4)) AS p,
              unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM dw WHERE len(w) >= 5),
its AS (SELECT item_id, len(w) AS size, unnest(range(0, len(w) - 4)) AS place,
              unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM iw WHERE len(w) >= 5),
win AS (SELECT DISTINCT doc_id, item_id, size, greatest(0, least(p - place, n - size)) AS start, least(size, n) AS n_words
        FROM ds JOIN its USING (g)),
wc AS (SELECT win.doc_id, item_id, size, start, n_words, g, count(*) AS c FROM win JOIN ds
         ON ds.doc_id = win.doc_id AND ds.p BETWEEN start AND start + n_words - 5 GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c FROM its GROUP BY ALL),
shared AS (SELECT doc_id, item_id, size, start, n_words, sum(least(wc.c, ic.c))::DOUBLE AS overlap FROM wc JOIN ic USING (item_id, g)
           GROUP BY ALL),
scored AS (SELECT *, overlap / (n_words + size - 8 - overlap) AS similarity FROM shared)
SELECT doc_id, item_id, round(similarity, 9) AS similarity, start::INTEGER AS start, n_words::INTEGER AS n_words
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n_words) = 1""")
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 9).alias("similarity"), "start", "n_words")


@query("op13_minhash_dedup", r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT s.doc_id, s.g, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.f, s.g) AS place
         FROM s JOIN n USING (doc_id) JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) f USING (g)),
pre AS (SELECT doc_id, g FROM rare WHERE place <= n - ceil(0.8 * n - 1e-9) + 1),
c AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM pre a JOIN pre b ON a.g = b.g AND a.doc_id < b.doc_id),
p AS (SELECT c.x, c.y, count(*) AS k FROM c JOIN s a ON a.doc_id = c.x JOIN s b ON b.doc_id = c.y AND b.g = a.g GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.y, reach.root FROM reach JOIN e ON e.x = reach.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, m.doc_id = m.component_id AS kept FROM m LEFT JOIN n USING (doc_id)""")
def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return tensor_minhash.dedup(table(spark, folder, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op12_spelling", rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS w, count(*) AS c FROM runs GROUP BY ALL),
crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
          lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps),
bytes AS (SELECT low.*, flatten(list_transform(range(1, length(doc_id || ':' || w) + 1), lambda i:
            CASE WHEN unicode(substr(doc_id || ':' || w, i, 1)) < 128 THEN [unicode(substr(doc_id || ':' || w, i, 1))::BIGINT]
                 ELSE [195, unicode(substr(doc_id || ':' || w, i, 1))::BIGINT - 64] END)) AS b FROM low WHERE length(w) >= 5),
hashed AS (SELECT w, c, xor(list_reduce([4294967295] || b, lambda x, y: xor(x >> 8, steps[(xor(x, y) & 255) + 1])), 4294967295) AS h
           FROM bytes, crc),
kept AS (SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c
         FROM hashed),
v AS (SELECT word, sum(c)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, p, left(word, p::INT - 1) || substr(word, p::INT + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM v)),
one AS (SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT cut.word, v.word FROM cut JOIN v ON v.word = cut.rest
        UNION SELECT v.word, cut.word FROM cut JOIN v ON v.word = cut.rest),
near AS (SELECT x AS word, count(*) AS n_near, first(y ORDER BY n DESC, y) AS best, max(n) AS best_n
         FROM one JOIN v ON v.word = y GROUP BY x),
known AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
                 CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
path AS (SELECT word, word AS at FROM known UNION ALL SELECT path.word, form FROM path JOIN known ON known.word = path.at WHERE form IS NOT NULL)
SELECT k.word, k.form, path.at AS root, k.n, k.n_near, k.form_n
FROM known k JOIN path ON path.word = k.word JOIN known e ON e.word = path.at AND e.form IS NULL""")
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(table(spark, folder, "documents"))


@query("op11_lexical_search", rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS term
           FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS term
      FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
           FROM i JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), whole GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50""")
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
