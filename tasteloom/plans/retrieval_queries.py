"""Queries: histories, vector arithmetic, top-N retrieval and similar items."""

from pyspark.sql import functions as F

from tasteloom.functions import vectors as V
from tasteloom.operators import histories as H
from tasteloom.operators import metrics as M
from tasteloom.operators import retrieval as R
from tasteloom.operators import splitting as S
from tasteloom.operators.ordering import first_per_group
from tasteloom.operators.popularity import popularity_head
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.evaluation_queries import evaluate_sql, rounded
from tasteloom.plans.registry import query, view
from tasteloom.session import write_stage

DIM = 64

view("unit_vectors", """
SELECT item_id, list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS vec FROM vectors""")
view("recent20", """
SELECT user_id, item_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS rn FROM train) WHERE rn <= 20""")
view("user_vecs", """
SELECT user_id, list(a ORDER BY d) AS vec FROM (
  SELECT user_id, d, avg(vec[d]) AS a FROM recent20 JOIN vectors USING (item_id), range(1, 65) t(d) GROUP BY 1, 2)
GROUP BY 1""")
view("user_units", """
SELECT user_id, list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS vec FROM user_vecs""")
view("retrieved", """
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM (SELECT u.user_id, v.item_id, round(list_inner_product(u.vec, v.vec), 9) AS score
      FROM user_units u CROSS JOIN unit_vectors v)""")
view("candidates", """
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank
  FROM (SELECT * FROM retrieved WHERE rank <= 200) r
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)) WHERE rank <= 100""")
view("similar_all", """
SELECT item_id, neighbor_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, neighbor_id) AS rank
FROM (SELECT a.item_id, b.item_id AS neighbor_id, round(list_inner_product(a.vec, b.vec), 9) AS score
      FROM unit_vectors a JOIN unit_vectors b ON a.item_id <> b.item_id)""")
view("label_cells", """
SELECT cell, list(a ORDER BY d) AS vec FROM (
  SELECT label::BIGINT AS cell, d, avg(embedding[d]::DOUBLE) AS a FROM embeddings, range(1, 65) t(d) GROUP BY 1, 2)
GROUP BY 1""")


def user_vectors(w):
    return H.mean_pool(H.recent_rows(w.train), w.vectors, DIM)


def candidates(w, n=100):
    return R.batch_retrieve(user_vectors(w), w.vectors, S.seen_items(w.train), n)


def long_rank(df, *columns):
    return df.select(*columns, F.col("rank").cast("bigint").alias("rank"))


@query("user_history", """
SELECT user_id, item_id, ts, rank FROM (
  SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, max(ts) AS ts FROM live_events GROUP BY ALL)) WHERE rank <= 20""")
def _(w):
    return long_rank(H.user_history(w.live_events), "user_id", "item_id", "ts")


@query("history_sequence", "SELECT user_id, pos, item_id, ts FROM train_seq")
def _(w):
    return H.history_sequence(w.train)


@query("history_windows", """
SELECT user_id, pos, history, target FROM (
  SELECT user_id, pos, item_id AS target,
         array_to_string(list(item_id) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), ',')
           AS history FROM train_seq) WHERE pos > 0""")
def _(w):
    return H.history_windows(w.train).select(
        "user_id", "pos", F.concat_ws(",", F.col("history").cast("array<string>")).alias("history"), "target"
    )


@query("pad_mask", """
WITH h AS (SELECT user_id, pos, list(item_id) OVER (PARTITION BY user_id ORDER BY pos
             ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS h,
           ('0x' || substr(md5('42|' || user_id || '|' || pos), 1, 15))::BIGINT % 64 AS batch FROM train_seq),
     k AS (SELECT * FROM h WHERE pos > 0), m AS (SELECT batch, max(len(h)) AS width FROM k GROUP BY batch)
SELECT user_id, pos, k.batch,
       array_to_string(list_concat(h, list_transform(range(width - len(h)), lambda x: 0)), ',') AS padded,
       CAST(len(h) AS DOUBLE) AS mask_sum, CAST(width AS INTEGER) AS width
FROM k JOIN m ON k.batch = m.batch""")
def _(w):
    from tasteloom.functions.seeded import draw_below

    windows = H.history_windows(w.train).withColumn("batch", draw_below(64, 42, "user_id", "pos"))
    return H.pad_mask(windows, "batch").select(
        "user_id", "pos", "batch",
        F.concat_ws(",", F.col("padded").cast("array<string>")).alias("padded"),
        F.aggregate("mask", F.lit(0.0), lambda a, x: a + x).alias("mask_sum"),
        F.size("mask").alias("width"),
    )


@query("recently_viewed", """
SELECT h.user_id, h.rank, h.item_id, title, category, price FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, max(ts) AS ts FROM live_events GROUP BY ALL)) h
LEFT JOIN items i ON i.item_id = h.item_id WHERE rank <= 10""")
def _(w):
    return long_rank(H.recently_viewed(w.live_events, w.items, 10), "user_id", "item_id", "title", "category", "price")


@query("rank_to_score", "SELECT user_id, item_id, CAST(-(rank - 1) AS DOUBLE) AS retriever_score FROM candidates")
def _(w):
    from tasteloom.operators.features import rank_to_score

    return rank_to_score(candidates(w)).select("user_id", "item_id", "retriever_score")


def _exploded(df, key, vec):
    return df.select(key, F.posexplode(vec).alias("d", "x")).select(
        key, (F.col("d") + 1).cast("bigint").alias("d"), r6("x")
    )


@query("l2_normalize", "SELECT item_id, d, round(vec[d], 6) AS x FROM unit_vectors, range(1, 65) t(d)")
def _(w):
    return _exploded(w.vectors.withColumn("vec", V.l2_normalize("vec")), "item_id", "vec")


@query("dot", """
SELECT user_id, h.item_id, round(list_inner_product(u.vec, v.vec), 6) AS score
FROM (SELECT DISTINCT user_id, item_id FROM recent20) h JOIN user_vecs u USING (user_id) JOIN vectors v USING (item_id)""")
def _(w):
    pairs = H.recent_rows(w.train).select("user_id", "item_id").distinct()
    return pairs.join(user_vectors(w).withColumnRenamed("vec", "uvec"), "user_id").join(w.vectors, "item_id").select(
        "user_id", "item_id", r6(V.dot("uvec", "vec"), "score")
    )


@query("cosine", """
SELECT user_id, h.item_id, round(list_cosine_similarity(u.vec, v.vec), 6) AS score
FROM (SELECT DISTINCT user_id, item_id FROM recent20) h JOIN user_vecs u USING (user_id) JOIN vectors v USING (item_id)""")
def _(w):
    pairs = H.recent_rows(w.train).select("user_id", "item_id").distinct()
    return pairs.join(user_vectors(w).withColumnRenamed("vec", "uvec"), "user_id").join(w.vectors, "item_id").select(
        "user_id", "item_id", r6(V.cosine("uvec", "vec"), "score")
    )


@query("mean_pool_user_vector", "SELECT user_id, d, round(vec[d], 6) AS x FROM user_vecs, range(1, 65) t(d)")
def _(w):
    return _exploded(user_vectors(w), "user_id", "vec")


@query("mf_user_vectors", """
SELECT user_id, d, round(list_append(vec, 1.0)[d], 6) AS x FROM user_vecs, range(1, 66) t(d)""")
def _(w):
    return _exploded(user_vectors(w).withColumn("vec", V.append_constant("vec", 1.0)), "user_id", "vec")


BIAS_SQL = "coalesce(ln(1 + n), 0)::DOUBLE"


@query("mf_item_vectors", f"""
SELECT v.item_id, d, round(list_append(vec, {BIAS_SQL})[d], 6) AS x
FROM vectors v LEFT JOIN popularity p ON p.item_id = v.item_id, range(1, 66) t(d)""")
def _(w):
    return _exploded(_biased_items(w), "item_id", "vec")


def _biased_items(w):
    counts = w.train.groupBy("item_id").agg(F.count("*").alias("n"))
    bias = F.coalesce(F.log1p(F.col("n").cast("double")), F.lit(0.0))
    return w.vectors.join(counts, "item_id", "left").select("item_id", V.append_constant("vec", bias).alias("vec"))


@query("topn_inner_product", "SELECT user_id, item_id, score, rank FROM retrieved WHERE rank <= 100")
def topn_inner_product(w):
    found = R.topn_inner_product(user_vectors(w), w.vectors, 100, normalize=True)
    return long_rank(found, "user_id", "item_id", "score")


@query("topn_raw_product", f"""
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT u.user_id, v.item_id, round(list_inner_product(u.vec, v.vec) + {BIAS_SQL}, 9) AS score
    FROM user_vecs u CROSS JOIN vectors v LEFT JOIN popularity p ON p.item_id = v.item_id)) WHERE rank <= 20""")
def _(w):
    """Raw inner product with the item bias as an extra dimension."""
    queries = user_vectors(w).withColumn("vec", V.append_constant("vec", 1.0))
    found = R.topn_inner_product(queries, _biased_items(w), 20)
    return long_rank(found, "user_id", "item_id", "score")


@query("topn_block_grid", "SELECT user_id, item_id, score, rank FROM retrieved WHERE rank <= 100")
def _(w):
    """The same search forced onto the block grid used beyond the broadcast bound."""
    from dataclasses import replace

    from tasteloom.config import DEFAULTS

    opts = replace(DEFAULTS, broadcast_bytes=0, vector_block=200)
    found = R.topn_inner_product(user_vectors(w), w.vectors, 100, normalize=True, opts=opts)
    return long_rank(found, "user_id", "item_id", "score")


@query("topn_ivf", """
WITH c AS (SELECT cell, vec FROM label_cells),
home AS (SELECT item_id, cell FROM (SELECT v.item_id, c.cell, row_number() OVER (PARTITION BY v.item_id
           ORDER BY round(list_inner_product(v.vec, c.vec), 9) DESC, c.cell) AS rn FROM unit_vectors v CROSS JOIN c) WHERE rn = 1),
probe AS (SELECT user_id, cell FROM (SELECT u.user_id, c.cell, row_number() OVER (PARTITION BY u.user_id
           ORDER BY round(list_inner_product(u.vec, c.vec), 9) DESC, c.cell) AS rn FROM user_units u CROSS JOIN c) WHERE rn <= 3)
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT p.user_id, h.item_id, round(list_inner_product(u.vec, v.vec), 9) AS score
    FROM probe p JOIN home h ON h.cell = p.cell JOIN user_units u ON u.user_id = p.user_id
    JOIN unit_vectors v ON v.item_id = h.item_id)) WHERE rank <= 20""")
def _(w):
    cells = write_stage(R.label_cells(
        w.table("embeddings").select("label", F.col("embedding").alias("vec")), "label", DIM), "cells")
    found = R.topn_ivf(user_vectors(w), w.vectors, cells, 20, nprobe=3)
    return long_rank(found, "user_id", "item_id", "score")


@query("topn_ivf_kmeans", "SELECT user_id, item_id, score, rank FROM retrieved WHERE rank <= 20")
def _(w):
    """Cells trained by k-means; with all of them probed the result is exact, wherever they lie."""
    found = R.topn_ivf(user_vectors(w), w.vectors, R.train_cells(w.vectors, 16), 20, nprobe=16)
    return long_rank(found, "user_id", "item_id", "score")


@query("ivf_kmeans_recall")
def _(w):
    """Share of the exact lists that 4 of 16 trained cells give, and the share of items they hold."""
    queries = write_stage(user_vectors(w), "queries")
    cells = write_stage(R.train_cells(w.vectors, 16), "cells")
    exact = write_stage(R.topn_inner_product(queries, w.vectors, 20, normalize=True).select("user_id", "item_id"), "exact")
    some = R.topn_ivf(queries, w.vectors, cells, 20, nprobe=4).select("user_id", "item_id", F.lit(1).alias("hit"))
    return rounded(exact.join(some, ["user_id", "item_id"], "left").agg(
        F.lit(4).alias("nprobe"), F.count("*").alias("n_exact"), F.count("hit").alias("n_found"),
        (F.count("hit") / F.count("*")).alias("recall_20")))


@query("similar_items", """
SELECT item_id, neighbor_id, score, rank FROM similar_all
WHERE rank <= 10 AND item_id IN (SELECT item_id FROM pop_recs)""")
def _(w):
    from tasteloom.plans.evaluation_queries import popularity_lists

    seeds = popularity_lists(w)[0].select("item_id").distinct()
    found = R.similar_items(w.vectors, 10, seeds)
    return long_rank(found, "item_id", "neighbor_id", "score")


@query("precompute_similar", "SELECT item_id, neighbor_id, score, rank FROM similar_all WHERE rank <= 30")
def _(w):
    found = R.similar_items(w.vectors, 30)
    return long_rank(found, "item_id", "neighbor_id", "score")


view("vector_recs", """
SELECT user_id, item_id, rank FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank
  FROM (SELECT * FROM retrieved WHERE rank <= 200) r
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)) WHERE rank <= 50""")


def vector_recs(w):
    return R.recommend_from_vectors(user_vectors(w), w.vectors, S.seen_items(w.train), 50)


@query("recommend_from_index", "SELECT user_id, item_id, rank FROM vector_recs")
def _(w):
    return long_rank(vector_recs(w), "user_id", "item_id")


@query("batch_retrieve", "SELECT user_id, item_id, score, rank FROM candidates")
def _(w):
    return long_rank(candidates(w), "user_id", "item_id", "score")


@query("evaluate_index", evaluate_sql("vector_recs", "vectors"))
def _(w):
    size = w.train.agg(F.countDistinct("item_id")).first()[0]
    return rounded(M.evaluate(write_stage(vector_recs(w), "recs"), S.ground_truth(w.test), size, method="vectors"))


@query("user_item_cross", """
SELECT u.user_id, p.item_id, p.pop_rank FROM users u CROSS JOIN popularity p WHERE pop_rank <= 20""")
def _(w):
    """Every user with the catalog head: ranks are generated per user, the head is a bounded lookup."""
    head = popularity_head(w.train, 20)
    return w.users.select(
        "user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(20).cast("bigint"))).alias("pop_rank")
    ).join(F.broadcast(head.select("pop_rank", "item_id")), "pop_rank").select("user_id", "item_id", "pop_rank")


@query("fetch_items", """
SELECT r.user_id, r.rank, r.item_id, title, price FROM vector_recs r LEFT JOIN items i ON i.item_id = r.item_id WHERE rank <= 10""")
def _(w):
    top = first_per_group(vector_recs(w).drop("score"), ["user_id"], ["rank"], 10)
    return long_rank(top.join(w.items, "item_id", "left"), "user_id", "item_id", "title", "price")
