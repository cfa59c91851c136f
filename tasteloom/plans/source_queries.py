"""Queries: raw sources, saved tables and artifacts, round-tripped through the shared folder."""

from pyspark.sql import functions as F

from tasteloom import schema
from tasteloom.functions.scalars import clean_price, leaf_category, pick_image
from tasteloom.operators import metrics as M
from tasteloom.operators import retrieval as R
from tasteloom.operators import splitting as S
from tasteloom.operators.features import feature_store
from tasteloom.operators.popularity import popularity_rank
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.evaluation_queries import catalog_size, evaluate_sql, popularity_lists, random_lists, rounded
from tasteloom.plans.registry import query
from tasteloom.session import stage_path, write_stage
from tasteloom.sources import raw as J
from tasteloom.sources import tables as B


def reviews_json(w, parts=None):
    """Interactions as raw review lines."""
    path = stage_path(w.spark, "reviews")
    rows = w.interactions.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("item_id").cast("string").alias("parent_asin"),
        "rating", F.col("ts").alias("timestamp"), F.lit("ok").alias("title"),
    )
    rows.write.json(path)
    return path


def meta_json(w):
    """Metadata lines: numeric, text and missing prices, images as list or lists."""
    path = stage_path(w.spark, "meta")
    w.raw_meta.write.json(path)
    return path


_REVIEWS = """
SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS item_id, rating, ts FROM interactions"""


@query("read_jsonl", f"SELECT user_id, item_id AS parent_asin, rating, ts AS timestamp FROM ({_REVIEWS})")
def _(w):
    return J.read_jsonl(w.spark, reviews_json(w), schema.RAW_REVIEWS)


@query("read_reviews", f"SELECT * FROM ({_REVIEWS}) WHERE ts >= epoch_ms(TIMESTAMP '1998-01-01')")
def _(w):
    return J.read_reviews(w.spark, reviews_json(w), 1998)


@query("chunk_union", _REVIEWS)
def _(w):
    path = reviews_json(w)
    rows = J.read_reviews(w.spark, path, 1970)
    late = J.read_reviews(w.spark, path, 1999)
    return J.chunk_union([rows.where(F.col("ts") < F.lit(915148800000)), late])


_META = """
SELECT p_partkey::VARCHAR AS item_id, p_name AS title, CASE WHEN p_partkey % 7 = 0 THEN NULL
  WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'img/' || p_partkey || '-l'
       WHEN p_partkey % 3 = 0 THEN 'img/' || p_partkey || '-h' ELSE 'img/' || p_partkey || '-t' END
  WHEN p_partkey % 3 = 0 THEN 'img/' || p_partkey || '-l' ELSE 'img/' || p_partkey || '-h' END AS image_url,
  CASE WHEN p_partkey % 11 = 0 THEN p_type ELSE p_brand END AS category, p_brand AS brand,
  round(CASE p_partkey % 5 WHEN 2 THEN p_retailprice + 5 WHEN 1 THEN p_retailprice WHEN 3 THEN p_retailprice END, 6) AS price,
  round(1 + (p_partkey * 7 % 41) / 10.0, 6)::DOUBLE AS avg_rating
FROM part"""


@query("read_meta", f"SELECT * FROM ({_META}) WHERE item_id IN (SELECT item_id::VARCHAR FROM test)")
def _(w):
    return rounded(J.read_meta(w.spark, meta_json(w), w.test.select("item_id").distinct()))


@query("read_meta_all", _META)
def _(w):
    return rounded(J.read_meta(w.spark, meta_json(w)))


def _saved_split(w):
    folder = stage_path(w.spark, "split")
    B.write_split(folder, w.train, w.val, w.test, w.items)
    return B.read_split(w.spark, folder)


@query("write_split", """
SELECT split, count(*) AS n_rows, CAST(sum(ts) AS DOUBLE) AS ts_sum FROM labelled GROUP BY split
UNION ALL SELECT 'items', count(*), CAST(sum(item_id) AS DOUBLE) FROM items""")
def saved_split_sums(w):
    parts = _saved_split(w)
    out = None
    for name in ("train", "val", "test", "items"):
        key = "item_id" if name == "items" else "ts"
        total = F.sum(F.col(key).cast("decimal(20,0)"))    # beyond 10 million rows the times do not add up in 64 bits
        row = parts[name].agg(F.count("*").alias("n_rows"), total.cast("double").alias("ts_sum")).select(
            F.lit(name).alias("split"), "n_rows", "ts_sum"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("read_split", "SELECT split, user_id, item_id, rating, ts FROM labelled")
def _(w):
    parts = _saved_split(w)
    return J.chunk_union([parts[n].select(F.lit(n).alias("split"), "user_id", "item_id", "rating", "ts") for n in ("train", "val", "test")])


@query("write_encoders", """
SELECT 'user' AS kind, user_id AS id, CAST(u AS INTEGER) AS code FROM user_codes
UNION ALL SELECT 'item', item_id, CAST(i AS INTEGER) FROM item_codes""")
def _(w):
    folder = stage_path(w.spark, "encoders")
    B.write_encoders(folder, S.build_encoder(w.train, "user_id", "u"), S.build_encoder(w.train, "item_id", "i"))
    users, items = B.read_encoders(w.spark, folder)
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("u").alias("code")).unionByName(
        items.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("i").alias("code"))
    )


@query("bulk_upsert_items", """
SELECT item_id, title, price FROM items WHERE item_id IN (SELECT item_id FROM train)
UNION ALL SELECT item_id, title || ' (new)', CASE WHEN item_id % 2 = 0 THEN price END FROM items
WHERE item_id NOT IN (SELECT item_id FROM train)""")
def _(w):
    known = w.items.join(w.train.select("item_id").distinct(), "item_id", "left_semi").select("item_id", "title", "price")
    new = w.items.select(
        "item_id", F.concat("title", F.lit(" (new)")).alias("title"),
        F.when(F.col("item_id") % 2 == 0, F.col("price")).otherwise(F.lit(float("nan"))).alias("price"),
    )
    return B.upsert_items(known, new)


@query("append_interactions", """
SELECT user_id, item_id, rating, ts, event_type FROM live_events UNION ALL SELECT user_id, item_id, rating, ts, NULL FROM test""")
def _(w):
    return B.append_interactions(w.live_events.select("user_id", "item_id", "rating", "ts", "event_type"), w.test)


def _results(w):
    pop, truth = popularity_lists(w)
    rnd, _truth = random_lists(w)
    size = catalog_size(w)
    return (
        M.evaluate(write_stage(pop, "recs"), truth, size, method="popularity"),
        M.evaluate(write_stage(rnd, "recs"), truth, size, method="random"),
    )


_BOTH = f"{evaluate_sql('pop_recs', 'popularity')} UNION ALL {evaluate_sql('random_recs', 'random')}"


@query("write_results_csv", _BOTH)
def _(w):
    pop, rnd = _results(w)
    path = stage_path(w.spark, "results")
    B.write_results_csv(pop.unionByName(rnd), path)
    return rounded(B.read_results_csv(w.spark, path, schema.RESULTS))


@query("upsert_result_row", _BOTH)
def _(w):
    pop, rnd = _results(w)
    stale = pop.withColumn("recall_10", F.lit(0.0))
    return rounded(B.upsert_result_rows(stale.unionByName(rnd), pop))


@query("read_results_csv", evaluate_sql("pop_recs", "popularity"))
def _(w):
    pop, rnd = _results(w)
    path = stage_path(w.spark, "results")
    B.write_results_csv(pop, path)
    return rounded(B.read_results_csv(w.spark, path, schema.RESULTS, default=rnd))


@query("assert_dataset_contract", """
SELECT count(*) AS n_rows, max(u) AS max_u, max(i) AS max_i FROM encoded""")
def _(w):
    users, items = S.build_encoder(w.train, "user_id", "u"), S.build_encoder(w.train, "item_id", "i")
    encoded = S.encode_ids(w.interactions, users, items)
    schema.assert_contract(encoded, users.count(), items.count(), min_rows=100)
    return encoded.agg(F.count("*").alias("n_rows"), F.max("u").alias("max_u"), F.max("i").alias("max_i"))


def _artifacts(w, with_store=True):
    folder = stage_path(w.spark, "artifacts")
    tables = {
        "popularity": popularity_rank(w.train),
        "item_encoder": S.build_encoder(w.train, "item_id", "i"),
        "item_vectors": w.vectors,
        "similar_items": R.similar_items(w.vectors, 30),
    }
    if with_store:
        store = feature_store(w.train, w.items)
        tables["user_features"], tables["item_features"] = store.users, store.items
        tables["feature_constants"] = w.train.limit(1).select(
            F.lit(store.global_avg_rating).alias("global_avg_rating"), F.lit(store.now_ts).alias("now_ts")
        )
    B.write_artifacts(folder, **tables)
    return folder


@query("write_artifacts", """
SELECT 'popularity' AS artifact, (SELECT count(*) FROM popularity) AS n_rows
UNION ALL SELECT 'item_encoder', (SELECT count(*) FROM item_codes)
UNION ALL SELECT 'item_vectors', (SELECT count(*) FROM vectors)
UNION ALL SELECT 'similar_items', (SELECT count(*) * 30 FROM vectors)
UNION ALL SELECT 'user_features', (SELECT count(DISTINCT user_id) FROM train)
UNION ALL SELECT 'item_features', (SELECT count(*) FROM items)
UNION ALL SELECT 'feature_constants', 1""")
def _(w):
    return B.artifact_health(w.spark, _artifacts(w)).where("loaded").select("artifact", "n_rows")


@query("artifact_health", """
SELECT a AS artifact, a IN ('popularity', 'item_encoder', 'item_vectors', 'similar_items') AS loaded,
  CASE a WHEN 'popularity' THEN (SELECT count(*) FROM popularity) WHEN 'item_encoder' THEN (SELECT count(*) FROM item_codes)
    WHEN 'item_vectors' THEN (SELECT count(*) FROM vectors) WHEN 'similar_items' THEN (SELECT count(*) * 30 FROM vectors) END AS n_rows
FROM (SELECT unnest(['popularity', 'item_encoder', 'item_vectors', 'similar_items', 'user_features', 'item_features',
  'feature_constants', 'ranker_trees', 'tower_weights']) AS a)""")
def _(w):
    return B.artifact_health(w.spark, _artifacts(w, with_store=False))


@query("load_artifacts_or_degrade", """
SELECT user_id, 'retriever' AS stage, 'Two-tower' AS model_label FROM users""")
def _(w):
    found = B.load_artifacts(w.spark, _artifacts(w, with_store=False))
    return w.users.select("user_id", F.lit(found.stage).alias("stage"), F.lit(found.model_label).alias("model_label"))
