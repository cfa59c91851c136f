"""Queries: baselines, ranking metrics, cold-start buckets and comparison tables."""

from pyspark.sql import functions as F

from tasteloom.operators import metrics as M
from tasteloom.operators import popularity as B
from tasteloom.operators import splitting as S
from tasteloom.operators.ordering import first_per_group
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.registry import query, view
from tasteloom.session import write_stage

RECALL_SQL = """
SELECT t.user_id, {cols}
FROM (SELECT user_id, count(*) AS n_rel FROM truth GROUP BY user_id) t
JOIN (SELECT DISTINCT user_id FROM {recs}) a ON a.user_id = t.user_id
LEFT JOIN (SELECT r.user_id, {sums} FROM {recs} r JOIN truth h USING (user_id, item_id) GROUP BY r.user_id) g
  ON g.user_id = t.user_id"""


def user_scores_sql(recs: str, ks=(10, 20, 50)) -> str:
    sums = ", ".join(
        f"count(DISTINCT r.item_id) FILTER (rank <= {k}) AS h{k}, "
        f"sum(1 / log2(rank + 1)) FILTER (rank <= {k}) AS g{k}" for k in ks
    )
    cols = ", ".join(
        f"coalesce(h{k}, 0)::DOUBLE / n_rel AS recall_{k}, "
        f"coalesce(g{k}, 0) / (SELECT sum(1 / log2(p + 1)) FROM range(1, least(n_rel, {k}) + 1) q(p)) AS ndcg_{k}"
        for k in ks
    )
    return RECALL_SQL.format(cols=cols, sums=sums, recs=recs)


def evaluate_sql(recs: str, method: str, ks=(10, 20, 50), catalog="(SELECT count(DISTINCT item_id) FROM train)") -> str:
    means = ", ".join(f"round(avg({m}_{k}), 6) AS {m}_{k}" for k in ks for m in ("recall", "ndcg"))
    top = max(ks)
    return f"""
SELECT '{method}' AS method, {means},
       round((SELECT count(DISTINCT item_id) FROM {recs} WHERE rank <= {top})::DOUBLE / {catalog}, 6)
         AS coverage_{top},
       count(*) AS n_users_scored
FROM ({user_scores_sql(recs, ks)})"""


def rounded(df):
    """Doubles to six digits. Retrieval scores are already rounded to nine; price means get
    eight, because sums of tenths over a few dozen rows often end in an exact half at six."""
    exact, fine = ("score", "retriever_score"), ("user_avg_price", "price_gap")
    return df.select(*(
        F.col(c) if t != "double" or c in exact else F.round(c, 8 if c in fine else 6).alias(c) for c, t in df.dtypes
    ))


def _draw(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


view("random_recs", f"""
SELECT user_id, item_id, rank FROM (
  SELECT d.user_id, c.item_id, row_number() OVER (PARTITION BY d.user_id ORDER BY d.key) AS rank
  FROM (SELECT user_id, i, min(d) AS key FROM (
          SELECT user_id, d, {_draw("'42|' || user_id || '|' || d")} % (SELECT count(*) FROM item_codes) AS i
          FROM (SELECT DISTINCT user_id FROM truth), range(0, 114) t(d)) GROUP BY user_id, i) d
  JOIN item_codes c ON c.i = d.i
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = d.user_id AND s.item_id = c.item_id))
WHERE rank <= 50""")


def popularity_lists(w, n=50):
    truth = S.ground_truth(w.test)
    ranking = B.popularity_rank(w.train)
    return B.popularity_recommend(truth.select("user_id"), ranking, w.train.select("user_id", "item_id"), n), truth


def catalog_size(w) -> int:
    return w.train.agg(F.countDistinct("item_id")).first()[0]


def random_lists(w, n=50):
    truth = S.ground_truth(w.test)
    items = S.build_encoder(w.train, "item_id", "i")
    return B.random_recommend(truth.select("user_id"), items, S.seen_items(w.train), n), truth


@query("popularity_rank", "SELECT pop_rank, item_id, n FROM popularity")
def _(w):
    return B.popularity_rank(w.train)


@query("popularity_head", "SELECT pop_rank, item_id, n FROM popularity WHERE pop_rank <= 100")
def _(w):
    return B.popularity_head(w.train, 100)


@query("popularity_recommend", "SELECT user_id, item_id, rank, pop_rank FROM pop_recs")
def _(w):
    recs, _truth = popularity_lists(w)
    return recs.select("user_id", "item_id", F.col("rank").cast("bigint").alias("rank"), "pop_rank")


@query("random_recommend", "SELECT user_id, item_id, rank FROM random_recs")
def _(w):
    recs, _truth = random_lists(w)
    return recs.select("user_id", "item_id", F.col("rank").cast("bigint").alias("rank"))


@query("evaluate_popularity", evaluate_sql("pop_recs", "popularity"))
def evaluate_popularity(w):
    recs, truth = popularity_lists(w)
    return rounded(M.evaluate(write_stage(recs, "recs"), truth, catalog_size(w), method="popularity"))


@query("evaluate_random", evaluate_sql("random_recs", "random"))
def _(w):
    recs, truth = random_lists(w)
    return rounded(M.evaluate(write_stage(recs, "recs"), truth, catalog_size(w), method="random"))


@query("recall_at_k", f"""
SELECT user_id, round(recall_10, 6) AS recall_10, round(recall_20, 6) AS recall_20,
       round(recall_50, 6) AS recall_50 FROM ({user_scores_sql("pop_recs")})""")
def _(w):
    recs, truth = popularity_lists(w)
    s = M.score_users(recs, truth, (10, 20, 50))
    return s.select("user_id", r6("recall_10"), r6("recall_20"), r6("recall_50"))


@query("ndcg_at_k", f"""
SELECT user_id, round(ndcg_10, 6) AS ndcg_10, round(ndcg_20, 6) AS ndcg_20,
       round(ndcg_50, 6) AS ndcg_50 FROM ({user_scores_sql("pop_recs")})""")
def _(w):
    recs, truth = popularity_lists(w)
    s = M.score_users(recs, truth, (10, 20, 50))
    return s.select("user_id", r6("ndcg_10"), r6("ndcg_20"), r6("ndcg_50"))


@query("catalog_coverage", """
SELECT round(count(DISTINCT item_id)::DOUBLE / (SELECT count(DISTINCT item_id) FROM train), 6) AS coverage_50
FROM pop_recs""")
def _(w):
    recs, _truth = popularity_lists(w)
    return M.catalog_coverage(recs, catalog_size(w), 50).select(r6("coverage_50"))


@query("hits_join", """
SELECT t.user_id, t.item_id, CAST(rank AS BIGINT) AS rank, rank IS NOT NULL AS hit
FROM truth t LEFT JOIN pop_recs r ON r.user_id = t.user_id AND r.item_id = t.item_id AND rank <= 50""")
def _(w):
    recs, truth = popularity_lists(w)
    return truth.join(recs.where("rank <= 50").select("user_id", "item_id", "rank"),
                      ["user_id", "item_id"], "left").select(
        "user_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.col("rank").isNotNull().alias("hit")
    )


BUCKET_SQL = """CASE WHEN n BETWEEN 1 AND 4 THEN '1-4' WHEN n BETWEEN 5 AND 19 THEN '5-19'
                     WHEN n >= 20 THEN '20-+' ELSE '0' END"""
view("buckets", f"""
SELECT u.user_id, {BUCKET_SQL} AS bucket
FROM (SELECT DISTINCT user_id FROM test) u
LEFT JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY user_id) t ON t.user_id = u.user_id""")


@query("activity_bucket", "SELECT user_id, bucket FROM buckets")
def _(w):
    return M.activity_buckets(w.test, w.train)


def bucket_sql(recs):
    return f"""
SELECT bucket, count(*) AS users, round(avg(recall_20), 6) AS recall_20, round(avg(ndcg_20), 6) AS ndcg_20
FROM ({user_scores_sql(recs, (20,))}) s JOIN buckets b ON b.user_id = s.user_id GROUP BY bucket"""


@query("evaluate_by_bucket", bucket_sql("pop_recs"))
def _(w):
    recs, truth = popularity_lists(w)
    return rounded(M.evaluate_by_bucket(recs, truth, w.train, 20))


@query("inner_bucket_merge", f"""
SELECT a.bucket, a.users, a.recall_20 AS recall_20_pop, a.ndcg_20 AS ndcg_20_pop,
       b.recall_20 AS recall_20_random, b.ndcg_20 AS ndcg_20_random
FROM ({bucket_sql("pop_recs")}) a JOIN ({bucket_sql("random_recs")}) b
  ON a.bucket = b.bucket AND a.users = b.users""")
def _(w):
    pop, truth = popularity_lists(w)
    rnd, _truth = random_lists(w)
    return rounded(M.merge_buckets(
        M.evaluate_by_bucket(pop, truth, w.train, 20), M.evaluate_by_bucket(rnd, truth, w.train, 20),
        "pop", "random",
    ))


@query("comparison_table", f"{evaluate_sql('pop_recs', 'popularity')} UNION ALL {evaluate_sql('random_recs', 'random')}")
def _(w):
    pop, truth = popularity_lists(w)
    rnd, _truth = random_lists(w)
    size = catalog_size(w)
    return rounded(M.comparison_table(
        M.evaluate(write_stage(pop, "recs"), truth, size, method="popularity"),
        M.evaluate(write_stage(rnd, "recs"), truth, size, method="random"),
    ))


# ------------------------------------------------------ sets, sorts and limits
@query("set_intersect", "SELECT r.user_id, r.item_id FROM pop_recs r JOIN truth t USING (user_id, item_id) WHERE rank <= 20")
def _(w):
    recs, truth = popularity_lists(w)
    return recs.where("rank <= 20").select("user_id", "item_id").join(truth, ["user_id", "item_id"], "left_semi")


@query("set_union", "SELECT DISTINCT item_id FROM pop_recs WHERE rank <= 50")
def _(w):
    recs, _truth = popularity_lists(w)
    return recs.where("rank <= 50").select("item_id").distinct()


@query("set_difference", """
SELECT DISTINCT item_id FROM interactions EXCEPT SELECT item_id FROM pop_recs""")
def _(w):
    recs, _truth = popularity_lists(w)
    return w.interactions.select("item_id").distinct().join(recs.select("item_id").distinct(), "item_id", "left_anti")


@query("topk", """
SELECT user_id, item_id, ts, rank FROM (
  SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, max(ts) AS ts FROM interactions GROUP BY ALL)) WHERE rank <= 5""")
def _(w):
    latest = w.interactions.groupBy("user_id", "item_id").agg(F.max("ts").alias("ts"))
    return first_per_group(latest, ["user_id"], [F.desc("ts"), "item_id"], 5, "rank").select(
        "user_id", "item_id", "ts", F.col("rank").cast("bigint").alias("rank")
    )


@query("sort_nulls_last", """
SELECT item_id, avg_rating, price FROM items ORDER BY avg_rating DESC NULLS LAST, item_id LIMIT 100""")
def _(w):
    return w.items.select("item_id", "avg_rating", "price").orderBy(
        F.desc_nulls_last("avg_rating"), "item_id"
    ).limit(100)


@query("dedupe_first", """
SELECT title, item_id FROM (SELECT title, item_id, row_number() OVER (PARTITION BY title ORDER BY item_id) AS rn
FROM items) WHERE rn = 1""")
def _(w):
    return w.items.groupBy("title").agg(F.min("item_id").alias("item_id"))


@query("concat_tables", """
SELECT user_id, item_id, rating, ts FROM train UNION ALL SELECT user_id, item_id, rating, ts FROM val""")
def _(w):
    return w.train.unionByName(w.val)
