"""Queries: feature store, ranker data, list-wise gradients, boosting and diversification."""

from pyspark.sql import functions as F

from tasteloom.operators import diversity as D
from tasteloom.operators import features as X
from tasteloom.operators import metrics as M
from tasteloom.operators import popularity as B
from tasteloom.operators import ranker as L
from tasteloom.operators import retrieval as R
from tasteloom.operators import splitting as S
from tasteloom.operators.histories import user_history
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.evaluation_queries import catalog_size, evaluate_sql, rounded
from tasteloom.plans.registry import query, view
from tasteloom.plans.retrieval_queries import candidates, long_rank, user_vectors
from tasteloom.session import write_stage

view("item_features", """
SELECT coalesce(t.item_id, i.item_id) AS item_id, item_pop, item_avg_rating, item_last_ts,
       price AS item_price, brand AS item_brand, category AS item_cat
FROM (SELECT item_id, count(*) AS item_pop, avg(rating) AS item_avg_rating, max(ts) AS item_last_ts
      FROM train GROUP BY item_id) t FULL JOIN items i ON i.item_id = t.item_id""")
view("train_meta", "SELECT t.user_id, t.rating, t.ts, category, brand, price FROM train t LEFT JOIN items i ON i.item_id = t.item_id")
view("top_cats", """
SELECT user_id, category FROM (SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category) AS rn
FROM train_meta WHERE category IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""")
view("top_brands", """
SELECT user_id, brand FROM (SELECT user_id, brand, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, brand) AS rn
FROM train_meta WHERE brand IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""")
view("user_features", """
SELECT m.*, c.category AS user_top_cat, b.brand AS user_top_brand FROM (
  SELECT user_id, count(*) AS user_activity, avg(rating) AS user_avg_rating, max(ts) AS user_last_ts,
         avg(price) AS user_avg_price FROM train_meta GROUP BY user_id) m
LEFT JOIN top_cats c ON c.user_id = m.user_id LEFT JOIN top_brands b ON b.user_id = m.user_id""")
view("pairs", "SELECT user_id, item_id, score AS retriever_score FROM candidates")
view("features", """
SELECT p.user_id, p.item_id, retriever_score,
  coalesce(item_pop, 0)::DOUBLE AS item_pop, round(coalesce(item_avg_rating, g.mean), 6) AS item_avg_rating,
  coalesce(item_price, 0)::DOUBLE AS item_price,
  round((g.now - coalesce(item_last_ts, g.now)) / 8.64e7, 6) AS item_age_days,
  coalesce(user_activity, 0)::DOUBLE AS user_activity, round(coalesce(user_avg_rating, g.mean), 6) AS user_avg_rating,
  round((g.now - coalesce(user_last_ts, g.now)) / 8.64e7, 6) AS days_since_user_last,
  coalesce((user_top_cat = item_cat)::INT, 0)::DOUBLE AS cat_match,
  coalesce((user_top_brand = item_brand)::INT, 0)::DOUBLE AS brand_match,
  round(coalesce(abs(item_price - user_avg_price), 0), 8) AS price_gap,
  round(coalesce(item_avg_rating, g.mean) - coalesce(user_avg_rating, g.mean), 6) AS rating_vs_user_mean
FROM pairs p LEFT JOIN item_features i ON i.item_id = p.item_id LEFT JOIN user_features u ON u.user_id = p.user_id,
     (SELECT avg(rating) AS mean, max(ts) AS now FROM train) g""")
view("ranker_rows", """
SELECT f.*, CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS label
FROM features f LEFT JOIN val_truth t ON t.user_id = f.user_id AND t.item_id = f.item_id
WHERE f.user_id IN (SELECT c.user_id FROM candidates c JOIN val_truth v ON v.user_id = c.user_id AND v.item_id = c.item_id)""")
view("scored", """
SELECT user_id, item_id, label, round(retriever_score + 0.1 * cat_match - 0.01 * rating_vs_user_mean, 9) AS score
FROM ranker_rows""")


def store(w):
    return X.feature_store(w.train, w.items)


def pairs(w):
    return candidates(w).select("user_id", "item_id", F.col("score").alias("retriever_score"))


def feature_rows(w):
    return X.featurize(pairs(w), store(w))


def ranker_rows(w):
    users = S.group_eligible_users(w.train, w.val)
    queries = user_vectors(w).join(users, "user_id", "left_semi")
    cands = R.batch_retrieve(queries, w.vectors, S.seen_items(w.train), 100)
    return X.build_ranker_data(write_stage(cands, "cands"), S.ground_truth(w.val), store(w))


def linear_scores(w):
    rows = ranker_rows(w)
    score = F.round(
        F.col("retriever_score") + 0.1 * F.col("cat_match") - 0.01 * F.round("rating_vs_user_mean", 6), 9
    )
    return rows.select("user_id", "item_id", "label", score.alias("score"))


def _item_stat(name, column, sql):
    @query(name, f"SELECT item_id, {sql} AS {column} FROM item_features WHERE item_pop IS NOT NULL")
    def _(w):
        out = X.item_features(w.train, w.items).where(F.col("item_pop").isNotNull())
        return rounded(out.select("item_id", column))


def _user_stat(name, column, sql):
    @query(name, f"SELECT user_id, {sql} AS {column} FROM user_features")
    def _(w):
        return rounded(X.user_features(w.train, w.items).select("user_id", column))


_item_stat("item_pop", "item_pop", "item_pop")
_item_stat("item_avg_rating", "item_avg_rating", "round(item_avg_rating, 6)")
_item_stat("item_last_ts", "item_last_ts", "item_last_ts")
_user_stat("user_activity", "user_activity", "user_activity")
_user_stat("user_avg_rating", "user_avg_rating", "round(user_avg_rating, 6)")
_user_stat("user_last_ts", "user_last_ts", "user_last_ts")
_user_stat("user_top_cat", "user_top_cat", "user_top_cat")
_user_stat("user_top_brand", "user_top_brand", "user_top_brand")
_user_stat("user_avg_price", "user_avg_price", "round(user_avg_price, 8)")


@query("global_avg_rating", "SELECT round(avg(rating), 6) AS global_avg_rating, max(ts) AS now_ts FROM train")
def _(w):
    return w.train.agg(F.round(F.avg("rating"), 6).alias("global_avg_rating"), F.max("ts").alias("now_ts"))


@query("feature_store", """
SELECT user_id, user_activity, round(user_avg_rating, 6) AS user_avg_rating, user_last_ts,
       round(user_avg_price, 8) AS user_avg_price, user_top_cat, user_top_brand FROM user_features""")
def _(w):
    return rounded(store(w).users)


@query("feature_store_items", """
SELECT item_id, item_pop, round(item_avg_rating, 6) AS item_avg_rating, item_last_ts, item_price, item_brand, item_cat
FROM item_features""")
def _(w):
    return rounded(store(w).items)


@query("left_enrich", """
SELECT user_id, t.item_id, rating, category, brand, price FROM train t LEFT JOIN items i ON i.item_id = t.item_id""")
def _(w):
    return w.train.join(w.items, "item_id", "left").select("user_id", "item_id", "rating", "category", "brand", "price")


@query("map_lookup", """
SELECT p.user_id, p.item_id, coalesce(item_pop, 0) AS item_pop,
       round(coalesce(user_avg_rating, (SELECT avg(rating) FROM train)), 6) AS user_avg_rating
FROM (SELECT DISTINCT user_id, item_id FROM test) p LEFT JOIN item_features i ON i.item_id = p.item_id
LEFT JOIN user_features u ON u.user_id = p.user_id""")
def _(w):
    s = store(w)
    return S.ground_truth(w.test, False).join(s.items, "item_id", "left").join(s.users, "user_id", "left").select(
        "user_id", "item_id", F.coalesce("item_pop", F.lit(0).cast("bigint")).alias("item_pop"),
        r6(F.coalesce("user_avg_rating", F.lit(s.global_avg_rating)), "user_avg_rating"),
    )


@query("featurize", "SELECT * FROM features")
def featurize_query(w):
    return rounded(feature_rows(w))


def _feature(name):
    @query(f"feature_{name}", f"SELECT user_id, item_id, {name} FROM features")
    def _(w):
        return rounded(feature_rows(w).select("user_id", "item_id", name))


for _name in X.FEATURES:
    _feature(_name)


@query("build_ranker_data", "SELECT * FROM ranker_rows")
def _(w):
    return rounded(ranker_rows(w))


@query("ranker_label_report", """
SELECT part, count(*) AS n_rows, count(DISTINCT user_id) AS n_groups, round(avg(label), 6) AS positive_rate
FROM (SELECT *, CASE WHEN (('0x' || substr(md5('42|' || user_id), 1, 15))::BIGINT + 0.5) / 1152921504606846976.0 < 0.85
      THEN 'fit' ELSE 'holdout' END AS part FROM ranker_rows) GROUP BY part""")
def _(w):
    return rounded(X.label_report(L.fit_holdout(ranker_rows(w))))


@query("lambda_gradients", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rk,
             sum(label) OVER (PARTITION BY user_id) AS positives FROM scored),
ideal AS (SELECT user_id, sum(1 / log2(p + 1)) AS idcg FROM (SELECT DISTINCT user_id, positives FROM r),
          range(1, 101) t(p) WHERE p <= positives GROUP BY user_id),
pr AS (SELECT a.user_id, a.item_id AS hi, b.item_id AS lo, 1 / (1 + exp(a.score - b.score)) AS rho,
         abs(1 / log2(a.rk + 1) - 1 / log2(b.rk + 1)) / idcg AS delta
       FROM r a JOIN r b ON a.user_id = b.user_id AND a.label > b.label JOIN ideal ON ideal.user_id = a.user_id),
parts AS (SELECT user_id, hi AS item_id, rho * delta AS g, rho * (1 - rho) * delta AS h FROM pr
          UNION ALL SELECT user_id, lo, -rho * delta, rho * (1 - rho) * delta FROM pr)
SELECT user_id, item_id, round(sum(g), 6) AS lambda, round(sum(h), 6) AS weight FROM parts GROUP BY 1, 2""")
def _(w):
    return rounded(L.lambda_gradients(linear_scores(w)))


@query("rerank_linear", """
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored)
WHERE rank <= 10""")
def _(w):
    return long_rank(L.rerank(linear_scores(w), "score", 10), "user_id", "item_id", "score")


def small_ranker(w, rounds=4):
    rows = write_stage(L.fit_holdout(ranker_rows(w)), "ranker")
    return L.lambdamart_fit(rows, rounds=rounds, min_rows=20, leaves=15), rows


@query("lambdamart_fit")
def _(w):
    model, _rows = small_ranker(w)
    return w.spark.createDataFrame(
        [(h["round"], h["fit"], h["holdout"]) for h in model.history], "round int, fit_ndcg double, holdout_ndcg double"
    )


@query("feature_importance")
def _(w):
    return small_ranker(w)[0].importance_table(w.spark)


@query("rerank_fitted")
def _(w):
    model, rows = small_ranker(w)
    return long_rank(L.rerank(model.score(rows), "ranker_score", 10), "user_id", "item_id", "score")


# an ensemble with stated splits and values, for what follows the fit: (feature, threshold, left, right) or a value
STATED_TREES = (
    ("retriever_score", 0.125, ("item_pop", 29.5, -0.25, 0.125), ("cat_match", 0.5, 0.25, ("brand_match", 0.5, 0.5, 0.75))),
    ("item_pop", 24.5, ("user_activity", 33.5, -0.0625, 0.03125), ("retriever_score", 0.25, 0.0625, 0.375)),
    ("user_activity", 40.5, -0.015625, ("item_pop", 31.5, 0.0078125, 0.046875)),
)


def stated_ranker():
    trees = []
    for spec in STATED_TREES:
        tree = L.Tree()

        def add(part, tree=tree):
            at = tree.add()
            if not isinstance(part, tuple):
                tree.value[at], tree.leaf[at] = part, sum(1 for n in tree.leaf if n >= 0)
                return at
            tree.feature[at], tree.threshold[at] = X.FEATURES.index(part[0]), part[1]
            tree.left[at], tree.right[at] = add(part[2]), add(part[3])
            return at

        add(spec)
        trees.append(tree)
    return L.LambdaMart(trees, {}, [])


def _tree_sql(part) -> str:
    if not isinstance(part, tuple):
        return f"{part}::DOUBLE"
    return f"CASE WHEN {part[0]} <= {part[1]} THEN {_tree_sql(part[2])} ELSE {_tree_sql(part[3])} END"


STATED_SCORE = " + ".join(_tree_sql(t) for t in STATED_TREES)
view("stated_ranked", f"""
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM (SELECT user_id, item_id, {STATED_SCORE} AS score FROM features)""")
view("retrieved_lists", "SELECT user_id, item_id, rank FROM candidates WHERE rank <= 50")
view("stated_lists", "SELECT user_id, item_id, rank FROM stated_ranked WHERE rank <= 50")


@query("rerank", f"""
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, {STATED_SCORE} AS score FROM ranker_rows)) WHERE rank <= 10""")
def _(w):
    return long_rank(L.rerank(stated_ranker().score(ranker_rows(w)), "ranker_score", 10), "user_id", "item_id", "score")


@query("ablation_table", "SELECT method, ndcg_10, coverage_50 FROM (" + evaluate_sql("retrieved_lists", "retrieval")
       + ") UNION ALL SELECT method, ndcg_10, coverage_50 FROM (" + evaluate_sql("stated_lists", "retrieval + ranker") + ")")
def _(w):
    model = stated_ranker()
    cands = write_stage(candidates(w), "cands")
    scored = model.score(X.featurize(cands.select("user_id", "item_id", F.col("score").alias("retriever_score")), store(w)))
    truth, size = S.ground_truth(w.test), catalog_size(w)
    plain = M.evaluate(cands.where("rank <= 50"), truth, size, method="retrieval")
    ranked = M.evaluate(write_stage(L.rerank(scored, k=50), "ranked"), truth, size, method="retrieval + ranker")
    return rounded(M.ablation_table(plain, ranked))


# ------------------------------------------------------------------ diversity
view("pool", "SELECT user_id, item_id, score, rank FROM candidates WHERE rank <= 30")


def pool(w):
    return candidates(w).where(F.col("rank") <= 30)


@query("min_max_normalize", """
SELECT user_id, item_id, round(CASE WHEN max(score) OVER p > min(score) OVER p
  THEN (score - min(score) OVER p) / (max(score) OVER p - min(score) OVER p) ELSE score END, 6) AS rel
FROM pool WINDOW p AS (PARTITION BY user_id)""")
def _(w):
    return D.min_max_normalize(pool(w)).select("user_id", "item_id", r6("rel"))


@query("rank_relevance", """
SELECT user_id, item_id, round(1 - (rank - 1) / count(*) OVER (PARTITION BY user_id), 6) AS rel FROM pool""")
def _(w):
    return D.rank_relevance(pool(w)).select("user_id", "item_id", r6("rel"))


view("mmr_rel", """
SELECT user_id, item_id, rank, CASE WHEN max(score) OVER p > min(score) OVER p
  THEN (score - min(score) OVER p) / (max(score) OVER p - min(score) OVER p) ELSE score END AS rel
FROM pool WINDOW p AS (PARTITION BY user_id)""")
for _lam, _tag in ((0.7, "a"), (0.5, "b"), (1.0, "c")):
    view(f"mmr_{_tag}1", """SELECT user_id, item_id, 1 AS pick FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY round(rel, 9) DESC, rank) AS rn FROM mmr_rel) WHERE rn = 1""")
    for _n in range(2, 6):
        _p = f"mmr_{_tag}{_n - 1}"
        view(f"mmr_{_tag}{_n}", f"""
SELECT * FROM {_p} UNION ALL SELECT user_id, item_id, {_n} FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, rank) AS rn FROM (
    SELECT m.user_id, m.item_id, m.rank, round({_lam} * rel - (1 - {_lam}) * max(list_inner_product(a.vec, b.vec)), 9) AS v
    FROM mmr_rel m JOIN {_p} q ON q.user_id = m.user_id JOIN unit_vectors a ON a.item_id = m.item_id
    JOIN unit_vectors b ON b.item_id = q.item_id
    WHERE NOT EXISTS (SELECT 1 FROM {_p} z WHERE z.user_id = m.user_id AND z.item_id = m.item_id)
    GROUP BY m.user_id, m.item_id, m.rank, rel)) WHERE rn = 1""")


@query("mmr_rerank", """
SELECT user_id, 0.7::DOUBLE AS lambda, item_id, CAST(pick AS BIGINT) AS rank FROM mmr_a5
UNION ALL SELECT user_id, 0.5::DOUBLE, item_id, CAST(pick AS BIGINT) FROM mmr_b5
UNION ALL SELECT user_id, 1.0::DOUBLE, item_id, CAST(pick AS BIGINT) FROM mmr_c5""")
def _(w):
    return long_rank(D.mmr_rerank(pool(w), w.vectors, 5, (0.7, 0.5, 1.0)), "user_id", "lambda", "item_id")


_ILS = """
SELECT r.user_id, avg(list_inner_product(a.vec, b.vec)) AS s
FROM {lists} r JOIN {lists} q ON q.user_id = r.user_id AND r.rank < q.rank
JOIN unit_vectors a ON a.item_id = r.item_id JOIN unit_vectors b ON b.item_id = q.item_id GROUP BY r.user_id"""


@query("pairwise_in_group", f"""
SELECT s.user_id, n, round(s, 6) AS similarity FROM ({_ILS.format(lists="(SELECT * FROM pool WHERE rank <= 10)")}) s
JOIN (SELECT user_id, count(*) AS n FROM pool WHERE rank <= 10 GROUP BY 1) c ON c.user_id = s.user_id""")
def _(w):
    return rounded(D.list_similarity(pool(w).where("rank <= 10"), w.vectors))


@query("intra_list_similarity", f"""
SELECT round(avg(s), 6) AS intra_list_similarity FROM ({_ILS.format(lists="(SELECT * FROM pool WHERE rank <= 10)")})""")
def _(w):
    return rounded(D.intra_list_similarity(pool(w).where("rank <= 10"), w.vectors))


def _sweep_part(tag, lam):
    lists = f"(SELECT user_id, item_id, pick AS rank FROM mmr_{tag}5)"
    return f"""SELECT {lam}::DOUBLE AS lambda, ndcg_5, recall_5, coverage_5,
    (SELECT round(avg(s), 6) FROM ({_ILS.format(lists=lists)})) AS intra_list_similarity
  FROM ({evaluate_sql(lists, "x", (5,))})"""


@query("mmr_sweep", " UNION ALL ".join(_sweep_part(t, lam) for lam, t in ((1.0, "c"), (0.7, "a"), (0.5, "b"))))
def _(w):
    return rounded(D.mmr_sweep(
        write_stage(pool(w), "pool"), w.vectors, S.ground_truth(w.test), catalog_size(w), 5, (1.0, 0.7, 0.5)
    ))


@query("mmr_sweep_full")
def _(w):
    """The published grid of six lambdas at k = 10."""
    return rounded(D.mmr_sweep(write_stage(candidates(w), "pool"), w.vectors, S.ground_truth(w.test), catalog_size(w)))


_RACE = """round(-ln((('0x' || substr(md5('42|' || user_id || '|' || item_id), 1, 15))::BIGINT + 0.5) / 1152921504606846976.0)
   / exp(-(rank - 1) / {scale}), 9)"""


def sample_sql(lists, n, scale="40.0"):
    return f"""
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_RACE.format(scale=scale)}, rank) AS rn FROM {lists})
WHERE rn <= {n}"""


@query("temperature_sample", sample_sql("pool", 10))
def _(w):
    return long_rank(D.temperature_sample(pool(w), 10), "user_id", "item_id")


@query("rank_decay_weight", """
SELECT user_id, item_id, round(exp(-(rank - 1) / 40.0) / sum(exp(-(rank - 1) / 40.0)) OVER (PARTITION BY user_id), 6) AS weight
FROM pool""")
def _(w):
    from pyspark.sql import Window

    raw = F.exp(-(F.col("rank") - 1) / F.lit(40.0))
    return pool(w).select("user_id", "item_id", r6(raw / F.sum(raw).over(Window.partitionBy("user_id")), "weight"))


view("popular_lists", """
SELECT user_id, item_id, pop_rank AS rank FROM users CROSS JOIN popularity WHERE pop_rank <= 60""")


@query("popular_feed", sample_sql("popular_lists", 20))
def _(w):
    feed = D.popular_feed(w.users, B.popularity_head(w.train, 60), w.vectors, 20)
    return long_rank(feed, "user_id", "item_id")


def capped_sql(lists, n):
    return f"""
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY over_cap, rank) AS rank FROM (
  SELECT l.*, CASE WHEN brand IS NOT NULL AND row_number() OVER (PARTITION BY user_id, lower(coalesce(brand, '')) ORDER BY rank) > 2
         THEN 1 ELSE 0 END AS over_cap FROM {lists} l JOIN items i ON i.item_id = l.item_id)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY over_cap, rank) <= {n}"""


@query("brand_cap", capped_sql("pool", 15))
def _(w):
    lists = pool(w).join(w.items.select("item_id", "brand"), "item_id", "left")
    return long_rank(D.brand_cap(lists, 15), "user_id", "item_id")


view("history", """
SELECT user_id, item_id, ts, rank FROM (
  SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, max(ts) AS ts FROM live_events GROUP BY ALL)) WHERE rank <= 20""")
view("prior", """
SELECT user_id, category, item_id, title, rank AS hist_rank FROM (
  SELECT h.user_id, i.category, h.item_id, i.title, h.rank,
         row_number() OVER (PARTITION BY h.user_id, i.category ORDER BY h.rank) AS rn
  FROM history h JOIN items i ON i.item_id = h.item_id WHERE i.category IS NOT NULL) WHERE rn = 1""")


@query("prior_items_rank", "SELECT user_id, category, item_id, title, hist_rank FROM prior")
def _(w):
    out = D.prior_items_rank(user_history(w.live_events), w.items)
    return out.withColumn("hist_rank", F.col("hist_rank").cast("bigint"))


@query("attach_reasons", """
SELECT l.user_id, l.item_id, CASE WHEN h.item_id IS NULL THEN 'Because you viewed ' || left(p.title, 45) END AS reason
FROM (SELECT * FROM pool WHERE rank <= 10) l JOIN items i ON i.item_id = l.item_id
LEFT JOIN prior p ON p.user_id = l.user_id AND p.category = i.category
LEFT JOIN history h ON h.user_id = l.user_id AND h.item_id = l.item_id""")
def _(w):
    lists = pool(w).where("rank <= 10").join(w.items.select("item_id", "category"), "item_id")
    return D.attach_reasons(lists, user_history(w.live_events), w.items).select("user_id", "item_id", "reason")


view("guarded", """
SELECT item_id, neighbor_id, prio, row_number() OVER (PARTITION BY item_id ORDER BY prio, r) AS rank FROM (
  WITH near AS (SELECT item_id, neighbor_id, rank AS r FROM similar_all WHERE rank <= 30
                UNION ALL SELECT i.item_id, p.item_id, pop_rank FROM items i CROSS JOIN popularity p
                WHERE pop_rank <= 30 AND i.item_id NOT IN (SELECT item_id FROM vectors)),
  kept AS (SELECT n.* FROM near n JOIN items a ON a.item_id = n.item_id JOIN items b ON b.item_id = n.neighbor_id
           WHERE a.category = b.category),
  best AS (SELECT item_id AS neighbor_id, category, row_number() OVER (
             PARTITION BY category ORDER BY avg_rating DESC NULLS LAST, item_id) AS cr FROM items WHERE category IS NOT NULL),
  fill AS (SELECT a.item_id, b.neighbor_id, b.cr AS r FROM items a JOIN best b ON a.category = b.category
           WHERE a.item_id <> b.neighbor_id AND b.cr <= 100 AND NOT EXISTS (
             SELECT 1 FROM kept k WHERE k.item_id = a.item_id AND k.neighbor_id = b.neighbor_id)),
  good AS (SELECT item_id, neighbor_id, 0 AS prio, r FROM kept UNION ALL SELECT item_id, neighbor_id, 1, r FROM fill)
  SELECT * FROM good UNION ALL
  SELECT item_id, neighbor_id, 2, r FROM near WHERE item_id NOT IN (SELECT item_id FROM good))""")


@query("similar_guarded", """
SELECT item_id, neighbor_id, rank, CASE WHEN prio < 2 THEN 'Similar items (embedding + category)'
  ELSE 'Similar items (embedding cosine)' END AS model_label
FROM guarded WHERE rank <= 10 AND (prio < 2 OR item_id IN (SELECT item_id FROM vectors))
UNION ALL SELECT item_id, neighbor_id, rank, 'Popular right now' FROM guarded
WHERE rank <= 10 AND prio = 2 AND item_id NOT IN (SELECT item_id FROM vectors)""")
def _(w):
    head = B.popularity_head(w.train, 30).select("item_id", F.col("pop_rank").alias("rank"))
    similar = R.similar_items(w.vectors, 30)
    return long_rank(D.similar_guarded(w.items, similar, w.items, head, 10), "item_id", "neighbor_id", "model_label")


@query("because_you_liked", """
WITH latest AS (SELECT user_id, item_id AS seed FROM history WHERE rank = 1)
SELECT user_id, neighbor_id AS item_id, rank, 'Because you liked this' AS model_label
FROM latest JOIN similar_all s ON s.item_id = seed AND rank <= 10
UNION ALL
SELECT u.user_id, p.item_id, pop_rank, CASE WHEN l.user_id IS NULL THEN 'Popular right now' ELSE 'Because you liked this' END
FROM users u LEFT JOIN latest l ON l.user_id = u.user_id CROSS JOIN popularity p
WHERE pop_rank <= 10 AND (l.seed IS NULL OR l.seed NOT IN (SELECT item_id FROM vectors))""")
def _(w):
    head = B.popularity_head(w.train, 10).select("item_id", F.col("pop_rank").alias("rank"))
    out = D.because_you_liked(user_history(w.live_events), w.users, R.similar_items(w.vectors, 10), head, 10)
    return long_rank(out, "user_id", "item_id", "model_label")


@query("model_label", """
SELECT u.user_id, CASE WHEN h.user_id IS NULL THEN 'Popular right now' ELSE 'Two-tower + MMR(λ=0.7)' END AS model_label
FROM users u LEFT JOIN (SELECT DISTINCT user_id FROM history) h ON h.user_id = u.user_id""")
def _(w):
    from tasteloom.functions.scalars import model_label

    known = w.live_events.select("user_id", F.lit(True).alias("k")).distinct()
    label = F.when(F.col("k").isNull(), F.lit("Popular right now")).otherwise(model_label("Two-tower", 0.7))
    return w.users.join(known, "user_id", "left").select("user_id", label.alias("model_label"))


@query("variety_to_lambda", """
SELECT item_id, round(1 - (variety - 1) * 0.25, 3) AS lambda FROM (SELECT item_id, (1 + item_id % 3)::DOUBLE AS variety FROM items)""")
def _(w):
    from tasteloom.functions.scalars import variety_to_lambda

    return w.items.select("item_id", variety_to_lambda((1 + F.col("item_id") % 3).cast("double")).alias("lambda"))
