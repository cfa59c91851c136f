"""Queries: triplet sampling, BPR, towers, training histories and the full feed."""

from pyspark.sql import functions as F

from tasteloom.functions.seeded import draw_int
from tasteloom.operators import bpr as B
from tasteloom.operators import histories as H
from tasteloom.operators import metrics as M
from tasteloom.operators import ranker as L
from tasteloom.operators import retrieval as R
from tasteloom.operators import splitting as S
from tasteloom.operators import towers as T
from tasteloom.operators.features import feature_store
from tasteloom.operators.popularity import popularity_head
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.evaluation_queries import catalog_size, rounded
from tasteloom.plans.feed import FeedModels, grid_search, recommend_batch
from tasteloom.plans.ranking_queries import ranker_rows
from tasteloom.plans.registry import query, view
from tasteloom.plans.retrieval_queries import DIM, user_vectors
from tasteloom.session import write_stage

N_TRIPLETS = 20_000


def d(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


view("positives", """
SELECT row_number() OVER (ORDER BY u, i, ts, rating) - 1 AS row, u, i FROM encoded WHERE split = 'train'""")
view("triplets", f"""
WITH t AS (SELECT t.t, p.u, p.i FROM range({N_TRIPLETS}) t(t) JOIN positives p
           ON p.row = {d("'42|row|' || t.t")} % (SELECT count(*) FROM positives)),
n AS (SELECT t.*, k.p, {d("'42|neg|' || t || '|' || k.p")} % (SELECT count(*) FROM item_codes) AS j FROM t, range(4) k(p))
SELECT t, u, i, CAST(j AS INTEGER) AS j FROM (
  SELECT n.*, row_number() OVER (PARTITION BY t ORDER BY p) AS rn FROM n
  WHERE NOT EXISTS (SELECT 1 FROM positives s WHERE s.u = n.u AND s.i = n.j)) WHERE rn = 1""")


def unit(expr):
    return f"(({d(expr)} + 0.5) / 1152921504606846976.0)"


def factors_sql(tag, n):
    r, a = unit(f"'42|{tag}|' || id || '|' || k || '|r'"), unit(f"'42|{tag}|' || id || '|' || k || '|a'")
    return f"SELECT id, list(0.01 * sqrt(-2 * ln({r})) * cos(2 * pi() * {a}) ORDER BY k) AS vec FROM range({n}) t(id), range(4) q(k) GROUP BY id"


view("p0", factors_sql("p", "(SELECT count(*) FROM user_codes)"))
view("q0", factors_sql("q", "(SELECT count(*) FROM item_codes)"))
view("bpr_rows", """
SELECT t, u, i, j, pu.vec AS p, qi.vec AS qi, qj.vec AS qj,
       list_inner_product(pu.vec, qi.vec) - list_inner_product(pu.vec, qj.vec) AS x
FROM triplets JOIN p0 pu ON pu.id = u JOIN q0 qi ON qi.id = i JOIN q0 qj ON qj.id = j""")
view("bpr_grad", """
SELECT *, 1 / (1 + exp(-x)) AS s, -(1 / (1 + exp(-x))) * (1 - 1 / (1 + exp(-x))) / (1 / (1 + exp(-x)) + 1e-9) AS g FROM bpr_rows""")


def encoded(w):
    users, items = S.build_encoder(w.train, "user_id", "u"), S.build_encoder(w.train, "item_id", "i")
    users, items = write_stage(users, "users"), write_stage(items, "items")
    return write_stage(S.encode_ids(w.train, users, items), "encoded"), users, items


def _triplets(w):
    rows, users, items = encoded(w)
    positives = B.index_positives(rows)
    return B.sample_triplets(positives, N_TRIPLETS, items.count()), users, items


@query("sample_triplets", "SELECT t, u, i, j FROM triplets")
def _(w):
    return _triplets(w)[0]


def _start(w):
    triplets, users, items = _triplets(w)
    p, q = B.init_factors(w.spark, users.count(), items.count(), 4)
    return write_stage(triplets, "triplets"), p, q


@query("bpr_loss", """
SELECT count(*) AS n_triplets, round(avg(-ln(s + 1e-9) + 1e-2 * (list_inner_product(p, p) + list_inner_product(qi, qi)
  + list_inner_product(qj, qj))), 6) AS loss FROM bpr_grad""")
def _(w):
    triplets, p, q = _start(w)
    return rounded(B.bpr_loss(triplets, p, q, 4, reg=1e-2))


# every value moves by lr * count / batch of the mean gradient, i.e. by lr / 16 per triplet here
@query("bpr_step", """
WITH gu AS (SELECT u, k, sum(g * (qi[k] - qj[k]) + 2e-2 * p[k]) AS s FROM bpr_grad, range(1, 5) r(k) GROUP BY 1, 2),
gi AS (SELECT id, k, sum(v) AS s FROM (
  SELECT i AS id, k, g * p[k] + 2e-2 * qi[k] AS v FROM bpr_grad, range(1, 5) r(k)
  UNION ALL SELECT j, k, -g * p[k] + 2e-2 * qj[k] FROM bpr_grad, range(1, 5) r(k)
  UNION ALL SELECT i, 5, g FROM bpr_grad UNION ALL SELECT j, 5, -g FROM bpr_grad) GROUP BY 1, 2)
SELECT 'user' AS kind, id, k AS d, round(vec[k] - 0.05 / 16 * coalesce(s, 0), 6) AS x
FROM p0 CROSS JOIN range(1, 5) r(k) LEFT JOIN gu ON gu.u = id AND gu.k = r.k
UNION ALL SELECT 'item', q0.id, r.k, round(coalesce(vec[r.k], 0) - 0.05 / 16 * coalesce(s, 0), 6)
FROM q0 CROSS JOIN range(1, 6) r(k) LEFT JOIN gi ON gi.id = q0.id AND gi.k = r.k""".replace("id, k AS d, round(vec[k]", "p0.id, r.k AS d, round(vec[r.k]").replace("gu.u = id", "gu.u = p0.id"))
def _(w):
    triplets, p, q = _start(w)
    users, items, _loss = B.bpr_step(triplets, p, q, 4, reg=1e-2, batch_size=16)

    def long(df, key, kind):
        return df.select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id"), F.posexplode("vec").alias("d", "x")).select(
            "kind", "id", (F.col("d") + 1).cast("bigint").alias("d"), r6("x"))

    return long(users, "u", "user").unionByName(long(items, "i", "item"))


def trained_bpr(w, epochs=4, dim=64):
    """Four draws per row and epoch, one update per 256 draws."""
    rows, users, items = encoded(w)
    model = B.mf_bpr_fit(rows, users.count(), items.count(), dim=dim, epochs=epochs,
                         triplets_per_epoch=4 * rows.count(), batch_size=256)
    return model, users, items


@query("mf_bpr_fit")
def _(w):
    model, users, items = trained_bpr(w)
    truth = S.filter_known_users(S.ground_truth(w.test), w.train)
    queries = model.query_vectors(users).join(truth.select("user_id").distinct(), "user_id", "left_semi")
    recs = R.recommend_from_vectors(queries, write_stage(model.item_vectors(items), "vectors"), S.seen_items(w.train), 50, normalize=False)
    return rounded(M.evaluate(write_stage(recs, "recs"), truth, items.count(), method="mf_bpr"))


@query("loss_history")
def _(w):
    model, _users, _items = trained_bpr(w)
    return model.loss_history(w.spark)


# ------------------------------------------------------------------ towers
view("pairs_last", """
SELECT user_id, item_id FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS rn
FROM (SELECT user_id, item_id, max(ts) AS ts FROM train JOIN vectors USING (item_id) GROUP BY ALL)) WHERE rn = 1""")


@query("in_batch_softmax_loss", f"""
WITH b AS (SELECT l.user_id, u.vec AS uv, v.vec AS iv, {d("'42|' || l.user_id")} % CAST(ceil((SELECT count(*) FROM pairs_last) / 128.0) AS BIGINT) AS batch
  FROM pairs_last l JOIN user_units u ON u.user_id = l.user_id JOIN unit_vectors v ON v.item_id = l.item_id),
z AS (SELECT a.batch, a.user_id, ln(sum(exp(list_inner_product(a.uv, c.iv) / 0.05))) - any_value(list_inner_product(a.uv, a.iv)) / 0.05 AS nll
  FROM b a JOIN b c ON a.batch = c.batch GROUP BY 1, 2)
SELECT batch, count(*) AS n, round(avg(nll), 6) AS loss FROM z GROUP BY batch""")
def _(w):
    from tasteloom.functions.vectors import l2_normalize

    last = H.user_history(w.train.join(w.vectors.select("item_id"), "item_id", "left_semi"), 1)
    n_batches = F.lit(max(1, -(-last.count() // 128)))
    rows = last.join(user_vectors(w).withColumnRenamed("vec", "uvec"), "user_id").join(w.vectors, "item_id").select(
        F.pmod(draw_int(42, "user_id"), n_batches).cast("bigint").alias("batch"),
        l2_normalize("uvec").alias("uvec"), l2_normalize("vec").alias("ivec"),
    )
    return rounded(T.in_batch_loss(rows))


def _long(df, key):
    return df.select(key, F.posexplode("vec").alias("d", "x")).select(key, F.col("d").cast("bigint").alias("d"), r6("x"))


def tower_views(tower: str, rows: str, key: str, hidden: int = 128) -> None:
    """Views of one tower's forward pass over ``rows`` (key, vec), with the drawn starting weights."""
    def draws(part: str, place: str, inputs: int) -> str:
        return f"(2 * {unit(f"'42|{tower}|{part}|' || ({place})")} - 1) / sqrt({inputs})"

    for layer, inputs, outputs in ((1, DIM, hidden), (2, hidden, DIM)):
        view(f"{tower}_layer{layer}", f"""
SELECT c, list({draws(f"w{layer}", f"r * {outputs} + c", inputs)} ORDER BY r) AS w,
       any_value({draws(f"b{layer}", "c", inputs)}) AS b FROM range({inputs}) x(r), range({outputs}) y(c) GROUP BY c""")
    view(f"{tower}_hidden", f"""
SELECT {key}, list(greatest(list_inner_product(vec, w) + b, 0) ORDER BY c) AS h FROM {rows}, {tower}_layer1 GROUP BY {key}""")
    view(f"{tower}_out", f"SELECT {key}, c AS d, list_inner_product(h, w) + b AS y FROM {tower}_hidden, {tower}_layer2")
    view(f"{tower}_units_out", f"SELECT {key}, d, y / greatest(sqrt(sum(y * y) OVER (PARTITION BY {key})), 1e-12) AS y FROM {tower}_out")


tower_views("item", "vectors", "item_id")
tower_views("user", "user_vecs", "user_id")


@query("item_tower", "SELECT item_id, d, round(y, 6) AS x FROM item_units_out")
def _(w):
    return _long(T.apply_tower(w.vectors, "item_id", T.Weights.initial(DIM, 128, 42), "item"), "item_id")


@query("user_tower", """
SELECT p.user_id, p.d, round(coalesce(y, 0), 6) AS x
FROM (SELECT user_id, d FROM (SELECT DISTINCT user_id FROM users), range(64) r(d)) p
LEFT JOIN user_units_out t ON t.user_id = p.user_id AND t.d = p.d""")
def _(w):
    towers = T.apply_tower(user_vectors(w), "user_id", T.Weights.initial(DIM, 128, 42), "user")
    return _long(T.zero_for_empty(w.users, towers, DIM), "user_id")


def trained_towers(w):
    """The published fit: 64 places, 128 hidden units, ten epochs of Adam at 1e-3."""
    rows, _users, items = encoded(w)
    return T.two_tower_fit(rows, items.count()), rows, items


def small_towers(w, dim, temperature):
    """One epoch of narrow towers, to rank a configuration."""
    rows, _users, items = encoded(w)
    return T.two_tower_fit(rows, items.count(), dim=dim, hidden=32, lr=0.01, epochs=1, temperature=temperature), rows, items


@query("two_tower_fit")
def _(w):
    model, _rows, _items = trained_towers(w)
    return model.loss_history(w.spark)


def tower_recs(w, model, rows, items, users=None):
    """Lists from the towers over each user's last training rows."""
    history = H.recent_rows(w.train).join(items, "item_id")
    queries = model.user_vectors(history)
    if users is not None:
        queries = queries.join(users, "user_id", "left_semi")
    return R.recommend_from_vectors(write_stage(queries, "queries"), write_stage(model.item_vectors(items), "vectors"),
                                    S.seen_items(w.train), 50)


@query("evaluate_two_tower")
def _(w):
    model, rows, items = trained_towers(w)
    truth = S.filter_known_users(S.ground_truth(w.test), w.train)
    recs = tower_recs(w, model, rows, items, truth.select("user_id").distinct())
    return rounded(M.evaluate(write_stage(recs, "recs"), truth, items.count(), method="two_tower"))


@query("grid_search")
def _(w):
    truth = S.filter_known_users(S.ground_truth(w.val), w.train)
    wanted = truth.select("user_id").distinct()

    def fit(config):
        model, rows, items = small_towers(w, config["dim"], config["temperature"])
        recs = tower_recs(w, model, rows, items, wanted)
        return M.evaluate(write_stage(recs, "recs"), truth, items.count(), (20,)).first()["recall_20"]

    return grid_search([{"dim": 8, "temperature": 0.05}, {"dim": 8, "temperature": 0.1}], fit, w.spark)


# ------------------------------------------------------------------ feed
@query("recommend_batch")
def _(w):
    rows = write_stage(L.fit_holdout(ranker_rows(w)), "ranker")
    ranker = L.lambdamart_fit(rows, rounds=2, min_rows=20, leaves=15)
    models = FeedModels(popularity_head(w.train, 60), w.vectors, None, ranker, feature_store(w.train, w.items))
    feed = recommend_batch(w.users, w.live_events, w.items, models, n=10, mmr_lambda=0.7)
    return feed.withColumn("rank", F.col("rank").cast("bigint"))
