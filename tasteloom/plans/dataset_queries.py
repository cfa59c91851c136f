"""Queries: subsampling, time split, encoding and profiling."""

from pyspark.sql import functions as F

from tasteloom.operators import profiling as P
from tasteloom.operators import splitting as S
from tasteloom.operators import subsample as K
from tasteloom.operators.ordering import exact_quantiles
from tasteloom.plans.registry import query
from tasteloom.session import write_stage


def r6(column, name=None):
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(name or column)


@query("kcore", "SELECT user_id, item_id, rating, ts FROM core20")
def _(w):
    return K.kcore(w.interactions, 20, 20).select("user_id", "item_id", "rating", "ts")


@query("recency_cap", """
SELECT user_id, item_id, rating, ts FROM (
  SELECT *, row_number() OVER (ORDER BY ts DESC, user_id, item_id, rating) AS rn FROM interactions)
WHERE rn <= (SELECT count(*) // 3 FROM interactions)""")
def _(w):
    return K.recency_cap(w.interactions, w.interactions.count() // 3)


@query("subsample_report", """
WITH capped AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, user_id, item_id, rating) AS rn
                FROM core20) WHERE rn <= (SELECT count(*) // 2 FROM interactions))
SELECT 'start' AS stage, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items FROM interactions
UNION ALL SELECT 'core', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM core20
UNION ALL SELECT 'cap', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM capped""")
def _(w):
    return K.subsample_report(w.interactions, 20, 20, w.interactions.count() // 2)


@query("time_split", "SELECT user_id, item_id, rating, ts, split FROM labelled")
def _(w):
    return w.labelled


@query("split_cuts", "SELECT val_cut, test_cut FROM cuts")
def _(w):
    cuts = exact_quantiles(w.interactions, "ts", [0.85, 0.90])
    return w.interactions.limit(1).select(F.lit(cuts[0]).alias("val_cut"), F.lit(cuts[1]).alias("test_cut"))


@query("leakage_check", """
SELECT (SELECT max(ts) FROM train) AS train_max_ts, (SELECT min(ts) FROM test) AS test_min_ts,
       (SELECT max(ts) FROM train) > (SELECT min(ts) FROM test) AS leakage""")
def _(w):
    return S.leakage_check(w.train, w.test)


def _encoded(w):
    users = S.build_encoder(w.train, "user_id", "u")
    items = S.build_encoder(w.train, "item_id", "i")
    return S.encode_ids(w.labelled, users, items), users.count(), items.count()


@query("encode_ids", "SELECT user_id, item_id, ts, split, u, i FROM encoded")
def _(w):
    return _encoded(w)[0].select("user_id", "item_id", "ts", "split", "u", "i")


@query("cold_rate", """
SELECT split, count(*) AS n_rows,
       round(avg((i = (SELECT count(*) FROM item_codes))::INT), 6) AS cold_item_rate,
       round(avg((u = (SELECT count(*) FROM user_codes))::INT), 6) AS cold_user_rate
FROM encoded GROUP BY split""")
def _(w):
    encoded, n_users, n_items = _encoded(w)
    return S.cold_rate(encoded, n_users, n_items).select(
        "split", "n_rows", r6("cold_item_rate"), r6("cold_user_rate")
    )


@query("ground_truth", "SELECT user_id, item_id FROM truth")
def _(w):
    return S.ground_truth(w.test)


@query("ground_truth_all", "SELECT DISTINCT user_id, item_id FROM test")
def _(w):
    return S.ground_truth(w.test, positive_only=False)


@query("seen_items", "SELECT user_id, item_id FROM seen")
def _(w):
    return S.seen_items(w.train)


@query("exclude_seen", "SELECT DISTINCT user_id, item_id FROM test EXCEPT SELECT user_id, item_id FROM seen")
def _(w):
    return S.exclude_seen(S.ground_truth(w.test, False), S.seen_items(w.train))


@query("user_holdout_split", """
SELECT user_id, CASE WHEN ('0x' || substr(md5('42|' || user_id), 1, 15))::BIGINT % 100 < 85
                     THEN 'fit' ELSE 'holdout' END AS part
FROM (SELECT DISTINCT user_id FROM train)""")
def _(w):
    return S.user_holdout_split(w.train.select("user_id").distinct())


@query("user_sample", """
SELECT user_id FROM (SELECT DISTINCT user_id FROM truth)
ORDER BY ('0x' || substr(md5('42|' || user_id), 1, 15))::BIGINT, user_id LIMIT 200""")
def _(w):
    return S.user_sample(S.ground_truth(w.test).select("user_id").distinct(), 200)


@query("filter_known_users", "SELECT user_id, item_id, rating, ts FROM test WHERE user_id IN (SELECT user_id FROM train)")
def _(w):
    return S.filter_known_users(w.test, w.train)


@query("group_eligible_users", "SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM val_truth)")
def _(w):
    return S.group_eligible_users(w.train, w.val)


# ------------------------------------------------------------------ filters
@query("positive_filter", "SELECT user_id, item_id, rating FROM interactions WHERE rating >= 4.0")
def _(w):
    from tasteloom.functions.scalars import is_positive

    return w.interactions.where(is_positive("rating")).select("user_id", "item_id", "rating")


@query("recent_filter", """
SELECT user_id, item_id, ts FROM interactions WHERE ts >= epoch_ms(TIMESTAMP '1998-01-01')""")
def _(w):
    from tasteloom.functions.scalars import is_recent

    return w.interactions.where(is_recent("ts", 1998)).select("user_id", "item_id", "ts")


@query("ts_range", """
SELECT split, make_timestamp(min(ts) * 1000)::DATE AS first_day, make_timestamp(max(ts) * 1000)::DATE AS last_day
FROM labelled GROUP BY split""")
def _(w):
    return P.ts_range(w.labelled)


@query("ms_to_timestamp", """
SELECT user_id, item_id, make_timestamp(ts * 1000)::DATE AS day, year(make_timestamp(ts * 1000))::INTEGER AS yr
FROM interactions""")
def _(w):
    from tasteloom.functions.scalars import ms_to_timestamp

    day = ms_to_timestamp("ts")
    return w.interactions.select("user_id", "item_id", day.cast("date").alias("day"), F.year(day).alias("yr"))


# ------------------------------------------------------------------ profiling
@query("matrix_density", """
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       round(count(*)::DOUBLE / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 9) AS density,
       round(1 - count(*)::DOUBLE / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 9) AS sparsity
FROM interactions""")
def _(w):
    return P.matrix_density(w.interactions).select(
        "n_rows", "n_users", "n_items",
        F.round("density", 9).alias("density"), F.round("sparsity", 9).alias("sparsity"),
    )


@query("distinct_counts", """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM interactions""")
def _(w):
    return w.interactions.agg(
        F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items")
    )


@query("rating_distribution", """
SELECT rating, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM interactions), 6) AS share,
       rating >= 4 AS positive,
       round((SELECT avg((rating >= 4)::INT) FROM interactions), 6) AS positive_share
FROM interactions GROUP BY rating""")
def _(w):
    return P.rating_distribution(w.interactions).select(
        "rating", "n", r6("share"), "positive", r6("positive_share")
    )


@query("long_tail_curve", """
SELECT row_number() OVER (ORDER BY count(*) DESC, item_id) AS pop_rank, item_id, count(*) AS n
FROM interactions GROUP BY item_id""")
def _(w):
    return P.long_tail_curve(w.interactions)


@query("head_share", """
WITH c AS (SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC) AS rn
           FROM interactions GROUP BY item_id),
     h AS (SELECT greatest(1, CAST(floor(0.01 * count(*)) AS BIGINT)) AS head_items FROM c)
SELECT head_items, CAST(sum(n) FILTER (rn <= head_items) AS BIGINT) AS head_rows,
       CAST(sum(n) AS BIGINT) AS n_rows,
       round(sum(n) FILTER (rn <= head_items) / sum(n), 6) AS head_share
FROM c, h GROUP BY head_items""")
def _(w):
    return P.head_share(w.interactions).select("head_items", "head_rows", "n_rows", r6("head_share"))


def _histogram_sql(key):
    return f"""
WITH c AS (SELECT {key}, count(*) AS c FROM interactions GROUP BY {key}),
     b AS (SELECT min(c) AS lo, max(c) AS hi FROM c)
SELECT least(CAST(floor((c - lo) * 50 / greatest(hi - lo, 1)) AS BIGINT), 49) AS bin,
       count(*) AS n FROM c, b GROUP BY 1"""


@query("interactions_per_user", _histogram_sql("user_id"))
def _(w):
    return P.activity_histogram(w.interactions, "user_id")


@query("interactions_per_item", _histogram_sql("item_id"))
def _(w):
    return P.activity_histogram(w.interactions, "item_id")


@query("median_activity", """
SELECT 'user_id' AS key, median(n)::DOUBLE AS median_rows
FROM (SELECT count(*) AS n FROM interactions GROUP BY user_id)
UNION ALL SELECT 'item_id', median(n)::DOUBLE FROM (SELECT count(*) AS n FROM interactions GROUP BY item_id)""")
def _(w):
    return P.median_activity(w.interactions)


@query("monthly_volume", """
SELECT date_trunc('month', make_timestamp(ts * 1000))::DATE AS month, count(*) AS n FROM interactions GROUP BY 1""")
def _(w):
    return P.monthly_volume(w.interactions)


@query("split_histogram", """
WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM labelled)
SELECT split, least(CAST(floor((ts - lo) * 60 / (hi - lo)) AS BIGINT), 59) AS bin, count(*) AS n
FROM labelled, b GROUP BY 1, 2""")
def _(w):
    return P.split_histogram(w.labelled)


@query("retention_report", """
SELECT round((SELECT count(*) FROM core20)::DOUBLE / count(*), 6) AS rows_kept,
       round((SELECT count(DISTINCT user_id) FROM core20)::DOUBLE / count(DISTINCT user_id), 6) AS users_kept,
       round((SELECT count(DISTINCT item_id) FROM core20)::DOUBLE / count(DISTINCT item_id), 6) AS items_kept
FROM interactions""")
def _(w):
    core = write_stage(K.kcore(w.interactions, 20, 20), "core")
    return P.retention_report(w.interactions, core).select(r6("rows_kept"), r6("users_kept"), r6("items_kept"))


@query("meta_coverage", """
SELECT count(v.item_id) AS with_metadata, count(*) AS n_items
FROM (SELECT DISTINCT item_id FROM interactions) u LEFT JOIN vectors v ON v.item_id = u.item_id""")
def _(w):
    return P.meta_coverage(w.interactions, w.vectors)
