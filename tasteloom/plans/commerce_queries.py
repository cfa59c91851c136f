"""Queries: carts, wishlists, orders, sessions and behaviour statistics."""

from pyspark.sql import functions as F

from tasteloom.operators import commerce as O
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.evaluation_queries import rounded
from tasteloom.plans.registry import query, view

DAY = 86_400_000


def now_ms(w) -> int:
    return w.raw_events.agg(F.max("ts")).first()[0]


# rows after the last reset, then the first add, then the last set
def lines_sql(log, keys):
    k = ", ".join(keys)

    def on(a, b):
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)

    return f"""
SELECT {', '.join('a.' + c for c in keys)}, CAST(coalesce(max(s.qty), 0) + count(*) FILTER (
         a.action = 'add' AND (s.at IS NULL OR (a.ts, a.seq) > s.at)) AS BIGINT) AS qty, min(f.at[1]) AS added_at
FROM {log} a
JOIN (SELECT {k}, min((ts, seq)) AS at FROM {log} WHERE action = 'add' GROUP BY {k}) f ON {on('a', 'f')}
LEFT JOIN (SELECT {', '.join('x.' + c for c in keys)}, max((x.ts, x.seq)) AS at, arg_max(x.qty, (x.ts, x.seq)) AS qty
  FROM {log} x JOIN (SELECT {k}, min((ts, seq)) AS at FROM {log} WHERE action = 'add' GROUP BY {k}) y ON {on('x', 'y')}
  WHERE x.action = 'set' AND (x.ts, x.seq) >= y.at GROUP BY {', '.join('x.' + c for c in keys)}) s ON {on('a', 's')}
WHERE (a.ts, a.seq) >= f.at GROUP BY {', '.join('a.' + c for c in keys)}"""


view("cart_live", """
SELECT * FROM cart_log c WHERE action IN ('add', 'set') AND NOT (action = 'set' AND qty <= 0)
AND NOT EXISTS (SELECT 1 FROM cart_log k WHERE k.user_id = c.user_id AND k.action = 'checkout' AND (k.ts, k.seq) > (c.ts, c.seq))
AND NOT EXISTS (SELECT 1 FROM cart_log k WHERE k.user_id = c.user_id AND k.item_id = c.item_id
  AND (k.action = 'remove' OR (k.action = 'set' AND k.qty <= 0)) AND (k.ts, k.seq) > (c.ts, c.seq))""")
view("cart", lines_sql("cart_live", ["user_id", "item_id"]))
view("cart_baskets", """
SELECT *, count(*) FILTER (action = 'checkout') OVER (PARTITION BY user_id ORDER BY ts, seq) AS done FROM cart_log""")
view("basket_live", """
SELECT c.*, c.done AS basket FROM cart_baskets c WHERE action IN ('add', 'set') AND NOT (action = 'set' AND qty <= 0)
AND NOT EXISTS (SELECT 1 FROM cart_baskets k WHERE k.user_id = c.user_id AND k.item_id = c.item_id AND k.done = c.done
  AND (k.action = 'remove' OR (k.action = 'set' AND k.qty <= 0)) AND (k.ts, k.seq) > (c.ts, c.seq))""")
view("checkout_orders_sql", f"""
SELECT l.user_id, l.item_id, k.seq AS checkout_seq, l.qty, i.price, k.ts AS purchased_at
FROM ({lines_sql("basket_live", ["user_id", "item_id", "basket"])}) l
JOIN cart_baskets k ON k.user_id = l.user_id AND k.action = 'checkout' AND k.done = l.basket + 1
JOIN items i ON i.item_id = l.item_id""")
view("wishlist", """
SELECT user_id, item_id, min(ts) AS added_at FROM wishlist_log c WHERE action = 'add' AND NOT EXISTS (
  SELECT 1 FROM wishlist_log k WHERE k.user_id = c.user_id AND k.item_id = c.item_id AND k.action = 'remove'
  AND (k.ts, k.seq) > (c.ts, c.seq)) GROUP BY user_id, item_id""")


@query("cart_state", "SELECT user_id, item_id, qty, added_at FROM cart")
def _(w):
    return O.cart_state(w.cart_log)


@query("wishlist_state", "SELECT user_id, item_id, added_at FROM wishlist")
def _(w):
    return O.wishlist_state(w.wishlist_log)


@query("inner_cart_items", """
SELECT c.user_id, c.item_id, title, price, qty, round(coalesce(price, 0) * qty, 6) AS line_total
FROM cart c JOIN items i ON i.item_id = c.item_id""")
def _(w):
    return O.cart_view(O.cart_state(w.cart_log), w.items).select(
        "user_id", "item_id", "title", "price", "qty", r6("line_total")
    )


@query("line_total", """
SELECT order_id, round(coalesce(price, 0) * coalesce(qty, 1), 6) AS line_total FROM order_rows""")
def _(w):
    from tasteloom.functions.scalars import line_total

    return w.order_rows.select("order_id", r6(line_total("price", "qty"), "line_total"))


@query("cart_total", """
SELECT user_id, round(sum(coalesce(price, 0) * qty), 6) AS total, CAST(sum(qty) AS BIGINT) AS n_items
FROM cart c JOIN items i ON i.item_id = c.item_id GROUP BY user_id""")
def _(w):
    return rounded(O.cart_totals(O.cart_view(O.cart_state(w.cart_log), w.items)))


@query("checkout_orders", "SELECT user_id, item_id, checkout_seq, qty, price, purchased_at FROM checkout_orders_sql")
def _(w):
    return O.checkout_orders(w.cart_log, w.items)


@query("purchase_events", """
SELECT user_id, item_id, 5.0::DOUBLE AS rating, purchased_at AS ts, 'purchase' AS event_type FROM checkout_orders_sql""")
def _(w):
    return O.purchase_events(O.checkout_orders(w.cart_log, w.items))


@query("buy_item", """
SELECT user_id, e.item_id, CAST(1 AS BIGINT) AS qty, price, ts AS purchased_at
FROM raw_events e JOIN items i ON i.item_id = e.item_id WHERE event_type = 'purchase'""")
def _(w):
    return O.buy_item(w.raw_events.where(F.col("event_type") == "purchase"), w.items)


@query("order_history", """
SELECT o.user_id, row_number() OVER (PARTITION BY o.user_id ORDER BY purchased_at DESC, order_id) AS rank, order_id,
       o.item_id, title, category, brand, avg_rating, qty, o.price, make_timestamp(purchased_at * 1000)::DATE AS purchased_on
FROM order_rows o JOIN items i ON i.item_id = o.item_id""")
def _(w):
    return O.order_history(w.order_rows, w.items)


@query("order_totals", """
SELECT user_id, round(sum(coalesce(price, 0) * qty), 6) AS total, CAST(sum(qty) AS BIGINT) AS n_items FROM order_rows GROUP BY 1""")
def _(w):
    return rounded(O.cart_totals(w.order_rows))


@query("user_badges", """
SELECT u.user_id, coalesce(a.n, 0) AS n_wishlist, coalesce(b.n, 0) AS n_cart, coalesce(c.n, 0) AS n_orders FROM users u
LEFT JOIN (SELECT user_id, count(*) AS n FROM wishlist GROUP BY 1) a ON a.user_id = u.user_id
LEFT JOIN (SELECT user_id, count(*) AS n FROM cart GROUP BY 1) b ON b.user_id = u.user_id
LEFT JOIN (SELECT user_id, count(*) AS n FROM order_rows GROUP BY 1) c ON c.user_id = u.user_id""")
def _(w):
    return O.user_badges(w.users, O.wishlist_state(w.wishlist_log), O.cart_state(w.cart_log), w.order_rows)


@query("move_to_cart", """
SELECT user_id, item_id, 'cart' AS target, 'add' AS action FROM wishlist
UNION ALL SELECT user_id, item_id, 'wishlist', 'remove' FROM wishlist""")
def _(w):
    return O.move_to_cart(O.wishlist_state(w.wishlist_log))


@query("log_event", """
SELECT user_id, item_id, rating, ts, CAST(NULL AS VARCHAR) AS event_type FROM test
UNION ALL SELECT user_id, item_id, rating, ts, event_type FROM live_events WHERE event_type IN ('view', 'like', 'cart')""")
def _(w):
    log = w.test.withColumn("event_type", F.lit(None).cast("string"))
    return O.log_events(log, w.live_events.select("user_id", "item_id", "event_type", "ts"))


@query("user_counters", """
SELECT u.user_id, count(event_id) AS n_interactions FROM users u LEFT JOIN live_events e ON e.user_id = u.user_id GROUP BY 1""")
def _(w):
    return O.user_counters(w.users, w.live_events)


@query("session_view_dedup", """
SELECT user_id AS session, item_id, min(ts) AS ts FROM live_events WHERE event_type = 'view' GROUP BY 1, 2""")
def _(w):
    views = w.live_events.where(F.col("event_type") == "view")
    return O.session_view_dedup(views.withColumnRenamed("user_id", "session"))


@query("onboarding_seed", """
SELECT user_id, item_id, 5.0::DOUBLE AS rating, 'like' AS event_type FROM (
  SELECT c.user_id, b.item_id, row_number() OVER (PARTITION BY c.user_id, b.category ORDER BY avg_rating DESC NULLS LAST, b.item_id) AS rn
  FROM (SELECT c_custkey AS user_id, CASE c_custkey % 3 WHEN 0 THEN 'PROMO' WHEN 1 THEN 'SMALL' ELSE 'LARGE' END AS category
        FROM customer UNION ALL SELECT c_custkey, 'MEDIUM' FROM customer) c
  JOIN items b ON b.category = c.category) WHERE rn <= 2""")
def _(w):
    first = F.when(F.col("user_id") % 3 == 0, "PROMO").when(F.col("user_id") % 3 == 1, "SMALL").otherwise("LARGE")
    choices = w.users.select(
        "user_id", F.posexplode(F.array(first, F.lit("MEDIUM"))).alias("pos", "category")
    ).withColumn("pos", F.col("pos") + 1)
    return O.onboarding_seed(choices, w.items)


@query("admin_kpis", """
SELECT (SELECT count(*) FROM users) AS users,
  (SELECT count(DISTINCT user_id) FROM live_events WHERE ts > (SELECT max(ts) FROM raw_events) - 86400000) AS active_24h,
  (SELECT count(*) FROM order_rows) AS orders,
  (SELECT round(coalesce(sum(price * qty), 0), 6) FROM order_rows) AS revenue""")
def _(w):
    return rounded(O.admin_kpis(w.users, w.live_events, w.order_rows, now_ms(w)))


@query("events_by_type", "SELECT event_type, count(*) AS n FROM live_events WHERE event_type IS NOT NULL GROUP BY 1")
def _(w):
    return O.events_by_type(w.live_events)


@query("top_viewed", """
SELECT title, count(*) AS views FROM live_events e JOIN items i ON i.item_id = e.item_id
WHERE event_type = 'view' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(w):
    return O.top_viewed(w.live_events, w.items)


# the sketches hold every item of these tables, so their counts are exact
@query("top_viewed_sketch", """
SELECT title, count(*) AS views FROM live_events e JOIN items i ON i.item_id = e.item_id
WHERE event_type = 'view' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(w):
    days = O.view_sketches(w.live_events, F.floor(F.col("ts") / 86_400_000))
    return O.top_viewed_sketch(days, w.items)


@query("top_event_categories", """
SELECT category, count(*) AS events FROM live_events e JOIN items i ON i.item_id = e.item_id
WHERE event_type IS NOT NULL AND category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(w):
    return O.top_event_categories(w.live_events, w.items)


_ACTIVE = """
SELECT token, s.user_id, created_at FROM sessions s JOIN users u ON u.user_id = s.user_id
WHERE created_at > (SELECT max(ts) FROM raw_events) - 7 * 86400000"""


@query("active_sessions", _ACTIVE)
def _(w):
    return O.active_sessions(w.sessions, w.users, now_ms(w), 7)


@query("ttl_join", f"SELECT a.token, a.user_id, count(event_id) AS n_interactions FROM ({_ACTIVE}) a LEFT JOIN live_events e ON e.user_id = a.user_id GROUP BY 1, 2")
def _(w):
    active = O.active_sessions(w.sessions, w.users, now_ms(w), 7)
    return active.join(O.user_counters(w.users, w.live_events), "user_id").select("token", "user_id", "n_interactions")


@query("latency_summary", """
SELECT component, calls, round(mean_ms, 6) AS mean_ms, ms AS p95_ms FROM (
  SELECT event_type AS component, value AS ms, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS pos,
         count(*) OVER (PARTITION BY event_type) AS calls, avg(value) OVER (PARTITION BY event_type) AS mean_ms FROM events)
WHERE pos = CAST(floor(0.95 * (calls - 1)) AS BIGINT)""")
def _(w):
    return O.latency_summary(w.latency_log).select("component", "calls", r6("mean_ms"), "p95_ms")


@query("throttle_flags", """
WITH RECURSIVE a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS n FROM login_log),
f AS (
  SELECT user_id, seq, ts, result, n, false AS blocked, CASE WHEN result = 'failed' THEN [ts] ELSE [] END AS q FROM a WHERE n = 1
  UNION ALL
  SELECT user_id, seq, ts, result, n, len(k) >= 3 AS blocked,
         CASE WHEN len(k) >= 3 THEN k WHEN result = 'success' THEN [] ELSE list_append(k, ts) END AS q
  FROM (SELECT a.*, list_filter(f.q, lambda t: a.ts - t <= 432000000) AS k FROM f JOIN a ON a.user_id = f.user_id AND a.n = f.n + 1))
SELECT user_id, seq, ts, result, blocked FROM f""")
def _(w):
    return O.throttle_flags(w.login_log, 432_000, 3)
