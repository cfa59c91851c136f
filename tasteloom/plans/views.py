"""SQL forms of the star-schema views, shared by the SQL counterparts."""

from tasteloom.plans.registry import view

view("interactions", """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating, epoch_us(o_orderdate) // 1000 AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
view("items", """
SELECT p_partkey AS item_id, p_name AS title,
       CASE WHEN p_partkey % 23 <> 0 THEN p_type END AS category,
       CASE WHEN p_partkey % 19 <> 0 THEN p_brand END AS brand,
       CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice END AS price,
       CASE WHEN p_partkey % 13 <> 0 THEN 1 + (p_partkey * 7 % 41) / 10.0::DOUBLE END AS avg_rating
FROM part""")
view("vectors", "SELECT vec_id AS item_id, embedding::DOUBLE[] AS vec FROM embeddings")
view("cuts", """
SELECT quantile_cont(ts, 0.85) AS val_cut, quantile_cont(ts, 0.90) AS test_cut FROM interactions""")
view("labelled", """
SELECT i.*, CASE WHEN ts < val_cut THEN 'train' WHEN ts < test_cut THEN 'val' ELSE 'test' END AS split
FROM interactions i, cuts""")
view("train", "SELECT user_id, item_id, rating, ts FROM labelled WHERE split = 'train'")
view("val", "SELECT user_id, item_id, rating, ts FROM labelled WHERE split = 'val'")
view("test", "SELECT user_id, item_id, rating, ts FROM labelled WHERE split = 'test'")
view("seen", "SELECT DISTINCT user_id, item_id FROM train")
view("truth", "SELECT DISTINCT user_id, item_id FROM test WHERE rating >= 4")
view("val_truth", "SELECT DISTINCT user_id, item_id FROM val WHERE rating >= 4")
view("popularity", """
SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS pop_rank
FROM train GROUP BY item_id""")
view("pop_recs", """
SELECT * FROM (
  SELECT u.user_id, p.item_id, pop_rank,
         row_number() OVER (PARTITION BY u.user_id ORDER BY pop_rank) AS rank
  FROM (SELECT DISTINCT user_id FROM truth) u CROSS JOIN popularity p
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = p.item_id))
WHERE rank <= 50""")
view("raw_events", """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, event_type, value,
       epoch_us(ts) // 1000 AS ts
FROM events""")
view("live_events", """
SELECT event_id, user_id, item_id,
       CASE event_type WHEN 'view' THEN 3.0 WHEN 'error' THEN 4.0 ELSE 5.0 END::DOUBLE AS rating, ts,
       CASE event_type WHEN 'view' THEN 'view' WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'cart'
            WHEN 'signup' THEN 'like' WHEN 'error' THEN 'wishlist' END AS event_type
FROM raw_events""")
view("cart_log", """
SELECT user_id, item_id,
       CASE event_type WHEN 'click' THEN 'add' WHEN 'signup' THEN 'set' WHEN 'error' THEN 'remove'
            ELSE 'checkout' END AS action,
       CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS BIGINT) % 4 END AS qty, ts, event_id AS seq
FROM raw_events WHERE event_type <> 'view'""")
view("wishlist_log", """
SELECT user_id, item_id, CASE event_type WHEN 'click' THEN 'add' ELSE 'remove' END AS action, ts,
       event_id AS seq
FROM raw_events WHERE event_type IN ('click', 'error')""")
view("login_log", """
SELECT user_id, CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS result, ts, event_id AS seq
FROM raw_events WHERE event_type IN ('error', 'signup')""")
view("sessions", """
SELECT event_id AS token, user_id, ts AS created_at FROM raw_events WHERE event_type = 'signup'""")
view("order_rows", """
SELECT event_id AS order_id, user_id, e.item_id, 1 + event_id % 3 AS qty, price, ts AS purchased_at
FROM raw_events e JOIN items i ON i.item_id = e.item_id WHERE event_type = 'purchase'""")
view("users", "SELECT c_custkey AS user_id FROM customer")
view("raw_price", """
SELECT p_partkey AS item_id,
       CASE p_partkey % 5 WHEN 1 THEN '$' || p_retailprice::DECIMAL(18,2)::VARCHAR
            WHEN 2 THEN '$' || p_retailprice::DECIMAL(18,2)::VARCHAR || ' - $'
                 || (p_retailprice + 10)::DECIMAL(18,2)::VARCHAR
            WHEN 3 THEN p_retailprice::DECIMAL(18,2)::VARCHAR WHEN 4 THEN 'call' END AS price
FROM part""")
# kept ids after each round of the 20-core; eight rounds are past the fixpoint of the fixtures
_rounds = []
_prev = "interactions"
for _n in range(1, 9):
    view(f"core_i{_n}", f"""SELECT * FROM {_prev} WHERE item_id IN
      (SELECT item_id FROM {_prev} GROUP BY item_id HAVING count(*) >= 20)""")
    view(f"core_u{_n}", f"""SELECT * FROM core_i{_n} WHERE user_id IN
      (SELECT user_id FROM core_i{_n} GROUP BY user_id HAVING count(*) >= 20)""")
    _prev = f"core_u{_n}"
view("core20", f"SELECT * FROM {_prev}")
view("user_codes", "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS u FROM (SELECT DISTINCT user_id FROM train)")
view("item_codes", "SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS i FROM (SELECT DISTINCT item_id FROM train)")
view("encoded", """
SELECT l.*, CAST(coalesce(u, (SELECT count(*) FROM user_codes)) AS INTEGER) AS u,
       CAST(coalesce(i, (SELECT count(*) FROM item_codes)) AS INTEGER) AS i
FROM labelled l LEFT JOIN user_codes USING (user_id) LEFT JOIN item_codes USING (item_id)""")
view("train_seq", """
SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos FROM train""")
