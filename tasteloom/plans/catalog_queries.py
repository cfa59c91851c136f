"""Queries: catalog search, suggestion, browsing and column rules."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tasteloom.functions import scalars as C
from tasteloom.functions import text as TX
from tasteloom.operators import catalog as G
from tasteloom.operators.popularity import popularity_head
from tasteloom.plans.dataset_queries import r6
from tasteloom.plans.registry import query, view

PAGE = ["item_id", "title", "category", "brand", "price", "avg_rating"]


def _match(term):
    return f"(coalesce(title ILIKE '%{term}%', false) OR coalesce(brand ILIKE '%{term}%', false) OR coalesce(category ILIKE '%{term}%', false))"


def search_sql(terms, order="avg_rating DESC NULLS LAST, item_id", limit=20, extra="true"):
    where = " AND ".join(_match(t) for t in terms) if terms else "false"
    return f"SELECT {', '.join(PAGE)} FROM items WHERE {where} AND {extra} ORDER BY {order} LIMIT {limit}"


@query("search_items", search_sql(["brand#1", "widget"]))
def search_items(w):
    return G.search_items(w.items, "brand#1 widget").select(*PAGE)


@query("search_items_filtered", search_sql(
    ["small", "ring"], "price NULLS LAST, item_id", 30, "avg_rating >= 2.0 AND price >= 900 AND price <= 1100 AND brand ILIKE '%brand#2%'"))
def _(w):
    return G.search_items(w.items, " small  RING ", 30, "price_asc", min_rating=2.0, price_min=900, price_max=1100,
                          brand="brand#2").select(*PAGE)


@query("search_items_wildcard", search_sql(["%"], "price DESC NULLS LAST, item_id"))
def _(w):
    return G.search_items(w.items, "%", sort="price_desc").select(*PAGE)


@query("search_items_empty", search_sql([]))
def _(w):
    return G.search_items(w.items, "   ").select(*PAGE)


_BATCH = ("red", "small ring", "brand#1 widget", "%", "")


@query("search_many", " UNION ALL ".join(
    f"SELECT '{q}' AS query, row_number() OVER (ORDER BY avg_rating DESC NULLS LAST, item_id) AS rank, item_id "
    f"FROM ({search_sql(q.split())})" for q in _BATCH if q))
def _(w):
    return G.search_many(w.items, _BATCH).select("query", F.col("rank").cast("bigint").alias("rank"), "item_id")


_TERMS = "SELECT query, unnest(string_split(query, ' ')) AS term FROM asked"


@query("search_table", f"""
WITH asked AS (SELECT DISTINCT lower(p_name) AS query FROM part
  UNION SELECT DISTINCT lower(split_part(p_name, ' ', 1)) || ' ' || lower(p_brand) FROM part UNION SELECT unnest(['%1', 're_ ring'])),
terms AS ({_TERMS}),
hits AS (SELECT query, item_id, avg_rating FROM terms JOIN items ON coalesce(title ILIKE '%' || term || '%', false)
    OR coalesce(brand ILIKE '%' || term || '%', false) OR coalesce(category ILIKE '%' || term || '%', false)
  GROUP BY query, item_id, avg_rating HAVING count(DISTINCT term) = any_value(len(list_distinct(string_split(query, ' '))))),
ranked AS (SELECT query, item_id, row_number() OVER (PARTITION BY query ORDER BY avg_rating DESC NULLS LAST, item_id) AS rank FROM hits)
SELECT query, rank, item_id FROM ranked WHERE rank <= 20""")
def _(w):
    part = w.table("part")
    names = part.select(F.lower("p_name").alias("query"))
    brands = part.select(F.concat_ws(" ", F.lower(F.split("p_name", " ")[0]), F.lower("p_brand")).alias("query"))
    odd = part.limit(1).select(F.explode(F.array(F.lit("%1"), F.lit("re_ ring"))).alias("query"))
    found = G.search_table(w.items, names.unionByName(brands).unionByName(odd))
    return found.select("query", F.col("rank").cast("bigint").alias("rank"), "item_id")


@query("category_top", """
SELECT category, rank, item_id FROM (SELECT category, item_id, row_number() OVER (
  PARTITION BY category ORDER BY avg_rating DESC NULLS LAST, item_id) AS rank
  FROM items WHERE category IS NOT NULL AND price >= 950) WHERE rank <= 20""")
def _(w):
    return G.category_top(w.items, price_min=950).select("category", F.col("rank").cast("bigint").alias("rank"), "item_id")


@query("category_browse", f"""
SELECT {', '.join(PAGE)} FROM items WHERE category = 'PROMO' AND avg_rating >= 3
ORDER BY price NULLS LAST, item_id LIMIT 24""")
def _(w):
    return G.category_top(w.items, "PROMO", 24, "price_asc", min_rating=3.0).select(*PAGE)


@query("exclude_list", f"""
SELECT {', '.join(PAGE)} FROM items WHERE category = 'LARGE' AND item_id NOT IN (SELECT item_id FROM popularity WHERE pop_rank <= 200)
ORDER BY avg_rating DESC NULLS LAST, item_id LIMIT 20""")
def _(w):
    return G.category_top(w.items, "LARGE", exclude=popularity_head(w.train, 200)).select(*PAGE)


@query("top_categories", """
SELECT category, count(*) AS n_items FROM items WHERE category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""")
def _(w):
    return G.top_categories(w.items)


@query("item_lookup", f"SELECT {', '.join(PAGE)} FROM items WHERE item_id = 7")
def _(w):
    return G.item_lookup(w.items, 7).select(*PAGE)


view("words", """
SELECT item_id, unnest(regexp_split_to_array(lower(coalesce(title,'') || ' ' || coalesce(brand,'') || ' ' || coalesce(category,'')),
       '[^a-z0-9]+')) AS word FROM items""")
view("word_counts", """
SELECT word, count(*) AS n FROM words WHERE length(word) >= 3 AND NOT regexp_matches(word, '^[0-9]+$') GROUP BY word""")


@query("split_words", "SELECT item_id, word FROM words")
def _(w):
    return w.items.select("item_id", F.explode(TX.split_words(TX.catalog_text())).alias("word"))


@query("word_filter", """
SELECT item_id, word FROM words WHERE length(word) >= 3 AND NOT regexp_matches(word, '^[0-9]+$') AND starts_with(word, 'br')""")
def _(w):
    words = w.items.select("item_id", F.explode(TX.split_words(TX.catalog_text())).alias("word"))
    return words.where(TX.is_suggestable(F.col("word")) & F.startswith("word", F.lit("br")))


@query("tokenize_query", """
SELECT item_id, pos - 1 AS pos, t[pos] AS token FROM (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(brand,'') || '  ' || title || ' '), '\\s+'), lambda x: x <> '') AS t
  FROM items), range(1, 10) r(pos) WHERE pos <= len(t)""")
def _(w):
    text = F.concat(F.coalesce("brand", F.lit("")), F.lit("  "), "title", F.lit(" "))
    return w.items.select("item_id", F.posexplode(TX.tokenize_query(text)).alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query("suggest_words", f"""
SELECT 'small ' || word AS suggestion, count(*) AS n
FROM words WHERE item_id IN (SELECT item_id FROM items WHERE {_match('small')})
  AND word LIKE 'ri%' AND length(word) >= 3 AND NOT regexp_matches(word, '^[0-9]+$')
GROUP BY word ORDER BY n DESC, word LIMIT 8""")
def _(w):
    return G.suggest_words(w.items, "Small ri")


@query("suggest_words_first", """
SELECT word AS suggestion, n FROM word_counts WHERE word LIKE 'br%' ORDER BY n DESC, word LIMIT 8""")
def _(w):
    return G.suggest_words(w.items, "br")


@query("suggest_index", """
SELECT prefix, word, n, rank FROM (
  SELECT left(word, len) AS prefix, word, n, row_number() OVER (PARTITION BY left(word, len) ORDER BY n DESC, word) AS rank
  FROM word_counts, range(2, 40) r(len) WHERE len < length(word)) WHERE rank <= 8""")
def _(w):
    return G.suggest_index(w.items).select("prefix", "word", "n", F.col("rank").cast("bigint").alias("rank"))


_FORMS = """
SELECT p_partkey AS form_id,
  CASE p_partkey % 5 WHEN 0 THEN 'Relevance' WHEN 1 THEN 'Price: low to high' WHEN 2 THEN 'Price: high to low'
    WHEN 3 THEN 'Rating' ELSE 'Newest' END AS sort_label,
  CASE p_partkey % 4 WHEN 0 THEN 'Any' WHEN 1 THEN '4.5+' WHEN 2 THEN '4.0+' ELSE '3.5+' END AS rating_label,
  CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_retailprice END AS price_min,
  CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_retailprice + 10 END AS price_max,
  CASE WHEN p_partkey % 7 = 0 THEN '  ' ELSE ' ' || p_brand END AS brand FROM part"""


@query("normalize_filters", f"""
SELECT form_id, CASE sort_label WHEN 'Price: low to high' THEN 'price_asc' WHEN 'Price: high to low' THEN 'price_desc'
    WHEN 'Rating' THEN 'rating' ELSE 'relevance' END AS sort,
  CASE WHEN rating_label <> 'Any' THEN CAST(rtrim(rating_label, '+') AS DOUBLE) END AS min_rating,
  CASE WHEN price_min > 0 THEN price_min END AS price_min, CASE WHEN price_max > 0 THEN price_max END AS price_max,
  nullif(trim(brand), '') AS brand FROM ({_FORMS})""")
def _(w):
    w.table("part").createOrReplaceTempView("tasteloom_part")
    forms = w.spark.sql(_FORMS.replace("FROM part", "FROM tasteloom_part"))
    return G.normalize_filters(forms)


@query("load_more_pages", """
SELECT category, rank, item_id FROM (SELECT category, item_id, row_number() OVER (
  PARTITION BY category ORDER BY avg_rating DESC NULLS LAST, item_id) AS rank FROM items WHERE category IS NOT NULL)
WHERE rank > 24 AND rank <= 40""")
def _(w):
    ranked = G.category_top(w.items, limit=40)
    return G.page(ranked, 24, 24, 40).select("category", F.col("rank").cast("bigint").alias("rank"), "item_id")


def _keyset_sql(sort, order):
    return (f"SELECT '{sort}' AS sort, rank, item_id FROM (SELECT item_id, row_number() OVER (ORDER BY {order}, item_id) AS rank FROM items) "
            "WHERE rank > 24 AND rank <= 40")


@query("load_more_keyset", " UNION ALL ".join(_keyset_sql(s, o) for s, o in (
    ("rating", "avg_rating DESC NULLS LAST"), ("price_asc", "price NULLS LAST"), ("price_desc", "price DESC NULLS LAST"))))
def _(w):
    """The second page of the whole catalog: 16 rows behind the last of the first 24."""
    pages = []
    for sort in ("rating", "price_asc", "price_desc"):
        last = G.keyset_page(w.items, sort, None, 24).tail(1)
        page = G.keyset_page(w.items, sort, last[0] if last else None, 16)
        place = F.row_number().over(Window.orderBy(*G.sort_columns(sort)))     # of at most 16 rows
        pages.append(page.select(F.lit(sort).alias("sort"), (place + 24).cast("bigint").alias("rank"), "item_id"))
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


# ------------------------------------------------------------------ column rules
@query("clean_price", """
SELECT item_id, round(CASE WHEN len(v) > 0 THEN list_sum(v) / len(v) END, 6) AS price FROM (
  SELECT item_id, list_transform(regexp_extract_all(price, '[\\d,]+\\.?\\d*'), lambda x: CAST(replace(x, ',', '') AS DOUBLE)) AS v
  FROM raw_price)""")
def _(w):
    return w.raw_price.select("item_id", r6(C.clean_price("price"), "price"))


@query("pick_image", """
SELECT p_partkey::VARCHAR AS item_id, CASE WHEN p_partkey % 7 = 0 THEN NULL
  WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'img/' || p_partkey || '-l'
       WHEN p_partkey % 3 = 0 THEN 'img/' || p_partkey || '-h' ELSE 'img/' || p_partkey || '-t' END
  WHEN p_partkey % 3 = 0 THEN 'img/' || p_partkey || '-l' ELSE 'img/' || p_partkey || '-h' END AS image_url FROM part""")
def _(w):
    return w.raw_meta.select(F.col("parent_asin").alias("item_id"), C.pick_image("images").alias("image_url"))


@query("leaf_category", """
SELECT p_partkey::VARCHAR AS item_id, CASE WHEN p_partkey % 11 = 0 THEN p_type ELSE p_brand END AS category FROM part""")
def _(w):
    return w.raw_meta.select(
        F.col("parent_asin").alias("item_id"), C.leaf_category("categories", "main_category").alias("category")
    )


@query("collapse_variant", "SELECT p_partkey::VARCHAR AS item_id, p_name AS title FROM part")
def _(w):
    return w.raw_meta.select(F.col("parent_asin").alias("item_id"), "title")


@query("event_rating", "SELECT event_id, event_type, rating FROM live_events")
def _(w):
    return w.live_events.select("event_id", "event_type", "rating")


@query("truncate_title", "SELECT doc_id, left(text, 45) AS title FROM documents")
def _(w):
    return w.table("documents").select("doc_id", F.expr("left(text, 45)").alias("title"))


@query("reason_text", "SELECT item_id, 'Because you viewed ' || left(title, 45) AS reason FROM items")
def _(w):
    return w.items.select("item_id", C.reason_text("title").alias("reason"))


@query("top_rated_flag", "SELECT item_id, coalesce(avg_rating >= 4.7, false) AS top_rated FROM items")
def _(w):
    return w.items.select("item_id", C.top_rated("avg_rating").alias("top_rated"))


def icon_sql():
    chain = " ".join(
        "WHEN " + " OR ".join(f"contains(t, '{k}')" for k in words) + f" THEN '{icon}'" for words, icon in C.CATEGORY_KEYWORDS
    )
    return f"CASE {chain} ELSE '{C.OTHER_CATEGORY_ICON}' END"


@query("category_icon_rule", f"""
SELECT doc_id, {icon_sql()} AS icon FROM (SELECT doc_id, lower(coalesce(source, '') || ' ' || coalesce(text, '')) AS t FROM documents)""")
def _(w):
    return w.table("documents").select("doc_id", C.category_icon("source", "text").alias("icon"))
