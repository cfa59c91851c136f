"""Catalog search, category browsing and query suggestion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tasteloom.functions.text import catalog_text, is_suggestable, split_words
from tasteloom.operators.ordering import first_per_group
from tasteloom.session import write_stage

# fixed values: sort keys offered by search and browsing, and the labels of the filter form
SORTS = ("relevance", "rating", "price_asc", "price_desc")
SORT_LABELS = {
    "Relevance": "relevance", "Price: low to high": "price_asc", "Price: high to low": "price_desc", "Rating": "rating",
}
RATING_LABELS = ("Any", "4.5+", "4.0+", "3.5+")


def sort_columns(sort: str) -> list[Column]:
    """Order of a result page; unknown keys sort like relevance, which is the rating order."""
    return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in sort_keys(sort)]


def sort_keys(sort: str) -> list[tuple[str, bool]]:
    """(column, ascending) of ``sort_columns``; nulls stand last."""
    first = {"price_asc": ("price", True), "price_desc": ("price", False)}.get(sort, ("avg_rating", False))
    return [first, ("item_id", True)]


def like_pattern(pattern: Column) -> Column:
    """A search pattern in which a backslash before an ordinary character stands for that character."""
    return F.regexp_replace(pattern, r"(\\[\\%_])|\\(.)", "$1$2")


def matches_term(term: str | Column) -> Column:
    """Case-insensitive substring of title, brand or category; % and _ stay wildcards."""
    pattern = like_pattern(F.concat(F.lit("%"), F.lit(term) if isinstance(term, str) else term, F.lit("%")))
    hits = [F.coalesce(F.ilike(F.col(c), pattern), F.lit(False)) for c in ("title", "brand", "category")]
    return hits[0] | hits[1] | hits[2]


def filter_items(items: DataFrame, min_rating: float | None = None, price_min: float | None = None,
                 price_max: float | None = None, brand: str | None = None) -> DataFrame:
    if min_rating is not None:
        items = items.where(F.col("avg_rating") >= min_rating)
    if price_min is not None:
        items = items.where(F.col("price") >= price_min)
    if price_max is not None:
        items = items.where(F.col("price") <= price_max)
    if brand:
        items = items.where(F.ilike(F.col("brand"), like_pattern(F.lit(f"%{brand}%"))))
    return items


def search_items(items: DataFrame, query: str, limit: int = 20, sort: str = "relevance", **filters) -> DataFrame:
    """Items in which every term of ``query`` occurs; an empty query finds nothing."""
    terms = query.split()
    if not terms:
        return items.where(F.lit(False))
    found = filter_items(items, **filters)
    for term in terms:
        found = found.where(matches_term(term))
    return found.orderBy(*sort_columns(sort)).limit(limit)


_GRAM = 3  # characters of the pieces by which terms find items
_BLOCK_QUERIES = 200


def _grams(text: Column) -> Column:
    """Distinct runs of three characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (_GRAM - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(_GRAM))))


def search_many(items: DataFrame, queries: Sequence[str], limit: int = 20, sort: str = "relevance") -> DataFrame:
    """A few searches in one scan: (query, rank, item...). Pages are cut per query; see
    ``search_table`` for many."""
    tags = []
    for q in queries:
        terms = q.split()
        if not terms:
            continue
        hit = matches_term(terms[0])
        for term in terms[1:]:
            hit = hit & matches_term(term)
        tags.append(F.when(hit, F.lit(q)))
    if not tags:
        return items.where(F.lit(False)).select(F.lit("").alias("query"), F.lit(0).alias("rank"), "*")
    tagged = items.withColumn("query", F.explode(F.array_compact(F.array(*tags))))
    return first_per_group(tagged, ["query"], sort_columns(sort), limit, "rank").select("query", "rank", *items.columns)


def search_table(items: DataFrame, queries: DataFrame, limit: int = 20, sort: str = "relevance") -> DataFrame:
    """A table of searches at once: (query, rank, item...). Pages are cut per query.

    ``queries`` has a column ``query``. The rarest run of three characters of a query's terms finds the items that may match in an index of
    such runs, then every term is verified. Queries without such a run (only short
    terms, or terms with wildcards) go in blocks of ``_BLOCK_QUERIES``, each verified in
    one scan of the items; a row appears only where a query matches. Blank queries
    find nothing.
    """
    asked = queries.select("query").distinct().withColumn(
        "terms", F.filter(F.split(F.lower("query"), r"\s+"), lambda t: t != "")).where(F.size("terms") > 0)
    plain = F.filter("terms", lambda t: ~t.rlike(r"[%_\\]") & (F.length(t) >= _GRAM))
    asked = write_stage(asked.withColumn("grams", F.array_distinct(F.flatten(F.transform(plain, _grams)))), "searches")
    fields = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("title", "brand", "category")]
    keyed = items.select("*", F.monotonically_increasing_id().alias("_item"))
    keyed = write_stage(keyed, "searched-items")
    index = keyed.select("_item", F.explode(F.array_distinct(F.concat(*map(_grams, fields)))).alias("gram"))
    index = write_stage(index, "item-grams")
    wanted = asked.select("query", F.explode("grams").alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = wanted.join(counts, "gram", "left").groupBy("query").agg(
        F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    pairs = rarest.join(index, "gram").select("query", "_item")
    tagged = pairs.join(asked.select("query", "terms"), "query").join(keyed, "_item")
    found = tagged.where(F.forall("terms", matches_term)).select("query", *items.columns)
    block: list = []
    for row in asked.where(F.size("grams") == 0).select("query", "terms").toLocalIterator():
        block.append(row)
        if len(block) == _BLOCK_QUERIES:
            found, block = found.unionByName(_scanned(keyed, block, items.columns)), []
    if block:
        found = found.unionByName(_scanned(keyed, block, items.columns))
    return first_per_group(found, ["query"], sort_columns(sort), limit, "rank").select("query", "rank", *items.columns)


def _scanned(items: DataFrame, block: list[Row], columns: Sequence[str]) -> DataFrame:
    """Matches of a block of queries, from one scan."""
    held = F.array(*(F.struct(F.lit(r["query"]).alias("query"), F.array(*map(F.lit, r["terms"])).alias("terms")) for r in block))
    hits = F.filter(held, lambda q: F.forall(q["terms"], matches_term))
    return items.select(F.explode(F.transform(hits, lambda q: q["query"])).alias("query"), *columns)


def category_top(items: DataFrame, category: str | None = None, limit: int = 20, sort: str = "rating",
                 exclude: DataFrame | None = None, **filters) -> DataFrame:
    """Best items of one category, or of every category when none is named."""
    found = filter_items(items.where(F.col("category").isNotNull()), **filters)
    if category is not None:
        found = found.where(F.col("category") == category)
    if exclude is not None:
        found = found.join(exclude.select("item_id"), "item_id", "left_anti")
    if category is not None:
        return found.orderBy(*sort_columns(sort)).limit(limit)
    return first_per_group(found, ["category"], sort_columns(sort), limit, "rank")


def top_categories(items: DataFrame, n: int = 12) -> DataFrame:
    counts = items.where(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("n_items"))
    return counts.orderBy(F.desc("n_items"), "category").limit(n)


def item_lookup(items: DataFrame, item_id) -> DataFrame:
    return items.where(F.col("item_id") == item_id)


def catalog_words(items: DataFrame) -> DataFrame:
    """Every word occurrence of title, brand and category."""
    return items.select(F.explode(split_words(catalog_text())).alias("word"))


def suggest_words(items: DataFrame, query: str, n: int = 8, pool_limit: int | None = None) -> DataFrame:
    """Complete the last word of ``query`` with catalog words, most frequent first.

    Earlier words restrict the pool. ``pool_limit`` optionally bounds the pool, in
    item order; by default the whole pool counts.
    """
    tokens = query.lower().split()
    empty = items.select(F.lit("").alias("suggestion"), F.lit(0).cast("bigint").alias("n")).where(F.lit(False))
    if not tokens or len(tokens[-1]) < 2:
        return empty
    pool = items
    for term in tokens[:-1]:
        pool = pool.where(matches_term(term))
    if pool_limit is not None:
        pool = pool.orderBy("item_id").limit(pool_limit)
    words = catalog_words(pool).where(F.ilike("word", like_pattern(F.lit(tokens[-1] + "%"))) & is_suggestable(F.col("word")))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(n)
    head = " ".join(tokens[:-1])
    return top.select(F.trim(F.concat_ws(" ", F.lit(head), "word")).alias("suggestion"), "n")


def suggest_index(items: DataFrame, n: int = 8, min_prefix: int = 2) -> DataFrame:
    """Prefix -> best words, for all prefixes at once. Words are counted before their
    prefixes are expanded, so the size follows the vocabulary, not the catalog."""
    counts = catalog_words(items).where(is_suggestable(F.col("word"))).groupBy("word").agg(F.count("*").alias("n"))
    expanded = counts.select(
        "word", "n", F.explode(F.sequence(F.lit(min_prefix), F.length("word"))).alias("len")
    ).select(F.expr("left(word, len)").alias("prefix"), "word", "n").where(F.col("prefix") != F.col("word"))
    return first_per_group(expanded, ["prefix"], [F.desc("n"), F.asc("word")], n, "rank")


def normalize_filters(forms: DataFrame) -> DataFrame:
    """Filter form values to search arguments: zero bounds, "Any" and blanks mean none.

    ``forms``: sort_label, rating_label, price_min, price_max, brand.
    """
    pairs = [F.lit(x) for kv in SORT_LABELS.items() for x in kv]
    rating = F.when(F.col("rating_label") != "Any", F.rtrim(F.col("rating_label"), F.lit("+")).try_cast("double"))
    return forms.select(
        *(c for c in forms.columns if c not in {"sort_label", "rating_label", "price_min", "price_max", "brand"}),
        F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("sort_label")), F.lit("relevance")).alias("sort"),
        rating.alias("min_rating"),
        F.when(F.col("price_min") > 0, F.col("price_min")).alias("price_min"),
        F.when(F.col("price_max") > 0, F.col("price_max")).alias("price_max"),
        F.nullif(F.trim("brand"), F.lit("")).alias("brand"),
    )


def page(ranked: DataFrame, shown: int, step: int, cap: int) -> DataFrame:
    """Rows a "load more" click adds after ``shown`` rows; nothing beyond ``cap``."""
    return ranked.where((F.col("rank") > shown) & (F.col("rank") <= min(cap, shown + step)))



def keyset_page(items: DataFrame, sort: str = "rating", after: Row | None = None, limit: int = 24) -> DataFrame:
    """The ``limit`` rows of ``items`` that follow ``after``, a row shown before, in the order of ``sort``.

    Nothing that was shown is ranked again: the place behind ``after`` is a filter on the
    sort columns and the id that the scan can use, and only ``limit`` rows are kept.
    Nulls come last. ``category_top`` takes the same sorts.
    """
    rows = items if after is None else items.where(_behind(sort_keys(sort), after))
    return rows.orderBy(*sort_columns(sort)).limit(limit)


def _behind(order: Sequence[tuple[str, bool]], after: Row) -> Column:
    """Rows behind ``after`` when ordered by (column, ascending) with nulls last."""
    found, equal = F.lit(False), F.lit(True)
    for name, ascending in order:
        column, value = F.col(name), after[name]
        if value is None:
            equal = equal & column.isNull()
            continue
        later = (column > F.lit(value)) if ascending else (column < F.lit(value))
        found = found | (equal & (later | column.isNull()))
        equal = equal & (column == F.lit(value))
    return found
