import itertools

from tasteloom.operators import catalog as G
from tests.conftest import rows


def test_keyset_pages_join_to_the_ranked_list(frame):
    values = [None, 1.0, 2.0, 2.0, 5.0]
    items = frame([(n, a, b) for n, (a, b) in enumerate(itertools.product(values, values * 2))], "item_id int, avg_rating double, price double")
    for sort in G.SORTS:
        want = [r["item_id"] for r in items.orderBy(*G.sort_columns(sort)).collect()]
        got, last = [], None
        while True:
            page = G.keyset_page(items, sort, last, 9).collect()
            if not page:
                break
            got += [r["item_id"] for r in page]
            last = page[-1]
        assert got == want


def test_the_seek_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "items")
    frame([(n, 4.0, float(n)) for n in range(50)], "item_id int, avg_rating double, price double").write.parquet(path)
    items = spark.read.parquet(path)
    last = G.keyset_page(items, "price_desc", None, 5).collect()[-1]
    page = G.keyset_page(items, "price_desc", last, 5)
    assert rows(page, "item_id") == [(n,) for n in range(40, 45)]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "TakeOrderedAndProject" in plan and "Window" not in plan
