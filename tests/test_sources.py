import json

import pytest

from tasteloom import schema
from tasteloom.sources import raw as J
from tasteloom.sources import tables as B
from tests.conftest import rows


def test_reviews_and_meta(spark, frame, tmp_path):
    reviews = tmp_path / "r.jsonl"
    lines = [{"user_id": "u", "parent_asin": f"p{n}", "rating": 5.0, "timestamp": ts, "x": 1} for n, ts in enumerate((1546300799999, 1546300800000))]
    reviews.write_text("\n".join([json.dumps(lines[0]), "", json.dumps(lines[1]), "{broken"]))
    assert rows(J.read_reviews(spark, str(reviews), 2019)) == [("u", "p1", 5.0, 1546300800000)]
    meta = tmp_path / "m.jsonl"
    records = [
        {"parent_asin": "p1", "title": "first", "images": [{"large": "L"}], "categories": ["a", "b"], "price": 12.5, "average_rating": 4.5},
        {"parent_asin": "p1", "title": "second", "images": {"large": ["D"]}, "categories": [], "main_category": "m", "price": "$1 - $3"},
        {"parent_asin": "p2", "title": "other", "images": {"large": ["D"]}, "categories": [], "main_category": "m", "price": "$1 - $3"},
    ]
    meta.write_text("\n".join(map(json.dumps, records)))
    needed = frame([("p1",)], "item_id string")
    assert rows(J.read_meta(spark, str(meta), needed)) == [("p1", "first", "L", "b", None, 12.5, 4.5)]
    assert rows(J.read_meta(spark, str(meta)), "item_id", "image_url", "category", "price") == [("p1", "L", "b", 12.5), ("p2", "D", "m", 2.0)]


def test_records_of_odd_types_are_kept(spark, frame, tmp_path):
    reviews = tmp_path / "r.jsonl"
    lines = ['{"user_id": "a", "parent_asin": "p", "rating": "5", "timestamp": 1700000000000.0}',
             '{"user_id": 7, "parent_asin": "p", "rating": 4, "timestamp": "1700000000001"}',
             '{"user_id": "c", "parent_asin": "p", "rating": "five", "timestamp": 1700000000002}', "{broken", '[1]']
    reviews.write_text("\n".join(lines))
    assert rows(J.read_reviews(spark, str(reviews), 2019), "user_id", "ts") == [
        ("7", 1700000000001), ("a", 1700000000000), ("c", 1700000000002)]
    assert {r["rating"] for r in J.read_reviews(spark, str(reviews)).collect()} == {5.0, 4.0, None}
    lost = {(r["field"], r["raw"]) for r in J.read_rejects(spark, str(reviews), schema.RAW_REVIEWS).collect()}
    assert ("rating", "five") in lost and (None, "{broken") in lost
    meta = tmp_path / "m.jsonl"
    meta.write_text('{"parent_asin": "p1", "categories": "toys", "average_rating": "4.5", "price": -5}\n{"parent_asin": "p2", "price": 1e3}')
    assert rows(J.read_meta(spark, str(meta)), "item_id", "category", "avg_rating", "price") == [
        ("p1", "toys", 4.5, -5.0), ("p2", None, None, 1000.0)]


def test_first_of_equal_ids_is_inserted(frame):
    old = frame([("a", 1.0, 1)], "item_id string, price double, n int")
    new = frame([("b", 9.0, 2), ("b", 3.0, 1), ("b", 1.0, 3)], "item_id string, price double, n int")
    assert rows(B.upsert_items(old, new, ["n"])) == [("a", 1.0, 1), ("b", 3.0, 1)]


def test_upserts_and_results(spark, frame, tmp_path):
    old = frame([("a", 1.0)], "item_id string, price double")
    new = frame([("a", 9.0), ("b", float("nan"))], "item_id string, price double")
    assert B.upsert_items(old, new).orderBy("item_id").collect() == [("a", 1.0), ("b", None)]
    results = frame([("m1", 1.0), ("m2", 2.0)], "method string, recall_10 double")
    assert rows(B.upsert_result_rows(results, frame([("m1", 3.0)], "method string, recall_10 double"))) == [("m1", 3.0), ("m2", 2.0)]
    B.write_results_csv(results, str(tmp_path / "res"))
    assert rows(B.read_results_csv(spark, str(tmp_path / "res"), results.schema)) == rows(results)
    assert B.read_results_csv(spark, str(tmp_path / "none"), schema.RESULTS, results) is results


def test_artifacts_degrade(spark, frame, tmp_path):
    folder = str(tmp_path)
    assert B.load_artifacts(spark, folder).model_label == "Popular right now"
    B.write_artifacts(folder, popularity=frame([(1, "a")], "pop_rank int, item_id string"),
                      item_vectors=frame([("a", [1.0])], "item_id string, vec array<double>"))
    assert B.load_artifacts(spark, folder).stage == "retriever"
    health = {r["artifact"]: (r["loaded"], r["n_rows"]) for r in B.artifact_health(spark, folder).collect()}
    assert health["popularity"] == (True, 1) and health["ranker_trees"] == (False, None)
    with pytest.raises(ValueError):
        B.write_artifacts(folder, nonsense=frame([(1,)], "x int"))


def test_artifact_sets_are_whole(spark, frame, tmp_path):
    folder = str(tmp_path / "sets")
    one, two = (frame([(1, n)], "pop_rank int, item_id string") for n in "ab")
    assert B.write_artifacts(folder, popularity=one) == 1
    old = B.load_artifacts(spark, folder)
    # a set that broke off before its manifest is not seen, and its number is taken again
    two.write.parquet(f"{folder}/sets/2/popularity")
    assert rows(B.load_artifacts(spark, folder).get("popularity")) == [(1, "a")]
    assert B.write_artifacts(folder, popularity=two, item_encoder=one) == 2
    assert rows(B.load_artifacts(spark, folder).get("popularity")) == [(1, "b")] and rows(old.get("popularity")) == [(1, "a")]
    assert rows(B.load_artifacts(spark, folder, 1).get("popularity")) == [(1, "a")] and B.versions(spark, folder) == [1, 2]
    with pytest.raises(ValueError):
        B.load_artifacts(spark, folder, 7)


def test_feed_from_saved_artifacts_in_all_stages(spark, frame, tmp_path):
    from tasteloom.operators import towers as T
    from tasteloom.operators.features import FEATURES, feature_store
    from tasteloom.operators.histories import mean_pool
    from tasteloom.operators.ranker import LambdaMart, Tree
    from tasteloom.plans.feed import FeedModels, feed_models, recommend_batch

    log = frame([(u, (u * 7 + k * k) % 30, 4.0, 1000 * k + u) for u in range(8) for k in range(12)], "user_id int, item_id int, rating double, ts bigint")
    items = frame([(n, f"t{n}", f"c{n % 3}", f"b{n % 7}", float(n), 4.0) for n in range(30)],
                  "item_id int, title string, category string, brand string, price double, avg_rating double")
    vectors = frame([(n, [float(n % 5), 1.0 + n % 4]) for n in range(30)], "item_id int, vec array<double>")
    head, store = frame([(n + 1, n) for n in range(30)], "pop_rank bigint, item_id int"), feature_store(log, items)
    tree = Tree()
    tree.add()
    tree.split(0, FEATURES.index("item_price"), 0, 12.5)
    tree.value, tree.leaf = [0.0, 0.25, -0.5], [-1, 0, 1]
    ranker, weights = LambdaMart([tree], {}, []), T.Weights.initial(2, 4, 1)
    constants = frame([(store.global_avg_rating, store.now_ts)], "global_avg_rating double, now_ts bigint")

    def tower(history):
        return T.apply_tower(mean_pool(history, vectors, 2), "user_id", weights, "user")

    saved = {"popularity": head}
    stages = [("Popular right now", dict(saved), FeedModels(head))]
    saved["item_vectors"] = vectors
    stages.append(("Two-tower", dict(saved), FeedModels(head, vectors)))
    saved |= {"tower_weights": weights.to_table(spark), "item_embeddings": vectors}
    stages.append(("Two-tower", dict(saved), FeedModels(head, vectors, tower)))
    saved |= {"user_features": store.users, "item_features": store.items, "feature_constants": constants, "ranker_trees": ranker.to_table(spark)}
    stages.append(("Two-tower + ranker", dict(saved), FeedModels(head, vectors, tower, ranker, store)))
    folder = str(tmp_path / "feed")
    for label, tables, models in stages:
        B.write_artifacts(folder, **tables)
        found = B.load_artifacts(spark, folder)
        assert found.model_label == label
        got = recommend_batch(log, log, items, feed_models(found), n=4)
        want = recommend_batch(log, log, items, models, n=4)
        assert rows(got) == rows(want) and {r["model_label"] for r in got.collect()} == {label}
