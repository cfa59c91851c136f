import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import commerce as O
from tasteloom.operators.histories import user_history
from tasteloom.plans.feed import FeedModels, recommend_batch
from tasteloom.session import stage_path
from tasteloom.streaming import behaviour as S
from tests.conftest import rows
from tests.test_commerce import LOG, actions

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
EVENTS = "event_id bigint, user_id int, item_id int, event_type string, rating double, at timestamp, ts bigint"


def split_files(spark, df, order, parts):
    """The rows as ``parts`` files, so a stream sees several micro-batches."""
    folder = stage_path(spark, "input")
    total = df.count()
    for n in range(parts):
        lo, hi = total * n // parts, total * (n + 1) // parts
        df.where(F.col(order).between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(folder)
    return S.read_events(spark, folder, df.schema, files_per_trigger=1)


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(0)
    out = []
    for n in range(400):
        at = START + dt.timedelta(minutes=3 * n)
        out.append((n, int(rng.integers(0, 6)), int(rng.integers(0, 30)), str(rng.choice(["view", "like"])), 3.0, at, int(at.timestamp() * 1000)))
    return spark.createDataFrame(out, EVENTS)


def test_history_over_micro_batches(spark, events):
    stream = split_files(spark, events, "event_id", 4)
    got = S.newest_lists(S.drain(S.user_history_stream(stream, 5), "history", "update"))
    assert rows(got, "user_id", "item_id", "ts", "rank") == rows(user_history(events, 5), "user_id", "item_id", "ts", "rank")


def test_cart_over_micro_batches(spark, frame):
    log = frame(actions(300), LOG)
    got = S.cart_stream(split_files(spark, log, "seq", 3))
    assert rows(got, "user_id", "item_id", "qty", "added_at") == rows(O.cart_state(log))


def test_throttle_over_micro_batches(spark, frame):
    log = frame([(n % 2, "failed" if n % 9 else "success", n * 40_000, n) for n in range(120)], "user_id int, result string, ts bigint, seq bigint")
    got = S.throttle_stream(split_files(spark, log, "seq", 3))
    assert rows(got, "user_id", "seq", "blocked") == rows(O.throttle_flags(log), "user_id", "seq", "blocked")


def test_cart_changes_follow_the_micro_batch(spark, frame):
    """A batch passes on the lines it changed; a checkout empties lines of older batches; odd rows do nothing."""
    log = frame([(1, n, "add", None, n, n) for n in range(20)] + [(2, 5, "add", None, 20, 20), (None, 5, "add", None, 21, 21),
                 (1, None, "add", None, 22, 22), (1, 3, None, None, 23, 23), (1, 4, "look", None, 24, 24), (1, 2, "set", 7, 25, 25),
                 (1, 3, "set", 0, 26, 26), (2, None, "checkout", None, 27, 27), (2, 9, "add", None, 28, 28)], LOG)
    folder = stage_path(spark, "input")
    for low, high in ((0, 20), (21, 40)):
        log.where(F.col("seq").between(low, high)).coalesce(1).write.mode("append").parquet(folder)
    with S.rocksdb_state(spark):
        made = S.drain(S.cart_changes(S.read_events(spark, folder, log.schema, files_per_trigger=1)), "cart", "update")
    second = rows(made.where("batch = 1"), "user_id", "item_id", "qty", "open")
    assert second == [(1, 2, 7, True), (1, 3, 0, False), (2, 5, 0, False), (2, 9, 1, True)]


def test_a_timer_forgets_failures_without_a_new_row(spark, frame):
    schema = "user_id int, result string, ts bigint, seq bigint"
    log = frame([(1, "failed", 1000 * n, n) for n in range(5)] + [(1, "failed", 5000, 5), (2, "success", 3_000_000, 6), (2, "success", 6_000_000, 7)], schema)
    folder = stage_path(spark, "logins")
    for ids in ((0, 1, 2), (3, 4, 5), (6,), (7,)):
        log.where(F.col("seq").isin(*ids)).coalesce(1).write.mode("append").parquet(folder)
    with S.rocksdb_state(spark):
        made = S.drain(S.login_flags(S.read_events(spark, folder, log.schema, files_per_trigger=1)), "throttle", "update").collect()
    flags = sorted((r["seq"], r["blocked"]) for r in made if not r["forgotten"])
    assert flags == [(n, n == 5) for n in range(8)]
    fired = [(r["user_id"], r["forgotten"]) for r in made if r["forgotten"]]
    assert fired == [(1, 5)]     # user 1 has no row after the first six


def test_streams_go_on_where_they_stopped_and_take_nothing(spark, frame):
    log = frame(actions(300), LOG)
    source, folder = stage_path(spark, "input"), stage_path(spark, "run")
    for low, high in ((0, 99), (100, 299)):
        log.where(F.col("seq").between(low, high)).coalesce(1).write.mode("append").parquet(source)
        got = S.cart_stream(S.read_events(spark, source, log.schema), folder)
    assert rows(got, "user_id", "item_id", "qty", "added_at") == rows(O.cart_state(log))
    again = S.cart_stream(S.read_events(spark, source, log.schema), folder)
    assert rows(again) == rows(got)
    empty = stage_path(spark, "empty")
    log.limit(0).write.parquet(empty)
    assert S.cart_stream(S.read_events(spark, empty, log.schema)).count() == 0


def test_late_rows_beyond_the_delay_are_dropped(spark, frame):
    def row(n, minutes):
        at = START + dt.timedelta(minutes=minutes)
        return (n, 1, 1, "view", 3.0, at, int(at.timestamp() * 1000))

    # row 2 is out of order but inside the delay; row 3 is far beyond it once the watermark of
    # row 1 has become the late-row watermark, one micro-batch later; row 4 closes the windows
    df = frame([row(0, 5), row(1, 125), row(2, 118), row(3, 6), row(4, 600)], EVENTS)
    folder = stage_path(spark, "late")
    for ids in ((0,), (1,), (2,), (3,), (4,)):
        df.where(F.col("event_id").isin(*ids)).coalesce(1).write.mode("append").parquet(folder)
    counts = S.drain(S.event_counts(S.read_events(spark, folder, df.schema, files_per_trigger=1)), "late")
    start = int(START.timestamp() * 1000)
    assert rows(counts, "window_start", "n") == [(start, 1), (start + 3_600_000, 1), (start + 7_200_000, 1)]


def test_feed_is_refreshed_for_touched_users(spark, events, frame):
    items = frame([(n, f"t{n}", "c", f"b{n % 7}") for n in range(30)], "item_id int, title string, category string, brand string")
    vectors = frame([(n, [float(n), 1.0]) for n in range(30)], "item_id int, vec array<double>")
    head = frame([(n + 1, n) for n in range(30)], "pop_rank bigint, item_id int")
    models = FeedModels(head, vectors)

    def feed(users, log):
        return recommend_batch(users, log, items, models, n=5)

    got = S.recommend_stream(split_files(spark, events, "event_id", 2), feed)
    want = feed(events, events)
    assert rows(got, "user_id", "rank", "item_id", "reason") == rows(want, "user_id", "rank", "item_id", "reason")
    cold = recommend_batch(frame([(77,)], "user_id int"), events, items, models, n=5)
    assert {r["model_label"] for r in cold.collect()} == {"Popular right now"}
    assert recommend_batch(events, events, items, FeedModels(head), n=5).count() == 30


def test_sketches_of_active_users_are_close(spark):
    rng = np.random.default_rng(2)
    out = []
    for n in range(20_000):
        at = START + dt.timedelta(minutes=0.2 * n)
        out.append((n, int(rng.integers(0, 6000)), 1, "view", 3.0, at, int(at.timestamp() * 1000)))
    folder = stage_path(spark, "active")
    spark.createDataFrame(out, EVENTS).coalesce(1).write.parquet(folder)
    stream = [S.read_events(spark, folder, spark.read.parquet(folder).schema) for _ in range(2)]
    exact = dict(rows(S.drain(S.active_users(stream[0]), "exact")))
    close = dict(rows(S.drain(S.active_users_sketch(stream[1]), "close")))
    assert exact.keys() == close.keys() and max(exact.values()) > 3000
    assert all(abs(close[k] - v) <= 0.02 * v + 1 for k, v in exact.items())


def test_one_call_folds_the_carts_of_many_users():
    """A call per user and share took most of the time: a home's carts come in one, each read and written once at most."""
    import pandas as pd

    from tasteloom.streaming.keyed import CartLines

    class Carts(dict):
        reads, writes = 0, 0

        def getMapState(self, *_):
            return self

        def getValue(self, key):
            self.reads += 1
            return self.get(key)

        def updateValue(self, key, value):
            self.writes += 1
            self[key] = value

        def removeKey(self, key):
            del self[key]

    carts, fold = Carts(), CartLines("int", "int")
    fold.init(carts)

    def call(*made):
        frame = pd.DataFrame(made, columns=["user_id", "share", "item_id", "action", "qty", "ts", "seq"])
        return sorted(tuple(r) for out in fold.handleInputRows((0,), iter([frame]), None) for r in out.itertuples(index=False))

    got = call(*((u, 0, i, "add", None, 10 * u + i, 0) for i in (1, 0) for u in range(500)))
    assert got == [(u, i, 1, 10 * u + i, True) for u in range(500) for i in (0, 1)]
    assert (carts.reads, carts.writes) == (500, 500)
    got = call((7, 0, 1, "add", None, 9000, 3), (8, 0, None, "checkout", None, 9000, 4), (9, 0, 1, "set", 0, 9000, 5),
               (9, 0, 5, "remove", None, 9000, 6), (10, 0, 1, "set", 1, 9000, 7), (8, 0, 2, "add", None, 9001, 8))
    assert got == [(7, 1, 2, 71, True), (8, 0, 0, 0, False), (8, 1, 0, 0, False), (8, 2, 1, 9001, True), (9, 1, 0, 0, False)]
    assert (carts.reads, carts.writes) == (504, 503) and call((3, 0, None, "checkout", None, 1, 1))[0][:2] == (3, 0) and (3, 0) not in carts
