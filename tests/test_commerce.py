import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import commerce as O
from tests.conftest import rows

LOG = "user_id int, item_id int, action string, qty bigint, ts bigint, seq bigint"


def actions(n=600, seed=0):
    """Half of the rows belong to one user."""
    rng = np.random.default_rng(seed)
    out = []
    for seq in range(n):
        user = 0 if rng.random() < 0.5 else int(rng.integers(1, 6))
        action = str(rng.choice(["add", "set", "remove", "checkout"], p=[0.5, 0.3, 0.15, 0.05]))
        out.append((user, int(rng.integers(0, 4)), action, int(rng.integers(-1, 4)) if action == "set" else None, seq // 3, seq))
    return out


def apply_cart_action(lines, action, item, qty, ts):
    """One action on {item: (qty, added_at)}, as the shop defines it."""
    if action == "checkout":
        lines.clear()
    elif action == "remove":
        lines.pop(item, None)
    elif action == "add":
        count, since = lines.get(item, (0, ts))
        lines[item] = (count + 1, since)
    elif item in lines:
        if qty <= 0:
            lines.pop(item)
        else:
            lines[item] = (qty, lines[item][1])


def replay(log):
    carts, checkouts = {}, []
    for user, item, action, qty, ts, seq in log:
        lines = carts.setdefault(user, {})
        if action == "checkout":
            checkouts += [(user, i, seq, q, ts) for i, (q, _t) in lines.items()]
        apply_cart_action(lines, action, item, qty, ts)
    return sorted((u, i, q, t) for u, lines in carts.items() for i, (q, t) in lines.items()), sorted(checkouts)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_cart_and_checkout_match_replay(frame, seed):
    log = actions(seed=seed)
    cart, checkouts = replay(log)
    df = frame(log, LOG)
    assert rows(O.cart_state(df)) == cart
    assert rows(O.checkout_lines(df)) == checkouts


def test_cart_literals(frame):
    steps = [("add", None), ("add", None), ("set", 5), ("add", None), ("remove", None), ("add", None)]
    log = [(1, 1, a, q, n, n) for n, (a, q) in enumerate(steps)] + [(2, 1, "set", 3, 0, 9)]
    assert rows(O.cart_state(frame(log, LOG))) == [(1, 1, 1, 5)]


def test_wishlist(frame):
    log = [(1, 1, "add", 1, 1), (1, 1, "add", 2, 2), (1, 2, "add", 1, 3), (1, 2, "remove", 2, 4), (1, 3, "remove", 0, 0), (1, 3, "add", 5, 5)]
    assert rows(O.wishlist_state(frame(log, "user_id int, item_id int, action string, ts bigint, seq bigint"))) == [(1, 1, 1), (1, 3, 5)]


def throttle_replay(log, window, limit):
    recent, out = {}, []
    for user, result, ts, seq in sorted(log, key=lambda r: (r[2], r[3])):
        mine = [t for t in recent.get(user, []) if ts - t <= window]
        blocked = len(mine) >= limit
        if not blocked:
            mine = [] if result == "success" else [*mine, ts]
        recent[user] = mine
        out.append((user, seq, blocked))
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_throttle_matches_replay(frame, seed):
    rng = np.random.default_rng(seed)
    ts = np.cumsum(rng.choice([1, 100_000, 700_000], 800, p=[0.7, 0.25, 0.05]))
    log = [(0 if rng.random() < 0.5 else int(rng.integers(1, 4)), "success" if rng.random() < 0.1 else "failed", int(t), n) for n, t in enumerate(ts)]
    got = O.throttle_flags(frame(log, "user_id int, result string, ts bigint, seq bigint"))
    want = throttle_replay(log, 600_000, 5)
    assert rows(got, "user_id", "seq", "blocked") == want and any(b for _u, _s, b in want)


def test_throttle_literal(frame):
    times = [0, 1, 2, 3, 4, 5, 601.0, 602, 603]
    results = ["failed"] * 7 + ["success", "failed"]
    log = [(1, r, int(t * 1000), n) for n, (t, r) in enumerate(zip(times, results))]
    got = [b for _s, b in rows(O.throttle_flags(frame(log, "user_id int, result string, ts bigint, seq bigint")), "seq", "blocked")]
    assert got == [False] * 5 + [True] + [b for _u, _s, b in throttle_replay(log, 600_000, 5)][6:]


def test_latency_and_kpis(frame):
    log = frame([({"a": float(n), "b": 1.0},) for n in range(21)], "latency_ms map<string,double>")
    assert rows(O.latency_summary(log), "component", "mean_ms", "p95_ms") == [("a", 10.0, 19.0), ("b", 1.0, 1.0)]
    users = frame([(1,), (2,)], "user_id int")
    events = frame([(1, 5, 100_000_000, "view"), (2, 5, 1, None)], "user_id int, item_id int, ts bigint, event_type string")
    orders = frame([(1, 2.5, 2), (1, None, 1)], "user_id int, price double, qty bigint")
    assert tuple(O.admin_kpis(users, events, orders, 100_000_001).first()) == (2, 1, 2, 5.0)
    assert rows(O.user_counters(users, events)) == [(1, 1), (2, 0)]


def test_titles_from_frequent_item_sketches(spark, frame):
    rng = np.random.default_rng(6)
    heavy = [n for n in range(5) for _ in range(3000 - 300 * n)]
    light = rng.integers(100, 4000, 20_000).tolist()
    log = frame([(int(i), "view", n % 7) for n, i in enumerate(heavy + light)] + [(1, "like", 0), (None, "view", 0)], "item_id int, event_type string, day int")
    items = frame([(n, f"t{n}") for n in range(4000)], "item_id int, title string")
    exact = rows(O.top_viewed(log, items, 5), "title", "views")
    days = O.view_sketches(log, F.col("day"), tracked=600)
    got = rows(O.top_viewed_sketch(days, items, 5, tracked=600, most=50), "title", "views")
    assert days.count() == 7 and {t for t, _ in got} == {t for t, _ in exact}
    bound = 3.5 / 600 * (len(heavy) + len(light))
    assert all(abs(v - dict(exact)[t]) <= bound for t, v in got)
    assert rows(O.top_viewed_sketch(O.view_sketches(log, F.col("day")), items, 5)) == rows(O.top_viewed(log, items, 5))
