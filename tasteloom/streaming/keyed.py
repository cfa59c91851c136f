"""Keyed state of the behaviour loop: carts and login throttling.

State lives in a RocksDB store per partition, so a micro-batch costs what it touches,
whatever the number of carts and users. Rows of one key and micro-batch are folded in
the order of (ts, seq).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SHIFT = 1   # ms added to event times: a watermark begins at 0, which would make an attempt at 0 late
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class rocksdb_state:
    """State stores in RocksDB inside a ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)

    def __exit__(self, *_):
        self.spark.conf.unset(_PROVIDER) if self.before is None else self.spark.conf.set(_PROVIDER, self.before)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(["ts", "seq"], kind="stable")


# ---------------------------------------------------------------- carts
_HOMES = 1024   # keys of the cart state, each with the carts of many users: a key's rows come in one call


class CartLines(StatefulProcessor):
    """The carts of one home: a map of (user, share of the items) to its open lines.

    ``add`` opens a line or counts it up, ``set`` changes an open line and removes it at
    zero or below, ``remove`` removes it, ``checkout`` empties the cart. Only shares that a
    micro-batch has rows of are read, only those it changed are written, and only changed
    lines are passed on.
    """

    def __init__(self, user_kind: str, item_kind: str):
        self.user_kind, self.item_kind = user_kind, item_kind

    def init(self, handle) -> None:
        self.carts = handle.getMapState("carts", f"user_id {self.user_kind}, share int",
                                        f"items array<{self.item_kind}>, qty array<bigint>, added_at array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before: dict = {}
        now: dict = {}
        frame, whole = _in_order(rows), self.item_kind in ("int", "bigint")
        for user, share, item, action, qty, ts in zip(*(frame[c].tolist() for c in ("user_id", "share", "item_id", "action", "qty", "ts"))):
            lines = now.get((user, share))
            if lines is None:
                held = self.carts.getValue((user, share))
                before[user, share] = {i: line for i, *line in zip(*held)} if held else {}
                lines = now[user, share] = dict(before[user, share])
            if action == "checkout":
                lines.clear()
                continue
            item = int(item) if whole else item
            line = lines.get(item)
            if action == "add":
                lines[item] = [line[0] + 1, line[1]] if line else [1, None if pd.isna(ts) else int(ts)]
            elif action == "remove" or (action == "set" and qty <= 0):
                lines.pop(item, None)
            elif action == "set" and line:
                lines[item] = [0 if pd.isna(qty) else int(qty), line[1]]
        made: list = []
        for cart, lines in now.items():
            changed = [i for i in {**before[cart], **lines} if lines.get(i) != before[cart].get(i)]
            if not changed:
                continue
            if lines:
                self.carts.updateValue(cart, (list(lines), [q for q, _ in lines.values()], [t for _, t in lines.values()]))
            else:
                self.carts.removeKey(cart)
            made += [(cart[0], i, *lines.get(i, (0, 0)), i in lines) for i in changed]
        if made:
            yield pd.DataFrame(made, columns=["user_id", "item_id", "qty", "added_at", "open"])

    def close(self) -> None:
        pass


def cart_changes(actions: DataFrame, spread: int = 8) -> DataFrame:
    """Lines (user_id, item_id, qty, added_at, open) that each micro-batch changed, in update mode.

    A user's items are dealt to ``spread`` shares, and a checkout reaches all of them, so
    one user with very many rows is not one task. Shares are dealt to a fixed number of
    homes, as a call costs far more than a row. Lines stay until they are removed. Rows
    without a user, without a known action or, but for checkouts, without an item are
    left out.
    """
    kinds = dict(actions.dtypes)
    known = actions.where(F.col("user_id").isNotNull() & F.coalesce(
        (F.col("action") == "checkout") | (F.col("item_id").isNotNull() & F.col("action").isin("add", "set", "remove")), F.lit(False)))
    every = F.sequence(F.lit(0), F.lit(spread - 1))
    own = F.array(F.pmod(F.xxhash64("item_id"), F.lit(spread)).cast("int"))
    dealt = known.select("user_id", "item_id", "action", F.col("qty").cast("bigint").alias("qty"), "ts", "seq",
                         F.explode(F.when(F.col("action") == "checkout", every).otherwise(own)).alias("share"))
    homed = dealt.withColumn("home", F.pmod(F.xxhash64("user_id", "share"), F.lit(_HOMES)).cast("int"))
    return homed.groupBy("home").transformWithStateInPandas(
        CartLines(kinds["user_id"], kinds["item_id"]),
        f"user_id {kinds['user_id']}, item_id {kinds['item_id']}, qty bigint, added_at bigint, open boolean",
        "Update", "None")


# ---------------------------------------------------------------- login throttle
class LoginFailures(StatefulProcessor):
    """At most ``limit`` recorded failures per user, dropped by a timer once no attempt can count them."""

    def __init__(self, window_ms: int, limit: int):
        self.window_ms, self.limit = window_ms, limit

    def init(self, handle) -> None:
        self.handle = handle
        self.failures = handle.getListState("failures", "ts bigint")

    def _keep(self, times: list[int]) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if times:
            self.failures.put([(t,) for t in times])
            self.handle.registerTimer(min(times) + self.window_ms + 1 + _SHIFT)
        else:
            self.failures.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        recent = [t for (t,) in self.failures.get()] if self.failures.exists() else []
        before = list(recent)
        frame = _in_order(rows)
        blocked = []
        for result, ts in zip(frame["result"], frame["ts"].tolist()):
            recent = [t for t in recent if ts - t <= self.window_ms]
            blocked.append(len(recent) >= self.limit)
            if not blocked[-1]:
                recent = [] if result == "success" else [*recent, ts]
        if recent != before:
            self._keep(recent)
        yield pd.DataFrame({"user_id": key[0], "seq": frame["seq"], "ts": frame["ts"], "result": frame["result"],
                            "blocked": blocked, "forgotten": 0})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() - _SHIFT
        times = [t for (t,) in self.failures.get()]
        kept = [t for t in times if t + self.window_ms >= passed]
        self._keep(kept)
        yield pd.DataFrame({"user_id": [key[0]], "seq": [0], "ts": [passed], "result": [""], "blocked": [False],
                            "forgotten": [len(times) - len(kept)]})

    def close(self) -> None:
        pass


def login_flags(logins: DataFrame, window_s: float = 600, limit: int = 5, delay_s: float = 600) -> DataFrame:
    """``blocked`` of each attempt (user_id, seq, ts, result), in update mode, by event time.

    Rows with ``forgotten`` above 0 are no attempts: they tell how many failures a timer
    dropped for the user, with the watermark as their ``ts``. The watermark trails the
    latest attempt by ``delay_s``; attempts that are later than that are dropped as late.
    Rows without a user or a time are left out.
    """
    kinds = dict(logins.dtypes)
    timed = logins.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select(
        "user_id", "result", "ts", "seq", F.timestamp_millis(F.col("ts") + _SHIFT).alias("at")).withWatermark("at", f"{int(delay_s)} seconds")
    return timed.groupBy("user_id").transformWithStateInPandas(
        LoginFailures(int(window_s * 1000), limit),
        f"user_id {kinds['user_id']}, seq {kinds['seq']}, ts bigint, result string, blocked boolean, forgotten int",
        "Update", "EventTime")
