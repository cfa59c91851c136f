"""Seeded draws as column expressions.

A draw depends only on the seed and the row's keys, so results do not change
with partitioning, retries or lost executors, and any SQL engine with md5 can
reproduce them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 15  # hex digits of the digest: 60 bits
_SPAN = 16**_DIGITS


def draw_int(seed: int | str, *keys: Column | str) -> Column:
    """Uniform integer in [0, 2^60)."""
    parts = [F.lit(str(seed))]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, _DIGITS), 16, 10).cast("bigint")


def draw_unit(seed: int | str, *keys: Column | str) -> Column:
    """Uniform double strictly inside (0, 1)."""
    return (draw_int(seed, *keys).cast("double") + F.lit(0.5)) / F.lit(float(_SPAN))


def draw_below(limit: Column | int, seed: int | str, *keys: Column | str) -> Column:
    """Uniform integer in [0, limit)."""
    bound = limit if isinstance(limit, Column) else F.lit(int(limit))
    return F.pmod(draw_int(seed, *keys), bound.cast("bigint"))


def unit_draw(seed: int | str, *keys) -> float:
    """``draw_unit`` of one row, outside Spark."""
    digest = hashlib.md5("|".join(map(str, (seed, *keys))).encode()).hexdigest()
    return (int(digest[:_DIGITS], 16) + 0.5) / _SPAN
