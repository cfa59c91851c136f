"""Order-dependent operators that never put an unbounded group into one task.

A plain ``row_number() over (partition by user ...)`` sends all rows of a user to
one task. Here rows are range-partitioned by (group, order), so a hot group spans
many tasks; positions and running sums are completed with per-partition offsets,
of which there are only as many as shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.session import write_stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_ROW_MASK = (1 << _ROW_BITS) - 1


def _columns(names: Sequence[Column | str]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    keys = _columns(order)
    return write_stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_m", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_m", _ROW_BITS))


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """0-based position of every row in the total order."""
    staged = _numbered(df, order)
    sizes = staged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        staged.join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumn(name, F.col("_offset") + F.col("_m").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_part", "_m", "_offset")
    )


def group_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "pos"
) -> DataFrame:
    """0-based position inside each group; group columns must not be null."""
    indexed = global_index(df, [*group, *order], "_idx")
    starts = indexed.groupBy(*group).agg(F.min("_idx").alias("_start"))
    return (
        indexed.join(starts, list(group))
        .withColumn(name, F.col("_idx") - F.col("_start"))
        .drop("_idx", "_start")
    )


def group_running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    sums: dict[str, Column],
) -> DataFrame:
    """Inclusive running sums of integer columns inside each group.

    The sum runs over the whole total order; the value reached just before a
    group starts is then subtracted.
    """
    flags = {name: f"_flag_{n}" for n, name in enumerate(sums)}
    staged = _numbered(
        df.withColumns({flags[n]: c.cast("bigint") for n, c in sums.items()}), [*group, *order]
    )
    totals = staged.groupBy("_part").agg(*(F.sum(f).alias(f"_t{f}") for f in flags.values()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        *(F.coalesce(F.sum(f"_t{f}").over(before), F.lit(0)).alias(f"_o{f}") for f in flags.values()),
    )
    inside = Window.partitionBy("_part").orderBy("_m")
    scanned = staged.join(F.broadcast(offsets), "_part").withColumns(
        {f"_s{f}": F.col(f"_o{f}") + F.sum(f).over(inside) for f in flags.values()}
    )
    starts = scanned.groupBy(*group).agg(
        *(F.min(F.col(f"_s{f}") - F.col(f)).alias(f"_b{f}") for f in flags.values())
    )
    keep = df.columns
    return scanned.join(starts, list(group)).select(
        *keep, *((F.col(f"_s{f}") - F.col(f"_b{f}")).alias(name) for name, f in flags.items())
    )


def unseen_at(wanted: DataFrame, seen: DataFrame, user: str) -> DataFrame:
    """The ``at``-th code (from 0) that each user has not seen, as int column ``i`` beside the columns of ``wanted``.

    ``seen`` holds distinct (user, i). With c the user's sorted seen codes, the code is
    ``at`` plus the number of codes with c - position <= at. Codes and wanted ranks are
    merged in one ordered scan, so they are never paired.
    """
    gaps = group_positions(seen, [user], ["i"], "_pos").select(user, (F.col("i") - F.col("_pos")).cast("bigint").alias("at"))
    merged = gaps.withColumn("_want", F.lit(0)).unionByName(
        wanted.withColumn("_want", F.lit(1)), allowMissingColumns=True)
    counted = group_running_sum(merged, [user], ["at", "_want"], {"_below": F.col("_want") == 0})
    return counted.where(F.col("_want") == 1).withColumn("i", (F.col("at") + F.col("_below")).cast("int")).drop(
        "_want", "_below")


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int = 1,
                    rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group. Spark's window group limit keeps at most ``n``
    rows of a group per map task before the shuffle, so hot groups stay small."""
    w = Window.partitionBy(*group).orderBy(*_columns(order))
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")


# ---------------------------------------------------------------- order statistics
@dataclass
class _Target:
    low: int
    high: int
    rank: int  # rank inside [low, high]
    value: int | None = None


_BINS = 1 << 14


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int],
                     bounds: tuple[int, int] | None = None) -> list[int]:
    """Exact values at 0-based ranks of an integer column, by histogram refinement.

    Every pass is one partially aggregated histogram of at most ``_BINS`` bins per
    open interval; the driver sees only bin counts. Nothing is sorted.
    """
    data = df.select(F.col(column).cast("bigint").alias("v")).where(F.col("v").isNotNull())
    low, high = bounds or data.agg(F.min("v"), F.max("v")).first()
    if low is None:
        raise ValueError(f"no values in {column}")
    targets = [_Target(low, high, int(r)) for r in ranks]
    while any(t.value is None for t in targets):
        intervals = sorted({(t.low, t.high) for t in targets if t.value is None})
        which, offset = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for n, (lo, hi) in enumerate(intervals):
            width = (hi - lo) // _BINS + 1
            inside = F.col("v").between(lo, hi)
            which = F.when(inside, F.lit(n)).otherwise(which)
            offset = F.when(inside, F.floor((F.col("v") - lo) / width).cast("bigint")).otherwise(offset)
        bins = (
            data.select("v", which.alias("interval"), offset.alias("bin"))
            .where(F.col("interval").isNotNull())
            .groupBy("interval", "bin")
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        histogram: dict[int, list] = {}
        for row in sorted(bins, key=lambda r: (r["interval"], r["bin"])):
            histogram.setdefault(row["interval"], []).append(row)
        for t in targets:
            if t.value is not None:
                continue
            for row in histogram[intervals.index((t.low, t.high))]:
                if t.rank < row["n"]:
                    t.low, t.high = row["lo"], row["hi"]
                    break
                t.rank -= row["n"]
            else:
                raise ValueError("rank beyond the number of values")
            if t.low == t.high:
                t.value = t.low
    return [t.value for t in targets]


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Linear-interpolated quantiles of an integer column, exact at any size."""
    n, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if n == 0:
        raise ValueError(f"no values in {column}")
    places = [p * (n - 1) for p in probabilities]
    ranks = [r for p in places for r in (int(p), min(int(p) + 1, n - 1))]
    found = order_statistics(df, column, ranks, (low, high))
    out = []
    for k, p in enumerate(places):
        lo, hi = found[2 * k], found[2 * k + 1]
        out.append(lo + (hi - lo) * (p - int(p)))
    return out
