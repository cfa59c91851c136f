"""Vector arithmetic on array columns, evaluated JVM-side in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(vec: Column | str) -> Column:
    return (F.col(vec) if isinstance(vec, str) else vec).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_d(a), _d(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(vec: Column | str) -> Column:
    return F.sqrt(F.aggregate(_d(vec), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(vec: Column | str, epsilon: float = 0.0) -> Column:
    """Unit vector. With ``epsilon`` 0 a zero vector is passed through unchanged."""
    v = _d(vec)
    if epsilon:
        size = norm(v) + F.lit(epsilon)
    else:
        size = F.coalesce(F.nullif(norm(v), F.lit(0.0)), F.lit(1.0))
    # one-element transform binds the norm once instead of per component
    return F.element_at(
        F.transform(F.array(size), lambda n: F.transform(v, lambda x: x / n)), 1
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def sum_vectors(vec: Column | str, dim: int) -> Column:
    """Element-wise sum as an aggregate: one partial-aggregated sum per dimension."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.array(*(F.sum(v[i].cast("double")) for i in range(dim)))


def mean_vectors(vec: Column | str, dim: int) -> Column:
    """Element-wise mean: sums share one count, which keeps the aggregation buffer small."""
    total, count = sum_vectors(vec, dim), F.count(vec)
    return F.transform(total, lambda x: x / count)


def append_constant(vec: Column | str, value: Column | float) -> Column:
    tail = value if isinstance(value, Column) else F.lit(float(value))
    return F.concat(_d(vec), F.array(tail.cast("double")))
