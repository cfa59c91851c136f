"""Per-user candidate lists packed into one row, for list-wise kernels.

Lists come from top-N operators, so their length is the caller's retrieval depth;
``max_list`` checks that bound where the caller knows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pack_lists(df: DataFrame, user: str, order: str, columns: Sequence[str], max_list: int | None = None) -> DataFrame:
    """One row per user with aligned arrays, sorted by ``order`` ascending."""
    packed = df.groupBy(user).agg(F.sort_array(F.collect_list(F.struct(order, *columns))).alias("_l"))
    if max_list is None:
        return packed.select(user, *(F.col("_l")[c].alias(c) for c in [order, *columns]))
    checked = F.when(F.size("_l") <= max_list, F.col("_l")).otherwise(
        F.raise_error(F.lit(f"a list is longer than {max_list}; bound it with a top-N first")).cast(
            packed.schema["_l"].dataType
        )
    )
    packed = packed.withColumn("_l", checked)
    return packed.select(user, *(F.col("_l")[c].alias(c) for c in [order, *columns]))
