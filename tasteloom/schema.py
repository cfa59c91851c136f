"""Declared schemas of the library's tables and the contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
    "array<float>": T.ArrayType(T.FloatType()), "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _struct(spec: str) -> T.StructType:
    """Nullable columns from "name type, name type"; needs no running session."""
    fields = (part.split(maxsplit=1) for part in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_REVIEWS = _struct("user_id string, parent_asin string, rating double, timestamp bigint")
INTERACTIONS = _struct("user_id string, item_id string, rating double, ts bigint")
ENCODED = _struct("user_id string, item_id string, rating double, ts bigint, u int, i int")
ITEMS = _struct(
    "item_id string, title string, image_url string, category string, "
    "brand string, price double, avg_rating double"
)
EVENT_LOG = _struct("user_id string, item_id string, rating double, ts bigint, event_type string")
USERS = _struct("user_id string, created_at timestamp")
SESSIONS = _struct("token string, user_id string, created_at timestamp")
CART = _struct("user_id string, item_id string, qty bigint, added_at bigint")
WISHLIST = _struct("user_id string, item_id string, added_at bigint")
ORDERS = _struct(
    "order_id bigint, user_id string, item_id string, qty bigint, price double, purchased_at bigint"
)
RECOMMENDATIONS = _struct("user_id string, item_id string, rank int, score double")
ITEM_VECTORS = _struct("item_id string, vec array<float>")
LATENCY_LOG = _struct("latency_ms map<string,double>")
# metric columns follow evaluate(); one row per method
RESULTS = _struct(
    "method string, recall_10 double, ndcg_10 double, recall_20 double, ndcg_20 double, "
    "recall_50 double, ndcg_50 double, coverage_50 double, n_users_scored bigint"
)
# `price` stays a raw string, `images` stays raw JSON: both occur in two layouts
RAW_META = _struct(
    "parent_asin string, title string, images string, categories array<string>, "
    "main_category string, store string, price string, average_rating double"
)


class ContractError(ValueError):
    pass


def assert_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ContractError(f"missing columns {missing}; have {df.columns}")
    return df


def assert_contract(
    df: DataFrame, n_users: int, n_items: int, min_rows: int = 1
) -> DataFrame:
    """Encoded interactions: columns present, enough rows, codes inside the encoders.

    The code ``n`` is the row reserved for unseen ids, so it is allowed.
    """
    assert_columns(df, "user_id", "item_id", "rating", "ts", "u", "i")
    rows, max_u, max_i, min_u, min_i = df.agg(
        F.count("*"), F.max("u"), F.max("i"), F.min("u"), F.min("i")
    ).first()
    if rows < min_rows:
        raise ContractError(f"{rows} rows, expected at least {min_rows}")
    if max_u > n_users or max_i > n_items or min_u < 0 or min_i < 0:
        raise ContractError(f"codes outside encoders: u<={max_u} of {n_users}, i<={max_i} of {n_items}")
    return df
