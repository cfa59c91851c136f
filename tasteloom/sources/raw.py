"""Raw JSON sources: reviews and item metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom import schema
from tasteloom.config import DEFAULTS
from tasteloom.functions.scalars import clean_price, is_recent, leaf_category, nan_to_null, pick_image
from tasteloom.operators.ordering import first_per_group


_BAD = "_corrupt_record"


def _raw_lines(spark: SparkSession, path: str | Sequence[str], columns: T.StructType) -> DataFrame:
    """Every field as text, so no field of another JSON type costs the record; lines that are
    no JSON object are in ``_corrupt_record``."""
    paths = [path] if isinstance(path, str) else list(path)
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in columns), T.StructField(_BAD, T.StringType())])
    return spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).json(paths)


def _typed(name: str, kind: T.DataType) -> Column:
    """A raw field as its declared type, null where it cannot be one."""
    raw = F.col(name)
    if isinstance(kind, T.LongType):  # 1700000000000.0 is a whole number too
        number = raw.try_cast("double")
        return F.coalesce(raw.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
    if isinstance(kind, T.ArrayType):  # a single value is a list of one
        return F.when(F.startswith(F.ltrim(raw), F.lit("[")), F.from_json(raw, kind)).otherwise(
            F.when(raw.isNotNull() & (raw != ""), F.array(raw)))
    return raw if isinstance(kind, T.StringType) else raw.try_cast(kind)


def read_jsonl(spark: SparkSession, path: str | Sequence[str], columns: T.StructType) -> DataFrame:
    """JSON lines with a declared schema: no inference pass, blank lines are skipped.

    A record is kept whatever the types of its fields: each is cast by itself and is
    null where that fails. ``read_rejects`` shows what was lost.
    """
    return _records(spark, path, columns)


def _records(spark: SparkSession, path: str | Sequence[str], columns: T.StructType, *more: Column) -> DataFrame:
    raw = _raw_lines(spark, path, columns).where(F.col(_BAD).isNull())
    return raw.select(*(_typed(f.name, f.dataType).alias(f.name) for f in columns), *more)


def read_rejects(spark: SparkSession, path: str | Sequence[str], columns: T.StructType) -> DataFrame:
    """What ``read_jsonl`` could not use, as (field, raw): fields that do not fit their type,
    and under a null field the lines that are no JSON object."""
    lost = [F.struct(F.lit(f.name).alias("field"), F.col(f.name).alias("raw"),
                     (F.col(f.name).isNotNull() & _typed(f.name, f.dataType).isNull()).alias("bad")) for f in columns]
    line = F.struct(F.lit(None).cast("string").alias("field"), F.col(_BAD).alias("raw"), F.col(_BAD).isNotNull().alias("bad"))
    return _raw_lines(spark, path, columns).select(F.inline(F.array(*lost, line))).where("bad").select("field", "raw")


def read_reviews(spark: SparkSession, path: str | Sequence[str], from_year: int = DEFAULTS.recent_from_year,
                 limit: int | None = None) -> DataFrame:
    """Interactions from raw reviews: recent rows only, the item is the parent item.
    ``limit`` counts kept rows (a dry-run option)."""
    raw = read_jsonl(spark, path, schema.RAW_REVIEWS)
    kept = raw.where(is_recent("timestamp", from_year)).select(
        "user_id", F.col("parent_asin").alias("item_id"), "rating", F.col("timestamp").alias("ts")
    )
    return kept.limit(limit) if limit else kept


def chunk_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate parts by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def clean_meta(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("parent_asin").alias("item_id"),
        "title",
        pick_image("images").alias("image_url"),
        leaf_category("categories", "main_category").alias("category"),
        F.col("store").alias("brand"),
        clean_price("price").alias("price"),
        nan_to_null("average_rating").alias("avg_rating"),
    )


def read_meta(spark: SparkSession, path: str | Sequence[str], needed: DataFrame | None = None,
              scan_cap: int | None = None) -> DataFrame:
    """Metadata of the needed items; the first record of an item in file order wins.

    Records are filtered by a semi join on the needed ids before anything is parsed.
    """
    raw = _records(
        spark, path, schema.RAW_META,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    if scan_cap:
        raw = raw.limit(scan_cap)
    if needed is not None:
        ids = needed.select(F.col("item_id").cast("string").alias("parent_asin"))
        raw = raw.join(ids, "parent_asin", "left_semi")
    return clean_meta(first_per_group(raw, ["parent_asin"], ["_file", "_block", "_line"]))
