"""What the corpus operators share: reading the tables, staging rows, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.schema import assert_columns
from tasteloom.session import configure, stage_path, write_stage

__all__ = ["checksum", "crc_mod", "doc_rows", "session_conf", "small_batches", "stage_path", "table", "text_or_empty", "write_stage"]

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(configure(spark))
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches that stay small when texts are long."""
    for key, value in (("maxRecordsPerBatch", "2000"), ("maxBytesPerBatch", str(16 << 20))):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def doc_rows(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as bigint, ``text`` and ``more``; every other column is left behind."""
    assert_columns(docs, "doc_id", "text", *more)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       *(docs[c] for c in more))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_mod(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def checksum(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


class session_conf:
    """Set session options inside a ``with`` block and put the old ones back."""

    def __init__(self, spark: SparkSession, **options: str):
        self.spark, self.options = spark, {k.replace("__", "."): v for k, v in options.items()}

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.options}
        for k, v in self.options.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
