"""Exact deduplication with a stateful stream.

The keyed state (RocksDB on the executors' disks, copied to the shared folder)
has one entry per digest and no expiry: the smallest document id, the locator of
that document's content in the content store, and the number of rows seen. A
later run of the same stream, with the same folders, goes on from that state.
Rows that hit an entry another row made are compared with the located content,
byte for byte; a digest that two contents share is taken apart by content.

Streaming aggregation combines equal digests before the shuffle, so a content
that makes up a third of all rows costs one state update per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm.common import SPACE, doc_rows, session_conf, stage_path, text_or_empty, write_stage

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = {
    "spark__sql__streaming__stateStore__providerClass": _ROCKSDB,
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
    "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",  # many small stores
    "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
    "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "256",
}
_LAST = 2**63 - 1  # rank of a null id: after every other


def normalised(column: str = "text") -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def content_store(docs: DataFrame, digest=sha256_hex, *more: str) -> DataFrame:
    """Rows as the stream reads them: ``row_id`` (the locator), ``doc_id``, ``text``, ``digest`` and ``more``."""
    rows = doc_rows(docs, *more).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text",
                                        digest(normalised()).alias("digest"), *more)
    path = stage_path(docs.sparkSession, "dedup-content")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def advance_state(spark: SparkSession, source: str, checkpoint: str, bytes_per_trigger: int = 64 << 30,
                  files_per_trigger: int | None = None) -> None:
    """Take the content files of ``source`` that ``checkpoint`` has not seen into the keyed state."""
    stream = spark.readStream.schema("row_id bigint, doc_id bigint, digest string")
    stream = stream.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else \
        stream.option("maxBytesPerTrigger", bytes_per_trigger)
    order = F.coalesce("doc_id", F.lit(_LAST))
    entries = stream.parquet(source).groupBy("digest").agg(
        F.min(order).alias("first_id"), F.min_by("row_id", order).alias("locator"), F.count("*").alias("rows"))
    with session_conf(spark, **_STATE_CONF):
        query = (entries.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``digest, first_id, locator, group_size``: the keyed state as a table."""
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["value"].dataType.fieldNames()
    first, locator, size = names[0], names[1], names[-1]
    return state.select("key.digest", F.col(f"value.`{first}`").alias("first_id"),
                        F.col(f"value.`{locator}`").alias("locator"), F.col(f"value.`{size}`").alias("group_size"))


_DECISION = ("row_id", "doc_id", "digest", "first_id", "locator", "group_size")


def _grouped_by_content(rows: DataFrame) -> DataFrame:
    """Groups of rows whose digest stands for several contents, by the content itself."""
    rows = rows.select("row_id", "doc_id", "digest", normalised().alias("content"))
    order = F.coalesce("doc_id", F.lit(_LAST))
    groups = rows.groupBy("digest", "content").agg(
        F.min(order).alias("first_id"), F.min_by("row_id", order).alias("locator"), F.count("*").alias("group_size"))
    return rows.join(groups, ["digest", "content"]).select(*_DECISION)


def _decide(store: DataFrame, files_per_trigger: int | None) -> DataFrame:
    """For each row of the content store: the group it is in, by digest and verified content."""
    spark, source = store.sparkSession, store.inputFiles()
    checkpoint = stage_path(spark, "dedup-state")
    advance_state(spark, source[0].rsplit("/", 1)[0], checkpoint, files_per_trigger=files_per_trigger)
    state = write_stage(read_state(spark, checkpoint), "dedup-entries")
    hits = state.filter("group_size > 1").select("digest", "locator")
    # rows of shared digests only, then each against the content at its digest's locator
    doubtful = store.select("row_id", "digest", "text").join(hits, "digest").withColumn("content", normalised())
    doubtful = write_stage(doubtful.select("row_id", "digest", "locator", "content"), "dedup-hits")
    kept = doubtful.filter("row_id = locator").select("digest", F.col("content").alias("kept_content"))
    unequal = doubtful.select("digest", "content").join(kept, "digest").filter(
        F.col("content") != F.col("kept_content")).select("digest").distinct()
    rows = store.select("row_id", "doc_id", "digest").join(state, "digest").select(*_DECISION)
    if unequal.limit(1).collect():
        shared = write_stage(unequal, "dedup-collisions")
        rows = rows.join(shared, "digest", "left_anti").unionByName(
            _grouped_by_content(store.join(shared, "digest", "left_semi")))
    return rows


def deduplicate(docs: DataFrame, digest=sha256_hex, files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows with equal text (see :func:`normalised`) the one with the smallest
    ``doc_id`` is kept; a null id counts as the largest, and among rows that
    repeat an id exactly one is kept. Null and empty texts are equal texts. An
    empty table gives an empty result. Other columns, whatever their names, are
    ignored. ``digest`` maps a content column to the key of the state.
    """
    store = content_store(docs, digest)
    if not store.inputFiles():
        return store.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                            F.lit(True).alias("kept"), F.col("digest").cast("string").alias("text_sha256"))
    rows, sha = _decide(store, files_per_trigger), F.col("digest")
    if digest is not sha256_hex:  # the reported checksum stays that of the content
        rows = rows.join(store.select("row_id", sha256_hex(normalised()).alias("sha")), "row_id")
        sha = F.col("sha")
    return rows.select("doc_id", F.when(F.col("first_id") != _LAST, F.col("first_id")).alias("keep_id"), "group_size",
                       (F.col("row_id") == F.col("locator")).alias("kept"), sha.alias("text_sha256"))


def keep_first(docs: DataFrame, *columns: str, files_per_trigger: int | None = None) -> DataFrame:
    """``columns`` of the rows of ``docs`` that :func:`deduplicate` keeps, one of each text; all columns by default."""
    columns = columns or tuple(docs.columns)
    store = content_store(docs, sha256_hex, *(c for c in columns if c not in ("doc_id", "text")))
    if store.inputFiles():
        kept = _decide(store, files_per_trigger).filter("row_id = locator").select("row_id")
        store = store.join(kept, "row_id", "left_semi")
    return store.select(*columns)
