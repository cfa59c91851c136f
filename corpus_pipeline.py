"""A training corpus from raw documents: five stages, each over all that the one before kept.

Each stage takes the rows written by its predecessor; all but the last return the
columns of ``documents``. Rows are told apart by ``doc_id`` and the hash of their
text, so ids that repeat or are null do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from tasteloom.llm.common import crc_mod, small_batches, table, write_stage
from tasteloom.llm.queries import word_bpe
from tasteloom.session import configure

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _key():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _matching(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` by whether their ``doc_id`` and text are among ``chosen`` (``doc_id, key``)."""
    chosen = chosen.select(F.col("doc_id").alias("c_doc"), F.col("key").alias("c_key"))
    return docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("c_doc")) & (_key() == F.col("c_key")), how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the ordinal model, fitted to the labels, finds toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.grade(docs, model, *COLUMNS).filter(~F.col("toxic")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each exact text, the one with the smallest id."""
    return exact_dedup.keep_first(docs, *COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is connected by similar shingles, the one with the smallest id.

    Of rows that repeat this id and its text one stays. Texts without words, null ones
    too, are in no group, and all stay.
    """
    state = jaccard_join.join(docs).groupBy("doc_id", "key").agg(F.count_if("kept").alias("stay"), F.count("*").alias("n"))
    state = write_stage(state, "near-copies")
    kept = _matching(docs, state.filter("stay = 0"), "left_anti").select(*COLUMNS)
    again = state.filter("stay > 0 AND stay < n")
    if again.isEmpty():
        return kept
    once = _matching(docs, again, "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return _matching(kept, again, "left_anti").select(*COLUMNS).unionByName(once)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return _matching(docs, decontaminate.find(docs, table(spark, sf_dir, "benchmark")), "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the text they decode to: ``doc_id, n_tokens, ids, decoded``."""
    made = bpe.encode(docs, bpe.vocabulary(word_bpe()))
    return made.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_leaks), ("bpe", encode),
]
ORACLE_SQL = None  # the first stage's model has no SQL; tests/llm/test_pipeline.py has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written and read again."""
    configure(spark)
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
