"""A bounded sample of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, where: Column, most: int) -> DataFrame:
    """``doc_id, text, y`` of about ``most`` labelled rows, ``2 * most`` never exceeded; drawn by a hash of the id.

    ``where`` is over ``doc_id``. Labels that are null or name no document are left
    out, a label given twice counts once.
    """
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels[label].cast("int").alias("y"))
    known = known.filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & where).distinct()
    rows = known.count()
    draw = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 30))
    drawn = known.filter(draw < int((1 << 30) * min(1.0, most / max(rows, 1)))).limit(2 * most)  # the limit only bounds
    texts = doc_rows(docs).filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "y")
