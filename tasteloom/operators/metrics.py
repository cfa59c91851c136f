"""Ranking metrics on long tables.

``recs``: (user_id, item_id, rank) with 1-based rank. ``truth``: distinct
(user_id, item_id). Only hits are aggregated; recommendation lists are never
collected per user.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.config import BUCKET_EDGES, DEFAULTS


def _ideal_gain(k: int):
    """IDCG of min(relevant, k) hits, looked up in a literal array of k values."""
    total, values = 0.0, []
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        values.append(total)
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.least(F.col("n_rel"), F.lit(k)).cast("int"))


def score_users(recs: DataFrame, truth: DataFrame, k_values: Sequence[int],
                users: DataFrame | None = None) -> DataFrame:
    """Per scored user: recall_k and ndcg_k for every k.

    A scored user has ground truth and is in ``users`` (default: has recommendations).
    Recall divides by all relevant items and counts an item once; DCG counts every
    occurrence. Lists repeat themselves so much that their files are a hundred times smaller
    than their rows; the merge hints keep the planner from broadcasting them by file size.
    """
    asked = (users if users is not None else recs).select("user_id").distinct().hint("merge")
    relevant = truth.groupBy("user_id").agg(F.count("*").alias("n_rel"))
    rank = F.col("rank")
    gain = 1.0 / F.log2(rank + 1)
    hits = (
        recs.where(rank <= max(k_values))
        .select("user_id", "item_id", "rank").hint("merge")
        .join(truth, ["user_id", "item_id"])
        .groupBy("user_id", "item_id")
        .agg(
            F.min("rank").alias("first"),
            *(F.sum(F.when(rank <= k, gain).otherwise(0.0)).alias(f"g{k}") for k in k_values),
        )
        .groupBy("user_id")
        .agg(
            *(F.sum((F.col("first") <= k).cast("int")).alias(f"h{k}") for k in k_values),
            *(F.sum(f"g{k}").alias(f"g{k}") for k in k_values),
        )
    )
    scored = relevant.join(asked, "user_id", "left_semi").join(hits, "user_id", "left")
    columns = []
    for k in k_values:
        columns.append((F.coalesce(f"h{k}", F.lit(0)) / F.col("n_rel")).alias(f"recall_{k}"))
        columns.append((F.coalesce(f"g{k}", F.lit(0.0)) / _ideal_gain(k)).alias(f"ndcg_{k}"))
    return scored.select("user_id", "n_rel", *columns)


def catalog_coverage(recs: DataFrame, catalog_size: int, k: int) -> DataFrame:
    """Share of the catalog in anybody's top k (users without ground truth included)."""
    return recs.where(F.col("rank") <= k).agg(
        (F.countDistinct("item_id") / F.lit(float(catalog_size))).alias(f"coverage_{k}")
    )


def evaluate(recs: DataFrame, truth: DataFrame, catalog_size: int,
             k_values: Sequence[int] = DEFAULTS.k_values, method: str = "model",
             users: DataFrame | None = None) -> DataFrame:
    """One row: macro-averaged Recall@k and NDCG@k, Coverage@max(k), scored users."""
    top = max(k_values)
    means = score_users(recs, truth, k_values, users).agg(
        *(F.avg(f"{m}_{k}").alias(f"{m}_{k}") for k in k_values for m in ("recall", "ndcg")),
        F.count("*").alias("n_users_scored"),
    ).withColumn("_one", F.lit(1))
    cover = catalog_coverage(recs, catalog_size, top).withColumn("_one", F.lit(1))
    return means.join(cover, "_one").select(  # one row each
        F.lit(method).alias("method"),
        *(f"{m}_{k}" for k in k_values for m in ("recall", "ndcg")),
        f"coverage_{top}",
        "n_users_scored",
    )


def require_scored(result: DataFrame) -> DataFrame:
    """Raise when nobody could be scored."""
    if (result.agg(F.min("n_users_scored")).first()[0] or 0) == 0:
        raise ValueError("no users with ground-truth positives to score")
    return result


def bucket_label(count, edges=BUCKET_EDGES):
    chain = None
    for low, high in edges:
        test = (count >= low) if high is None else count.between(low, high)
        label = f"{low}-{'+' if high is None else high}"
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise("0")


def activity_buckets(users: DataFrame, train: DataFrame, edges=BUCKET_EDGES) -> DataFrame:
    counts = train.groupBy("user_id").agg(F.count("*").alias("n_train"))
    return users.select("user_id").distinct().join(counts, "user_id", "left").select(
        "user_id", bucket_label(F.coalesce("n_train", F.lit(0)), edges).alias("bucket")
    )


def evaluate_by_bucket(recs: DataFrame, truth: DataFrame, train: DataFrame, k: int = 20,
                       edges=BUCKET_EDGES) -> DataFrame:
    scores = score_users(recs, truth, [k])
    return (
        scores.join(activity_buckets(scores, train, edges), "user_id")
        .groupBy("bucket")
        .agg(
            F.count("*").alias("users"),
            F.avg(f"recall_{k}").alias(f"recall_{k}"),
            F.avg(f"ndcg_{k}").alias(f"ndcg_{k}"),
        )
    )


def merge_buckets(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two bucket tables side by side; only buckets with equal user counts remain."""
    keys = ["bucket", "users"]

    def named(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*keys, *(F.col(c).alias(f"{c}_{suffix}") for c in df.columns if c not in keys))

    return named(left, left_name).join(named(right, right_name), keys)


def comparison_table(*results: DataFrame) -> DataFrame:
    table = results[0]
    for more in results[1:]:
        table = table.unionByName(more)
    return table


def ablation_table(retrieval: DataFrame, ranked: DataFrame) -> DataFrame:
    columns = ["method", "ndcg_10", "coverage_50"]
    return retrieval.select(*columns).unionByName(ranked.select(*columns))
