"""Batch plans: the offline dataset build and the recommendation feed of all users."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.config import DEFAULTS, Settings
from tasteloom.functions.scalars import model_label
from tasteloom.operators import diversity as D
from tasteloom.operators.features import FeatureStore, featurize
from tasteloom.operators.histories import mean_pool, user_history
from tasteloom.operators.ranker import LambdaMart, rerank
from tasteloom.operators.retrieval import topn_inner_product, vector_dim
from tasteloom.operators.splitting import time_split
from tasteloom.operators.subsample import subsample
from tasteloom.operators.towers import Weights, apply_tower
from tasteloom.session import write_stage
from tasteloom.sources.tables import Artifacts


def build_dataset(reviews: DataFrame, opts: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Subsample once, then cut by time."""
    core = write_stage(subsample(reviews, opts.kcore_user, opts.kcore_item, opts.max_interactions), "dataset")
    return time_split(core, opts.val_quantile, opts.test_quantile)


@dataclass(frozen=True)
class FeedModels:
    """What the feed may use; missing parts degrade it to retrieval or popularity."""

    popularity: DataFrame                      # (pop_rank, item_id)
    vectors: DataFrame | None = None           # (item_id, vec)
    user_tower: Callable[[DataFrame], DataFrame] | None = None  # history -> (user_id, vec)
    ranker: LambdaMart | None = None
    store: FeatureStore | None = None

    @property
    def label(self) -> str:
        if self.vectors is None:
            return "Popular right now"
        return "Two-tower + ranker" if self.ranker and self.store else "Two-tower"


def feed_models(found: Artifacts) -> FeedModels:
    """What a set of saved artifacts allows: ranker, retriever or popularity.

    With tower weights and item embeddings users are queried through the user tower,
    without them by the mean of their items' vectors.
    """
    popularity = found.get("popularity")
    if popularity is None:
        raise ValueError("the artifact set has no popularity table, the last resort of every feed")
    vectors, ranker, store, tower = found.get("item_vectors"), None, None, None
    if found.stage == "ranker":
        ranker = LambdaMart.from_table(found.get("ranker_trees"))
        constants = found.get("feature_constants").first()
        store = FeatureStore(found.get("user_features"), found.get("item_features"), constants["global_avg_rating"], constants["now_ts"])
    weights, embeddings = found.get("tower_weights"), found.get("item_embeddings")
    if vectors is not None and weights is not None and embeddings is not None:
        towers = Weights.from_table(weights)

        def tower(history: DataFrame) -> DataFrame:
            return apply_tower(mean_pool(history, embeddings, towers.dim), "user_id", towers, "user")

    return FeedModels(popularity, vectors, tower, ranker, store)


def recommend_batch(
    users: DataFrame,
    log: DataFrame,
    items: DataFrame,
    models: FeedModels,
    n: int = 10,
    temperature: float = 1.0,
    seed: int = DEFAULTS.seed,
    mmr_lambda: float = 1.0,
    opts: Settings = DEFAULTS,
) -> DataFrame:
    """Feed of every user: (user_id, rank, item_id, model_label, reason).

    History -> user vector -> top candidates -> ranker -> MMR -> sample of 2n -> brand
    cap to n -> reasons. Users without a vector get the popularity feed.
    """
    wanted = users.select("user_id").distinct()
    history = write_stage(
        user_history(log.join(wanted, "user_id", "left_semi"), opts.max_history), "history"
    )
    vectors = models.vectors
    if vectors is None:
        cold, picked = wanted, None
    else:
        to_vector = models.user_tower or (lambda h: mean_pool(h, vectors, vector_dim(vectors)))
        queries = write_stage(to_vector(history), "queries")
        cands = topn_inner_product(queries, vectors, opts.candidates, normalize=True, opts=opts)
        if models.ranker and models.store:
            pairs = cands.select("user_id", "item_id", F.col("score").alias("retriever_score"))
            cands = rerank(models.ranker.score(featurize(pairs, models.store)), k=opts.candidates)
        if mmr_lambda < 0.999:
            cands = D.mmr_rerank(cands, vectors, opts.candidates, [mmr_lambda]).drop("lambda")
        picked = D.temperature_sample(cands.select("user_id", "item_id", "rank"), 2 * n, temperature, seed).withColumn(
            "model_label", model_label(models.label, mmr_lambda)
        )
        cold = wanted.join(queries.select("user_id"), "user_id", "left_anti")
    # the popularity fallback is sampled but, inside the feed, never re-ranked by MMR
    popular = D.popular_feed(cold, models.popularity, vectors, 2 * n, temperature, seed).withColumn(
        "model_label", F.lit("Popular right now")
    )
    columns = ["user_id", "item_id", "rank", "model_label"]
    lists = popular.select(*columns) if picked is None else picked.select(*columns).unionByName(popular.select(*columns))
    meta = items.select("item_id", "brand", "category")
    capped = D.brand_cap(lists.join(meta, "item_id", "left"), n)
    return D.attach_reasons(capped, history, items).select("user_id", "rank", "item_id", "model_label", "reason")


def grid_search(configs: list[dict], fit: Callable[[dict], float], spark) -> DataFrame:
    """Score each configuration with ``fit`` (a Spark job returning validation recall),
    best first."""
    rows = [(str(dict(sorted(c.items()))), float(fit(c))) for c in configs]
    return spark.createDataFrame(rows, "config string, val_recall_20 double").orderBy(F.desc("val_recall_20"), "config")
