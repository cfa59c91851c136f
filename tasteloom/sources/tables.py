"""Saved tables: splits, encoders, result tables and serving artifacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.functions.scalars import nan_to_null
from tasteloom.operators.ordering import first_per_group

SPLIT_PARTS = ("train", "val", "test", "items")
ARTIFACTS = (
    "popularity", "item_encoder", "item_vectors", "similar_items", "user_features", "item_features",
    "feature_constants", "ranker_trees", "tower_weights",
)
EXTRA_ARTIFACTS = ("item_embeddings",)   # what the user tower pools


def write_split(folder: str, train: DataFrame, val: DataFrame, test: DataFrame, items: DataFrame) -> None:
    for name, df in zip(SPLIT_PARTS, (train, val, test, items)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_split(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in SPLIT_PARTS}


def write_encoders(folder: str, users: DataFrame, items: DataFrame) -> None:
    users.write.mode("overwrite").parquet(f"{folder}/user_encoder")
    items.write.mode("overwrite").parquet(f"{folder}/item_encoder")


def read_encoders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{folder}/user_encoder"), spark.read.parquet(f"{folder}/item_encoder")


# ---------------------------------------------------------------- catalog and log
def upsert_items(existing: DataFrame, new: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Insert rows with unknown ids; known ids keep their row. NaN becomes null.

    Of new rows with one id the first by ``order`` is inserted, then by the other columns.
    """
    floats = [n for n, t in new.dtypes if t in ("double", "float")]
    clean = new.withColumns({n: nan_to_null(n) for n in floats})
    clean = first_per_group(clean, ["item_id"], [*order, *(c for c in clean.columns if c not in order)])
    return existing.unionByName(clean.join(existing.select("item_id"), "item_id", "left_anti").select(*existing.columns))


def append_interactions(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Bulk-load interactions as history; they carry no event type."""
    return log.unionByName(rows.select("user_id", "item_id", "rating", "ts"), allowMissingColumns=True)


def _is_missing(error: AnalysisException) -> bool:
    """Nothing was saved there, as opposed to something that cannot be read."""
    return error.getCondition() == "PATH_NOT_FOUND"


# ---------------------------------------------------------------- result tables
def upsert_result_rows(results: DataFrame, new: DataFrame, key: str = "method") -> DataFrame:
    """Replace the rows of the new methods, keep all others."""
    return results.join(new.select(key), key, "left_anti").select(*results.columns).unionByName(
        new, allowMissingColumns=True
    )


def write_results_csv(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").option("header", True).csv(path)


def read_results_csv(spark: SparkSession, path: str, columns: T.StructType, default: DataFrame | None = None) -> DataFrame:
    """Saved results; ``default`` when nothing was saved yet."""
    try:
        return spark.read.schema(columns).option("header", True).csv(path)
    except AnalysisException as error:
        if default is None or not _is_missing(error):
            raise
        return default


# ---------------------------------------------------------------- artifacts
def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished artifact sets, oldest first."""
    found = _maybe(spark, folder, "manifest")
    return [] if found is None else sorted(r["version"] for r in found.select(F.col("version").cast("bigint")).distinct().collect())


def write_artifacts(folder: str, **tables: DataFrame) -> int:
    """Write the tables as one new set and return its version number.

    The tables go into a folder of their own; the manifest that names them is written
    last, as one file. A set without a manifest, half-written or given up, is never read,
    and readers of an older set are not disturbed. One writer at a time: a second one
    that takes the same number fails at the manifest.
    """
    unknown = set(tables) - set(ARTIFACTS) - set(EXTRA_ARTIFACTS)
    if unknown or not tables:
        raise ValueError(f"unknown artifacts {sorted(unknown)}" if unknown else "no artifacts")
    spark = next(iter(tables.values())).sparkSession
    version = max(versions(spark, folder), default=0) + 1
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/sets/{version}/{name}")
    names = spark.createDataFrame([(n,) for n in sorted(tables)], "artifact string")
    names.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/manifest/version={version}")
    return version


def _maybe(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{folder}/{name}")
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return None


@dataclass(frozen=True)
class Artifacts:
    """Whatever was found; missing tables are absent and degrade the feed."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame | None:
        return self.tables.get(name)

    @property
    def stage(self) -> str:
        """Best feed the tables allow: ranker, retriever or popularity."""
        if "item_vectors" not in self.tables:
            return "popularity"
        needs = {"ranker_trees", "user_features", "item_features", "feature_constants"}
        return "ranker" if needs <= set(self.tables) else "retriever"

    @property
    def model_label(self) -> str:
        return {"ranker": "Two-tower + ranker", "retriever": "Two-tower", "popularity": "Popular right now"}[self.stage]


def load_artifacts(spark: SparkSession, folder: str, version: int | None = None) -> Artifacts:
    """The tables of one set, the newest finished one unless ``version`` is given."""
    known = versions(spark, folder)
    if version is None and not known:
        return Artifacts()
    if version is not None and version not in known:
        raise ValueError(f"no finished artifact set {version}")
    version = known[-1] if version is None else version
    names = [r["artifact"] for r in spark.read.parquet(f"{folder}/manifest/version={version}").collect()]
    return Artifacts({n: spark.read.parquet(f"{folder}/sets/{version}/{n}") for n in names})


def artifact_health(spark: SparkSession, folder: str) -> DataFrame:
    """One row per artifact: present or not, and its row count."""
    found = {n: t for n, t in load_artifacts(spark, folder).tables.items() if n in ARTIFACTS}
    status = spark.createDataFrame([(n, n in found) for n in ARTIFACTS], "artifact string, loaded boolean")
    counts = None
    for name, df in found.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("artifact"), "n_rows")
        counts = row if counts is None else counts.unionByName(row)
    if counts is None:
        return status.withColumn("n_rows", F.lit(None).cast("bigint"))
    return status.join(counts, "artifact", "left")
