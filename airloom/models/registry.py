"""Model registry: one row per registered model version, artifacts beside it."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REGISTRY_SCHEMA = ("name string, version int, model_group string, horizon int, algorithm string, "
                   "path string, metrics map<string,double>, features array<string>")


def model_name(model_group: str, horizon: int) -> str:
    return f"aqi_{model_group}_{horizon}h"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{path}/registry")
    except Exception as e:  # nothing registered yet
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], REGISTRY_SCHEMA)
        raise


def register(
    spark: SparkSession, path: str, model_group: str, horizon: int, algorithm: str, artifact: DataFrame,
    metrics: dict[str, float], features: list[str],
) -> int:
    """Save an artifact (a table of coefficients or of tree nodes) as the next version."""
    name = model_name(model_group, horizon)
    known = read_registry(spark, path).filter(F.col("name") == name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    target = f"{path}/artifacts/{name}/version={version}"
    artifact.coalesce(1).write.mode("overwrite").parquet(target)
    row = (name, version, model_group, horizon, algorithm, target,
           {k: float(v) for k, v in metrics.items()}, features)
    spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/registry")
    return version


def latest_models(registry: DataFrame) -> DataFrame:
    """The highest version of every name."""
    row = F.struct(*registry.columns)
    return registry.groupBy("name").agg(F.max_by(row, "version").alias("_row")).select("_row.*")


def list_versions(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Versions with their metrics, newest first within a name."""
    chosen = registry if name is None else registry.filter(F.col("name") == name)
    newest = Window.partitionBy("name").orderBy(F.desc("version"))
    return chosen.withColumn("position", F.row_number().over(newest)).orderBy("name", F.desc("version"))
