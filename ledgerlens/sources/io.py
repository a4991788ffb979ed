"""Sinks and round trips.

Everything is written under the session's shared checkpoint folder (or a path
the caller gives), never to a machine-local temp folder; reads use explicit
schemas so no inference pass runs over the written data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path


def run_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_csv(df: DataFrame, path: str) -> str:
    """A4/A5: CSV with header (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV scan with an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


META_SCHEMA = ("model_name string, feature_cols array<string>, optimal_threshold double, n_features int, "
               "classes array<int>, class_labels map<string,string>, primary_metric string, secondary_metric string")


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines (nested arrays / maps kept)."""
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: str = META_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_runs(runs: DataFrame, path: str) -> DataFrame:
    """A10: append run rows to a Parquet run table and read the table back."""
    runs.write.mode("append").parquet(path)
    return runs.sparkSession.read.parquet(path)


def best_run(runs: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """A10: top-1 run by the metric (name breaks ties; runs without a model excluded)."""
    return (runs.where(F.col("has_model")).orderBy(F.desc(metric), "model").limit(1))


def save_model(model, path: str) -> str:
    """Spark ML persistence (metadata + Parquet data), overwrite."""
    model.write().overwrite().save(path)
    return path


def reload_check(original, loaded, df: DataFrame, key: str, score) -> DataFrame:
    """Score the same rows with the original and the reloaded model; the
    anti-join of (key, score) pairs must be empty."""
    a = score(original, df).select(key, F.col("score").alias("s"))
    b = score(loaded, df).select(key, F.col("score").alias("s"))
    diff = a.join(b, [key, "s"], "left_anti")
    return a.agg(F.count(F.lit(1)).alias("n_checked")).crossJoin(  # one row x one row
        diff.agg(F.count(F.lit(1)).alias("n_mismatch")))
