"""Table scans (A1, A2) and the binding of the credit-risk roles to the test tables.

Every scan goes through ``read_table`` so that NaN is normalised to null for
floating columns (pandas has one missing value; Spark's NaN poisons sum/avg/max).
Column pruning and filter pushdown stay with Catalyst: callers select columns
after the scan and the Parquet reader only materialises what the plan needs.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every float/double column (one projection)."""
    cols = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
            changed = True
        else:
            cols.append(F.col(f.name))
    return df.select(*cols) if changed else df


_SCANS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, normalise: bool = True,
               where: Column | None = None) -> DataFrame:
    """Lazy Parquet scan of one table (memoised per session: DataFrames are
    immutable plans, so reusing one skips repeated file listing and footer reads).

    ``where`` filters twice: on the raw columns, which the scan pushes down, and on the
    normalised ones, which decides (a raw NaN passes some comparisons that null doesn't)."""
    if where is not None:
        raw = read_table(spark, sf_dir, name, False).where(where)
        return nan_to_null(raw).where(where) if normalise else raw
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path, normalise)
    if key not in _SCANS:
        df = spark.read.parquet(path)
        _SCANS[key] = nan_to_null(df) if normalise else df
    return _SCANS[key]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1: CSV scan with header; an explicit schema avoids an inference pass at scale."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def table_registry(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> dict[str, DataFrame]:
    """A2: name -> DataFrame (lazy; nothing is read until an action)."""
    return {n: read_table(spark, sf_dir, n) for n in names}


# ---------------------------------------------------------------------------
# Role binding: the credit-risk pipeline's tables on the test data
# ---------------------------------------------------------------------------

KEY = "c_custkey"          # applicant id (SK_ID_CURR role)
TARGET = "TARGET"          # 1 = default (c_acctbal < 0)


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """application role: one row per customer with a 0/1 TARGET."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        KEY, "c_nationkey", "c_mktsegment",
        (F.col("c_acctbal") < 0).cast("int").alias(TARGET),
    )
