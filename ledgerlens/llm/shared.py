"""Written tables in the shared folder, and small helpers of the operators."""

from __future__ import annotations

import uuid

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only a local session
    without that setting gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage
    ends there and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, or that with more underscores, so that no column begins with it."""
    while any(c.startswith(prefix) for c in columns):
        prefix = f"_{prefix}"
    return prefix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))
