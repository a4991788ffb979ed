"""Deterministic splits and samples.

Pseudo-random order = ``md5(cast(id as string) || salt)`` (salt "-42" mirrors
seed 42), identical in Spark and in SQL engines, so splits are reproducible
and checkable.

Exact ranks without a single-partition window
---------------------------------------------
``row_number() over (partition by class order by h)`` puts a whole class in one
task. Instead rows are spread over 65,536 buckets by the first 4 hex digits of
the hash (uniform by construction, whatever the key skew): one grouped count
per (class, bucket) -- at most classes x 65,536 rows, broadcast while the classes
are few -- gives each bucket's offset; the rank is offset + row_number inside
the bucket, a window over tiny partitions spread across all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = "-42"          # fixed value: seed 42
BUCKET_HEX = 4        # 16^4 = 65,536 rank buckets
MAX_GROUPS = 16       # with more groups than this the bucket offsets are joined, not broadcast


def hash_order(key: str, salt: str = SALT) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))


def exact_rank(df: DataFrame, key: str, by: list[str] | None = None, salt: str = SALT,
               rank_col: str = "rank", size_col: str = "group_size") -> DataFrame:
    """Add the 1-based rank of each row inside its ``by`` group in hash order,
    and the group's size. Ties on the hash are broken by the key."""
    by = list(by or [])
    h = hash_order(key, salt)
    tmp = df.withColumn("_h", h).withColumn(
        "_b", F.conv(F.substring("_h", 1, BUCKET_HEX), 16, 10).cast("int"))
    counts = tmp.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*by).orderBy("_b")
    offsets = counts.select(
        *by, "_b",
        (F.sum("_c").over(wb.rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*by)).alias(size_col))
    offsets = offsets.fillna(0, subset=["_off"])
    # groups x 65,536 rows of three numbers: sent to every task only if the groups are few
    few = not by or df.select(*by).distinct().limit(MAX_GROUPS + 1).count() <= MAX_GROUPS
    joined = tmp.join(F.broadcast(offsets) if few else offsets, [*by, "_b"])
    wr = Window.partitionBy(*by, "_b").orderBy("_h", key)
    return joined.withColumn(rank_col, F.col("_off") + F.row_number().over(wr)).drop("_h", "_b", "_off")


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.2,
                     salt: str = SALT, col: str = "split") -> DataFrame:
    """G1: per class, the round(test_frac * n_c) rows first in hash order are 'test'."""
    r = exact_rank(df, key, [label], salt)
    cut = F.round(F.col("group_size") * test_frac)
    return r.withColumn(col, F.when(F.col("rank") <= cut, "test").otherwise("train")).drop("rank", "group_size")


def stratified_sample(df: DataFrame, key: str, label: str, frac: float, salt: str = SALT) -> DataFrame:
    """Exact per-class share ``frac`` (first rows in hash order)."""
    r = exact_rank(df, key, [label], salt)
    return r.where(F.col("rank") <= F.round(F.col("group_size") * frac)).drop("rank", "group_size")


def uniform_sample(df: DataFrame, key: str, n: int, salt: str = SALT) -> DataFrame:
    """N rows without replacement = the n smallest hashes (TakeOrdered:
    each task keeps its n best, the driver merges tasks x n rows)."""
    return df.withColumn("_h", hash_order(key, salt)).orderBy("_h", key).limit(n).drop("_h")


def kfold(df: DataFrame, key: str, label: str, k: int, salt: str = SALT, col: str = "fold") -> DataFrame:
    """Stratified folds: fold = (rank in class - 1) mod k."""
    r = exact_rank(df, key, [label], salt)
    return r.withColumn(col, ((F.col("rank") - 1) % k).cast("int")).drop("rank", "group_size")


def tail_indicator(df: DataFrame, key: str, frac: float = 0.15, salt: str = SALT,
                   col: str = "is_validation") -> DataFrame:
    """The last ``frac`` of rows in (shuffled) position order is validation."""
    r = exact_rank(df, key, [], salt)
    n_val = F.floor(F.col("group_size") * frac)  # python slicing int(n * frac)
    return r.withColumn(col, F.col("rank") > F.col("group_size") - n_val).drop("rank", "group_size")


def position_windows(df: DataFrame, key: str, n_windows: int = 4, salt: str = SALT,
                     col: str = "window") -> DataFrame:
    """Consecutive chunks of n // n_windows rows; the remainder is dropped."""
    r = exact_rank(df, key, [], salt)
    chunk = F.floor(F.col("group_size") / n_windows)
    # fewer rows than windows: no chunk has a row, so nothing is left
    w = F.floor(F.try_divide(F.col("rank") - 1, chunk)).cast("int")
    return r.withColumn(col, w).where(F.col(col) < n_windows).drop("rank", "group_size")


def undersample(df: DataFrame, key: str, label: str, ratio: float = 2.0, majority: int = 0,
                salt: str = SALT) -> DataFrame:
    """H3: keep all minority rows and the first ratio x n_minority majority rows."""
    n_min = df.where(F.col(label) != majority).agg(F.count(F.lit(1)).alias("_m"))
    r = exact_rank(df.where(F.col(label) == majority), key, [], salt)
    kept = r.crossJoin(F.broadcast(n_min)).where(F.col("rank") <= F.col("_m") * ratio)
    return df.where(F.col(label) != majority).unionByName(kept.drop("rank", "group_size", "_m"))
