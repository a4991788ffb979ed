"""One-to-many roll-ups (D1-D3) and the left-join chain onto the applicant.

Scale notes
-----------
* ``aggregate_table`` is a single ``groupBy(key).agg`` -> partial (map-side) hash
  aggregate, one exchange of per-key buffers, final aggregate. A key holding a
  third of all rows is collapsed map-side before the shuffle, so hot keys cost
  one buffer per task, not one task.
* Every aggregated side is unique on its key, so the later left joins are 1:1
  and cannot explode; they hash-partition on the same key the aggregate already
  produced, so Spark reuses that partitioning (no extra exchange for the agg side).
* Null keys are dropped before grouping (pandas ``groupby`` drops them, Q2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS = ("min", "max", "mean", "sum")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns in schema order (booleans are not numbers here)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def aggregate_table(df: DataFrame, key: str, prefix: str, row_count: bool = False,
                    columns: list[str] | None = None) -> DataFrame:
    """Every numeric column x min/max/mean/sum (+count on the first one)."""
    cols = columns if columns is not None else numeric_columns(df, exclude=[key])
    exprs = rollup_aggregations(df, cols, prefix)
    if row_count:
        exprs.append(F.count(F.lit(1)).alias(f"{prefix}_row_count"))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*exprs)


def rollup_aggregations(df: DataFrame, cols: list[str], prefix: str) -> list:
    """The D1 aggregate expressions (usable inside a larger ``agg``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for i, c in enumerate(cols):
        is_int = isinstance(types[c], T.IntegralType)
        zero = F.lit(0).cast("bigint" if is_int else "double")
        exprs.append(F.min(c).alias(f"{prefix}_{c}_min"))
        exprs.append(F.max(c).alias(f"{prefix}_{c}_max"))
        exprs.append(F.avg(c).alias(f"{prefix}_{c}_mean"))
        exprs.append(F.coalesce(F.sum(c), zero).alias(f"{prefix}_{c}_sum"))
        if i == 0:
            exprs.append(F.count(c).alias(f"{prefix}_{c}_count"))
    return exprs


def left_join_chain(base: DataFrame, key: str, sides: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left-join each (already key-unique) aggregate side onto ``base``.

    Returns the joined frame; the added-column count per side is
    ``len(side.columns) - 1`` and is available from the schemas without a job.
    """
    out = base
    for side, side_key in sides:
        if side_key != key:
            side = side.withColumnRenamed(side_key, key)
        out = out.join(side, on=key, how="left")
    return out
