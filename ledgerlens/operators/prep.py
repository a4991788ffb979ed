"""Cleaning / preprocessing: fit on training rows -> params DataFrame -> apply
(SURVEY 2.F, A11).

Every fit is ONE aggregate job over the long form (column_name, value), whose
result has one row per column (bounded by the schema width); the driver reads
that small result to build the next static projection. Applying the fitted
parameters is a single projection (no shuffle).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import stats as S
from ledgerlens.operators.profile import to_long
from ledgerlens.operators.rollup import numeric_columns
from ledgerlens.session import materialize

ID_PATTERNS = ("key", "_id")     # fixed values: identifier-like column names (the SK_ID rule)
NULL_DROP_PCT = 60.0             # fixed value
SKEW_MEDIAN = 1.0                # fixed value: |skew| above -> median impute
SKEW_LOG = 2.0                   # fixed value: |skew| above (and min >= 0) -> log1p
CARD_ONEHOT = 10                 # fixed value: fewer distinct values -> one-hot
IQR_K = 1.5                      # fixed value
CAP_COLUMNS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
               "DAYS_EMPLOYED", "CNT_FAM_MEMBERS", "CNT_CHILDREN", "AMT_REQ_CREDIT_BUREAU_YEAR"]  # fixed values
NAME_CHARS = r"[\[\]\{\}\:\,]"   # fixed value: characters replaced by "_" in feature names
MISSING = "Missing"              # fixed value


def rows_for_fit(df: DataFrame, fit_on: str, split_col: str = "split") -> DataFrame:
    """Training rows by default; ``fit_on='all'`` reproduces fitting on every row."""
    if fit_on == "all" or split_col not in df.columns:
        return df
    return df.where(F.col(split_col) == "train")


# --------------------------------------------------------------------------- F1-F3

def column_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """One pass: per column the null count, the row count and whether the column
    is constant (non-null distinct count <= 1: min = max, or all null).

    Long form: numeric columns unpivot as double, the others as string, so the
    aggregate has three functions whatever the width (and each column's final
    aggregate runs on its own reducer)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], T.NumericType)]
    other = [c for c in cols if c not in num]
    parts = []
    if num:
        parts.append(df.select(*[F.col(c).cast("double").alias(c) for c in num]).unpivot(
            [], num, "column_name", "v"))
    if other:
        parts.append(df.select(*[F.col(c).cast("string").alias(c) for c in other]).unpivot(
            [], other, "column_name", "v").select("column_name", F.col("v")))
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(F.col("v").isNull()).alias("null_count"),
            (F.min("v").isNull() | (F.min("v") == F.max("v"))).alias("constant")]
    out = [p.groupBy("column_name").agg(*aggs) for p in parts]
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def drop_plan(df: DataFrame, key: str, target: str, id_patterns=ID_PATTERNS,
              null_pct: float = NULL_DROP_PCT) -> DataFrame:
    """(column_name, reason) of the columns to drop: constant (non-null
    distinct count <= 1, i.e. min = max or all null), identifier-like names,
    then more than ``null_pct`` % nulls among the rest."""
    cols = [c for c in df.columns if c not in (key, target)]
    st = column_stats(df, cols)
    name = F.lower(F.col("column_name"))
    is_id = None
    for p in id_patterns:
        cond = name.contains(p)
        is_id = cond if is_id is None else (is_id | cond)
    const = F.col("constant")
    pct = F.col("null_count") * 100.0 / F.col("_n")
    reason = (F.when(const, "constant").when(is_id, "id_pattern").when(pct > null_pct, "high_null"))
    return st.select("column_name", reason.alias("reason"), S.fround(pct).alias("null_pct")).where(
        F.col("reason").isNotNull())


def apply_drop(df: DataFrame, plan: DataFrame) -> DataFrame:
    names = [r["column_name"] for r in plan.select("column_name").collect()]  # <= schema width
    return df.drop(*names)


# --------------------------------------------------------------------------- F4-F7

def impute_params(df: DataFrame, cols: list[str], fit_on: str = "train",
                  skew_threshold: float = SKEW_MEDIAN) -> DataFrame:
    """Per numeric column: bias-corrected skew, strategy (median when
    |skew| > threshold, else mean) and the fill value, all from the fit rows."""
    long = to_long(rows_for_fit(df, fit_on), cols)
    v = F.col("value")
    med = S.grouped_quantiles(long, "column_name", "value", [0.5]).select(
        "column_name", F.col("q")[0].alias("_median"))
    g = long.groupBy("column_name").agg(S.skew(v).alias("skewness"), F.avg(v).alias("_mean")).join(
        med, "column_name", "left")
    med = F.abs(F.col("skewness")) > skew_threshold
    return g.select("column_name", "skewness",
                    F.when(med, "median").otherwise("mean").alias("strategy"),
                    F.when(med, F.col("_median")).otherwise(F.col("_mean")).alias("fill_value"))


def fill_values(params: DataFrame) -> dict:
    return {r["column_name"]: r["fill_value"] for r in params.collect()  # one row per column
            if r["fill_value"] is not None}


def fill_with(df: DataFrame, fills: dict, categorical: list[str] = ()) -> DataFrame:
    """Numeric fills by column; categorical nulls -> 'Missing'."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(*[F.coalesce(F.col(c), F.lit(fills[c]).cast(types[c])
                                 if isinstance(types[c], T.FractionalType)
                                 else F.lit(fills[c])).alias(c) if c in fills else F.col(c)
                      for c in df.columns])
    if categorical:
        out = out.fillna(MISSING, subset=list(categorical))
    return out


def apply_impute(df: DataFrame, params: DataFrame, categorical: list[str] = ()) -> DataFrame:
    """Numeric fills from the params table; categorical nulls -> 'Missing'."""
    return fill_with(df, fill_values(params), categorical)


# --------------------------------------------------------------------------- F8-F9

def cap_params(df: DataFrame, cols: list[str], fit_on: str = "train", k: float = IQR_K) -> DataFrame:
    """F8: IQR bounds from the fit rows: [Q1 - k·IQR, Q3 + k·IQR]."""
    cols = [c for c in cols if c in df.columns]
    long = to_long(rows_for_fit(df, fit_on), cols)
    q = S.grouped_quantiles(long, "column_name", "value", [0.25, 0.75]).select(
        "column_name", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select("column_name", (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def capped_counts(df: DataFrame, params: DataFrame) -> DataFrame:
    """F8: how many rows (all rows) each bound clips."""
    bounds = {r["column_name"]: (r["lower"], r["upper"]) for r in params.collect()}
    aggs = [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()]
    wide = df.agg(*aggs)
    return wide.unpivot([], list(bounds), "column_name", "n_capped")


def cap_bounds(params: DataFrame) -> dict:
    return {r["column_name"]: (r["lower"], r["upper"]) for r in params.collect()}


def cap_with(df: DataFrame, bounds: dict) -> DataFrame:
    return df.withColumns({c: F.least(F.greatest(F.col(c).cast("double"), F.lit(lo)), F.lit(hi))
                           for c, (lo, hi) in bounds.items()})


def apply_cap(df: DataFrame, params: DataFrame) -> DataFrame:
    return cap_with(df, cap_bounds(params))


def log_params(df: DataFrame, cols: list[str], fit_on: str = "train",
               threshold: float = SKEW_LOG) -> DataFrame:
    """|skew| on the fit rows > threshold, and min over all rows >= 0."""
    sk = to_long(rows_for_fit(df, fit_on), cols).groupBy("column_name").agg(S.skew("value").alias("skewness"))
    mn = to_long(df, cols).groupBy("column_name").agg(F.min("value").alias("min_value"))
    return sk.join(mn, "column_name").select(
        "column_name", "skewness", "min_value",
        ((F.abs(F.col("skewness")) > threshold) & (F.col("min_value") >= 0)).alias("applied"))


def log_columns(params: DataFrame) -> list[str]:
    return [r["column_name"] for r in params.where("applied").collect()]


def log_with(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in cols})


def apply_log(df: DataFrame, params: DataFrame) -> DataFrame:
    return log_with(df, log_columns(params))


# --------------------------------------------------------------------------- F10-F12

def cardinality(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct non-null count per column (one grouped pass)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column_name").agg(
        F.count_distinct("value").alias("n_unique"))


def onehot_values(df: DataFrame, col: str, drop_first: bool = True) -> list:
    """the values that get a column; the alphabetically first one is dropped. The < 10 rule is
    checked here: a column with more values is an error, found by reading one value too many."""
    values = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(CARD_ONEHOT).collect())
    if len(values) >= CARD_ONEHOT:
        raise ValueError(f"{col} has {CARD_ONEHOT} values or more: label-encode it")
    return values[1:] if drop_first else values


def onehot_with(df: DataFrame, col: str, values: list) -> DataFrame:
    """``{col}_{value}`` int8 columns; null where the value is null, 0 in all for any other value."""
    return df.withColumns({f"{col}_{v}": (F.col(col) == F.lit(v)).cast("tinyint") for v in values}).drop(col)


def onehot(df: DataFrame, col: str, drop_first: bool = True) -> DataFrame:
    """``get_dummies(drop_first=True)`` for a low-cardinality column."""
    return onehot_with(df, col, onehot_values(df, col, drop_first))


def sorted_labels(df: DataFrame, col: str) -> DataFrame:
    """(label, idx): the distinct non-null values, numbered from 0 in sorted order.

    A global sort spreads the labels over tasks; what the driver sees is one count per
    task, from which each task's first number follows."""
    labels = df.select(F.col(col).cast("string").alias("label")).where(F.col("label").isNotNull()).distinct()
    labels = materialize(labels.orderBy("label").withColumn("_id", F.monotonically_increasing_id()), "labels")
    task = F.shiftright("_id", 33).cast("int")
    firsts, total = [], 0
    for r in labels.groupBy(task.alias("t")).agg(F.count(F.lit(1)).alias("n")).orderBy("t").collect():
        firsts += [F.lit(r["t"]), F.lit(total)]
        total += r["n"]
    first = F.element_at(F.create_map(*firsts), task) if firsts else F.lit(0)
    return labels.select("label", (first + F.col("_id").bitwiseAND((1 << 33) - 1)).cast("int").alias("idx"))


def label_with(df: DataFrame, col: str, known: DataFrame, out: str | None = None) -> DataFrame:
    """index from ``known`` (label, idx); a null or unseen value gets the index behind the last."""
    out = out or col
    n = known.agg(F.count(F.lit(1)).cast("int").alias("_n"))
    res = (df.withColumn("_label", F.col(col).cast("string"))
           .join(known.select(F.col("label").alias("_label"), F.col("idx").alias("_idx")), "_label", "left")
           .crossJoin(F.broadcast(n)))  # one row
    idx = F.coalesce("_idx", "_n")
    columns = [idx.alias(out) if c == out else F.col(c) for c in df.columns]
    return res.select(*columns, *([] if out in df.columns else [idx.alias(out)]))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """index in sorted order (``LabelEncoder``); a null gets the index behind the last."""
    return label_with(df, col, sorted_labels(df, col), out)


# --------------------------------------------------------------------------- F13-F17

def split_xy(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(key, numeric columns without the target) and (key, y). Columns that are
    not numeric after encoding are dropped."""
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name not in (key, target)]
    return df.select(key, *numeric), df.select(key, F.col(target).alias("y"))


def without_inf(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).cast("double").isin(float("inf"), float("-inf")),
                                     F.col(c).cast("double")) for c in cols})


def medians(df: DataFrame, cols: list[str]) -> dict:
    """each column's median without its infinite values."""
    med = S.grouped_quantiles(to_long(without_inf(df, cols), cols), "column_name", "value", [0.5])
    return {r["column_name"]: r["q"][0] for r in med.collect() if r["q"] and r["q"][0] is not None}


def with_gaps(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns that hold a null or NaN."""
    long = to_long(df, cols)
    found = long.where(F.col("value").isNull() | F.isnan("value")).select("column_name").distinct().collect()
    names = {r["column_name"] for r in found}                   # <= schema width
    return [c for c in cols if c in names]


def inf_to_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """+-inf -> null, then every null -> the column median over all rows; only columns with
    something to fill are asked for theirs."""
    finite = without_inf(df, cols)
    gaps = with_gaps(finite, cols)
    values = medians(df, gaps) if gaps else {}
    return finite.fillna(values) if values else finite


def scale_params(df: DataFrame, cols: list[str], fit_on: str = "train") -> DataFrame:
    """mean and population std (ddof 0) from the fit rows; std 0 -> scale 1."""
    long = to_long(rows_for_fit(df, fit_on), cols)
    g = long.groupBy("column_name").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("_sd"))
    return g.select("column_name", "mean",
                    F.when(F.col("_sd") == 0, F.lit(1.0)).otherwise(F.col("_sd")).alias("scale"))


def scales(params: DataFrame) -> dict:
    return {r["column_name"]: (r["mean"], r["scale"]) for r in params.collect()}


def scale_with(df: DataFrame, by: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in by.items()})


def apply_scale(df: DataFrame, params: DataFrame) -> DataFrame:
    return scale_with(df, scales(params))


def clean_name(name: str) -> str:
    """F16: the feature-name rule on the driver (names are metadata)."""
    return re.sub(NAME_CHARS, "_", str(name))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def default_fill(request: DataFrame, map_col: str, features: list[str], default: float = 0.0) -> DataFrame:
    """Sparse request map -> one column per feature in order, missing -> 0.0."""
    m = F.col(map_col)
    return request.withColumns({f: F.coalesce(F.element_at(m, F.lit(f)), F.lit(default)) for f in features})


# --------------------------------------------------------------------------- A11

INT_RANGES = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]  # fixed values


def shrink_plan(df: DataFrame) -> DataFrame:
    """Chosen narrow type per numeric column: ints by min/max, doubles -> float."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    aggs = []
    for c in ints:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    wide = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    rows = []
    for c in ints:
        lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
        chosen = None
        for t, a, b in INT_RANGES:
            cond = (lo >= a) & (hi <= b)
            chosen = F.when(cond, t) if chosen is None else chosen.when(cond, t)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("from_type"),
                             chosen.otherwise(df.schema[c].dataType.simpleString()).alias("to_type")))
    for c in floats:
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit("double").alias("from_type"),
                             F.lit("float").alias("to_type")))
    return wide.select(F.inline(F.array(*rows)))


def apply_shrink(df: DataFrame, plan: DataFrame) -> DataFrame:
    types = {r["column_name"]: r["to_type"] for r in plan.collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
