"""Attributions and their tables and batch scoring output.

* Linear models: the exact Shapley value with an independent background is
  ``coef_j * (x_j - mean_j)`` -- one projection per row.
* Trees: exact path-dependent Shapley values (``treeshap``).
* Any other model: permutation Shapley as a scoring job. For each explained
  row, each of k seeded feature orders and each step t = 0..F, the vector
  z_t has the first t features of the order taken from the row and the rest
  from the background; all z_t are scored in ONE ``model.transform`` over the
  exploded frame, consecutive differences are the marginal contributions, and
  their average over orders is the attribution. Every order telescopes,
  so attributions sum exactly to f(x) - f(background).
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of the vectors z_t made at a time.
STEP_VALUES = 1 << 20
TOP_FACTORS = 10        # fixed value
TOP_GLOBAL = 20         # fixed value
TOP_DRIVERS = 5         # fixed value
WATERFALL_TOP = 15      # fixed value
HIGH = "HIGH RISK — Likely Defaulter"        # fixed value
LOW = "LOW RISK — Likely Non-Defaulter"      # fixed value


def linear_attributions(df: DataFrame, key: str, features_col: str, names: list[str],
                        coef: list[float], mean: list[float], largest: int | None = None) -> DataFrame:
    """L1 (linear): long table (key, feature, input_value, attribution); if asked for, only each row's
    ``largest`` |attributions|, the first names of equal ones."""
    x = vector_to_array(features_col)
    # arrays against literal arrays: the generated code doesn't grow with the number of features
    centred = F.zip_with("_x", F.lit([float(m) for m in mean]), lambda v, m: v - m)
    share = F.zip_with(F.lit([float(c) for c in coef]), centred, lambda c, v: c * v)
    if largest is None:
        items = F.arrays_zip(F.lit(names).alias("feature"), F.col("_x").alias("input_value"), share.alias("attribution"))
        return df.select(key, x.alias("_x")).select(key, F.inline(items))
    place = {n: -i for i, n in enumerate(sorted(names))}
    items = F.arrays_zip(F.transform(share, F.abs).alias("_a"), F.lit([place[n] for n in names]).alias("_p"),
                         F.lit(names).alias("feature"), F.col("_x").alias("input_value"), share.alias("attribution"))
    top = F.slice(F.sort_array(items, asc=False), 1, largest)
    return df.select(key, x.alias("_x")).select(key, F.inline(top)).drop("_a", "_p")


def permutation_attributions(model, df: DataFrame, key: str, features_col: str, names: list[str],
                             background: list[float], orders: int = 4, seed: int = 42,
                             prob_index: int = 1) -> DataFrame:
    """L1 (any model): permutation Shapley values, long table (key, feature, input_value, attribution) of every
    row. A row's vectors z_t stay in its task, one after the other, so nothing is shuffled; a row's values
    do not mix with those of another row with the same key."""
    n_f = len(names)
    rng = random.Random(seed)
    perms = []
    for _ in range(orders):
        p = list(range(n_f))
        rng.shuffle(p)
        perms.append(p)
    place = np.argsort(np.array(perms).reshape(orders, n_f), axis=1)     # position of each feature in each order
    each = orders * (n_f + 1)
    taken = place[:, None, :] < np.arange(n_f + 1)[:, None]              # (orders, steps, features)
    base = np.array([float(v) for v in background])
    some = max(1, STEP_VALUES // (each * max(n_f, 1)))

    def expand(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, some):
                b = batch.slice(at, some)
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n_f)
                z = np.where(taken, x[:, None, None, :], base).ravel()
                ends = np.arange(b.num_rows * each + 1, dtype=np.int32) * n_f
                whole = np.arange(b.num_rows * each) % each == n_f       # the first order's last step is the row itself
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), each))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(z)), pa.array(whole)], names=[key, "_z", "_whole"])

    def differences(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            n = held.num_rows // each
            if not n:
                continue
            rows, held = held.slice(0, n * each).combine_chunks(), held.slice(n * each)
            d = np.diff(rows.column(1).to_numpy().reshape(n, orders, n_f + 1), axis=2)
            v = np.mean([d[:, o, place[o]] for o in range(orders)], axis=0)
            x = rows.column(2).take(pa.array(np.arange(n) * each + n_f)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(np.arange(n) * each)).combine_chunks(),
                 pa.array(list(v), pa.list_(pa.float64())), x], names=[key, "v", "x"])

    rows = df.select(key, vector_to_array(features_col).alias("x"))
    keys = rows.select(key).schema
    steps = rows.mapInArrow(expand, T.StructType([*keys, T.StructField("_z", T.ArrayType(T.DoubleType())),
                                                  T.StructField("_whole", T.BooleanType())]))
    scored = model.transform(steps.withColumn(features_col, array_to_vector("_z")))
    p = scored.select(key, vector_to_array("probability")[prob_index].alias("_p"), F.when(F.col("_whole"), F.col("_z")).alias("x"))
    values = p.mapInArrow(differences, T.StructType([*keys, T.StructField("v", T.ArrayType(T.DoubleType())),
                                                     T.StructField("x", T.ArrayType(T.DoubleType()))]))
    pairs = F.arrays_zip(F.lit(names).alias("feature"), F.col("x").alias("input_value"), F.col("v").alias("attribution"))
    return values.select(key, F.inline(pairs))


def global_table(attr: DataFrame, top: int = TOP_GLOBAL) -> DataFrame:
    """Per feature mean |attribution| and mean attribution, ranked, top-k."""
    g = attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"),
                                    F.avg("attribution").alias("mean_signed"))
    return g.orderBy(F.desc("mean_abs"), "feature").limit(top)


def drivers(glob: DataFrame, top: int = TOP_DRIVERS) -> DataFrame:
    """L3: top drivers with direction (> 0 increases risk)."""
    return glob.orderBy(F.desc("mean_abs"), "feature").limit(top).select(
        "feature", "mean_abs", "mean_signed",
        F.when(F.col("mean_signed") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"))


def waterfall(attr: DataFrame, key: str, row_key, base_value: float, top: int = WATERFALL_TOP) -> DataFrame:
    """L4: one row's base value, its ``top`` largest |attributions| and the rest summed."""
    one = attr.where(F.col(key) == F.lit(row_key))
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("attribution")), "feature")
    r = one.withColumn("_r", F.row_number().over(w))
    named = r.where(F.col("_r") <= top).select(F.col("_r").cast("int").alias("step"), "feature", "attribution")
    rest = r.where(F.col("_r") > top).agg(F.lit(top + 1).alias("step"), F.lit("other features").alias("feature"),
                                          F.coalesce(F.sum("attribution"), F.lit(0.0)).alias("attribution"))
    base = one.limit(1).select(F.lit(0).alias("step"), F.lit("base value").alias("feature"),
                               F.lit(float(base_value)).alias("attribution"))
    return base.unionByName(named).unionByName(rest)


def beeswarm(attr: DataFrame, glob: DataFrame) -> DataFrame:
    """(key, feature, input_value, attribution) of the top global features."""
    return attr.join(F.broadcast(glob.select("feature")), "feature")  # <= 20 rows


def score_output(scored: DataFrame, keep: list[str], threshold: float, prob: str = "score") -> DataFrame:
    """Probability rounded to 6, class at threshold (>=), label text, stamp."""
    from ledgerlens.functions.stats import fround
    pred = (F.col(prob) >= F.lit(threshold)).cast("int")
    return scored.select(*keep, fround(prob, 6).alias("default_probability"),
                         F.when(pred == 1, HIGH).otherwise(LOW).alias("risk_label"),
                         F.lit(float(threshold)).alias("threshold_used"), pred.alias("predicted_class"),
                         F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))


def top_factors(attr: DataFrame, key: str, k: int = TOP_FACTORS) -> DataFrame:
    """Per row the k largest |attributions| as array<struct<feature, shap_value,
    input_value, direction>>, ordered by |value| (a window per row: F rows)."""
    from ledgerlens.functions.stats import fround
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("attribution")), "feature")
    r = attr.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    item = F.struct(F.col("_r").alias("rank"), F.col("feature"), fround("attribution", 6).alias("shap_value"),
                    fround("input_value", 4).alias("input_value"),
                    F.when(F.col("attribution") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"))
    g = r.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_l"))  # k items per row
    return g.select(key, F.transform("_l", lambda s: s.dropFields("rank")).alias("top_risk_factors"))


def rule_score(loan: Column, income: Column, credit: Column) -> Column:
    """``clip(int(loan / (income + 1) * 100 - (credit - 600) / 2), 0, 100)``."""
    x = loan / (income + 1) * 100 - (credit - 600) / 2
    # clip in double space first so the truncating cast cannot overflow (ANSI)
    raw = F.least(F.greatest(x, F.lit(-1.0)), F.lit(101.0)).cast("int")
    return F.least(F.greatest(raw, F.lit(0)), F.lit(100))
