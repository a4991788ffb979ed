"""pandas / sklearn / NumPy semantics re-expressed in Spark,
checked on micro-frames against hand values or brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import stats as S
from ledgerlens.operators import curves as C
from ledgerlens.operators import drift as D
from ledgerlens.operators import fairness as FA
from ledgerlens.operators import features as FE
from ledgerlens.operators import prep as PR
from ledgerlens.operators import rollup as RU
from ledgerlens.operators import split as SP


def test_bias_corrected_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = df.agg(S.skew("x").alias("s"), S.kurt("x").alias("k")).first()
    assert r.s == pytest.approx(1.7636326148, rel=1e-9)
    assert r.k == pytest.approx(3.228, rel=1e-9)
    const = spark.createDataFrame([(5.0,)] * 4, "x double").agg(S.skew("x").alias("s"), S.kurt("x").alias("k")).first()
    assert const.s == 0.0 and const.k == 0.0


def test_rollup_all_null_sum_is_zero_and_null_keys_dropped(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (None, 4.0)], "k int, v double")
    out = {r.k: r for r in RU.aggregate_table(df, "k", "t").collect()}
    assert set(out) == {1, 2}
    assert out[1].t_v_sum == 0.0 and out[1].t_v_mean is None and out[1].t_v_count == 0
    assert out[2].t_v_sum == 3.0


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(0.2, None, 0.6), (None, None, None)], "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    out = FE.domain_features(df).collect()
    a, b = out
    assert a.EXT_SOURCE_MEAN == pytest.approx(0.4) and a.EXT_SOURCE_SUM == pytest.approx(0.8)
    assert a.EXT_SOURCE_STD == pytest.approx(np.std([0.2, 0.6], ddof=1))
    assert a.EXT_SOURCE_WEIGHTED is None  # null propagates
    assert b.EXT_SOURCE_SUM == 0.0 and b.EXT_SOURCE_MEAN is None


def test_sentinel_and_eps_ratio(spark):
    df = spark.createDataFrame([(-10000, 365243, 0.0, 5.0, 1.0, 2.0)],
                               "DAYS_BIRTH int, DAYS_EMPLOYED int, AMT_INCOME_TOTAL double, AMT_ANNUITY double, AMT_CREDIT double, CNT_FAM_MEMBERS double")
    r = FE.domain_features(df).first()
    assert r.DAYS_EMPLOYED_CLEAN is None and r.YEARS_EMPLOYED is None
    assert r.DEBT_BURDEN_RATIO == pytest.approx(5.0 / 1e-6)
    assert r.AGE_YEARS == pytest.approx(10000 / 365.25)


def _sk_curve(y, s):
    """Brute force of the published ROC/PR definitions (ties = one point)."""
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = (1 + idx) - tps
    P, N = tps[-1], fps[-1]
    tpr = np.r_[0, tps / P]
    fpr = np.r_[0, fps / N]
    roc = np.trapezoid(tpr, fpr)
    prec = np.r_[1.0, tps / (tps + fps)]
    rec = np.r_[0.0, tps / P]
    pr = np.trapezoid(prec, rec)
    return roc, pr


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_curve_areas_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3000
    y = (rng.random(n) < 0.1).astype(int)
    s = np.round(rng.random(n) * 0.7 + y * 0.2, 3)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = C.areas(C.cumulative_counts(C.score_counts(df), buckets=16)).first()
    roc, pr = _sk_curve(y, s)
    assert got.roc_auc == pytest.approx(roc, abs=1e-12)
    assert got.pr_auc == pytest.approx(pr, abs=1e-12)


def test_exact_rank_is_row_number(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    r = SP.exact_rank(df, "k", ["g"]).collect()
    got = {(x.k): x["rank"] for x in r}
    import hashlib
    for g in range(3):
        keys = [k for k in range(5000) if k % 3 == g]
        keys.sort(key=lambda k: (hashlib.md5(f"{k}-42".encode()).hexdigest(), k))
        for i, k in enumerate(keys, start=1):
            assert got[k] == i


def test_stratified_split_sizes(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = SP.stratified_split(df, "k", "y", 0.2)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert counts[(1, "test")] == 20 and counts[(0, "test")] == 180


def _np_psi(expected, actual, buckets=10):
    bp = np.unique(np.nanpercentile(expected, np.linspace(0, 100, buckets + 1)))
    if len(bp) < 3:
        return 0.0
    e = np.histogram(expected, bins=bp)[0] + 1e-8
    a = np.histogram(actual, bins=bp)[0] + 1e-8
    e, a = e / e.sum(), a / a.sum()
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(7)
    ref = rng.normal(0, 1, 2000)
    acts = {0: rng.normal(0, 1, 500), 1: rng.normal(0.5, 1.2, 500), 2: rng.normal(3, 0.1, 300)}
    rdf = spark.createDataFrame([("f", float(v)) for v in ref], "feature string, value double")
    adf = spark.createDataFrame([("f", w, float(v)) for w, vs in acts.items() for v in vs],
                                "feature string, win int, value double")
    got = {r.win: r.psi for r in D.psi(rdf, adf, ["feature"], "win").collect()}
    for w, vs in acts.items():
        assert got[w] == pytest.approx(_np_psi(ref, vs), rel=1e-9, abs=1e-12)


def test_psi_constant_reference_is_zero(spark):
    rdf = spark.createDataFrame([("f", 1.0)] * 50, "feature string, value double")
    adf = spark.createDataFrame([("f", 0, 2.0)] * 5, "feature string, win int, value double")
    assert D.psi(rdf, adf, ["feature"], "win").first().psi == 0.0


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (30.5,), (100.0,), (101.0,)], "a double")
    got = [r.g for r in df.select(FA.cut(F.col("a"), FA.AGE_EDGES, FA.AGE_LABELS).alias("g")).collect()]
    assert got == [None, "18-30", "31-45", "60+", None]


def test_onehot_drops_alphabetically_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    out = PR.onehot(df, "x")
    assert out.columns == ["x_b", "x_c"]


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([("z",), ("a",), ("m",)], "x string")
    got = {r.x for r in PR.label_encode(df, "x").collect()}
    assert got == {0, 1, 2}
    enc = dict(zip(["z", "a", "m"], [r.x for r in PR.label_encode(df, "x").collect()]))
    assert enc == {"z": 2, "a": 0, "m": 1}


def test_fround_matches_c_rounding(spark):
    df = spark.createDataFrame([(281349.43875,), (-0.00001,), (2.5,)], "x double")
    got = [r.y for r in df.select(S.fround("x", 4).alias("y")).collect()]
    assert got == [281349.4388, 0.0, 2.5]
    assert math.copysign(1, got[1]) == 1.0


@pytest.mark.parametrize("seed", [0, 1])
def test_grouped_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    data = {}
    for g, n in [("a", 1), ("b", 7), ("c", 30000)]:
        vals = np.round(rng.normal(0, 5, n), 1 if g == "c" else 3)  # ties in c
        data[g] = vals
        rows += [(g, float(v)) for v in vals]
    rows.append(("b", None))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: r.q for r in S.grouped_quantiles(df, "g", "v", probs).collect()}
    for g, vals in data.items():
        want = np.quantile(vals, probs)
        assert got[g] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_filtered_scan_pushes_down_and_keeps_the_nan_rule(spark, tmp_path):
    from ledgerlens.sources import tables as TB
    spark.createDataFrame([(1, 5.0), (2, 50.0), (3, float("nan")), (4, None)], "k long, v double").write.parquet(
        str(tmp_path / "t.parquet"))
    out = TB.read_table(spark, str(tmp_path), "t", where=F.col("v") > 10)
    assert [r.k for r in out.collect()] == [2]
    assert "GreaterThan(v,10" in out._jdf.queryExecution().toString()


def test_exact_rank_with_many_groups(spark):
    df = spark.range(2000).select("id", (F.col("id") % 40).alias("g"))
    out = SP.exact_rank(df, "id", ["g"]).collect()
    for g in range(40):
        assert sorted(r["rank"] for r in out if r.g == g) == list(range(1, 51))
    assert all(r.group_size == 50 for r in out)


def test_rows_a_microsecond_apart_are_no_duplicates(spark):
    from ledgerlens.operators import profile
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"SELECT cast(t AS {kind}) AS ts, 1 AS n FROM VALUES ('2024-01-01 00:00:00.000001'), "
                       "('2024-01-01 00:00:00.000002'), ('2024-01-01 00:00:00.000002') AS x(t)")
        assert profile.duplicate_rows(df, "x").first().n_duplicates == 1, kind


def test_rollups_shuffle_rows_not_partial_sums(spark):
    from ledgerlens.plans.rollups import orders_rollup_two_stage
    plan = orders_rollup_two_stage(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(below) >= 2                      # lineitem, and the orders with their lines
    assert not any("Aggregate" in line for line in below)


def test_a_forest_keeps_its_rows_nodes():
    from ledgerlens.operators import models as MO
    assert MO.forest().getCacheNodeIds()


def test_only_columns_with_gaps_are_asked_for_their_median(spark, monkeypatch):
    """Null, NaN and infinite values get the median of the others; a whole column is not sketched."""
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1.0, None, 5.0, 1.0, None), (2, 2.0, 4.0, inf, nan, None), (3, 9.0, 8.0, 7.0, 3.0, None)]
    df = spark.createDataFrame(rows, "k int, whole double, a double, b double, c double, none double")
    asked, medians = [], PR.medians
    monkeypatch.setattr(PR, "medians", lambda d, cols: asked.extend(cols) or medians(d, cols))
    got = PR.inf_to_median(df, ["whole", "a", "b", "c", "none"]).orderBy("k").collect()
    assert asked == ["a", "b", "c", "none"]
    old = PR.without_inf(df, list("abc")).fillna(medians(df, ["whole", *"abc"])).orderBy("k").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in old]
    assert [r.a for r in got] == [6.0, 4.0, 8.0] and [r.b for r in got] == [5.0, 6.0, 7.0]
    assert [r.whole for r in PR.inf_to_median(df, ["whole"]).orderBy("k").collect()] == [1.0, 2.0, 9.0]
