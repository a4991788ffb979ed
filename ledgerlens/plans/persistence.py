"""Persistence queries (A4-A10): CSV / JSON / Parquet round trips, model reload."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import models as MO
from ledgerlens.operators import prep as PR
from ledgerlens.operators import stages as ST
from ledgerlens.plans import evaluation as EV
from ledgerlens.plans import monitoring as MON
from ledgerlens.plans.cleaning import CATEGORICAL, materialized_model_frame
from ledgerlens.plans.registry import query
from ledgerlens.plans.splits import SPLIT_CTE
from ledgerlens.sources import io as IO
from ledgerlens.session import once
from ledgerlens.sources.tables import KEY, TARGET

BOARD_SCHEMA = ("model string, accuracy double, precision double, recall double, f1_cls1 double, "
                "f1_macro double, f1_weighted double, roc_auc double, pr_auc double")


@query("csv_roundtrip", sql=f"""SELECT model, {EV._round_metrics(EV.M.METRICS)} FROM ({EV.BOARD_SQL})""")
def q_csv_roundtrip(spark, sf_dir):
    """Leaderboard -> CSV -> scan with the explicit schema (equals the leaderboard)."""
    path = IO.write_csv(EV.q_leaderboard(spark, sf_dir), IO.run_path(spark, "leaderboard_csv"))
    return IO.read_csv(spark, path, BOARD_SCHEMA)


PSI_SCHEMA = ("feature string, month_1 double, month_2 double, month_3 double, month_4 double, "
              "max_psi double, drift_class string")


@query("psi_report_csv", sql=MON.ORACLE_PSI_TABLE)
def q_psi_report_csv(spark, sf_dir):
    """A5: PSI report -> CSV -> scan (equals psi_table)."""
    path = IO.write_csv(MON.q_psi_table(spark, sf_dir), IO.run_path(spark, "psi_report_csv"))
    return IO.read_csv(spark, path, PSI_SCHEMA)


@query("json_meta", sql=f"""WITH {EV.BEST_CTE},
bd AS ({EV.BOARD_SQL})
SELECT (SELECT model FROM bd ORDER BY pr_auc DESC, model LIMIT 1) AS model_name, 'n_chars' AS feature_cols,
       {EV.R('(SELECT f1_threshold FROM bt)', 6)} AS optimal_threshold, 1 AS n_features, '0,1' AS classes,
       '0=Non-Default,1=Default' AS class_labels, 'pr_auc' AS primary_metric, 'roc_auc' AS secondary_metric""")
def q_json_meta(spark, sf_dir):
    """Deployment metadata (nested array / map fields) -> JSON -> typed scan."""
    board = EV.board(spark, sf_dir)
    best = board.orderBy(F.desc("pr_auc"), "model").limit(1)
    cut = EV.C.best_threshold(EV.C.threshold_scan(EV.cum(spark, sf_dir)))
    meta = best.crossJoin(cut).select(  # one row x one row
        F.col("model").alias("model_name"),
        F.array(F.lit("n_chars")).alias("feature_cols"),
        F.col("f1_threshold").alias("optimal_threshold"),
        F.lit(1).alias("n_features"),
        F.array(F.lit(0), F.lit(1)).alias("classes"),
        F.create_map(F.lit("0"), F.lit("Non-Default"), F.lit("1"), F.lit("Default")).alias("class_labels"),
        F.lit("pr_auc").alias("primary_metric"), F.lit("roc_auc").alias("secondary_metric"))
    path = IO.write_json(meta, IO.run_path(spark, "deployment_meta"))
    back = IO.read_json(spark, path)
    labels = F.transform(F.array_sort(F.map_entries("class_labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return back.select("model_name", F.array_join("feature_cols", ",").alias("feature_cols"),
                       fround("optimal_threshold", 6).alias("optimal_threshold"), "n_features",
                       F.array_join(F.transform("classes", lambda c: c.cast("string")), ",").alias("classes"),
                       F.array_join(labels, ",").alias("class_labels"), "primary_metric", "secondary_metric")


@query("model_reload")
def q_model_reload(spark, sf_dir):
    """Save the logistic model, load it back, re-score 5 test rows: 0 mismatches."""
    from ledgerlens.plans.modeling import _split, fitted_lr
    _, te, _ = _split(spark, sf_dir)
    lr = fitted_lr(spark, sf_dir)
    path = IO.save_model(lr, IO.run_path(spark, "lr_model"))
    loaded = LogisticRegressionModel.load(path)
    rows = te.orderBy(KEY).limit(5)
    return IO.reload_check(lr, loaded, rows, KEY, lambda m, d: MO.probability(m, d, [KEY]))


def full_pipeline() -> Pipeline:
    """From raw rows (key, target, split, numeric and text columns) to a score, as one object."""
    keep = [KEY, TARGET, "split"]
    return Pipeline(stages=[
        ST.Cleaning(keep, CATEGORICAL, PR.CAP_COLUMNS), ST.OneHot("c_mktsegment"), ST.Labels("n_name"),
        ST.Scaling(keep), ST.Assembling(keep),
        LogisticRegression(featuresCol=MO.FEATURES, labelCol=TARGET, regParam=0.01, maxIter=100)])


def _reloads(spark, sf_dir):
    """(name, fitted model, its class, rows, scoring) of every kind of model the library fits."""
    from ledgerlens.plans import modeling as MD
    _, te, _ = MD._split(spark, sf_dir)
    own = lambda m, d: m.transform(d).select(KEY, "score")            # noqa: E731
    ml = lambda m, d: MO.probability(m, d, [KEY])                       # noqa: E731
    raw = materialized_model_frame(spark, sf_dir)
    MD.binned_matrix(spark, sf_dir).rdd()                  # two of the fits share it
    lr, svm, tree, forest, ada, early, fitted = MD.together(spark, [
        lambda: MD.fitted_lr(spark, sf_dir), lambda: MD.fitted_svm(spark, sf_dir),
        lambda: MD.fitted(spark, sf_dir, "tree", MO.tree), lambda: MD.fitted(spark, sf_dir, "rf", MO.forest),
        lambda: MD.fitted_ada(spark, sf_dir), lambda: MD.fitted_early(spark, sf_dir),
        lambda: once(spark, "pipeline", sf_dir, lambda: full_pipeline().fit(raw.where(F.col("split") == "train")))])
    return [
        ("Logistic Regression", lr, LogisticRegressionModel, te, ml),
        ("SVM (Linear)", svm, ST.CalibratedSVCModel, te, own),
        ("Decision Tree", tree, DecisionTreeClassificationModel, te, ml),
        ("Random Forest", forest, RandomForestClassificationModel, te, ml),
        ("AdaBoost", ada, ST.AdaBoostModel, te, own),
        ("GBT (early stop)", ST.BoostedModel.of(early), ST.BoostedModel, te, own),
        ("Pipeline", fitted, PipelineModel, raw.where(F.col("split") == "test"), ml),
    ]


RELOADED = ("Logistic Regression", "SVM (Linear)", "Decision Tree", "Random Forest", "AdaBoost", "GBT (early stop)",
            "Pipeline")


@query("models_reload", sql=f"""{SPLIT_CTE}
SELECT model, (SELECT count(*) FROM s WHERE split = 'test') AS n_checked, CAST(0 AS BIGINT) AS n_mismatch
FROM (VALUES {', '.join(f"('{n}')" for n in RELOADED)}) v(model)""")
def q_models_reload(spark, sf_dir):
    """Every model, and the pipeline from raw columns to the score, saved, loaded and scored again on
    all test rows: no row differs."""
    out = None
    for name, model, cls, rows, score in _reloads(spark, sf_dir):
        loaded = cls.load(IO.save_model(model, IO.run_path(spark, "model")))
        found = IO.reload_check(model, loaded, rows, KEY, score).select(F.lit(name).alias("model"), "*")
        out = found if out is None else out.union(found)
    return out


RUN_METRICS = EV.M.METRICS
RUN_SQL = f"""WITH {EV.BEST_CTE},
bd AS ({EV.BOARD_SQL}),
tr AS ({EV.threshold_rows_sql()}),
runs AS (SELECT bd.*, true AS has_model FROM bd
         UNION ALL SELECT tr.*, false FROM tr WHERE model NOT IN (SELECT model FROM bd))"""
# fixed values: the run log's imbalance and metric labels, the same for every run
PARAMS_SQL = (f"model AS model_type, {EV.R('(SELECT f1_threshold FROM bt)', 6)} AS optimal_threshold, 1 AS n_features, "
              "'random_undersampling_2:1' AS imbalance_strategy, 'PR-AUC' AS primary_metric")


def run_table(spark, sf_dir):
    """A10: a row per evaluated model and tuned cut: 8 metrics, 5 params, whether it has a model object."""
    cut = EV.C.best_threshold(EV.C.threshold_scan(EV.cum(spark, sf_dir)))
    board = EV.q_leaderboard(spark, sf_dir).select("model", *RUN_METRICS).withColumn("has_model", F.lit(True))
    cuts = EV.q_threshold_rows(spark, sf_dir).select("model", *RUN_METRICS).withColumn("has_model", F.lit(False))
    cuts = cuts.join(board.select("model"), "model", "left_anti")
    runs = board.unionByName(cuts).crossJoin(cut)  # one row
    runs = runs.select(
        "model", *RUN_METRICS, "has_model", F.col("model").alias("model_type"),
        fround("f1_threshold", 6).alias("optimal_threshold"), F.lit(1).alias("n_features"),
        F.lit("random_undersampling_2:1").alias("imbalance_strategy"), F.lit("PR-AUC").alias("primary_metric"))
    return IO.append_runs(runs, IO.run_path(spark, "runs"))


@query("run_table", sql=f"""{RUN_SQL}
SELECT model, {EV._round_metrics(RUN_METRICS)}, has_model, {PARAMS_SQL} FROM runs""")
def q_run_table(spark, sf_dir):
    """A10: the run log, written and read back."""
    return run_table(spark, sf_dir)


@query("best_run", sql=f"""{RUN_SQL}
SELECT model, {EV._round_metrics(RUN_METRICS)}, has_model, {PARAMS_SQL} FROM runs WHERE has_model
ORDER BY runs.pr_auc DESC, model LIMIT 1""")
def q_best_run(spark, sf_dir):
    """A10: best run by PR-AUC among those with a model (tuned cuts share its PR-AUC and have none)."""
    return IO.best_run(run_table(spark, sf_dir))
