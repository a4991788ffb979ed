"""Classification metrics, reports, threshold comparison and leaderboards
(SURVEY K1, K2, K6, K7, K10, K12-K15, A10).

All metrics come from one conditional-count aggregate (partial + final), so a
scored table of any size costs one pass; curve-based areas come from
``curves.areas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import curves as C
from ledgerlens.session import materialize

METRICS = ["accuracy", "precision", "recall", "f1_cls1", "f1_macro", "f1_weighted", "roc_auc", "pr_auc"]
RADAR = ["accuracy", "precision", "recall", "f1_cls1", "roc_auc", "pr_auc"]


def predict(score: str, threshold) -> F.Column:
    """Class at threshold (>=)."""
    t = F.lit(threshold) if not isinstance(threshold, F.Column) else threshold
    return (F.col(score) >= t).cast("int")


def confusion(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """K1: TN, FP, FN, TP (optionally per group)."""
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp")]
    return df.groupBy(*(by or [])).agg(*aggs)


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _f1(p, r):
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def from_confusion(cm: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """K2: accuracy, precision (0 if undefined), recall, F1, macro and weighted F1."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    return cm.select(*(keep or []),
                     _ratio(tp + tn, n).alias("accuracy"), p1.alias("precision"), r1.alias("recall"),
                     f1.alias("f1_cls1"), ((f0 + f1) / 2).alias("f1_macro"),
                     _ratio(f0 * (tn + fp) + f1 * (tp + fn), n).alias("f1_weighted"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """K6: per-class precision / recall / F1 / support, accuracy, macro and weighted rows."""
    cm = confusion(df, label, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1, p0, r0 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    s0, s1 = (tn + fp), (tp + fn)
    rows = F.array(
        F.struct(F.lit("0").alias("row"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("row"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _ratio(tp + tn, n).alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), _ratio(p0 * s0 + p1 * s1, n).alias("precision"),
                 _ratio(r0 * s0 + r1 * s1, n).alias("recall"), _ratio(f0 * s0 + f1 * s1, n).alias("f1"),
                 n.alias("support")))
    return cm.select(F.inline(rows))


def eval_records(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """K7 for every model of (model, score, pos, neg): threshold metrics + ROC-AUC + PR-AUC."""
    by = ("model",)
    m = from_confusion(C.confusion_at(counts, threshold, by), keep=["model"])
    return m.join(C.areas(C.cumulative_counts(counts, by=by), by), "model").select("model", *METRICS)


def eval_record(df: DataFrame, score: str, label: str, model: str, threshold: float = 0.5) -> DataFrame:
    """K7: the ``evaluate_model`` row of one model's scored rows, which are read once."""
    return eval_records(model_counts(df.select(F.lit(model).alias("model"), F.col(label).alias("label"),
                                               F.col(score).alias("score"))), threshold)


def model_counts(scored: DataFrame) -> DataFrame:
    """(model, label, score) rows -> (model, score, pos, neg), written once for all that is derived from it."""
    return materialize(C.score_counts(scored, by=("model",)), "score-counts")


def threshold_compare(counts: DataFrame, cuts: DataFrame) -> DataFrame:
    """Precision / recall / F1 at each named cut, and deltas vs the first, from
    (score, pos, neg).

    ``cuts`` = (cut_label string, cutoff double, cut_order int): a handful of
    rows, broadcast against the distinct scores."""
    keep = ["cut_label", "cutoff", "cut_order"]
    m = from_confusion(C.confusion_at(counts.crossJoin(F.broadcast(cuts)), F.col("cutoff"), keep), keep=keep)
    base = m.where(F.col("cut_order") == 0).select(F.col("recall").alias("_r0"), F.col("f1_cls1").alias("_f0"))
    return m.crossJoin(base).select(  # base is one row
        "cut_label", "cutoff", "precision", "recall", F.col("f1_cls1").alias("f1"),
        (F.col("recall") - F.col("_r0")).alias("recall_delta"), (F.col("f1_cls1") - F.col("_f0")).alias("f1_delta"))


def leaderboard(records: DataFrame) -> DataFrame:
    """All records (deduplicated on model name, X13), best PR-AUC first."""
    return records.dropDuplicates(["model"]).orderBy(F.desc("pr_auc"), "model")


def best_by(board: DataFrame, metrics=("pr_auc", "roc_auc", "recall")) -> DataFrame:
    """Best model per metric (ties -> alphabetically first)."""
    return board.agg(*[F.min_by("model", F.struct(-F.col(m), F.col("model"))).alias(f"best_{m}")
                       for m in metrics])


def to_long(board: DataFrame, metrics=METRICS, name: str = "metric", value: str = "score") -> DataFrame:
    """Wide -> long (model, metric, score)."""
    return board.unpivot(["model"], list(metrics), name, value)
