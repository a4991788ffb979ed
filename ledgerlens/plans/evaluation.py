"""Evaluation queries (K1-K15, A10) on scored documents.

Scores: deterministic scoring rules over ``documents`` evaluated against
``labels.toxic`` (SURVEY 7.2). Each rule plays one "model" of the leaderboard.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import curves as C
from ledgerlens.operators import metrics as M
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.sqlgen import R
from ledgerlens.session import materialize
from ledgerlens.sources.tables import read_table

# scoring rules: name -> (Spark column, SQL expression over documents d)
SCORERS = {
    "chars_mod_997": (lambda: (F.col("n_chars") % 997) / F.lit(997.0), "CAST(d.n_chars % 997 AS DOUBLE) / 997.0"),
    "chars_mod_101": (lambda: (F.col("n_chars") % 101) / F.lit(101.0), "CAST(d.n_chars % 101 AS DOUBLE) / 101.0"),
    "length_sigmoid": (lambda: 1 / (1 + F.exp(-(F.log(F.col("n_chars") + 1) - 7))),
                       "1 / (1 + exp(-(ln(d.n_chars + 1) - 7)))"),
}
PRIMARY = "chars_mod_997"


def scored(spark, sf_dir, scorer: str = PRIMARY):
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return lab.join(docs, "doc_id").select("doc_id", "lang", "source", "n_chars", "label",
                                           SCORERS[scorer][0]().alias("score"))


def all_counts(spark, sf_dir):
    """(model, score, pos, neg) of every scoring rule, from one scan of the tables."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rules = F.array(*[F.struct(F.lit(n).alias("model"), rule().alias("score")) for n, (rule, _) in SCORERS.items()])
    return M.model_counts(lab.join(docs, "doc_id").select("label", F.inline(rules)))


def counts(spark, sf_dir, scorer: str = PRIMARY):
    """(score, pos, neg) of one rule, written once."""
    return materialize(C.score_counts(scored(spark, sf_dir, scorer)), "score-counts")


def cum(spark, sf_dir, scorer: str = PRIMARY):
    return C.cumulative_counts(counts(spark, sf_dir, scorer))


def curve_cte(scorer: str = PRIMARY, prefix: str = "") -> str:
    expr = SCORERS[scorer][1]
    return f"""{prefix}d AS (SELECT l.doc_id, l.toxic AS label, {expr} AS score
       FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic IS NOT NULL),
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM d WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)"""


AREAS_SQL = """sum(neg * (2 * tp - pos)) / (2.0 * any_value(P) * any_value(N)) AS roc_auc,
  sum(pos * (tp / (tp + fp) + CASE WHEN (tp - pos) + (fp - neg) = 0 THEN 1.0
                                   ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END)) / (2.0 * any_value(P)) AS pr_auc,
  any_value(P) / (any_value(P) + any_value(N)) AS baseline_rate"""

CM_SQL = """count_if(label = 0 AND score < {t}) AS tn, count_if(label = 0 AND score >= {t}) AS fp,
  count_if(label = 1 AND score < {t}) AS fn, count_if(label = 1 AND score >= {t}) AS tp"""


def metrics_sql(src: str = "cm") -> str:
    p1 = "coalesce(tp / nullif(tp + fp, 0), 0.0)"
    r1 = "coalesce(tp / nullif(tp + fn, 0), 0.0)"
    p0 = "coalesce(tn / nullif(tn + fn, 0), 0.0)"
    r0 = "coalesce(tn / nullif(tn + fp, 0), 0.0)"
    f1 = f"(CASE WHEN {p1} + {r1} > 0 THEN 2 * {p1} * {r1} / ({p1} + {r1}) ELSE 0.0 END)"
    f0 = f"(CASE WHEN {p0} + {r0} > 0 THEN 2 * {p0} * {r0} / ({p0} + {r0}) ELSE 0.0 END)"
    return (f"coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0.0) AS accuracy, {p1} AS precision, {r1} AS recall, "
            f"{f1} AS f1_cls1, ({f0} + {f1}) / 2 AS f1_macro, "
            f"coalesce(({f0} * (tn + fp) + {f1} * (tp + fn)) / nullif(tn + fp + fn + tp, 0), 0.0) AS f1_weighted")


def eval_record_sql(scorer: str) -> str:
    """One SELECT producing the K7 row of a scoring rule (used in UNION ALL)."""
    expr = SCORERS[scorer][1]
    return f"""(WITH {curve_cte(scorer)},
cm AS (SELECT {CM_SQL.format(t=0.5)} FROM d),
m AS (SELECT {metrics_sql()} FROM cm),
a AS (SELECT {AREAS_SQL} FROM c)
SELECT '{scorer}' AS model, m.*, a.roc_auc, a.pr_auc FROM m, a)"""


def _round_metrics(cols):
    return ", ".join(f"{R(c)} AS {c}" for c in cols)


@query("confusion", sql=f"""WITH {curve_cte()}
SELECT {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in ('tn', 'fp', 'fn', 'tp'))}
FROM (SELECT {CM_SQL.format(t=0.5)} FROM d)""")
def q_confusion(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", M.predict("score", 0.5))
    return M.confusion(s, "label", "pred")


@query("eval_record", sql=f"""SELECT model, {_round_metrics(M.METRICS)} FROM {eval_record_sql(PRIMARY)}""")
def q_eval_record(spark, sf_dir):
    return round_doubles(M.eval_record(scored(spark, sf_dir), "score", "label", PRIMARY))


@query("class_report", sql=f"""WITH {curve_cte()},
cm AS (SELECT {CM_SQL.format(t=0.5)} FROM d),
k AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r1,
             coalesce(tn / nullif(tn + fn, 0), 0.0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0.0) AS r0,
             tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n FROM cm),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
             CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0 FROM k),
u AS (SELECT '0' AS row, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
      UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
      UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / n, n FROM f
      UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
      UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f)
SELECT row, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1')} AS f1, CAST(support AS BIGINT) AS support FROM u""")
def q_class_report(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", M.predict("score", 0.5))
    return round_doubles(M.class_report(s, "label", "pred"))


@query("roc_points", sql=f"""WITH {curve_cte()}
SELECT {R('score')} AS threshold, {R('fp / N')} AS fpr, {R('tp / P')} AS tpr FROM c""")
def q_roc_points(spark, sf_dir):
    return round_doubles(C.roc_points(cum(spark, sf_dir)))


@query("pr_points", sql=f"""WITH {curve_cte()}
SELECT {R('score')} AS threshold, {R('tp / (tp + fp)')} AS precision, {R('tp / P')} AS recall FROM c""")
def q_pr_points(spark, sf_dir):
    return round_doubles(C.pr_points(cum(spark, sf_dir)))


@query("roc_auc", sql=f"""WITH {curve_cte()}
SELECT {R('roc_auc')} AS roc_auc FROM (SELECT {AREAS_SQL} FROM c)""")
def q_roc_auc(spark, sf_dir):
    return round_doubles(C.areas(cum(spark, sf_dir)).select("roc_auc"))


@query("pr_auc", sql=f"""WITH {curve_cte()}
SELECT {R('pr_auc')} AS pr_auc, {R('baseline_rate')} AS baseline_rate FROM (SELECT {AREAS_SQL} FROM c)""")
def q_pr_auc(spark, sf_dir):
    """K4/K5: PR-AUC and the baseline (positive) rate."""
    return round_doubles(C.areas(cum(spark, sf_dir)).select("pr_auc", "baseline_rate"))


SCAN_CTE = f"""{curve_cte()},
s AS (SELECT score AS threshold, tp / (tp + fp) AS precision, tp / P AS recall FROM c),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM s)"""


@query("threshold_scan", sql=f"""WITH {SCAN_CTE}
SELECT {_round_metrics(['threshold', 'precision', 'recall', 'f1'])} FROM f""")
def q_threshold_scan(spark, sf_dir):
    return round_doubles(C.threshold_scan(cum(spark, sf_dir)))


BEST_CTE = f"""{SCAN_CTE},
b AS (SELECT threshold AS f1_threshold FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1),
k AS (SELECT threshold AS c_threshold FROM f WHERE recall >= 0.8 ORDER BY f1 DESC, threshold ASC LIMIT 1),
bt AS (SELECT f1_threshold, coalesce(c_threshold, f1_threshold) AS constrained_threshold,
              c_threshold IS NOT NULL AS constraint_met FROM b LEFT JOIN k ON TRUE)"""


@query("threshold_constrained", sql=f"""WITH {BEST_CTE}
SELECT {R('f1_threshold')} AS f1_threshold, {R('constrained_threshold')} AS constrained_threshold, constraint_met FROM bt""")
def q_threshold_constrained(spark, sf_dir):
    """K8 + K9: F1-optimal cut and best-F1 cut with recall >= 0.80 (fallback: F1-optimal)."""
    return round_doubles(C.best_threshold(C.threshold_scan(cum(spark, sf_dir)), 0.80))


@query("threshold_compare", sql=f"""WITH {BEST_CTE},
cuts AS (SELECT 'Default (0.50)' AS cut_label, 0.5 AS cutoff, 0 AS cut_order
         UNION ALL SELECT 'F1-Optimal', f1_threshold, 1 FROM bt
         UNION ALL SELECT 'Recall>=0.80', constrained_threshold, 2 FROM bt),
cm AS (SELECT cut_label, cutoff, cut_order, count_if(label = 0 AND score < cutoff) AS tn,
              count_if(label = 0 AND score >= cutoff) AS fp, count_if(label = 1 AND score < cutoff) AS fn,
              count_if(label = 1 AND score >= cutoff) AS tp FROM d, cuts GROUP BY ALL),
m AS (SELECT cut_label, cutoff, cut_order, {metrics_sql()} FROM cm),
z AS (SELECT recall AS r0, f1_cls1 AS f0 FROM m WHERE cut_order = 0)
SELECT cut_label, {R('cutoff')} AS cutoff, {R('precision')} AS precision, {R('recall')} AS recall,
       {R('f1_cls1')} AS f1, {R('recall - r0')} AS recall_delta, {R('f1_cls1 - f0')} AS f1_delta FROM m, z""")
def q_threshold_compare(spark, sf_dir):
    """Metrics at the default, F1-optimal and recall-constrained cuts."""
    n = counts(spark, sf_dir)
    best = C.best_threshold(C.threshold_scan(C.cumulative_counts(n)), 0.80)
    cuts = (spark.range(1).select(F.lit("Default (0.50)").alias("cut_label"), F.lit(0.5).alias("cutoff"),
                                  F.lit(0).alias("cut_order"))
            .unionByName(best.select(F.lit("F1-Optimal").alias("cut_label"), F.col("f1_threshold").alias("cutoff"),
                                     F.lit(1).alias("cut_order")))
            .unionByName(best.select(F.lit("Recall>=0.80").alias("cut_label"),
                                     F.col("constrained_threshold").alias("cutoff"), F.lit(2).alias("cut_order"))))
    return round_doubles(M.threshold_compare(n, cuts))


@query("nearest_half", sql=f"""WITH {SCAN_CTE}
SELECT {_round_metrics(['threshold', 'precision', 'recall', 'f1'])} FROM f ORDER BY abs(threshold - 0.5), threshold LIMIT 1""")
def q_nearest_half(spark, sf_dir):
    """The curve point nearest the 0.50 cut."""
    return round_doubles(C.nearest(C.threshold_scan(cum(spark, sf_dir)), 0.5))


def board(spark, sf_dir):
    return M.leaderboard(M.eval_records(all_counts(spark, sf_dir)))


BOARD_SQL = " UNION ALL ".join(f"SELECT * FROM {eval_record_sql(s)}" for s in SCORERS)


@query("leaderboard", sql=f"""SELECT model, {_round_metrics(M.METRICS)} FROM ({BOARD_SQL})""")
def q_leaderboard(spark, sf_dir):
    """One evaluate_model row per scoring rule, best PR-AUC first."""
    return round_doubles(board(spark, sf_dir))


@query("best_models", sql=f"""WITH b AS ({BOARD_SQL})
SELECT min_by(model, (-pr_auc, model)) AS best_pr_auc, min_by(model, (-roc_auc, model)) AS best_roc_auc,
       min_by(model, (-recall, model)) AS best_recall FROM b""")
def q_best_models(spark, sf_dir):
    """Best model by PR-AUC, ROC-AUC and recall."""
    return M.best_by(board(spark, sf_dir))


@query("leaderboard_long", sql=f"""WITH b AS ({BOARD_SQL})
SELECT b.model, v.metric, {R('v.score')} AS score FROM b,
LATERAL (VALUES {', '.join(f"('{m}', {m})" for m in M.METRICS)}) v(metric, score)""")
def q_leaderboard_long(spark, sf_dir):
    """Leaderboard melted to (model, metric, score)."""
    return round_doubles(M.to_long(board(spark, sf_dir)))


@query("radar_table", sql=f"""WITH b AS ({BOARD_SQL})
SELECT b.model, v.metric, {R('v.score')} AS score FROM b,
LATERAL (VALUES {', '.join(f"('{m}', {m})" for m in M.RADAR)}) v(metric, score)""")
def q_radar_table(spark, sf_dir):
    """The six radar metrics per model."""
    return round_doubles(M.to_long(board(spark, sf_dir), M.RADAR))


def threshold_rows_sql() -> str:
    """K12 rows, unrounded; needs ``BEST_CTE``."""
    return f"""WITH rows AS (SELECT '{PRIMARY} @ F1-Optimal' AS model, f1_threshold AS cutoff FROM bt
         UNION ALL SELECT '{PRIMARY} @ Recall>=0.80', constrained_threshold FROM bt),
cm AS (SELECT model, cutoff, count_if(label = 0 AND score < cutoff) AS tn, count_if(label = 0 AND score >= cutoff) AS fp,
              count_if(label = 1 AND score < cutoff) AS fn, count_if(label = 1 AND score >= cutoff) AS tp
       FROM d, rows GROUP BY ALL),
a AS (SELECT {AREAS_SQL} FROM c)
SELECT * FROM {eval_record_sql(PRIMARY)}
UNION ALL SELECT model, {metrics_sql()}, a.roc_auc, a.pr_auc FROM cm, a"""


@query("threshold_rows", sql=f"""WITH {BEST_CTE},
u AS ({threshold_rows_sql()})
SELECT model, {_round_metrics(M.METRICS)} FROM u""")
def q_threshold_rows(spark, sf_dir):
    """The model's record plus rows at its tuned cuts (sharing its areas)."""
    n = counts(spark, sf_dir)
    c = C.cumulative_counts(n)
    best = C.best_threshold(C.threshold_scan(c), 0.80)
    areas = C.areas(c).select("roc_auc", "pr_auc")
    cuts = (best.select(F.lit(f"{PRIMARY} @ F1-Optimal").alias("model"), F.col("f1_threshold").alias("cutoff"))
            .unionByName(best.select(F.lit(f"{PRIMARY} @ Recall>=0.80").alias("model"),
                                     F.col("constrained_threshold").alias("cutoff"))))
    cm = C.confusion_at(n.crossJoin(F.broadcast(cuts)), F.col("cutoff"), ("model",))  # two rows
    rows = M.from_confusion(cm, keep=["model"]).crossJoin(areas)
    base = M.eval_records(n.withColumn("model", F.lit(PRIMARY)))
    return round_doubles(base.unionByName(rows.select("model", *M.METRICS)))
