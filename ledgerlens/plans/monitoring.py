"""Fairness audit and drift monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import curves as C
from ledgerlens.operators import drift as D
from ledgerlens.operators import fairness as FA
from ledgerlens.operators import features as FE
from ledgerlens.operators import profile as P
from ledgerlens.operators import sketches as SK
from ledgerlens.operators import split as SP
from ledgerlens.plans.evaluation import BEST_CTE, scored
from ledgerlens.plans.features import FEATURE_SQL, FINANCE_CTE, applicant_finance
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.splits import H_CUST, SPLIT_CTE
from ledgerlens.plans.sqlgen import R
from ledgerlens.session import materialize, once
from ledgerlens.sources.tables import KEY, TARGET, read_table

GROUP_COLS = ["age_group", "gender", "income_quartile", "lang"]


# --------------------------------------------------------------------------- fairness

def audited(spark, sf_dir, cut=None):
    """Scored documents with the class at the F1-optimal (or the given) cut and the group columns."""
    s = materialize(scored(spark, sf_dir), "scored")   # cut, edges, rates and groups read it
    best = C.best_threshold(C.threshold_scan(C.cumulative_counts(C.score_counts(s)))) if cut is None else \
        spark.range(1).select(F.lit(float(cut)).alias("f1_threshold"))
    x = s.crossJoin(F.broadcast(best)).withColumn(  # one-row side
        "pred", (F.col("score") >= F.col("f1_threshold")).cast("int"))
    x = x.withColumn("age_group", FA.cut(F.col("n_chars") % 100, FA.AGE_EDGES, FA.AGE_LABELS))
    x = x.withColumn("gender", FA.value_map(F.col("n_chars") % 2, FA.GENDER_MAP))
    return FA.qcut(x, "n_chars", FA.INCOME_LABELS, "income_quartile")


def fairness(spark, sf_dir, cut=None):
    return FA.fairness_table(audited(spark, sf_dir, cut), GROUP_COLS, "label", "pred")


STRICT_CUT = 0.9


def fair_cte(bt: str = "bt") -> str:
    return f"""WITH {BEST_CTE},
x AS (SELECT d.label, CAST(d.score >= bt.f1_threshold AS INTEGER) AS pred, doc.n_chars, doc.lang
      FROM d JOIN documents doc USING (doc_id), {bt} bt),
qe AS (SELECT quantile_cont(CAST(n_chars AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM x),
xg AS (SELECT x.*,
  CASE WHEN n_chars % 100 > 0 AND n_chars % 100 <= 30 THEN '18-30' WHEN n_chars % 100 > 30 AND n_chars % 100 <= 45 THEN '31-45'
       WHEN n_chars % 100 > 45 AND n_chars % 100 <= 60 THEN '46-60' WHEN n_chars % 100 > 60 AND n_chars % 100 <= 100 THEN '60+' END AS age_group,
  CASE n_chars % 2 WHEN 1 THEN 'Male' WHEN 0 THEN 'Female' END AS gender,
  CASE WHEN n_chars >= e[1] AND n_chars <= e[2] AND e[1] < e[2] THEN 'Q1-Low'
       WHEN n_chars > e[2] AND n_chars <= e[3] AND e[2] < e[3] THEN 'Q2'
       WHEN n_chars > e[3] AND n_chars <= e[4] AND e[3] < e[4] THEN 'Q3'
       WHEN n_chars > e[4] AND n_chars <= e[5] AND e[4] < e[5] THEN 'Q4-High' END AS income_quartile
  FROM x, qe),
ov AS (SELECT avg(label) AS o FROM x),
l AS (SELECT xg.label, xg.pred, v.dimension, v.grp FROM xg,
      LATERAL (VALUES ('age_group', age_group), ('gender', gender), ('income_quartile', income_quartile), ('lang', lang)) v(dimension, grp)),
ft AS (SELECT dimension, grp, count(*) AS n, avg(label) AS ar, avg(pred) AS pr,
              count_if(label = 1 AND pred = 1) AS tp, count_if(label = 1 AND pred = 0) AS fn,
              count_if(label = 0 AND pred = 1) AS fp, count_if(label = 0 AND pred = 0) AS tn
       FROM l WHERE grp IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
fair AS (SELECT dimension, grp AS "group", CAST(n AS BIGINT) AS n, {R('ar')} AS actual_rate, {R('pr')} AS predicted_rate,
                {R('coalesce(tp / nullif(tp + fn, 0), 0.0)')} AS tpr, {R('coalesce(fp / nullif(fp + tn, 0), 0.0)')} AS fpr,
                {R('coalesce(tp / nullif(tp + fp, 0), 0.0)')} AS precision, {R('pr / (o + 1e-8)')} AS disparate_impact_ratio
         FROM ft, ov)"""


FAIR_CTE = fair_cte()


@query("dir_violations_strict", sql=f"""{fair_cte(f"(SELECT CAST({STRICT_CUT} AS DOUBLE) AS f1_threshold)")}
SELECT * FROM fair WHERE disparate_impact_ratio < 0.8""")
def q_dir_violations_strict(spark, sf_dir):
    """M5 at a strict cut, where few are flagged and groups do fall under the floor."""
    return FA.dir_violations(fairness(spark, sf_dir, STRICT_CUT))


@query("fairness_groups", sql=f"{FAIR_CTE} SELECT * FROM fair")
def q_fairness_groups(spark, sf_dir):
    """Fairness metrics per age band, gender, income quartile and language."""
    return fairness(spark, sf_dir)


@query("dir_violations", sql=f"{FAIR_CTE} SELECT * FROM fair WHERE disparate_impact_ratio < 0.8")
def q_dir_violations(spark, sf_dir):
    """M5: groups with DIR < 0.80."""
    return FA.dir_violations(fairness(spark, sf_dir))


@query("equalized_odds", sql=f"""{FAIR_CTE}
SELECT dimension, CAST(count(*) AS BIGINT) AS n_groups, {R('max(tpr) - min(tpr)')} AS tpr_range,
       {R('max(fpr) - min(fpr)')} AS fpr_range, {R('max(tpr) - min(tpr)')} <= 0.05 AS tpr_ok,
       {R('max(fpr) - min(fpr)')} <= 0.05 AS fpr_ok
FROM fair GROUP BY dimension HAVING count(*) > 1""")
def q_equalized_odds(spark, sf_dir):
    """M6: TPR/FPR spread per dimension and the 5-point parity flags."""
    return FA.equalized_odds(fairness(spark, sf_dir))


@query("dir_matrix", sql=f"""{FAIR_CTE},
dm AS (SELECT * FROM fair WHERE dimension IN ('age_group', 'income_quartile')),
gl AS (SELECT DISTINCT "group" FROM dm), dl AS (SELECT DISTINCT dimension FROM dm)
SELECT dl.dimension, gl."group", coalesce(dm.disparate_impact_ratio, 1.0) AS dir
FROM dl, gl LEFT JOIN dm ON dm.dimension = dl.dimension AND dm."group" = gl."group" """)
def q_dir_matrix(spark, sf_dir):
    """M7/C4: age x income DIR matrix, missing cells = 1.0."""
    return FA.dir_matrix(fairness(spark, sf_dir), ["age_group", "income_quartile"])


@query("class_balance", sql=f"""
SELECT {R('avg(TARGET)')} AS pos_rate, {R('CAST(count_if(TARGET = 0) AS DOUBLE) / count_if(TARGET = 1)')} AS neg_pos_ratio
FROM (SELECT CAST(c_acctbal < 0 AS INTEGER) AS TARGET FROM customer)""")
def q_class_balance(spark, sf_dir):
    """Mean of the label and the negative/positive ratio."""
    c = read_table(spark, sf_dir, "customer").select((F.col("c_acctbal") < 0).cast("int").alias(TARGET))
    return round_doubles(c.agg(F.avg(TARGET).alias("pos_rate"),
                               F.try_divide(F.count_if(F.col(TARGET) == 0).cast("double"),
                                            F.count_if(F.col(TARGET) == 1)).alias("neg_pos_ratio")))


# --------------------------------------------------------------------------- drift

WEEK = 604800  # seconds


def psi_sql(ref: str = "ref", act: str = "act", p: str = "") -> str:
    """PSI CTEs; every CTE name gets the prefix ``p`` (the result is ``{p}psi``)."""
    probs = ", ".join(str(i / 10) for i in range(11))
    return f"""{p}edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(CAST(value AS DOUBLE), [{probs}]))) AS e
          FROM {ref} WHERE value IS NOT NULL GROUP BY feature),
{p}rb AS (SELECT r.feature, CASE WHEN r.value = e[len(e)] THEN len(e) - 2
                              ELSE len(list_filter(e, lambda q: q <= r.value)) - 1 END AS bin
       FROM {ref} r JOIN {p}edges USING (feature) WHERE r.value IS NOT NULL AND r.value >= e[1] AND r.value <= e[len(e)]),
{p}ab AS (SELECT a.feature, a.win, CASE WHEN a.value = e[len(e)] THEN len(e) - 2
                                     ELSE len(list_filter(e, lambda q: q <= a.value)) - 1 END AS bin
       FROM {act} a JOIN {p}edges USING (feature) WHERE a.value IS NOT NULL AND a.value >= e[1] AND a.value <= e[len(e)]),
{p}rc AS (SELECT feature, bin, count(*) AS e_n FROM {p}rb GROUP BY ALL),
{p}ac AS (SELECT feature, win, bin, count(*) AS a_n FROM {p}ab GROUP BY ALL),
{p}keys AS (SELECT DISTINCT feature, win FROM {act}),
{p}grid AS (SELECT k.feature, k.win, len(e) - 1 AS n_bins, UNNEST(range(0, greatest(len(e) - 1, 1))) AS bin
         FROM {p}keys k JOIN {p}edges USING (feature)),
{p}fullg AS (SELECT g.feature, g.win, g.n_bins, g.bin, coalesce(e_n, 0) + 1e-8 AS e, coalesce(a_n, 0) + 1e-8 AS a
          FROM {p}grid g LEFT JOIN {p}rc USING (feature, bin) LEFT JOIN {p}ac USING (feature, win, bin)),
{p}pct AS (SELECT feature, win, n_bins, e / sum(e) OVER (PARTITION BY feature, win) AS ep,
               a / sum(a) OVER (PARTITION BY feature, win) AS ap FROM {p}fullg),
{p}psi AS (SELECT feature, win, CASE WHEN any_value(n_bins) >= 2 THEN sum((ap - ep) * ln(ap / ep)) ELSE 0.0 END AS psi
        FROM {p}pct GROUP BY feature, win)"""


def events_windows(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / WEEK).cast("bigint").alias("win"),
                     F.lit("value").alias("feature"), "value")


ORACLE_PSI_FEATURE = f"""WITH ev AS (SELECT CAST(floor(epoch(ts) / {WEEK}) AS BIGINT) AS win, 'value' AS feature, value FROM events),
ref AS (SELECT feature, value FROM ev WHERE win = (SELECT min(win) FROM ev)),
act AS (SELECT feature, win, value FROM ev),
{psi_sql()}
SELECT feature, win, {R('psi')} AS psi FROM psi"""


@query("psi_feature", sql=ORACLE_PSI_FEATURE)
def q_psi_feature(spark, sf_dir):
    """M8: PSI of events.value per epoch-aligned 7-day window vs the first window."""
    ev = events_windows(spark, sf_dir)
    first = ev.agg(F.min("win").alias("_w0"))
    ref = ev.join(F.broadcast(first), F.col("win") == F.col("_w0")).select("feature", "value")  # one-row side
    return round_doubles(D.psi(ref, ev, ["feature"], "win"))


@query("psi_sketches", sql=f"""SELECT *, true AS sketches_agree FROM ({ORACLE_PSI_FEATURE})""")
def q_psi_sketches(spark, sf_dir):
    """M8 from stored sketches: a sketch of events.value per day is written; the first week's merge to the reference,
    each week's to a window, and no row is read again. They agree with the exact PSI up to the sketches' rank error."""
    ev = read_table(spark, sf_dir, "events").select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), F.lit("value").alias("feature"), "value")
    days = materialize(SK.value_sketches(ev.withColumn("day", F.floor(F.col("s") / 86400)), ("day",)), "kll")
    days = days.withColumn("win", F.floor(F.col("day") / 7).cast("bigint"))
    first = days.agg(F.min("win").alias("_w0"))
    ref = days.join(F.broadcast(first), F.col("win") == F.col("_w0")).drop("_w0")  # one-row side
    edges = materialize(SK.sketch_edges(ref), "edges")
    about = D.psi_from_counts(edges, SK.sketch_counts(ref, edges).withColumnRenamed("n", "e_n"),
                              SK.sketch_counts(days, edges, ("win",)).withColumnRenamed("n", "a_n"),
                              days.select("feature", "win").distinct(), ["feature"], "win")
    both = q_psi_feature(spark, sf_dir).join(about.withColumnRenamed("psi", "_about"), ["feature", "win"])
    return both.select("feature", "win", "psi", (F.abs(F.col("psi") - F.col("_about")) <= PSI_ERROR).alias("sketches_agree"))


#: How far the PSI of stored sketches may be from that of the rows (their rank error is under half a percent).
PSI_ERROR = 0.02

MONITOR = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
           "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "EXT_SOURCE_1",
           "EXT_SOURCE_2", "EXT_SOURCE_3", "DEBT_BURDEN_RATIO", "CREDIT_INCOME_RATIO", "ANNUITY_CREDIT_RATIO"]
WINDOW_NAMES = ["month_1", "month_2", "month_3", "month_4"]


def monitored(spark, sf_dir):
    """(key, split, features..., score) with the test rows' position window, written once."""
    return once(spark, "monitored", sf_dir, lambda: _write_monitored(spark, sf_dir))


def _write_monitored(spark, sf_dir):
    fe = FE.domain_features(applicant_finance(spark, sf_dir))
    fe = fe.withColumn("score", F.col("EXT_SOURCE_MEAN"))
    sp = SP.stratified_split(fe.select(KEY, TARGET), KEY, TARGET, 0.2).select(KEY, "split")
    fe = fe.join(sp, KEY)
    wins = SP.position_windows(fe.where(F.col("split") == "test").select(KEY), KEY, 4, col="win")
    return materialize(fe.join(wins, KEY, "left"), "monitored")


def feature_psi(spark, sf_dir, cols=MONITOR, m=None):
    m = m if m is not None else monitored(spark, sf_dir)
    q = [fround(F.col(c).cast("double"), RES).alias(c) for c in cols]
    m = m.select("split", "win", *q)
    ref = P.to_long(m.where(F.col("split") == "train"), cols).withColumnRenamed("column_name", "feature")
    act = P.to_long(m.where(F.col("win").isNotNull()), cols, ids=["win"]).withColumnRenamed("column_name", "feature")
    return D.psi(ref, act, ["feature"], "win")


MON_CTE = f"""WITH {FINANCE_CTE[5:]},
fe AS (SELECT fin.*, {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin),
{SPLIT_CTE[5:]},
tw AS (SELECT c_custkey, row_number() OVER (ORDER BY {H_CUST}, c_custkey) AS pos, count(*) OVER () AS n_all
       FROM s WHERE split = 'test'),
wn AS (SELECT c_custkey, CAST(floor((pos - 1) / floor(n_all / 4)) AS INTEGER) AS win FROM tw
       WHERE floor((pos - 1) / floor(n_all / 4)) < 4),
m AS (SELECT fe.*, fe.EXT_SOURCE_MEAN AS score, s.split, wn.win FROM fe JOIN s USING (c_custkey) LEFT JOIN wn USING (c_custkey))"""

# values are quantised to 1e-6 before binning: mathematically equal values (averages
# of cents summed in different orders) then bin identically on every run/engine
RES = 6
_VALS = ", ".join(f"('{c}', {R(f'CAST({c} AS DOUBLE)', RES)})" for c in MONITOR)
PSI_TABLE_CTE = f"""{MON_CTE},
ref AS (SELECT v.feature, v.value FROM m, LATERAL (VALUES {_VALS}) v(feature, value) WHERE m.split = 'train'),
act AS (SELECT v.feature, m.win, v.value FROM m, LATERAL (VALUES {_VALS}) v(feature, value) WHERE m.win IS NOT NULL),
{psi_sql()},
pt AS (SELECT feature, {', '.join(f"coalesce(max(CASE WHEN win = {i} THEN {R('psi')} END), 0.0) AS {w}" for i, w in enumerate(WINDOW_NAMES))}
       FROM psi GROUP BY feature),
ptm AS (SELECT *, greatest({', '.join(WINDOW_NAMES)}) AS max_psi FROM pt)"""


def psi_table(spark, sf_dir, cols=MONITOR, m=None):
    p = feature_psi(spark, sf_dir, cols, m).withColumn("psi", fround("psi"))
    wide = p.groupBy("feature").pivot("win", [0, 1, 2, 3]).agg(F.first("psi"))
    wide = wide.select("feature", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(w)
                                    for i, w in enumerate(WINDOW_NAMES)])
    return wide.withColumn("max_psi", F.greatest(*WINDOW_NAMES))


ORACLE_PSI_TABLE = f"""{PSI_TABLE_CTE}
SELECT *, CASE WHEN max_psi > 0.2 THEN 'drifted' WHEN max_psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS drift_class
FROM ptm ORDER BY max_psi DESC, feature"""


@query("psi_table", sql=ORACLE_PSI_TABLE)
def q_psi_table(spark, sf_dir):
    """15 features x 4 test windows vs the training rows, Max PSI, drift class."""
    t = psi_table(spark, sf_dir)
    return t.withColumn("drift_class", D.drift_class(F.col("max_psi"))).orderBy(F.desc("max_psi"), "feature")


@query("psi_by_importance")
def q_psi_by_importance(spark, sf_dir):
    """M9: the table for the 15 columns of the model's own matrix that matter most to it: the training rows
    against four position windows of the test rows."""
    from pyspark.ml.functions import vector_to_array

    from ledgerlens.plans import modeling as MD
    fm, names = MD.feature_matrix(spark, sf_dir)
    cols = MD.ranked_features(spark, sf_dir, 15)
    wins = SP.position_windows(fm.where(F.col("split") == "test").select(KEY), KEY, 4, col="win")
    x = vector_to_array(MD.MO.FEATURES)
    m = fm.select(KEY, "split", *[x[names.index(c)].alias(c) for c in cols]).join(wins, KEY, "left")
    t = psi_table(spark, sf_dir, cols, m)
    return t.withColumn("drift_class", D.drift_class(F.col("max_psi"))).orderBy(F.desc("max_psi"), "feature")


SCORE_CTE = f"""{MON_CTE},
ref AS (SELECT 'score' AS feature, {R('score', RES)} AS value FROM m WHERE split = 'train'),
act AS (SELECT 'score' AS feature, win, {R('score', RES)} AS value FROM m WHERE win IS NOT NULL),
{psi_sql()},
sp AS (SELECT win, {R('psi')} AS score_psi FROM psi)"""


def score_psi(spark, sf_dir):
    m = monitored(spark, sf_dir).withColumn("score", fround("score", RES))
    ref = m.where(F.col("split") == "train").select(F.lit("score").alias("feature"), F.col("score").alias("value"))
    act = m.where(F.col("win").isNotNull()).select(F.lit("score").alias("feature"), "win", F.col("score").alias("value"))
    return D.psi(ref, act, ["feature"], "win").select("win", fround("psi").alias("score_psi"))


@query("psi_score", sql=f"""{SCORE_CTE}
SELECT win, score_psi, CASE WHEN score_psi > 0.2 THEN 'RETRAIN' WHEN score_psi > 0.1 THEN 'MONITOR' ELSE 'STABLE' END AS status
FROM sp""")
def q_psi_score(spark, sf_dir):
    """Score PSI per window with RETRAIN / MONITOR / STABLE status."""
    return score_psi(spark, sf_dir).withColumn("status", D.score_status(F.col("score_psi")))


@query("psi_density", sql=f"""{MON_CTE},
sc AS (SELECT CASE WHEN split = 'train' THEN -1 ELSE win END AS win, score FROM m
       WHERE (split = 'train' OR win IS NOT NULL) AND score IS NOT NULL),
st AS (SELECT win, min(score) AS mn, max(score) AS mx, count(*) AS n FROM sc GROUP BY win),
cn AS (SELECT sc.win, CAST(least(floor((score - mn) * 40 / (mx - mn)), 39) AS INTEGER) AS bin, count(*) AS cnt
       FROM sc JOIN st USING (win) GROUP BY ALL),
gr AS (SELECT st.*, CAST(UNNEST(range(40)) AS INTEGER) AS bin FROM st)
SELECT gr.win, gr.bin, CAST(coalesce(cnt, 0) AS BIGINT) AS count,
       {R('coalesce(cnt, 0) / (n * ((mx - mn) / 40))')} AS density
FROM gr LEFT JOIN cn USING (win, bin)""")
def q_psi_density(spark, sf_dir):
    """40-bin score density per window (-1 = training reference)."""
    m = monitored(spark, sf_dir)
    sc = m.where(((F.col("split") == "train") | F.col("win").isNotNull()) & F.col("score").isNotNull()).select(
        F.when(F.col("split") == "train", F.lit(-1)).otherwise(F.col("win")).alias("win"), "score")
    h = P.grouped_histogram(sc, "score", "win", 40)
    return round_doubles(h.select("win", "bin", "count", "density"))


@query("retrain_trigger", sql=f"""{MON_CTE},
ref AS (SELECT v.feature, v.value FROM m, LATERAL (VALUES {_VALS}) v(feature, value) WHERE m.split = 'train'),
act AS (SELECT v.feature, m.win, v.value FROM m, LATERAL (VALUES {_VALS}) v(feature, value) WHERE m.win IS NOT NULL),
{psi_sql('ref', 'act', 'f_')},
sref AS (SELECT 'score' AS feature, {R('score', RES)} AS value FROM m WHERE split = 'train'),
sact AS (SELECT 'score' AS feature, win, {R('score', RES)} AS value FROM m WHERE win IS NOT NULL),
{psi_sql('sref', 'sact', 's_')},
fm AS (SELECT feature, max({R('psi')}) AS max_psi FROM f_psi GROUP BY feature),
t AS (SELECT (SELECT count(*) FROM fm WHERE max_psi > 0.2) AS n_drifted_features,
             (SELECT count(*) FROM s_psi WHERE {R('psi')} > 0.2) AS n_score_windows)
SELECT CAST(n_drifted_features AS BIGINT) AS n_drifted_features, CAST(n_score_windows AS BIGINT) AS n_score_windows,
       n_drifted_features > 0 OR n_score_windows > 0 AS retrain FROM t""")
def q_retrain_trigger(spark, sf_dir):
    """Retrain when any feature drifted or any score window has PSI > 0.20."""
    p = feature_psi(spark, sf_dir, [*MONITOR, "score"])   # the score is a 16th monitored column
    p = p.select("feature", "win", (fround("psi") > D.DRIFTED).alias("over"))
    is_score = F.col("feature") == "score"
    return p.agg(F.count_distinct(F.when(F.col("over") & ~is_score, F.col("feature"))).alias("n_drifted_features"),
                 F.count_if(F.col("over") & is_score).alias("n_score_windows")).select(
        "n_drifted_features", "n_score_windows",
        ((F.col("n_drifted_features") > 0) | (F.col("n_score_windows") > 0)).alias("retrain"))
