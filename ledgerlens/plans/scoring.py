"""Scoring and explanation queries."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ledgerlens.functions.stats import EPS, fround
from ledgerlens.operators import curves as C
from ledgerlens.operators import explain as X
from ledgerlens.operators import features as FE
from ledgerlens.operators import models as MO
from ledgerlens.operators import split as SP
from ledgerlens.operators import treeshap as TS
from ledgerlens.plans.features import FEATURE_SQL, FINANCE_CTE, applicant_finance
from ledgerlens.plans.modeling import _split, fitted_lr, parallelism
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.splits import SPLIT_CTE
from ledgerlens.plans.sqlgen import R
from ledgerlens.session import materialize, once
from ledgerlens.sources.tables import KEY


# --------------------------------------------------------------------------- dashboard rule (SQL-checked)

def dashboard_inputs(spark, sf_dir):
    """The dashboard's four inputs per applicant and the features derived from them."""
    fe = FE.domain_features(applicant_finance(spark, sf_dir))
    return fe.select(
        KEY,
        F.col("AMT_INCOME_TOTAL").alias("income"),
        F.col("AMT_CREDIT").alias("loan_amount"),
        (300 + 550 * F.coalesce(F.col("EXT_SOURCE_MEAN"), F.lit(0.5))).alias("credit_score"),
        F.coalesce(F.col("YEARS_EMPLOYED"), F.lit(0.0)).alias("employment_years"))


def rule_scored(d):
    """The dashboard rule over its inputs (the same projection in batch and as a stream)."""
    score = X.rule_score(F.col("loan_amount"), F.col("income"), F.col("credit_score"))
    return d.select(
        KEY, "income", "loan_amount", "credit_score", "employment_years",
        (-F.col("employment_years") * 365).alias("days_employed"),
        F.try_divide(F.col("loan_amount"), F.col("income") + EPS).alias("credit_income_ratio"),
        score.alias("risk_score"),
        F.when(score > 60, "HIGH RISK").otherwise("LOW RISK").alias("risk_band"))


def dashboard_scored(spark, sf_dir):
    return rule_scored(dashboard_inputs(spark, sf_dir))


DASH_CTE = f"""WITH {FINANCE_CTE[5:]},
fe AS (SELECT fin.*, {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin),
di AS (SELECT c_custkey, AMT_INCOME_TOTAL AS income, AMT_CREDIT AS loan_amount,
              300 + 550 * coalesce(EXT_SOURCE_MEAN, 0.5) AS credit_score, coalesce(YEARS_EMPLOYED, 0.0) AS employment_years FROM fe),
ds AS (SELECT *, least(greatest(CAST(trunc(least(greatest(loan_amount / (income + 1) * 100 - (credit_score - 600) / 2, -1.0), 101.0)) AS INTEGER), 0), 100) AS risk_score FROM di)"""


ORACLE_RULE_SCORE = f"""{DASH_CTE}
SELECT c_custkey, {R('income')} AS income, {R('loan_amount')} AS loan_amount, {R('credit_score')} AS credit_score,
       {R('employment_years')} AS employment_years, {R('-employment_years * 365')} AS days_employed,
       {R(f'loan_amount / (income + {EPS})')} AS credit_income_ratio, risk_score,
       CASE WHEN risk_score > 60 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_band FROM ds"""


@query("rule_score", sql=ORACLE_RULE_SCORE)
def q_rule_score(spark, sf_dir):
    """The dashboard rule score (clip(int(...), 0, 100), > 60 = HIGH) per applicant."""
    return round_doubles(dashboard_scored(spark, sf_dir))


@query("highest_risk", sql=f"""{DASH_CTE}
SELECT c_custkey, risk_score FROM ds ORDER BY risk_score DESC, c_custkey LIMIT 1""")
def q_highest_risk(spark, sf_dir):
    """The highest-risk applicant (first key on ties)."""
    d = dashboard_scored(spark, sf_dir)
    return d.agg(F.min_by(F.struct(KEY, "risk_score"), F.struct(-F.col("risk_score"), F.col(KEY))).alias("b")).select(
        "b.*")


# --------------------------------------------------------------------------- model scoring / attributions

def feature_means(rows) -> list[float]:
    return rows.select(Summarizer.mean(F.col(MO.FEATURES)).alias("m")).first()["m"].toArray().tolist()


def _lr_parts(spark, sf_dir):
    tr, te, names = _split(spark, sf_dir)
    lr = fitted_lr(spark, sf_dir)
    return tr, te, names, lr, feature_means(tr)


def f1_threshold(scored):
    best = C.best_threshold(C.threshold_scan(C.cumulative_counts(C.score_counts(scored, "score", MO.LABEL))))
    return best.first()["f1_threshold"]


def explained_rows(spark, sf_dir, n: int = 2000):
    """<= 2000 test rows drawn without replacement (G4) for attribution work."""
    _, te, _ = _split(spark, sf_dir)
    return SP.uniform_sample(te, KEY, n)


def linear_attr(spark, sf_dir):
    tr, te, names, lr, means = _lr_parts(spark, sf_dir)
    rows = explained_rows(spark, sf_dir)
    return X.linear_attributions(rows, KEY, MO.FEATURES, names, lr.coefficients.toArray().tolist(), means)


def scored_test(spark, sf_dir):
    """All test rows with the model's probability, and its F1-optimal cut on them."""
    _, te, _ = _split(spark, sf_dir)
    s = MO.probability(fitted_lr(spark, sf_dir), te, [KEY, MO.LABEL])
    return te, s, f1_threshold(s)


@query("score_batch")
def q_score_batch(spark, sf_dir):
    """Batch scoring output of the test rows at the model's F1-optimal cut."""
    _, s, cut = scored_test(spark, sf_dir)
    return X.score_output(s, [KEY], cut)


@query("explain_batch")
def q_explain_batch(spark, sf_dir):
    """The scoring output of every test row, at the same cut as ``score_batch``, plus the 10
    largest attributions with direction."""
    te, s, cut = scored_test(spark, sf_dir)
    _, _, names, lr, means = _lr_parts(spark, sf_dir)
    attr = X.linear_attributions(te, KEY, MO.FEATURES, names, lr.coefficients.toArray().tolist(), means,
                                 largest=X.TOP_FACTORS)       # a row's other features are not sorted
    return X.score_output(s, [KEY], cut).join(X.top_factors(attr, KEY), KEY)


@query("shap_linear")
def q_shap_linear(spark, sf_dir):
    """L1 (linear, exact): coef * (x - train mean) per sampled test row and feature."""
    return round_doubles(linear_attr(spark, sf_dir), 6)


@query("attribution_colstats")
def q_attribution_colstats(spark, sf_dir):
    """Column-wise mean |attribution| and mean attribution of the attribution matrix."""
    a = linear_attr(spark, sf_dir)
    return round_doubles(a.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"),
                                                  F.avg("attribution").alias("mean_signed")), 5)


@query("shap_global")
def q_shap_global(spark, sf_dir):
    """L2: global attribution table, top 20 by mean |value| (5 decimals)."""
    return round_doubles(X.global_table(linear_attr(spark, sf_dir)), 5)


@query("shap_drivers")
def q_shap_drivers(spark, sf_dir):
    """L3: top-5 drivers with direction (> 0 increases risk)."""
    return round_doubles(X.drivers(X.global_table(linear_attr(spark, sf_dir))), 5)


@query("shap_waterfall")
def q_shap_waterfall(spark, sf_dir):
    """L4: the highest-risk sampled row: base value, 15 largest attributions, the rest summed."""
    rows = explained_rows(spark, sf_dir)
    lr = fitted_lr(spark, sf_dir)
    s = MO.probability(lr, rows, [KEY])
    top = s.orderBy(F.desc("score"), KEY).limit(1).first()[KEY]
    tr, _, names, _, means = _lr_parts(spark, sf_dir)
    base = float(sum(c * m for c, m in zip(lr.coefficients.toArray().tolist(), means)) + lr.intercept)
    return round_doubles(X.waterfall(linear_attr(spark, sf_dir), KEY, top, base), 6)


@query("shap_beeswarm")
def q_shap_beeswarm(spark, sf_dir):
    """(row, feature, value, attribution) of the 20 top global features."""
    a = linear_attr(spark, sf_dir)
    return round_doubles(X.beeswarm(a, X.global_table(a)), 6)


@query("shap_perm")
def q_shap_perm(spark, sf_dir):
    """L1 (trees): permutation Shapley values of the decision tree (4 seeded orders) for every test row,
    against the train-mean background; per row they sum to f(x) - f(background)."""
    from ledgerlens.plans.modeling import fitted
    tr, te, names = _split(spark, sf_dir)
    model = fitted(spark, sf_dir, "tree", MO.tree)  # the train_tree fit
    bg = feature_means(tr)
    rows = te.repartition(4 * parallelism(spark))     # a row is scored orders x (features + 1) times
    return round_doubles(X.permutation_attributions(model, rows, KEY, MO.FEATURES, names, bg, orders=4), 6)


# --------------------------------------------------------------------------- exact attributions of the boosted trees

def tree_paths(spark, sf_dir):
    from ledgerlens.plans.modeling import fitted_early
    return TS.of_boosted(fitted_early(spark, sf_dir))


def tree_attr(spark, sf_dir):
    """L1 on the sampled test rows, written once: five tables read it."""
    def write():
        _, _, names = _split(spark, sf_dir)
        rows = explained_rows(spark, sf_dir).repartition(parallelism(spark), KEY)     # a draw is one partition
        return materialize(TS.attributions(tree_paths(spark, sf_dir), rows, KEY, MO.FEATURES, names), "tree-attr")
    return once(spark, "tree_attr", sf_dir, write)


@query("shap_tree")
def q_shap_tree(spark, sf_dir):
    """L1 (trees, exact): path-dependent Shapley values of the leaf-wise model's log odds; a row's values
    and the base value add up to its log odds."""
    return round_doubles(tree_attr(spark, sf_dir), 6)


@query("shap_tree_check")
def q_shap_tree_check(spark, sf_dir):
    """L1: per explained row the base value plus all attributions, and the model's own score of it."""
    from ledgerlens.operators import stages as ST
    from ledgerlens.plans.modeling import fitted_early
    base = tree_paths(spark, sf_dir).base
    sums = tree_attr(spark, sf_dir).groupBy(KEY).agg((F.sum("attribution") + F.lit(base)).alias("log_odds"))
    scored = ST.BoostedModel.of(fitted_early(spark, sf_dir)).transform(explained_rows(spark, sf_dir)).select(KEY, "score")
    return round_doubles(sums.join(scored, KEY).select(KEY, (1 / (1 + F.exp(-F.col("log_odds")))).alias("from_parts"), "score"), 6)


@query("shap_tree_adds_up", sql=f"""{SPLIT_CTE}
SELECT least(count(*), 2000) AS n_rows, true AS adds_up FROM s WHERE split = 'test'""")
def q_shap_tree_adds_up(spark, sf_dir):
    """L1: whether every explained row's base value and attributions give the model's score of it."""
    parts = q_shap_tree_check(spark, sf_dir)
    return parts.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.bool_and(F.abs(F.col("from_parts") - F.col("score")) <= 1e-6).alias("adds_up"))


@query("shap_tree_global")
def q_shap_tree_global(spark, sf_dir):
    """L2 for the trees: top 20 by mean |value|."""
    return round_doubles(X.global_table(tree_attr(spark, sf_dir)), 5)


@query("shap_tree_drivers")
def q_shap_tree_drivers(spark, sf_dir):
    """L3 for the trees: top-5 drivers with direction."""
    return round_doubles(X.drivers(X.global_table(tree_attr(spark, sf_dir))), 5)


@query("shap_tree_waterfall")
def q_shap_tree_waterfall(spark, sf_dir):
    """L4 for the trees: the row of the highest log odds (first key on ties)."""
    a = tree_attr(spark, sf_dir)
    top = a.groupBy(KEY).agg(F.sum("attribution").alias("s")).orderBy(F.desc("s"), KEY).limit(1).first()[KEY]
    return round_doubles(X.waterfall(a, KEY, top, tree_paths(spark, sf_dir).base), 6)


@query("shap_tree_beeswarm")
def q_shap_tree_beeswarm(spark, sf_dir):
    """L5 for the trees."""
    a = tree_attr(spark, sf_dir)
    return round_doubles(X.beeswarm(a, X.global_table(a)), 6)
