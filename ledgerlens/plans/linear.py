"""Scoring and explanation with a fixed linear model (J1, J3, J4, L1-L5, D8, F17 -> F15).

The operators are those of the fitted models; with stated coefficients every
output is a function of the tables that SQL computes too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import explain as X
from ledgerlens.operators import features as FE
from ledgerlens.operators import models as MO
from ledgerlens.operators import prep as PR
from ledgerlens.operators import split as SP
from ledgerlens.plans.features import FEATURE_SQL, FINANCE_CTE, applicant_finance
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.splits import SPLIT_CTE
from ledgerlens.plans.sqlgen import R
from ledgerlens.session import materialize, once
from ledgerlens.sources.tables import KEY, TARGET

#: feature: coefficient on the scaled value
COEF = {"EXT_SOURCE_1": -0.9, "EXT_SOURCE_2": -1.1, "EXT_SOURCE_3": -0.7, "AGE_YEARS": -0.25,
        "CREDIT_INCOME_RATIO": 0.6, "CNT_FAM_MEMBERS": 0.35, "AMT_CREDIT": 0.15, "AMT_ANNUITY": -0.05}
NAMES = list(COEF)
INTERCEPT, CUT = -0.2, 0.5
TOP = 5


def _frame(spark, sf_dir):
    """(key, TARGET, split, features with nulls as 0), written once."""
    def write():
        fe = FE.domain_features(applicant_finance(spark, sf_dir)).select(
            KEY, TARGET, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in NAMES])
        return materialize(SP.stratified_split(fe, KEY, TARGET, 0.2), "linear")
    return once(spark, "linear", sf_dir, write)


def _scaled_test(spark, sf_dir):
    """Test rows scaled with the training rows' parameters (F15), features as one vector."""
    df = _frame(spark, sf_dir)
    scaled = PR.apply_scale(df.where(F.col("split") == "test"), PR.scale_params(df, NAMES))
    return MO.assemble(scaled, NAMES)


def _margin():
    return F.lit(INTERCEPT) + sum((F.lit(b) * F.col(c) for c, b in list(COEF.items())[1:]),
                                  F.lit(COEF[NAMES[0]]) * F.col(NAMES[0]))


def _probability(df):
    return df.withColumn("score", 1 / (1 + F.exp(-_margin())))


def attributions(spark, sf_dir):
    """Against a background of zeros: the scaled training mean."""
    return X.linear_attributions(_scaled_test(spark, sf_dir), KEY, MO.FEATURES, NAMES, list(COEF.values()),
                                 [0.0] * len(NAMES))


_VALS = lambda src: ", ".join(f"('{c}', {src}.{c}, {b}, {i})" for i, (c, b) in enumerate(COEF.items()))
LIN_CTE = f"""WITH {FINANCE_CTE[5:]},
fe AS (SELECT fin.*, {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin),
{SPLIT_CTE[5:]},
fz AS (SELECT c_custkey, s.split, {', '.join(f'coalesce(CAST(fe.{c} AS DOUBLE), 0.0) AS {c}' for c in NAMES)}
       FROM fe JOIN s USING (c_custkey)),
pa AS (SELECT {', '.join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}_s" for c in NAMES)}
       FROM fz WHERE split = 'train'),
x AS (SELECT c_custkey, {', '.join(f'(fz.{c} - {c}_m) / {c}_s AS {c}' for c in NAMES)} FROM fz, pa WHERE split = 'test'),
sc AS (SELECT *, {INTERCEPT} + {' + '.join(f'{b} * {c}' for c, b in COEF.items())} AS margin FROM x),
pr AS (SELECT *, 1 / (1 + exp(-margin)) AS score FROM sc),
att AS (SELECT x.c_custkey, v.feature, v.value AS input_value, v.coef * v.value AS attribution
       FROM x, LATERAL (VALUES {_VALS('x')}) v(feature, value, coef, pos)),
gl AS (SELECT feature, avg(abs(attribution)) AS mean_abs, avg(attribution) AS mean_signed FROM att GROUP BY feature),
rk AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(attribution) DESC, feature) AS r FROM att),
hi AS (SELECT c_custkey FROM pr ORDER BY score DESC, c_custkey LIMIT 1)"""


@query("lin_scaled_rows", sql=f"""{LIN_CTE}
SELECT c_custkey, {', '.join(f'{R(c, 6)} AS {c}' for c in NAMES)} FROM x""")
def q_lin_scaled_rows(spark, sf_dir):
    """F15 applied: the test rows scaled with the training parameters."""
    return round_doubles(_scaled_test(spark, sf_dir).select(KEY, *NAMES), 6)


@query("lin_score", sql=f"""{LIN_CTE}
SELECT c_custkey, {R('score', 6)} AS default_probability,
       CASE WHEN score >= {CUT} THEN '{X.HIGH}' ELSE '{X.LOW}' END AS risk_label,
       CAST({CUT} AS DOUBLE) AS threshold_used, CAST(score >= {CUT} AS INTEGER) AS predicted_class FROM pr""")
def q_lin_score(spark, sf_dir):
    """Scoring output of the test rows (without the time stamp)."""
    return X.score_output(_probability(_scaled_test(spark, sf_dir)), [KEY], CUT).drop("timestamp")


@query("lin_explain", sql=f"""{LIN_CTE}
SELECT rk.c_custkey, {R('score', 6)} AS default_probability, CAST(r AS INTEGER) AS rank, feature,
       {R('attribution', 6)} AS shap_value, {R('input_value')} AS input_value,
       CASE WHEN attribution > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction
FROM rk JOIN pr USING (c_custkey) WHERE r <= {TOP}""")
def q_lin_explain(spark, sf_dir):
    """Every test row's score and its largest attributions, one row each."""
    s = X.score_output(_probability(_scaled_test(spark, sf_dir)), [KEY], CUT)
    out = s.join(X.top_factors(attributions(spark, sf_dir), KEY, TOP), KEY)
    return out.select(KEY, "default_probability", F.posexplode("top_risk_factors").alias("pos", "f")).select(
        KEY, "default_probability", (F.col("pos") + 1).alias("rank"), "f.feature", "f.shap_value", "f.input_value",
        "f.direction")


@query("lin_minmax", sql=f"""{LIN_CTE}
SELECT c_custkey, {R('(margin - (SELECT min(margin) FROM sc)) / ((SELECT max(margin) FROM sc) - (SELECT min(margin) FROM sc))', 6)} AS score
FROM sc""")
def q_lin_minmax(spark, sf_dir):
    """Margins scaled to [0, 1] by the scored rows' range."""
    m = _scaled_test(spark, sf_dir).withColumn("margin", _margin())
    return round_doubles(MO.minmax(m, "margin", [KEY]), 6)


@query("lin_attributions", sql=f"""{LIN_CTE}
SELECT c_custkey, feature, {R('input_value', 6)} AS input_value, {R('attribution', 6)} AS attribution FROM att""")
def q_lin_attributions(spark, sf_dir):
    """L1: exact attributions of every test row."""
    return round_doubles(attributions(spark, sf_dir), 6)


@query("lin_colstats", sql=f"""{LIN_CTE}
SELECT feature, {R('mean_abs', 5)} AS mean_abs, {R('mean_signed', 5)} AS mean_signed FROM gl""")
def q_lin_colstats(spark, sf_dir):
    """Column-wise mean |attribution| and mean attribution."""
    a = attributions(spark, sf_dir)
    return round_doubles(a.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"),
                                                  F.avg("attribution").alias("mean_signed")), 5)


@query("lin_global", sql=f"""{LIN_CTE}
SELECT feature, {R('mean_abs', 5)} AS mean_abs, {R('mean_signed', 5)} AS mean_signed FROM gl
ORDER BY gl.mean_abs DESC, feature LIMIT {TOP}""")
def q_lin_global(spark, sf_dir):
    """L2: the largest features by mean |attribution|."""
    return round_doubles(X.global_table(attributions(spark, sf_dir), TOP), 5)


@query("lin_drivers", sql=f"""{LIN_CTE}
SELECT feature, {R('mean_abs', 5)} AS mean_abs, {R('mean_signed', 5)} AS mean_signed,
       CASE WHEN gl.mean_signed > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction
FROM gl ORDER BY gl.mean_abs DESC, feature LIMIT 3""")
def q_lin_drivers(spark, sf_dir):
    """L3: top drivers with direction."""
    return round_doubles(X.drivers(X.global_table(attributions(spark, sf_dir)), 3), 5)


@query("lin_waterfall", sql=f"""{LIN_CTE},
one AS (SELECT rk.* FROM rk JOIN hi USING (c_custkey))
SELECT 0 AS step, 'base value' AS feature, {R(str(INTERCEPT), 6)} AS attribution
UNION ALL SELECT CAST(r AS INTEGER), feature, {R('attribution', 6)} FROM one WHERE r <= {TOP}
UNION ALL SELECT {TOP + 1}, 'other features', {R('coalesce(sum(attribution), 0.0)', 6)} FROM one WHERE r > {TOP}""")
def q_lin_waterfall(spark, sf_dir):
    """L4: the highest-risk row: base value, its largest attributions, the rest summed."""
    s = _probability(_scaled_test(spark, sf_dir))
    top = s.orderBy(F.desc("score"), KEY).select(KEY).limit(1).first()
    return round_doubles(X.waterfall(attributions(spark, sf_dir), KEY, top[0] if top else None, INTERCEPT, TOP), 6)


@query("lin_beeswarm", sql=f"""{LIN_CTE}
SELECT feature, c_custkey, {R('input_value', 6)} AS input_value, {R('attribution', 6)} AS attribution FROM att
WHERE feature IN (SELECT feature FROM gl ORDER BY mean_abs DESC, feature LIMIT 3)""")
def q_lin_beeswarm(spark, sf_dir):
    """(row, feature, value, attribution) of the largest global features."""
    a = attributions(spark, sf_dir)
    return round_doubles(X.beeswarm(a, X.global_table(a, 3)), 6)


SPARSE_SQL = f"""{LIN_CTE},
rq AS (SELECT c_custkey, {', '.join(f"CASE WHEN c_custkey % 4 <> {i % 4} THEN fz.{c} ELSE 0.0 END AS {c}" for i, c in enumerate(NAMES))} FROM fz),
rx AS (SELECT c_custkey, {', '.join(f'(rq.{c} - {c}_m) / {c}_s AS {c}' for c in NAMES)} FROM rq, pa),
rs AS (SELECT c_custkey, 1 / (1 + exp(-({INTERCEPT} + {' + '.join(f'{b} * {c}' for c, b in COEF.items())}))) AS score FROM rx)
SELECT c_custkey, {R('score', 6)} AS default_probability, CAST(score >= {CUT} AS INTEGER) AS predicted_class FROM rs"""


@query("sparse_request_score", sql=SPARSE_SQL)
def q_sparse_request_score(spark, sf_dir):
    """J3 from sparse requests: a map with some features -> default fill (F17) -> scale (F15) -> score."""
    return request_scorer(spark, sf_dir)(requests(spark, sf_dir))


def requests(spark, sf_dir):
    """(key, map of the features that a request gives): every fourth feature is missing."""
    given = F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(c).alias("k"), F.when(F.col(KEY) % 4 != i % 4, F.col(c)).alias("v"))
        for i, c in enumerate(NAMES)]), lambda e: e["v"].isNotNull()))
    return _frame(spark, sf_dir).select(KEY, given.alias("request"))


def request_scorer(spark, sf_dir):
    """The pipeline fitted on the training rows, as a function of requests (a batch or a stream)."""
    params = PR.scale_params(_frame(spark, sf_dir), NAMES)
    fitted = spark.createDataFrame(params.collect(), params.schema)     # a row per feature

    def score(request):
        filled = PR.default_fill(request, "request", NAMES).drop("request")
        scored = X.score_output(_probability(PR.apply_scale(filled, fitted)), [KEY], CUT)
        return scored.select(KEY, "default_probability", "predicted_class")
    return score
