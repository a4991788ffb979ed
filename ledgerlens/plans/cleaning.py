"""Cleaning queries (F1-F17, A11) on the applicant model frame.

model frame = applicant roll-ups (D2, C2) + domain features (E) + nation name,
with the stratified split column (G1); statistics are fitted on the training
rows (SURVEY X3).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import features as FE
from ledgerlens.operators import prep as PR
from ledgerlens.operators import sketches as SK
from ledgerlens.operators import split as SP
from ledgerlens.plans.features import FEATURE_SQL, FINANCE_CTE, applicant_finance
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.rollups import APPLICANT_BASE_COLS, APPLICANT_BASE_CTE, applicant_base
from ledgerlens.plans.splits import SPLIT_CTE
from ledgerlens.plans.sqlgen import R, skew_sql
from ledgerlens.session import materialize, once
from ledgerlens.sources.tables import KEY, TARGET, read_table

FIN_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
            "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH",
            "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
FEAT_COLS = [n for g in FEATURE_SQL.values() for n in g]
BASE_COLS = [c for c, _ in APPLICANT_BASE_COLS]
MODEL_COLS = BASE_COLS + FIN_COLS + FEAT_COLS + ["n_name"]
CATEGORICAL = ["c_mktsegment", "n_name"]
CANDIDATES = [c for c in MODEL_COLS if c not in (KEY, TARGET)]
NUMERIC = [c for c in CANDIDATES if c not in CATEGORICAL]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # fixed values: c_mktsegment domain


def model_frame(spark, sf_dir):
    base = applicant_base(spark, sf_dir)
    fe = FE.domain_features(applicant_finance(spark, sf_dir)).drop(TARGET)
    nat = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    mf = base.join(fe, KEY, "left").join(nat, "c_nationkey", "left").select(*MODEL_COLS)
    split = SP.stratified_split(mf.select(KEY, TARGET), KEY, TARGET, 0.2).select(KEY, "split")
    return mf.join(split, KEY)


def materialized_model_frame(spark, sf_dir):
    """The model frame written to the checkpoint folder. While it is computed,
    the per-customer aggregate feeding both the roll-up and the finance columns
    is cached, so the largest tables are scanned and shuffled once."""
    return once(spark, "model-frame", sf_dir, lambda: _write_model_frame(spark, sf_dir))


def _write_model_frame(spark, sf_dir):
    from pyspark import StorageLevel
    from ledgerlens.plans.rollups import customer_order_stats
    shared = customer_order_stats(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return materialize(model_frame(spark, sf_dir), "model-frame")
    finally:
        shared.unpersist()


MF_CTE = f"""{APPLICANT_BASE_CTE},
{FINANCE_CTE[5:]},
fe AS (SELECT fin.* EXCLUDE (TARGET), {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin),
{SPLIT_CTE[5:]},
mf AS (SELECT {', '.join('base.' + c for c in BASE_COLS)}, {', '.join('fe.' + c for c in FIN_COLS + FEAT_COLS)}, n.n_name, s.split
       FROM base LEFT JOIN fe USING (c_custkey) LEFT JOIN nation n ON n.n_nationkey = base.c_nationkey
       JOIN s USING (c_custkey))"""


def _id_like(name_sql: str) -> str:
    return " OR ".join(f"lower({name_sql}) LIKE '%{p}%'" for p in PR.ID_PATTERNS)


DROP_CTE = f"""{MF_CTE},
st AS (SELECT count(*) AS n, {', '.join(f'count_if({c} IS NULL) AS "{c}__n", (min({c}) IS NULL OR min({c}) = max({c})) AS "{c}__k"' for c in CANDIDATES)} FROM mf),
dp AS (SELECT v.column_name,
              CASE WHEN v.k THEN 'constant' WHEN {_id_like('v.column_name')} THEN 'id_pattern'
                   WHEN v.nulls * 100.0 / n > {PR.NULL_DROP_PCT} THEN 'high_null' END AS reason,
              {R('v.nulls * 100.0 / n')} AS null_pct
       FROM st, LATERAL (VALUES {', '.join(f"('{c}', \"{c}__k\", \"{c}__n\")" for c in CANDIDATES)}) v(column_name, k, nulls))"""


def drop_plan(spark, sf_dir, mf=None):
    mf = mf if mf is not None else materialized_model_frame(spark, sf_dir)
    return PR.drop_plan(mf.drop("split"), KEY, TARGET)


@query("drop_const_id", sql=f"""{DROP_CTE}
SELECT column_name, reason, null_pct FROM dp WHERE reason IN ('constant', 'id_pattern')""")
def q_drop_const_id(spark, sf_dir):
    """constant columns and identifier-like columns."""
    return drop_plan(spark, sf_dir).where(F.col("reason").isin("constant", "id_pattern"))


@query("drop_high_null", sql=f"""{DROP_CTE}
SELECT column_name, null_pct FROM dp WHERE reason = 'high_null'""")
def q_drop_high_null(spark, sf_dir):
    """columns with more than 60 % nulls (after F1/F2)."""
    return drop_plan(spark, sf_dir).where(F.col("reason") == "high_null").select("column_name", "null_pct")


# --------------------------------------------------------------------------- impute / cap / log

def cleaned_stages(spark, sf_dir, fit_on="train", until: str = "log"):
    """mf -> dropped -> imputed -> capped -> logged, with every params table,
    stopping after stage ``until`` (each fit is an eager job, so later stages
    are only fitted when asked for).

    The model frame is written once to the checkpoint folder (lineage cut,
    survives executor loss); every fit job then scans that table instead of
    recomputing the roll-ups and joins."""
    mf = materialized_model_frame(spark, sf_dir)
    plan = drop_plan(spark, sf_dir, mf)
    dropped = PR.apply_drop(mf, plan)
    num = [c for c in NUMERIC if c in dropped.columns]
    cats = [c for c in CATEGORICAL if c in dropped.columns]
    out = {"mf": mf, "plan": plan, "dropped": dropped, "numeric": num, "categorical": cats}
    out["impute"] = ip = PR.impute_params(dropped, num, fit_on)
    if until == "impute":
        return out
    out["imputed"] = imputed = PR.apply_impute(dropped, ip, cats)
    out["cap"] = cp = PR.cap_params(imputed, PR.CAP_COLUMNS, fit_on)
    if until == "cap":
        return out
    out["capped"] = capped = PR.apply_cap(imputed, cp)
    out["log"] = lp = PR.log_params(capped, num, fit_on)
    out["logged"] = PR.apply_log(capped, lp)
    return out


_NUM_VALS = ", ".join(f"('{c}', CAST({c} AS DOUBLE))" for c in NUMERIC)
IMPUTE_CTE = f"""{DROP_CTE},
kept AS (SELECT v.column_name FROM (VALUES {', '.join(f"('{c}')" for c in NUMERIC)}) v(column_name)
         WHERE v.column_name NOT IN (SELECT column_name FROM dp WHERE reason IS NOT NULL)),
lg AS (SELECT mf.c_custkey, mf.split, v.column_name, v.value FROM mf, LATERAL (VALUES {_NUM_VALS}) v(column_name, value)
       WHERE v.column_name IN (SELECT column_name FROM kept)),
ip0 AS (SELECT column_name, {skew_sql('value')} AS skewness, avg(value) AS mean_v, quantile_cont(value, 0.5) AS median_v
        FROM lg WHERE split = 'train' GROUP BY column_name),
ip AS (SELECT column_name, skewness, CASE WHEN abs(skewness) > {PR.SKEW_MEDIAN} THEN 'median' ELSE 'mean' END AS strategy,
              CASE WHEN abs(skewness) > {PR.SKEW_MEDIAN} THEN median_v ELSE mean_v END AS fill_value FROM ip0),
lf AS (SELECT lg.c_custkey, lg.split, lg.column_name, coalesce(lg.value, ip.fill_value) AS value FROM lg JOIN ip USING (column_name))"""


@query("impute", sql=f"""{IMPUTE_CTE}
SELECT column_name, {R('skewness')} AS skewness, strategy, {R('fill_value')} AS fill_value FROM ip""")
def q_impute(spark, sf_dir):
    """Skew split, median / mean fill values fitted on the training rows."""
    st = cleaned_stages(spark, sf_dir, until="impute")
    return round_doubles(st["impute"])


CAP_PRESENT = [c for c in PR.CAP_COLUMNS if c in NUMERIC]
CAP_CTE = f"""{IMPUTE_CTE},
cp AS (SELECT column_name, quantile_cont(value, 0.25) - {PR.IQR_K} * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lower,
              quantile_cont(value, 0.75) + {PR.IQR_K} * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS upper
       FROM lf WHERE split = 'train' AND column_name IN ({', '.join(f"'{c}'" for c in CAP_PRESENT)}) GROUP BY column_name),
lc AS (SELECT lf.c_custkey, lf.split, lf.column_name,
              CASE WHEN cp.column_name IS NULL THEN lf.value ELSE least(greatest(lf.value, cp.lower), cp.upper) END AS value,
              lf.value AS raw_value, cp.lower, cp.upper
       FROM lf LEFT JOIN cp USING (column_name))"""


@query("iqr_cap", sql=f"""{CAP_CTE}
SELECT cp.column_name, {R('cp.lower')} AS lower, {R('cp.upper')} AS upper,
       CAST((SELECT count(*) FROM lc WHERE lc.column_name = cp.column_name AND (lc.raw_value < lc.lower OR lc.raw_value > lc.upper)) AS BIGINT) AS n_capped
FROM cp""")
def q_iqr_cap(spark, sf_dir):
    """F8: train-row IQR bounds of the financial columns and how many values each clips."""
    st = cleaned_stages(spark, sf_dir, until="cap")
    n = PR.capped_counts(st["imputed"], st["cap"])
    return round_doubles(st["cap"].join(n, "column_name").select("column_name", "lower", "upper", "n_capped"))


@query("log1p_skewed", sql=f"""{CAP_CTE},
sk AS (SELECT column_name, {skew_sql('value')} AS skewness FROM lc WHERE split = 'train' GROUP BY column_name),
mn AS (SELECT column_name, min(value) AS min_value FROM lc GROUP BY column_name)
SELECT column_name, {R('skewness')} AS skewness, {R('min_value')} AS min_value,
       (abs(skewness) > {PR.SKEW_LOG} AND min_value >= 0) AS applied FROM sk JOIN mn USING (column_name)""")
def q_log1p_skewed(spark, sf_dir):
    """log1p for columns with train |skew| > 2 and no negative value."""
    st = cleaned_stages(spark, sf_dir)
    return round_doubles(st["log"])


# --------------------------------------------------------------------------- encoding

def encoded(spark, sf_dir):
    st = cleaned_stages(spark, sf_dir)
    df = st["logged"]
    card = {r["column_name"]: r["n_unique"] for r in PR.cardinality(df, st["categorical"]).collect()}
    for c in st["categorical"]:
        df = PR.onehot(df, c) if card.get(c, 0) < PR.CARD_ONEHOT else PR.label_encode(df, c)
    return df, st


@query("onehot", sql=f"""
SELECT c_custkey, {', '.join(f"CAST(coalesce(c_mktsegment, 'Missing') = '{v}' AS TINYINT) AS c_mktsegment_{v}" for v in SEGMENTS[1:])}
FROM customer""")
def q_onehot(spark, sf_dir):
    """the low-cardinality segment column one-hot encoded, first value dropped."""
    c = read_table(spark, sf_dir, "customer").select(KEY, "c_mktsegment").fillna(PR.MISSING)
    return PR.onehot(c, "c_mktsegment")


@query("label_encode", sql="""
SELECT c.c_custkey, CAST(dense_rank() OVER (ORDER BY coalesce(n.n_name, 'Missing')) - 1 AS INTEGER) AS n_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_label_encode(spark, sf_dir):
    """the high-cardinality nation name as its index in sorted order."""
    c = read_table(spark, sf_dir, "customer").select(KEY, "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    df = c.join(n, "c_nationkey", "left").select(KEY, "n_name").fillna(PR.MISSING)
    return PR.label_encode(df, "n_name")


@query("cardinality", sql="""
SELECT 'c_mktsegment' AS column_name, CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS n_unique FROM customer
UNION ALL SELECT 'n_name', CAST(count(DISTINCT n.n_name) AS BIGINT) FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_cardinality(spark, sf_dir):
    """Distinct non-null values of the categorical columns."""
    c = read_table(spark, sf_dir, "customer").select(KEY, "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return PR.cardinality(c.join(n, "c_nationkey", "left"), ["c_mktsegment", "n_name"])


SKETCHED = ["o_orderkey", "o_custkey", "o_orderpriority"]


@query("cardinality_hll", sql=f"""{' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique, true AS close FROM orders" for c in SKETCHED)}""")
def q_cardinality_hll(spark, sf_dir):
    """D5, approximate option: sketches per order month, written, merged over the months; close: within three
    standard errors of the exact count."""
    orders = read_table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    parts = materialize(SK.distinct_sketches(orders, SKETCHED, ("month",)), "hll")
    about = SK.distinct_counts(parts).withColumnRenamed("n_unique", "about")
    exact = PR.cardinality(orders, SKETCHED)
    error = 3 * 1.04 / 2 ** (SK.LG_K / 2)
    return exact.join(about, "column_name").select(
        "column_name", "n_unique", (F.abs(F.col("about") - F.col("n_unique")) <= error * F.col("n_unique") + 1).alias("close"))


NULLABLE = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_EMPLOYED_CLEAN", "YEARS_EMPLOYED",
            "EMPLOYMENT_LIFE_FRACTION", "EXT_SOURCE_MEAN", "EXT_SOURCE_STD", "EXT_SOURCE_WEIGHTED"]
FE_CTE = f"""WITH {FINANCE_CTE[5:]},
fe AS (SELECT fin.*, {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin)"""


@query("inf_fill", sql=f"""{FE_CTE},
cl AS (SELECT c_custkey, {', '.join(f"CASE WHEN isinf(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in NULLABLE)} FROM fe)
SELECT c_custkey, {', '.join(f"{R(f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM cl))')} AS {c}" for c in NULLABLE)} FROM cl""")
def q_inf_fill(spark, sf_dir):
    """+-inf -> null -> median of all rows, on the nullable domain features."""
    fe = FE.domain_features(applicant_finance(spark, sf_dir)).select(KEY, *NULLABLE)
    return round_doubles(PR.inf_to_median(fe, NULLABLE))


SCALE_COLS = FIN_COLS + ["DEBT_BURDEN_RATIO", "CREDIT_INCOME_RATIO", "AGE_YEARS", "INCOME_PER_PERSON"]


@query("scale", sql=f"""{FE_CTE},
{SPLIT_CTE[5:]},
lg AS (SELECT v.column_name, v.value FROM fe JOIN s USING (c_custkey),
       LATERAL (VALUES {', '.join(f"('{c}', CAST({c} AS DOUBLE))" for c in SCALE_COLS)}) v(column_name, value)
       WHERE s.split = 'train')
SELECT column_name, {R('avg(value)')} AS mean, {R('CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END')} AS scale
FROM lg GROUP BY column_name""")
def q_scale(spark, sf_dir):
    """standard-scaler parameters (train mean, population std, 0 -> 1)."""
    fe = FE.domain_features(applicant_finance(spark, sf_dir))
    sp = SP.stratified_split(fe.select(KEY, TARGET), KEY, TARGET, 0.2).select(KEY, "split")
    return round_doubles(PR.scale_params(fe.join(sp, KEY), SCALE_COLS))


@query("clean_names", sql="""
SELECT DISTINCT props AS original, regexp_replace(props, '[\\[\\]\\{\\}\\:\\,]', '_', 'g') AS cleaned,
       replace(regexp_replace(props, '[\\[\\]\\{\\}\\:\\,]', '_', 'g'), '_ ', ', ') AS restored
FROM events WHERE props IS NOT NULL""")
def q_clean_names(spark, sf_dir):
    """F16: the feature-name rule applied to data-derived names (pivot labels of
    ``events.props``), and the reverse '_ ' -> ', ' patch."""
    ev = read_table(spark, sf_dir, "events").select("props").where(F.col("props").isNotNull()).distinct()
    cleaned = F.regexp_replace("props", PR.NAME_CHARS, "_")
    return ev.select(F.col("props").alias("original"), cleaned.alias("cleaned"),
                     F.replace(cleaned, F.lit("_ "), F.lit(", ")).alias("restored"))


REQUEST_FEATURES = ["k", "amount"]


@query("default_fill", sql="""
SELECT event_id, coalesce(TRY_CAST(json_extract(props, '$.k') AS DOUBLE), 0.0) AS k,
       coalesce(TRY_CAST(json_extract(props, '$.amount') AS DOUBLE), 0.0) AS amount FROM events""")
def q_default_fill(spark, sf_dir):
    """JSON request -> map<string,double> -> feature columns in order, missing -> 0.0."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,double>").alias("req"))
    return PR.default_fill(ev, "req", REQUEST_FEATURES).select("event_id", *REQUEST_FEATURES)


@query("schema_shrink", sql="""
WITH m AS (SELECT min(l_orderkey) a1, max(l_orderkey) b1, min(l_partkey) a2, max(l_partkey) b2,
                  min(l_suppkey) a3, max(l_suppkey) b3, min(l_linenumber) a4, max(l_linenumber) b4 FROM lineitem),
t AS (SELECT * FROM m, LATERAL (VALUES ('l_orderkey', 'bigint', a1, b1), ('l_partkey', 'bigint', a2, b2),
                                        ('l_suppkey', 'bigint', a3, b3), ('l_linenumber', 'int', a4, b4)) v(column_name, from_type, lo, hi))
SELECT column_name, from_type, CASE WHEN lo >= -128 AND hi <= 127 THEN 'tinyint' WHEN lo >= -32768 AND hi <= 32767 THEN 'smallint'
                                    WHEN lo >= -2147483648 AND hi <= 2147483647 THEN 'int' ELSE from_type END AS to_type FROM t
UNION ALL SELECT * FROM (VALUES ('l_quantity', 'double', 'float'), ('l_extendedprice', 'double', 'float'),
                                ('l_discount', 'double', 'float'), ('l_tax', 'double', 'float')) v(column_name, from_type, to_type)""")
def q_schema_shrink(spark, sf_dir):
    """Narrowest integer type by min/max, doubles to float (before a write)."""
    li = read_table(spark, sf_dir, "lineitem")
    return PR.shrink_plan(li)


# --------------------------------------------------------------------------- the cleaned rows themselves

def _long_rows(df, cols):
    from ledgerlens.operators.profile import to_long
    return round_doubles(to_long(df, cols, ids=[KEY]))


@query("imputed_rows", sql=f"""{IMPUTE_CTE}
SELECT c_custkey, column_name, {R('value')} AS value FROM lf""")
def q_imputed_rows(spark, sf_dir):
    """F5/F6 applied: every numeric value after filling, train and test rows."""
    st = cleaned_stages(spark, sf_dir, until="cap")
    return _long_rows(st["imputed"], st["numeric"])


@query("capped_rows", sql=f"""{CAP_CTE}
SELECT c_custkey, column_name, {R('value')} AS value FROM lc WHERE lower IS NOT NULL""")
def q_capped_rows(spark, sf_dir):
    """F8 applied: the capped columns' values."""
    st = cleaned_stages(spark, sf_dir)
    return _long_rows(st["capped"], [c for c in PR.CAP_COLUMNS if c in st["numeric"]])


@query("logged_rows", sql=f"""{CAP_CTE},
sk AS (SELECT column_name, {skew_sql('value')} AS skewness FROM lc WHERE split = 'train' GROUP BY column_name),
mn AS (SELECT column_name, min(value) AS min_value FROM lc GROUP BY column_name),
ap AS (SELECT column_name FROM sk JOIN mn USING (column_name) WHERE abs(skewness) > {PR.SKEW_LOG} AND min_value >= 0)
SELECT c_custkey, column_name, {R('ln(1 + value)')} AS value FROM lc WHERE column_name IN (SELECT column_name FROM ap)""")
def q_logged_rows(spark, sf_dir):
    """F9 applied: the values of the columns that log1p changes."""
    st = cleaned_stages(spark, sf_dir)
    cols = [r["column_name"] for r in st["log"].where("applied").collect()]     # at most one per column
    if not cols:
        return _long_rows(st["logged"], st["numeric"][:1]).limit(0)
    return _long_rows(st["logged"], cols)


@query("missing_category", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'Missing' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def q_missing_category(spark, sf_dir):
    """categorical nulls (every 7th segment is taken away) become 'Missing'."""
    c = read_table(spark, sf_dir, "customer").select(
        KEY, F.when(F.col(KEY) % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    fills = spark.createDataFrame([], "column_name string, fill_value double")
    return PR.apply_impute(c, fills, ["c_mktsegment"])


@query("xy_split", sql=f"""{FE_CTE}
SELECT c_custkey, TARGET AS y, {', '.join(f'{R(f"CAST({c} AS DOUBLE)")} AS {c}' for c in FIN_COLS)}
FROM fe""")
def q_xy_split(spark, sf_dir):
    """numeric features and label; the key is kept, other columns and non-numeric ones go."""
    fe = FE.domain_features(applicant_finance(spark, sf_dir)).select(KEY, TARGET, *FIN_COLS)
    x, y = PR.split_xy(fe.withColumn("segment", F.lit("text")), KEY, TARGET)
    return round_doubles(x.join(y, KEY).select(KEY, "y", *[F.col(c).cast("double").alias(c) for c in FIN_COLS]))


@query("renamed_columns", sql="""
SELECT l_orderkey, l_linenumber, l_quantity AS "qty_EUR_", l_tax AS "tax_ _rate_", l_discount AS "a_b_c" FROM lineitem""")
def q_renamed_columns(spark, sf_dir):
    """F16: the renamer on a frame whose column names hold brackets, colons and commas."""
    li = read_table(spark, sf_dir, "lineitem")
    return PR.clean_names(li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty[EUR]"),
                                    F.col("l_tax").alias("tax: {rate}"), F.col("l_discount").alias("a:b,c")))


@query("shrunk_rows", sql="""
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 2) AS l_extendedprice, 'tinyint' AS line_type, 'float' AS price_type
FROM lineitem""")
def q_shrunk_rows(spark, sf_dir):
    """A11 applied: lineitem with the narrow types, their names and the values read back as wide ones."""
    li = read_table(spark, sf_dir, "lineitem")
    small = PR.apply_shrink(li, PR.shrink_plan(li))
    kinds = dict(small.dtypes)
    return small.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"),
                        F.round(F.col("l_extendedprice").cast("double"), 2).alias("l_extendedprice"),
                        F.lit(kinds["l_linenumber"]).alias("line_type"), F.lit(kinds["l_extendedprice"]).alias("price_type"))
