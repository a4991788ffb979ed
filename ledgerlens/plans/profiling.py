"""Profiling queries (2.B, A3, D4-D6) on the test tables and the applicant frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import profile as P
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.rollups import APPLICANT_BASE_COLS, APPLICANT_BASE_CTE, applicant_base
from ledgerlens.plans.sqlgen import R, kurt_sql, name_index, skew_sql, unpivot_lateral
from ledgerlens.session import materialize
from ledgerlens.sources.tables import KEY, TABLE_NAMES, TARGET, applicants, read_table, table_registry

BASE_NUMERIC = [c for c, k in APPLICANT_BASE_COLS if k != "str" and c not in (KEY,)]
BASE_FEATURES = [c for c in BASE_NUMERIC if c != TARGET]
LINEITEM_NUMERIC = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]

# fixed values: column count and kinds of each test table (numeric, string, other)
TABLE_KINDS = {
    "region": (2, 1, 1, 0), "nation": (3, 2, 1, 0), "customer": (5, 3, 2, 0),
    "supplier": (4, 3, 1, 0), "part": (6, 3, 3, 0), "orders": (6, 3, 2, 1),
    "lineitem": (11, 8, 2, 1), "events": (6, 3, 2, 1), "documents": (5, 2, 3, 0),
    "embeddings": (3, 2, 0, 1), "pages": (3, 1, 2, 0), "benchmark": (2, 1, 1, 0),
    "labels": (3, 3, 0, 0), "conversations": (4, 2, 2, 0),
}


@query("table_shape", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, {k[0]} AS n_cols, "
    f"{k[1]} AS n_numeric, {k[2]} AS n_string, {k[3]} AS n_other FROM {t}"
    for t, k in TABLE_KINDS.items()))
def q_table_shape(spark, sf_dir):
    frames = [P.basic_checks(read_table(spark, sf_dir, t), t) for t in TABLE_NAMES]
    return reduce(lambda a, b: a.unionByName(b), frames)


ROLE_TABLES = {"customer": "application", "orders": "bureau", "lineitem": "bureau_balance",
               "events": "sparse_child", "part": "categorical", "documents": "scored_items",
               "labels": "labels"}  # fixed values: SURVEY 7.2 binding


@query("scan_tables", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{r}' AS role, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
    for t, r in ROLE_TABLES.items()))
def q_scan_tables(spark, sf_dir):
    """A1/A2: the table registry (name -> lazy scan) of the role tables, with row counts."""
    reg = table_registry(spark, sf_dir, tuple(ROLE_TABLES))
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), F.lit(ROLE_TABLES[t]).alias("role"), "n_rows") for t, df in reg.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


DUP_SOURCES = {
    "documents": ["text", "lang", "source", "n_chars"],
    "orders": ["o_custkey", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"],
}


@query("dup_rows", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates "
    f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(c)})"
    for t, c in DUP_SOURCES.items()))
def q_dup_rows(spark, sf_dir):
    frames = [P.duplicate_rows(read_table(spark, sf_dir, t).select(*c), t) for t, c in DUP_SOURCES.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


WHOLE_ROWS = ["documents", "orders", "lineitem", "events", "labels", "conversations", "pages"]


@query("dup_whole_rows", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS n_rows, "
    f"CAST((SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS BIGINT) AS n_duplicates"
    for t in WHOLE_ROWS))
def q_dup_whole_rows(spark, sf_dir):
    """B2: rows beyond the first copy, over every column of each table."""
    return reduce(lambda a, b: a.unionByName(b), [P.duplicate_rows(read_table(spark, sf_dir, t), t) for t in WHOLE_ROWS])


ALL_BASE = [c for c, _ in APPLICANT_BASE_COLS]
NULL_PROFILE_SQL = f"""{APPLICANT_BASE_CTE},
w AS (SELECT count(*) AS n, {', '.join(f'count_if({c} IS NULL) AS {c}' for c in ALL_BASE)} FROM base),
l AS (SELECT w.n, v.column_name, v.null_count FROM w,
      LATERAL (VALUES {', '.join(f"('{c}', {c})" for c in ALL_BASE)}) v(column_name, null_count))"""


@query("null_profile", sql=f"""{NULL_PROFILE_SQL}
SELECT column_name, CAST(null_count AS BIGINT) AS null_count, {R('null_count * 100.0 / n')} AS null_pct
FROM l WHERE null_count > 0""")
def q_null_profile(spark, sf_dir):
    return round_doubles(P.null_profile(applicant_base(spark, sf_dir)))


@query("null_counts_over", sql=f"""{NULL_PROFILE_SQL}
SELECT CAST(count_if(null_count * 100.0 / n > 50) AS BIGINT) AS n_over_50,
       CAST(count_if(null_count * 100.0 / n > 70) AS BIGINT) AS n_over_70 FROM l WHERE null_count > 0""")
def q_null_counts_over(spark, sf_dir):
    return P.null_counts_over(P.null_profile(applicant_base(spark, sf_dir)))


def _summary_sql(v="value"):
    return (f"CAST(count({v}) AS BIGINT) AS count, {R(f'avg({v})')} AS mean, {R(f'stddev_samp({v})')} AS std, "
            f"{R(f'min({v})')} AS min, {R(f'quantile_cont({v}, 0.25)')} AS p25, "
            f"{R(f'quantile_cont({v}, 0.5)')} AS p50, {R(f'quantile_cont({v}, 0.75)')} AS p75, "
            f"{R(f'max({v})')} AS max, {R(skew_sql(v))} AS skewness, {R(kurt_sql(v))} AS kurtosis")


@query("numeric_summary", sql=f"""
WITH l AS ({unpivot_lateral('lineitem', LINEITEM_NUMERIC)})
SELECT column_name, {_summary_sql()} FROM l GROUP BY column_name""")
def q_numeric_summary(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return round_doubles(P.numeric_summary(li, LINEITEM_NUMERIC))


@query("skew_rank", sql=f"""{APPLICANT_BASE_CTE},
l AS ({unpivot_lateral('base', BASE_FEATURES)}),
s AS (SELECT column_name, {skew_sql('value')} AS skewness FROM l GROUP BY column_name)
SELECT column_name, {R('skewness')} AS skewness FROM s WHERE abs(skewness) > 1.5
ORDER BY abs(skewness) DESC, column_name LIMIT 20""")
def q_skew_rank(spark, sf_dir):
    return round_doubles(P.skew_rank(applicant_base(spark, sf_dir), BASE_FEATURES))


PART_CATS = ["p_name", "p_brand", "p_type"]


@query("categorical_top5", sql=f"""
WITH l AS ({unpivot_lateral('part', PART_CATS, cast='VARCHAR')}),
c AS (SELECT column_name, value, CAST(count(*) AS BIGINT) AS value_count FROM l GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank FROM c),
p AS (SELECT column_name, CAST(count(value) AS BIGINT) AS n_unique,
             CAST(coalesce(sum(CASE WHEN value IS NULL THEN value_count END), 0) AS BIGINT) AS n_null
      FROM c GROUP BY column_name)
SELECT r.column_name, rank, value, value_count, n_unique, n_null FROM r JOIN p USING (column_name) WHERE rank <= 5""")
def q_categorical_top5(spark, sf_dir):
    return P.categorical_top(read_table(spark, sf_dir, "part"), PART_CATS, 5)


@query("value_counts", sql=f"""
WITH g AS (SELECT event_type AS value, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1)
SELECT value, n, {R('n / sum(n) OVER ()')} AS share FROM g""")
def q_value_counts(spark, sf_dir):
    return round_doubles(P.value_counts(read_table(spark, sf_dir, "events"), "event_type"))


@query("target_profile", sql=f"""
WITH a AS (SELECT CAST(c_acctbal < 0 AS INTEGER) AS TARGET FROM customer),
t AS (SELECT count_if(TARGET = 0) AS n0, count_if(TARGET = 1) AS n1, count(TARGET) AS n FROM a)
SELECT TARGET, CAST(count(*) AS BIGINT) AS n_class, {R('count(*) * 100.0 / any_value(n)')} AS pct,
       {R('any_value(n0) / any_value(n1)')} AS imbalance_ratio,
       {R('least(any_value(n0), any_value(n1)) * 100.0 / any_value(n)')} AS minority_pct
FROM a, t WHERE TARGET IS NOT NULL GROUP BY TARGET""")
def q_target_profile(spark, sf_dir):
    return round_doubles(P.target_profile(applicants(spark, sf_dir), TARGET))


@query("density_hist", sql=f"""
WITH s AS (SELECT min(value) AS mn, max(value) AS mx, count(value) AS n, avg(value) AS mean,
                  quantile_cont(value, 0.5) AS median FROM events),
c AS (SELECT CAST(least(floor((value - mn) * 50 / (mx - mn)), 49) AS INTEGER) AS bin, count(*) AS cnt
      FROM events, s WHERE value IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT g.bin, {R('mn + g.bin * (mx - mn) / 50')} AS bin_lo, {R('mn + (g.bin + 1) * (mx - mn) / 50')} AS bin_hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count, {R('coalesce(cnt, 0) / (n * ((mx - mn) / 50))')} AS density,
       {R('mean')} AS mean, {R('median')} AS median
FROM g LEFT JOIN c USING (bin), s""")
def q_density_hist(spark, sf_dir):
    return round_doubles(P.density_histogram(read_table(spark, sf_dir, "events"), "value", 50))


@query("kde_curve", sql=f"""
WITH p AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h,
                  min(value) - (max(value) - min(value)) * 0.5 AS lo,
                  max(value) + (max(value) - min(value)) * 0.5 AS hi FROM events),
g AS (SELECT CAST(range AS INTEGER) AS grid_index, lo + range * (hi - lo) / 999 AS x, h, n FROM range(1000), p)
SELECT grid_index, {R('x')} AS x,
       {R('sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} AS density
FROM g, events WHERE value IS NOT NULL GROUP BY grid_index, x""")
def q_kde_curve(spark, sf_dir):
    return round_doubles(P.kde_curve(read_table(spark, sf_dir, "events"), "value", 1000))


@query("box_by_target", sql=f"""{APPLICANT_BASE_CTE},
b AS (SELECT quantile_cont(CAST(ord_o_totalprice_sum AS DOUBLE), 0.01) AS lo,
             quantile_cont(CAST(ord_o_totalprice_sum AS DOUBLE), 0.99) AS hi FROM base),
k AS (SELECT TARGET, TRY_CAST(ord_o_totalprice_sum AS DOUBLE) AS v FROM base, b
      WHERE ord_o_totalprice_sum IS NOT NULL AND ord_o_totalprice_sum BETWEEN lo AND hi),
q AS (SELECT TARGET, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM k GROUP BY TARGET),
w AS (SELECT k.TARGET, min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS wl,
             max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS wh FROM k JOIN q USING (TARGET) GROUP BY k.TARGET)
SELECT TARGET, CAST(n AS BIGINT) AS n, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3,
       {R('wl')} AS whisker_lo, {R('wh')} AS whisker_hi FROM q JOIN w USING (TARGET)""")
def q_box_by_target(spark, sf_dir):
    base = P.coerce_numeric(applicant_base(spark, sf_dir).select(TARGET, "ord_o_totalprice_sum"),
                            ["ord_o_totalprice_sum"])
    return round_doubles(P.box_by_group(base, "ord_o_totalprice_sum", TARGET))


# --------------------------------------------------------------------------- correlation

CORR_COLS = BASE_NUMERIC
CORR_LONG_CTE = f"""{APPLICANT_BASE_CTE},
ix AS ({name_index(CORR_COLS)}),
l AS (SELECT u.c_custkey, u.column_name, u.value, ix.idx FROM ({unpivot_lateral('base', CORR_COLS, ids=['c_custkey'])}) u
      JOIN ix USING (column_name) WHERE u.value IS NOT NULL),
pr AS (SELECT a.column_name AS x, b.column_name AS y, count(*) AS n_pairs,
              CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0
                   THEN greatest(least(covar_pop(a.value, b.value) / sqrt(var_pop(a.value) * var_pop(b.value)), 1.0), -1.0) END AS r
       FROM l a JOIN l b ON a.c_custkey = b.c_custkey WHERE (b.idx - a.idx) > 0 GROUP BY 1, 2)"""


def corr_long_spark(spark, sf_dir):
    return P.correlation_long(applicant_base(spark, sf_dir).select(*CORR_COLS), CORR_COLS)


@query("corr_long", sql=f"""{CORR_LONG_CTE}
SELECT x, y, CAST(n_pairs AS BIGINT) AS n_pairs, {R('r')} AS r FROM pr""")
def q_corr_long(spark, sf_dir):
    return round_doubles(corr_long_spark(spark, sf_dir))


@query("corr_pairs", sql=f"""{CORR_LONG_CTE}
SELECT x, y, {R('r')} AS r FROM pr
WHERE x <> 'TARGET' AND y <> 'TARGET' AND abs({R('r')}) > 0.8
ORDER BY abs({R('r')}) DESC, x, y LIMIT 20""")
def q_corr_pairs(spark, sf_dir):
    """Strongly correlated feature pairs, TARGET excluded, top 20 by |r|."""
    c = corr_long_spark(spark, sf_dir).select("x", "y", fround("r").alias("r"))
    return (c.where((F.col("x") != TARGET) & (F.col("y") != TARGET) & (F.abs("r") > 0.8))
            .orderBy(F.desc(F.abs("r")), "x", "y").limit(20))


TARGET_CORR_CTE = f"""{APPLICANT_BASE_CTE},
l AS ({unpivot_lateral('base', BASE_FEATURES, ids=['TARGET'])}),
tc AS (SELECT column_name, count(CASE WHEN value IS NOT NULL AND TARGET IS NOT NULL THEN 1 END) AS n_pairs,
              CASE WHEN var_pop(CASE WHEN TARGET IS NOT NULL THEN value END) > 0
                    AND var_pop(CASE WHEN value IS NOT NULL THEN TARGET END) > 0
                   THEN covar_pop(value, TARGET) / sqrt(var_pop(CASE WHEN TARGET IS NOT NULL THEN value END)
                                                        * var_pop(CASE WHEN value IS NOT NULL THEN TARGET END)) END AS r
       FROM l GROUP BY column_name),
tr AS (SELECT column_name, CAST(n_pairs AS BIGINT) AS n_pairs, {R('r')} AS r FROM tc)"""


def target_corr_spark(spark, sf_dir):
    t = P.correlation_with(applicant_base(spark, sf_dir), BASE_FEATURES, TARGET)
    return t.select("column_name", "n_pairs", fround("r").alias("r"))


@query("corr_target_top", sql=f"""{TARGET_CORR_CTE}
SELECT * FROM tr WHERE r IS NOT NULL ORDER BY abs(r) DESC, column_name LIMIT 24""")
def q_corr_target_top(spark, sf_dir):
    """Features most correlated with TARGET by |r|, top 24."""
    t = target_corr_spark(spark, sf_dir)
    return t.where(F.col("r").isNotNull()).orderBy(F.desc(F.abs("r")), "column_name").limit(24)


@query("corr_submatrix", sql=f"""{TARGET_CORR_CTE},
tops AS (SELECT column_name FROM tr WHERE r IS NOT NULL ORDER BY abs(r) DESC, column_name LIMIT 24),
keep AS (SELECT column_name FROM tops UNION ALL SELECT 'TARGET'),
ix AS ({name_index(CORR_COLS)}),
lv AS (SELECT u.c_custkey, u.column_name, u.value, ix.idx FROM ({unpivot_lateral('base', CORR_COLS, ids=['c_custkey'])}) u
       JOIN ix USING (column_name) JOIN keep USING (column_name) WHERE u.value IS NOT NULL)
SELECT a.column_name AS x, b.column_name AS y,
       {R('CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0 THEN greatest(least(covar_pop(a.value, b.value) / sqrt(var_pop(a.value) * var_pop(b.value)), 1.0), -1.0) END')} AS r
FROM lv a JOIN lv b ON a.c_custkey = b.c_custkey WHERE b.idx - a.idx > 0 GROUP BY 1, 2""")
def q_corr_submatrix(spark, sf_dir):
    """The correlations among the 24 features most correlated with TARGET, and TARGET."""
    base = materialize(applicant_base(spark, sf_dir).select(*CORR_COLS))
    t = P.correlation_with(base, BASE_FEATURES, TARGET).select("column_name", fround("r").alias("r"))
    tops = t.where(F.col("r").isNotNull()).orderBy(F.desc(F.abs("r")), "column_name").limit(24).collect()
    names = {r["column_name"] for r in tops} | {TARGET}
    c = P.correlation_long(base, [n for n in CORR_COLS if n in names])
    return round_doubles(c.select("x", "y", "r"))


@query("corr_extremes", sql=f"""{TARGET_CORR_CTE}
(SELECT * FROM tr WHERE r IS NOT NULL ORDER BY r ASC, column_name LIMIT 15)
UNION
(SELECT * FROM tr WHERE r IS NOT NULL ORDER BY r DESC, column_name LIMIT 15)""")
def q_corr_extremes(spark, sf_dir):
    """Bottom 15 and top 15 signed correlations with TARGET, de-duplicated."""
    t = target_corr_spark(spark, sf_dir).where(F.col("r").isNotNull())
    lo = t.orderBy(F.asc("r"), "column_name").limit(15)
    hi = t.orderBy(F.desc("r"), "column_name").limit(15)
    return lo.unionByName(hi).distinct()
