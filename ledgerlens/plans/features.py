"""Domain-feature queries.

Binding of the application columns to the test tables (SURVEY 7.2): money
amounts, day offsets and external scores are per-customer aggregates of orders
and lineitem. Lineitem is first reduced per order, then joined to orders and
reduced per customer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import features as FE
from ledgerlens.operators import profile as P
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.sqlgen import R
from ledgerlens.sources.tables import KEY, TARGET, read_table

AS_OF = "2002-01-01"  # fixed value: day offsets are counted back from this date


def applicant_finance(spark, sf_dir):
    """application role with credit-style columns (one row per customer)."""
    from ledgerlens.plans.rollups import customer_order_stats
    named = {"_credit": "AMT_CREDIT", "_annuity": "AMT_ANNUITY", "_goods": "AMT_GOODS_PRICE",
             "_income": "AMT_INCOME_TOTAL", "_orders": "CNT_FAM_MEMBERS", "_first_order": "first_order",
             "_last_order": "last_order", "_first_ship": "first_ship", "_avg_discount": "avg_disc",
             "_avg_tax": "avg_tax", "_avg_quantity": "avg_qty"}
    st = customer_order_stats(spark, sf_dir)  # shared with the D2 roll-up
    per_cust = st.select(KEY, *[F.col(c).alias(n) for c, n in named.items()])
    cust = read_table(spark, sf_dir, "customer").select(
        KEY, "c_nationkey", (F.col("c_acctbal") < 0).cast("int").alias(TARGET))
    asof = F.lit(AS_OF).cast("date")
    k = F.col(KEY)
    return cust.join(per_cust, KEY, "left").select(
        KEY, TARGET, "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
        (-F.datediff(asof, F.col("first_order").cast("date"))).alias("DAYS_BIRTH"),
        F.when(k % 10 == 0, F.lit(FE.EMPLOYED_SENTINEL))
         .otherwise(-F.datediff(asof, F.col("last_order").cast("date"))).alias("DAYS_EMPLOYED"),
        (-F.datediff(asof, F.col("first_ship").cast("date"))).alias("DAYS_REGISTRATION"),
        (-(F.col("c_nationkey") * 100 + k % 100)).cast("int").alias("DAYS_ID_PUBLISH"),
        F.when(k % 7 != 0, F.col("avg_disc") * 10).alias("EXT_SOURCE_1"),
        F.when(k % 11 != 0, F.col("avg_tax") * 12.5).alias("EXT_SOURCE_2"),
        F.when(k % 13 != 0, F.col("avg_qty") / 50).alias("EXT_SOURCE_3"))


FINANCE_CTE = f"""WITH po AS (
  SELECT l_orderkey, sum(l_extendedprice) AS goods, sum(l_extendedprice * (1 - l_discount)) AS net,
         sum(l_discount) AS disc, sum(l_tax) AS tax, sum(l_quantity) AS qty, count(l_orderkey) AS lines,
         min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey),
pc AS (
  SELECT o_custkey AS c_custkey, sum(o_totalprice) AS AMT_CREDIT, avg(o_totalprice) AS AMT_ANNUITY,
         sum(goods) AS AMT_GOODS_PRICE, sum(net) AS AMT_INCOME_TOTAL,
         CAST(count(o_orderkey) AS DOUBLE) AS CNT_FAM_MEMBERS,
         min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, min(first_ship) AS first_ship,
         sum(disc) / sum(lines) AS avg_disc, sum(tax) / sum(lines) AS avg_tax, sum(qty) / sum(lines) AS avg_qty
  FROM orders o LEFT JOIN po ON o.o_orderkey = po.l_orderkey GROUP BY o_custkey),
fin AS (
  SELECT c.c_custkey, CAST(c.c_acctbal < 0 AS INTEGER) AS TARGET,
         AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, AMT_GOODS_PRICE, CNT_FAM_MEMBERS,
         -date_diff('day', CAST(first_order AS DATE), DATE '{AS_OF}') AS DAYS_BIRTH,
         CASE WHEN c.c_custkey % 10 = 0 THEN 365243
              ELSE -date_diff('day', CAST(last_order AS DATE), DATE '{AS_OF}') END AS DAYS_EMPLOYED,
         -date_diff('day', CAST(first_ship AS DATE), DATE '{AS_OF}') AS DAYS_REGISTRATION,
         CAST(-(c.c_nationkey * 100 + c.c_custkey % 100) AS INTEGER) AS DAYS_ID_PUBLISH,
         CASE WHEN c.c_custkey % 7 <> 0 THEN avg_disc * 10 END AS EXT_SOURCE_1,
         CASE WHEN c.c_custkey % 11 <> 0 THEN avg_tax * 12.5 END AS EXT_SOURCE_2,
         CASE WHEN c.c_custkey % 13 <> 0 THEN avg_qty / 50 END AS EXT_SOURCE_3
  FROM customer c LEFT JOIN pc USING (c_custkey))"""

EPS = "0.000001"
EXT = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
PRESENT = f"list_filter({EXT}, lambda x: x IS NOT NULL)"

FEATURE_SQL = {
    "ratios": {
        "DEBT_BURDEN_RATIO": f"AMT_ANNUITY / (AMT_INCOME_TOTAL + {EPS})",
        "CREDIT_INCOME_RATIO": f"AMT_CREDIT / (AMT_INCOME_TOTAL + {EPS})",
        "ANNUITY_CREDIT_RATIO": f"AMT_ANNUITY / (AMT_CREDIT + {EPS})",
        "PAYMENT_RATE": f"AMT_ANNUITY / (AMT_CREDIT + {EPS})",
        "GOODS_CREDIT_RATIO": f"AMT_GOODS_PRICE / (AMT_CREDIT + {EPS})",
        "CREDIT_GOODS_DIFF": "AMT_CREDIT - AMT_GOODS_PRICE",
    },
    "lifecycle": {
        "AGE_YEARS": "-DAYS_BIRTH / 365.25",
        "DAYS_EMPLOYED_CLEAN": "CAST(nullif(DAYS_EMPLOYED, 365243) AS DOUBLE)",
        "YEARS_EMPLOYED": "-nullif(DAYS_EMPLOYED, 365243) / 365.25",
        "EMPLOYMENT_LIFE_FRACTION": f"-nullif(DAYS_EMPLOYED, 365243) / (-DAYS_BIRTH + {EPS})",
        "YEARS_SINCE_REGISTRATION": "-DAYS_REGISTRATION / 365.25",
        "YEARS_SINCE_ID_CHANGE": "-DAYS_ID_PUBLISH / 365.25",
    },
    "ext_composites": {
        "EXT_SOURCE_MEAN": f"list_avg({PRESENT})",
        "EXT_SOURCE_SUM": f"coalesce(list_sum({PRESENT}), 0.0)",
        "EXT_SOURCE_MIN": f"list_min({PRESENT})",
        "EXT_SOURCE_MAX": f"list_max({PRESENT})",
        "EXT_SOURCE_STD": f"CASE WHEN len({PRESENT}) >= 2 THEN list_stddev_samp({PRESENT}) END",
        "EXT_SOURCE_RANGE": f"list_max({PRESENT}) - list_min({PRESENT})",
        "EXT_SOURCE_WEIGHTED": "(EXT_SOURCE_1 * 0.25 + EXT_SOURCE_2 * 0.5 + EXT_SOURCE_3 * 0.25) / 1.0",
    },
    "per_capita": {
        "INCOME_PER_PERSON": f"AMT_INCOME_TOTAL / (CNT_FAM_MEMBERS + {EPS})",
        "CREDIT_PER_PERSON": f"AMT_CREDIT / (CNT_FAM_MEMBERS + {EPS})",
    },
}


def _feature_query(group):
    def run(spark, sf_dir):
        fin = applicant_finance(spark, sf_dir)
        exprs = FE.GROUPS[group](set(fin.columns))
        return round_doubles(fin.select(KEY, *[e.alias(n) for n, e in exprs.items()]))
    run.__name__ = f"q_{group}"
    return run


for _g, _exprs in FEATURE_SQL.items():
    query(_g, sql=f"""{FINANCE_CTE}
SELECT c_custkey, {', '.join(f'{R(e)} AS {n}' for n, e in _exprs.items())} FROM fin""")(_feature_query(_g))


ALL_FEATURES = [n for g in FEATURE_SQL.values() for n in g]


@query("domain_features", sql=f"""{FINANCE_CTE}
SELECT fin.c_custkey, fin.TARGET, {', '.join(f'{R(e)} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())}
FROM fin""")
def q_domain_features(spark, sf_dir):
    """All E-features in one projection (df_fe)."""
    df = FE.domain_features(applicant_finance(spark, sf_dir))
    return round_doubles(df.select(KEY, TARGET, *ALL_FEATURES))


@query("row_max", sql=f"""{FINANCE_CTE}
SELECT c_custkey, {R('greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)')} AS row_max FROM fin""")
def q_row_max(spark, sf_dir):
    """Row-wise max over columns, nulls skipped."""
    fin = applicant_finance(spark, sf_dir)
    return round_doubles(fin.select(KEY, F.greatest("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3").alias("row_max")))


@query("corr_features", sql=f"""{FINANCE_CTE},
fe AS (SELECT TARGET, {', '.join(f'{e} AS {n}' for g in FEATURE_SQL.values() for n, e in g.items())} FROM fin),
l AS (SELECT fe.TARGET, v.column_name, v.value FROM fe,
      LATERAL (VALUES {', '.join(f"('{n}', CAST({n} AS DOUBLE))" for n in ALL_FEATURES)}) v(column_name, value))
SELECT column_name, CAST(count(CASE WHEN value IS NOT NULL AND TARGET IS NOT NULL THEN 1 END) AS BIGINT) AS n_pairs,
       {R('CASE WHEN var_pop(CASE WHEN TARGET IS NOT NULL THEN value END) > 0 AND var_pop(CASE WHEN value IS NOT NULL THEN TARGET END) > 0 THEN covar_pop(value, TARGET) / sqrt(var_pop(CASE WHEN TARGET IS NOT NULL THEN value END) * var_pop(CASE WHEN value IS NOT NULL THEN TARGET END)) END')} AS r
FROM l GROUP BY column_name""")
def q_corr_features(spark, sf_dir):
    """Correlation of each new domain feature with TARGET."""
    df = FE.domain_features(applicant_finance(spark, sf_dir))
    t = P.correlation_with(df, ALL_FEATURES, TARGET)
    return t.select("column_name", "n_pairs", fround("r").alias("r"))
