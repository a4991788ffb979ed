"""Roll-up queries: D1-D3 aggregates and the C1/C2 left-join chain.

Role binding: lineitem (bureau_balance) -> orders (bureau) -> customer
(application); events play the sparse child table (credit-card balance).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import sql_round
from ledgerlens.operators.rollup import aggregate_table, left_join_chain, numeric_columns, rollup_aggregations
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.sources.tables import KEY, applicants, read_table

# (column, kind) of the numeric columns each roll-up sees, in schema order
LINEITEM_NUM = [("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
                ("l_quantity", "dbl"), ("l_extendedprice", "dbl"), ("l_discount", "dbl"),
                ("l_tax", "dbl")]
ORDERS_NUM = [("o_orderkey", "int"), ("o_totalprice", "dbl")]
EVENTS_NUM = [("event_id", "int"), ("value", "dbl")]


def rollup_columns(cols, prefix):
    """Output (name, kind) of aggregate_table for the given numeric inputs."""
    out = []
    for i, (c, k) in enumerate(cols):
        out += [(f"{prefix}_{c}_min", k), (f"{prefix}_{c}_max", k),
                (f"{prefix}_{c}_mean", "dbl"), (f"{prefix}_{c}_sum", k)]
        if i == 0:
            out.append((f"{prefix}_{c}_count", "int"))
    return out


def rollup_sql_exprs(cols, prefix, rounded=True):
    parts = []
    r = (lambda e: sql_round(e)) if rounded else (lambda e: e)
    for i, (c, k) in enumerate(cols):
        if k == "int":
            parts += [f"min({c}) AS {prefix}_{c}_min", f"max({c}) AS {prefix}_{c}_max",
                      f"{r(f'avg({c})')} AS {prefix}_{c}_mean",
                      f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {prefix}_{c}_sum"]
        else:
            parts += [f"{r(f'min({c})')} AS {prefix}_{c}_min",
                      f"{r(f'max({c})')} AS {prefix}_{c}_max",
                      f"{r(f'avg({c})')} AS {prefix}_{c}_mean",
                      f"{r(f'coalesce(sum({c}), 0)')} AS {prefix}_{c}_sum"]
        if i == 0:
            parts.append(f"CAST(count({c}) AS BIGINT) AS {prefix}_{c}_count")
    return ",\n  ".join(parts)


ORDERS_MERGED_NUM = ORDERS_NUM + rollup_columns(LINEITEM_NUM, "li")

LI_CTE = f"""li AS (
  SELECT l_orderkey AS o_orderkey,
  {rollup_sql_exprs(LINEITEM_NUM, 'li', rounded=False)}
  FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)"""

ORD_CTE = f"""{LI_CTE},
om AS (SELECT o.*, li.* EXCLUDE (o_orderkey) FROM orders o LEFT JOIN li USING (o_orderkey)),
ord AS (
  SELECT o_custkey AS c_custkey,
  {rollup_sql_exprs(ORDERS_MERGED_NUM, 'ord', rounded=False)}
  FROM om WHERE o_custkey IS NOT NULL GROUP BY o_custkey)"""

EV_CTE = f"""ev AS (
  SELECT user_id AS c_custkey,
  {rollup_sql_exprs(EVENTS_NUM, 'ev', rounded=False)}
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id)"""


def _round_select(cols):
    return ", ".join(f"{sql_round(c)} AS {c}" if k == "dbl" else c for c, k in cols)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def lineitem_order_stats(spark, sf_dir):
    """ONE per-order aggregate of lineitem (the largest table) carrying both the
    D1 roll-up columns and the finance columns; every consumer selects from this
    same plan. An order has few lines, so its lines are shorter than its 40 partial
    sums: the rows are shuffled, and no task holds a map of all orders it scans."""
    li = read_table(spark, sf_dir, "lineitem")
    cols = [c for c, _ in LINEITEM_NUM]
    extra = [F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_net"),
             F.count(F.lit(1)).alias("_lines"), F.min("l_shipdate").alias("_first_ship")]
    return (li.where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey").groupBy("l_orderkey")
            .agg(*rollup_aggregations(li, cols, "li"), *extra))


def customer_order_stats(spark, sf_dir):
    """Lineitem -> order (D1), left join onto orders (C1), -> customer (D1), with the sums that the
    finance columns need. A customer's orders lie in as many tasks as there are, so these rows are
    shuffled rather than partial sums four times as long; roll-up and finance columns share the shuffle."""
    orders = read_table(spark, sf_dir, "orders")
    li = lineitem_order_stats(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    merged = orders.join(li, "o_orderkey", "left")
    cols = numeric_columns(merged, exclude=("o_custkey", "_net", "_lines"))
    finance = [
        F.sum("o_totalprice").alias("_credit"), F.avg("o_totalprice").alias("_annuity"),
        F.sum("li_l_extendedprice_sum").alias("_goods"), F.sum("_net").alias("_income"),
        F.count("o_orderkey").cast("double").alias("_orders"),
        F.min("o_orderdate").alias("_first_order"), F.max("o_orderdate").alias("_last_order"),
        F.min("_first_ship").alias("_first_ship"),
        *[F.try_divide(F.sum(f"li_l_{c}_sum"), F.sum("_lines")).alias(f"_avg_{c}") for c in ("discount", "tax", "quantity")]]
    return (merged.where(F.col("o_custkey").isNotNull()).repartition("o_custkey").groupBy("o_custkey")
            .agg(*rollup_aggregations(merged, cols, "ord"), *finance).withColumnRenamed("o_custkey", KEY))


def orders_rollup_two_stage(spark, sf_dir):
    """The roll-up columns per customer."""
    st = customer_order_stats(spark, sf_dir)
    return st.select(*[c for c in st.columns if not c.startswith("_")])


def events_rollup(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return aggregate_table(ev, "user_id", "ev").withColumnRenamed("user_id", KEY)


def applicant_base(spark, sf_dir):
    """df_main: one row per applicant with all roll-ups left-joined."""
    base = applicants(spark, sf_dir)
    return left_join_chain(base, KEY, [
        (orders_rollup_two_stage(spark, sf_dir), KEY),
        (events_rollup(spark, sf_dir), KEY),
    ])


APPLICANT_BASE_CTE = f"""WITH {ORD_CTE},
{EV_CTE},
base AS (
  SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment,
         CAST(c.c_acctbal < 0 AS INTEGER) AS TARGET,
         ord.* EXCLUDE (c_custkey), ev.* EXCLUDE (c_custkey)
  FROM customer c LEFT JOIN ord USING (c_custkey) LEFT JOIN ev USING (c_custkey))"""

APPLICANT_BASE_COLS = ([("c_custkey", "int"), ("c_nationkey", "int"), ("c_mktsegment", "str"),
                        ("TARGET", "int")] + rollup_columns(ORDERS_MERGED_NUM, "ord")
                       + rollup_columns(EVENTS_NUM, "ev"))


@query("rollup_orders", sql=f"""
SELECT o_custkey, {rollup_sql_exprs(ORDERS_NUM, 'ord')}
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""")
def q_rollup_orders(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return round_doubles(aggregate_table(orders, "o_custkey", "ord"))


@query("rollup_lineitem_orders", sql=f"""
WITH {ORD_CTE}
SELECT {_round_select([('c_custkey', 'int')] + rollup_columns(ORDERS_MERGED_NUM, 'ord'))} FROM ord""")
def q_rollup_lineitem_orders(spark, sf_dir):
    return round_doubles(orders_rollup_two_stage(spark, sf_dir))


@query("rollup_events", sql=f"""
SELECT user_id, {rollup_sql_exprs(EVENTS_NUM, 'ev')}
FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
def q_rollup_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return round_doubles(aggregate_table(ev, "user_id", "ev"))


@query("applicant_base", sql=f"""
{APPLICANT_BASE_CTE}
SELECT {_round_select(APPLICANT_BASE_COLS)} FROM base""")
def q_applicant_base(spark, sf_dir):
    return round_doubles(applicant_base(spark, sf_dir))
