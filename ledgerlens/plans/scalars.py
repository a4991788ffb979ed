"""Scalar / array / map / JSON / sort / set / reshape surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.sqlgen import R
from ledgerlens.sources.tables import read_table


@query("scalar_math", sql=f"""
SELECT l_orderkey, l_linenumber, {R('ln(1 + l_extendedprice)')} AS log1p_price, {R('ln(l_quantity)')} AS log_qty,
       {R('abs(l_extendedprice * (l_discount - 0.05))')} AS abs_dev, {R('round(l_extendedprice / 7, 2)')} AS rounded,
       {R('least(greatest(l_quantity, 10.0), 40.0)')} AS clipped, {R('exp(-l_discount)')} AS exp_disc
FROM lineitem""")
def q_scalar_math(spark, sf_dir):
    """log1p, log, abs, round, clip, exp."""
    li = read_table(spark, sf_dir, "lineitem")
    return round_doubles(li.select(
        "l_orderkey", "l_linenumber", F.log1p("l_extendedprice").alias("log1p_price"),
        F.log("l_quantity").alias("log_qty"),
        F.abs(F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("abs_dev"),
        fround(F.col("l_extendedprice") / 7, 2).alias("rounded"),
        F.least(F.greatest("l_quantity", F.lit(10.0)), F.lit(40.0)).alias("clipped"),
        F.exp(-F.col("l_discount")).alias("exp_disc")))


@query("scalar_null", sql=f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v,
                  nullif(event_type, 'error') AS t FROM events)
SELECT event_id, v IS NULL AS v_missing, {R('coalesce(v, 0.0)')} AS v_filled, coalesce(t, 'Missing') AS t_filled,
       {R("CASE WHEN isinf(CASE WHEN v > 100 THEN CAST('inf' AS DOUBLE) ELSE v END) THEN NULL ELSE v END")} AS v_clean
FROM e WHERE t IS NOT NULL""")
def q_scalar_null(spark, sf_dir):
    """Sentinel -> null (nullif), null tests, fills, inf -> null, drop null rows."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("t"))
    capped = F.when(F.col("v") > 100, F.lit(float("inf"))).otherwise(F.col("v"))  # +inf marker
    out = ev.na.drop(subset=["t"]).select(
        "event_id", F.col("v").isNull().alias("v_missing"), F.coalesce("v", F.lit(0.0)).alias("v_filled"),
        F.coalesce("t", F.lit("Missing")).alias("t_filled"),
        F.when(~capped.isin(float("inf"), float("-inf")), F.col("v")).alias("v_clean"))
    return round_doubles(out)


@query("scalar_cast", sql=f"""
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num,
       TRY_CAST(o_orderstatus AS DOUBLE) AS status_num, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
       CAST(o_custkey AS VARCHAR) AS cust_str
FROM orders""")
def q_scalar_cast(spark, sf_dir):
    """Coercing casts (bad -> null), int truncation, to string."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    F.expr("try_cast(substr(o_orderpriority, 1, 1) AS double)").alias("priority_num"),
                    F.expr("try_cast(o_orderstatus AS double)").alias("status_num"),
                    F.col("o_totalprice").cast("long").alias("price_int"),
                    F.col("o_custkey").cast("string").alias("cust_str"))


@query("scalar_text", sql="""
SELECT p_partkey, regexp_replace(p_type, '[ ,:]', '_', 'g') AS type_clean, replace(p_brand, '#', ' no. ') AS brand_text,
       contains(p_type, 'BRASS') AS is_brass, contains(lower(p_name), 'green') AS mentions_green
FROM part""")
def q_scalar_text(spark, sf_dir):
    """Regex replace, replace, contains."""
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", F.regexp_replace("p_type", "[ ,:]", "_").alias("type_clean"),
                    F.replace("p_brand", F.lit("#"), F.lit(" no. ")).alias("brand_text"),
                    F.col("p_type").contains("BRASS").alias("is_brass"),
                    F.lower("p_name").contains("green").alias("mentions_green"))


@query("scalar_time", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month, CAST(o_orderdate AS DATE) AS order_day,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days_before_asof FROM orders""")
def q_scalar_time(spark, sf_dir):
    """Date formatting and day offsets (the run stamp itself is in score_batch)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
                    F.col("o_orderdate").cast("date").alias("order_day"),
                    F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).alias("days_before_asof"))


@query("scalar_array", sql=f"""
WITH g AS (SELECT l_orderkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                  list_sort(list_distinct(list(l_returnflag))) AS flags,
                  arg_max(l_linenumber, l_extendedprice) AS argmax_line, arg_min(l_linenumber, l_extendedprice) AS argmin_line,
                  count(*) AS n
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, list_transform(range(5), lambda i: {R('lo + i * (hi - lo) / 4')}) AS grid, flags,
       argmax_line, argmin_line FROM g""")
def q_scalar_array(spark, sf_dir):
    """Linspace (sequence + transform), unique values, argmax / argmin per group."""
    li = read_table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey").agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"),
        F.array_sort(F.collect_set("l_returnflag")).alias("flags"),  # distinct flags only
        F.max_by("l_linenumber", F.struct("l_extendedprice", F.col("l_linenumber"))).alias("argmax_line"),
        F.min_by("l_linenumber", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("argmin_line"))
    grid = F.transform(F.sequence(F.lit(0), F.lit(4)),
                       lambda i: fround(F.col("lo") + i * (F.col("hi") - F.col("lo")) / 4))
    return g.select("l_orderkey", grid.alias("grid"), "flags", "argmax_line", "argmin_line")


@query("scalar_map_json", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, 0.0 AS absent,
       '{"event_type":"' || event_type || '","k":' || CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS VARCHAR) || '}' AS encoded
FROM events""")
def q_scalar_map_json(spark, sf_dir):
    """JSON -> map, lookup with default, map -> JSON."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "map<string,double>").alias("m"))
    return ev.select("event_id", F.element_at("m", F.lit("k")).alias("k"),
                     F.coalesce(F.element_at("m", F.lit("absent")), F.lit(0.0)).alias("absent"),
                     F.to_json(F.struct("event_type", F.element_at("m", F.lit("k")).alias("k"))).alias("encoded"))


@query("sort_topk", sql=f"""
SELECT l_orderkey, l_linenumber, {R('l_extendedprice * (l_discount - 0.05)')} AS dev FROM lineitem
ORDER BY abs(l_extendedprice * (l_discount - 0.05)) DESC, l_orderkey, l_linenumber LIMIT 15""")
def q_sort_topk(spark, sf_dir):
    """Sort by |value| desc, head(15) (TakeOrderedAndProject: per-task top-k)."""
    li = read_table(spark, sf_dir, "lineitem")
    dev = F.col("l_extendedprice") * (F.col("l_discount") - 0.05)
    return round_doubles(li.select("l_orderkey", "l_linenumber", dev.alias("dev"))
                         .orderBy(F.desc(F.abs("dev")), "l_orderkey", "l_linenumber").limit(15))


@query("union_distinct", sql="""
SELECT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'F'
UNION SELECT user_id FROM events WHERE event_type = 'purchase'""")
def q_union_distinct(spark, sf_dir):
    """Union by name + distinct (list-set union)."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(F.col("user_id").alias("c_custkey"))
    return o.unionByName(e).distinct()


@query("unpivot_pivot", sql="""
SELECT l_returnflag,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS DOUBLE) AS F,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS DOUBLE) AS O
FROM lineitem GROUP BY l_returnflag""")
def q_unpivot_pivot(spark, sf_dir):
    """Long -> wide with a known value list (no extra distinct job)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))


@query("predicates", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (l_quantity BETWEEN 10 AND 20 OR l_discount > 0.08) AND l_returnflag IN ('R', 'A') AND NOT (l_tax = 0)""")
def q_predicates(spark, sf_dir):
    """Comparisons, between, and/or/not, membership (pushed to the Parquet scan)."""
    cond = ((F.col("l_quantity").between(10, 20) | (F.col("l_discount") > 0.08))
            & F.col("l_returnflag").isin("R", "A") & ~(F.col("l_tax") == 0))
    return read_table(spark, sf_dir, "lineitem", where=cond).select("l_orderkey", "l_linenumber")
