"""Split / sampling / class-balance queries (G1-G7, H1-H3) on the applicant table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import split as SP
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.plans.sqlgen import R
from ledgerlens.sources.tables import KEY, TARGET, applicants, read_table

HASH = "md5(CAST({k} AS VARCHAR) || '-42')"
H_CUST = HASH.format(k="c_custkey")

SPLIT_CTE = f"""WITH a AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS TARGET FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY {H_CUST}, c_custkey) AS rk,
             count(*) OVER (PARTITION BY TARGET) AS n FROM a),
s AS (SELECT c_custkey, TARGET, CASE WHEN rk <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r)"""


def split_frame(spark, sf_dir):
    return SP.stratified_split(applicants(spark, sf_dir), KEY, TARGET, 0.2)


def train_frame(spark, sf_dir):
    return split_frame(spark, sf_dir).where(F.col("split") == "train").drop("split")


@query("split_stratified", sql=f"{SPLIT_CTE} SELECT * FROM s")
def q_split_stratified(spark, sf_dir):
    return split_frame(spark, sf_dir).select(KEY, TARGET, "split")


@query("split_check", sql=f"""{SPLIT_CTE}
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(TARGET) AS BIGINT) AS n_pos, {R('avg(TARGET)')} AS pos_rate
FROM s GROUP BY split""")
def q_split_check(spark, sf_dir):
    """Class share per split."""
    s = split_frame(spark, sf_dir)
    return round_doubles(s.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(TARGET).cast("bigint").alias("n_pos"),
        F.avg(TARGET).alias("pos_rate")))


TRAIN_RANK = f"""{SPLIT_CTE},
t AS (SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY {H_CUST}, c_custkey) AS rk,
             count(*) OVER (PARTITION BY TARGET) AS n,
             row_number() OVER (ORDER BY {H_CUST}, c_custkey) AS pos, count(*) OVER () AS n_all
      FROM s WHERE split = 'train')"""


@query("sample_stratified", sql=f"""{TRAIN_RANK}
SELECT c_custkey, TARGET FROM t WHERE rk <= round(n * 0.1)""")
def q_sample_stratified(spark, sf_dir):
    """Stratified 10 % of the training rows."""
    return SP.stratified_sample(train_frame(spark, sf_dir), KEY, TARGET, 0.1).select(KEY, TARGET)


@query("sample_uniform", sql=f"""
SELECT o_orderkey, o_custkey FROM orders ORDER BY {HASH.format(k='o_orderkey')}, o_orderkey LIMIT 2000""")
def q_sample_uniform(spark, sf_dir):
    """2000 orders without replacement."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return SP.uniform_sample(o, "o_orderkey", 2000)


@query("kfold_balance", sql=f"""{TRAIN_RANK}
SELECT CAST((rk - 1) % 5 AS INTEGER) AS fold, TARGET, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY ALL""")
def q_kfold_balance(spark, sf_dir):
    """Stratified 5-fold assignment of the training rows, counted per fold and class."""
    f = SP.kfold(train_frame(spark, sf_dir), KEY, TARGET, 5)
    return f.groupBy("fold", TARGET).agg(F.count(F.lit(1)).alias("n"))


@query("tail_validation", sql=f"""{TRAIN_RANK}
SELECT c_custkey, TARGET, pos > n_all - floor(n_all * 0.15) AS is_validation FROM t""")
def q_tail_validation(spark, sf_dir):
    """Last 15 % of the (shuffled) training rows flagged as validation."""
    return SP.tail_indicator(train_frame(spark, sf_dir), KEY, 0.15).select(KEY, TARGET, "is_validation")


@query("position_windows", sql=f"""{SPLIT_CTE},
t AS (SELECT *, row_number() OVER (ORDER BY {H_CUST}, c_custkey) AS pos, count(*) OVER () AS n_all
      FROM s WHERE split = 'test')
SELECT c_custkey, TARGET, CAST(floor((pos - 1) / floor(n_all / 4)) AS INTEGER) AS window FROM t
WHERE floor((pos - 1) / floor(n_all / 4)) < 4""")
def q_position_windows(spark, sf_dir):
    """The test rows in 4 consecutive position windows of n // 4 rows."""
    test = split_frame(spark, sf_dir).where(F.col("split") == "test")
    return SP.position_windows(test, KEY, 4).select(KEY, TARGET, "window")


@query("class_weights", sql=f"""{SPLIT_CTE},
c AS (SELECT TARGET, count(*) AS n_class FROM s WHERE split = 'train' GROUP BY TARGET)
SELECT TARGET, CAST(n_class AS BIGINT) AS n_class,
       {R('sum(n_class) OVER () / (2.0 * n_class)')} AS class_weight,
       {R('sum(CASE WHEN TARGET = 0 THEN n_class END) OVER () / sum(CASE WHEN TARGET = 1 THEN n_class END) OVER ()')} AS scale_pos_weight
FROM c""")
def q_class_weights(spark, sf_dir):
    """H1/H2: balanced weights n / (k * n_c) and scale_pos_weight n0 / n1 on train."""
    from ledgerlens.operators.balance import class_weights
    return round_doubles(class_weights(train_frame(spark, sf_dir), TARGET))


@query("undersample_2to1", sql=f"""{TRAIN_RANK},
m AS (SELECT count(*) AS n1 FROM t WHERE TARGET <> 0),
z AS (SELECT c_custkey, TARGET, row_number() OVER (ORDER BY {H_CUST}, c_custkey) AS zr FROM t WHERE TARGET = 0)
SELECT c_custkey, TARGET FROM t WHERE TARGET <> 0
UNION ALL SELECT c_custkey, TARGET FROM z, m WHERE zr <= n1 * 2""")
def q_undersample(spark, sf_dir):
    """H3: majority class randomly undersampled to 2:1 (training rows)."""
    return SP.undersample(train_frame(spark, sf_dir), KEY, TARGET, 2.0).select(KEY, TARGET)
