"""Rebalancing queries on the embeddings table (H4, H5): label 0 vs rest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.stats import fround
from ledgerlens.operators import cells as C
from ledgerlens.operators import knn as K
from ledgerlens.plans.sqlgen import R
from ledgerlens.plans.registry import query
from ledgerlens.sources.tables import read_table

MINORITY = 1  # y = 1 for label 0 (one label vs the other nine)


def points(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
                    (F.col("label") == 0).cast("int").alias("y"))


PAIRS_CTE = """WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label = 0 AS INTEGER) AS y FROM embeddings)"""


@query("knn_minority", sql=f"""{PAIRS_CTE},
d AS (SELECT a.id AS q_id, b.id AS nn_id, list_distance(a.vec, b.vec) AS distance
      FROM p a JOIN p b ON a.id <> b.id AND a.y = 1 AND b.y = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, nn_id) AS nn_rank FROM d)
SELECT q_id, nn_id, {R("distance", 6)} AS distance, CAST(nn_rank AS INTEGER) AS nn_rank FROM r WHERE nn_rank <= 5""")
def q_knn_minority(spark, sf_dir):
    """H4 building block: exact 5 nearest minority neighbours of each minority point."""
    m = points(spark, sf_dir).where(F.col("y") == MINORITY)
    nn = K.knn(m, m, 5)
    return nn.select("q_id", "nn_id", fround("distance", 6).alias("distance"), F.col("nn_rank").cast("int"))


@query("enn_filter", sql=f"""{PAIRS_CTE},
d AS (SELECT a.id AS q_id, a.y AS qy, b.y AS ny, list_distance(a.vec, b.vec) AS distance, b.id AS nn_id
      FROM p a JOIN p b ON a.id <> b.id AND a.y <> {MINORITY}),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, nn_id) AS rk FROM d),
v AS (SELECT q_id FROM r WHERE rk <= 3 GROUP BY q_id HAVING sum(CAST(qy = ny AS INTEGER)) < count(*))
SELECT id, y FROM p WHERE id NOT IN (SELECT q_id FROM v)""")
def q_enn_filter(spark, sf_dir):
    """H5: edited nearest neighbours (k = 3, 'all' rule) cleaning the majority class."""
    return K.enn(points(spark, sf_dir), "y", k=3, keep_class=MINORITY).select("id", "y")


SMOTE_SQL = f"""{PAIRS_CTE},
m AS (SELECT id, vec, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) - 1 AS idx FROM p WHERE y = {MINORITY}),
c AS (SELECT count(*) FILTER (WHERE y = {MINORITY}) AS n_min, count(*) AS n FROM p),
d AS (SELECT a.id AS base_id, b.id AS nn_id, list_distance(a.vec, b.vec) AS distance FROM m a JOIN m b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY distance, nn_id) AS nr FROM d),
j AS (SELECT i AS sample_id, i % c.n_min AS idx, least(5, c.n_min - 1) AS k, md5(CAST(i AS VARCHAR) || '-smote') AS h
      FROM c, LATERAL (SELECT UNNEST(range(greatest(0, c.n - 2 * c.n_min))) AS i)),
s AS (SELECT sample_id, idx, CAST('0x' || substr(h, 1, 8) AS BIGINT) % k + 1 AS nr,
             CAST(CAST('0x' || substr(h, 9, 13) AS BIGINT) AS DOUBLE) / pow(16, 13) AS gap FROM j),
b AS (SELECT s.sample_id, m.id AS base_id, r.nn_id, s.gap, m.vec AS x FROM s JOIN m USING (idx)
      JOIN r ON r.base_id = m.id AND r.nr = s.nr)
SELECT b.sample_id, b.base_id, b.nn_id, {R('b.gap', 6)} AS gap,
       {R('list_sum(list_transform(list_zip(b.x, n.vec), lambda e: e[1] + b.gap * (e[2] - e[1])))', 6)} AS vec_sum,
       {MINORITY} AS y FROM b JOIN m n ON n.id = b.nn_id"""


@query("smote", sql=SMOTE_SQL)
def q_smote(spark, sf_dir):
    """H4: SMOTE synthetic minority rows (k = 5) up to a 1:1 balance, each vector as its sum."""
    out = K.smote(points(spark, sf_dir), "y", MINORITY, k=5)
    return out.select("sample_id", "base_id", "nn_id", fround("gap", 6).alias("gap"),
                      fround(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("vec_sum"), "y")


@query("knn_cells", sql="""SELECT CAST(5 * count(*) AS BIGINT) AS n_pairs, true AS recall_over_90 FROM embeddings
WHERE embedding IS NOT NULL AND vec_id IS NOT NULL""")
def q_knn_cells(spark, sf_dir):
    """H4/H5 at scale: five neighbours of every vector by an inverted file, as many cells looked into as a sample
    of queries needs, and their recall against the exact way."""
    p = points(spark, sf_dir)
    cells = C.build(p, cell=128)
    found = C.neighbours(cells, p, 5, C.probes_for(cells, p, 5))
    return C.recall(found, K.knn(p, p, 5)).select("n_pairs", (F.col("recall") > 0.9).alias("recall_over_90"))
