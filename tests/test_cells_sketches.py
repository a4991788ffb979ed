"""Cells against exact neighbours, sketches against exact counts and edges, co-moments against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cells as C
from ledgerlens.operators import drift as D
from ledgerlens.operators import knn as K
from ledgerlens.operators import profile as P
from ledgerlens.operators import sketches as SK


def vectors(spark, x, ids=None):
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(4)


def test_cells_find_the_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    df = vectors(spark, x)
    cells = C.build(df, cell=100)
    probes = C.probes_for(cells, df, 5)
    assert 1 <= probes <= 12 and len(cells.centres) == 30
    found = C.neighbours(cells, df, 5, probes)
    share = C.recall(found, K.knn(df, df, 5)).first()
    assert share["n_pairs"] == 15_000 and share["recall"] > 0.9
    # with all cells it is the exact way
    some = df.where("id < 200")
    exact = {tuple(r) for r in K.knn(some, df, 4).select("q_id", "nn_id", "nn_rank").collect()}
    assert {tuple(r) for r in C.neighbours(cells, some, 4, 30).select("q_id", "nn_id", "nn_rank").collect()} == exact


def test_equal_vectors_come_in_blocks(spark):
    x = np.concatenate((np.zeros((300, 3)), np.arange(60).reshape(20, 3)))
    df = vectors(spark, x)
    cells = C.build(df, cell=50, block=64)
    assert max(cells.blocks.values()) >= 5
    exact = {tuple(r) for r in K.knn(df, df, 3).select("q_id", "nn_id", "nn_rank").collect()}
    found = C.neighbours(cells, df, 3, len(cells.centres))
    assert {tuple(r) for r in found.select("q_id", "nn_id", "nn_rank").collect()} == exact


def test_points_without_distance_and_no_points(spark):
    rows = [(1, [0.0, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.0, 2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    cells = C.build(df)
    assert sorted(tuple(r) for r in C.neighbours(cells, df, 5, 3).select("q_id", "nn_id").collect()) == [(1, 4), (4, 1)]
    assert C.probes_for(cells, df.limit(0), 5) == 1


def test_distinct_sketches_merge(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"), (F.col("id") % 20_000).alias("a"), F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 10)).alias("column_name"))
    parts = SK.distinct_sketches(df, ["a", "nothing", "column_name"], ("day",))
    got = {r.column_name: r.n_unique for r in SK.distinct_counts(parts).collect()}
    assert got["column_name"] == 10 and "nothing" not in got
    assert abs(got["a"] - 20_000) < 3 * 1.04 / 2 ** (SK.LG_K / 2) * 20_000
    by_day = {(r.day, r.column_name): r.n_unique for r in SK.distinct_counts(parts, ("day",)).collect()}
    assert abs(by_day[3, "a"] - df.where("day = 3").select("a").distinct().count()) < 300


def test_edges_of_merged_sketches_are_within_their_rank_error(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate((rng.lognormal(0, 2, 30_000), np.full(3000, 1.0)))
    df = spark.createDataFrame([(int(i % 9), "x", float(t)) for i, t in enumerate(v)], "day long, feature string, value double")
    edges = SK.sketch_edges(SK.value_sketches(df, ("day",))).first()["edges"]
    for share, e in zip(np.linspace(0, 1, 11), edges):
        low, high = (v < e).mean(), (v <= e).mean()
        assert low - 2 * SK.RANK_ERROR <= share <= high + 2 * SK.RANK_ERROR
    assert edges[0] == v.min() and edges[-1] == v.max()


def test_psi_of_sketches_is_close_to_the_exact_one(spark):
    rng = np.random.default_rng(6)
    rows = [(d, f, float(rng.normal(0.02 * d if f == "moves" else 0.0))) for d in range(28) for f in ("moves", "stays") for _ in range(800)]
    rows += [(d, "few", 1.0) for d in range(28)]
    df = spark.createDataFrame(rows, "day long, feature string, value double").withColumn("win", F.floor(F.col("day") / 7))
    days = SK.value_sketches(df, ("win", "day"))
    ref = days.where("win = 0")
    edges = SK.sketch_edges(ref)
    about = D.psi_from_counts(edges, SK.sketch_counts(ref, edges).withColumnRenamed("n", "e_n"),
                              SK.sketch_counts(days, edges, ("win",)).withColumnRenamed("n", "a_n"),
                              df.select("feature", "win").distinct(), ["feature"], "win")
    exact = D.psi(df.where("win = 0").select("feature", "value"), df.select("feature", "win", "value"), ["feature"], "win")
    one = {(r.feature, r.win): r.psi for r in about.collect()}
    two = {(r.feature, r.win): r.psi for r in exact.collect()}
    assert one.keys() == two.keys() and len(one) == 12
    assert max(abs(one[k] - two[k]) for k in one) < 0.02
    assert one["moves", 3] > 0.1 > one["stays", 3] and one["few", 2] == 0


def test_correlations_survive_large_means_and_holes(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 4))
    x[:, 1] += x[:, 0]
    x[:, 2] = 1e8 + 1e-2 * x[:, 2] + 1e-2 * x[:, 0]
    x[rng.random((500, 4)) < 0.2] = np.nan
    x[:, 3] = 1e9
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x] + [[None] * 4],
                               "a double, b double, c double, d double").repartition(5)
    got = {(r.x, r.y): (r.n_pairs, r.r) for r in P.correlation_long(df, list("abcd")).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        n, r = got["abcd"[i], "abcd"[j]]
        assert n == both.sum() and r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)
    assert got["a", "d"][1] is None
    none = df.select(F.col("a"), F.lit(None).cast("double").alias("b"))
    assert [tuple(r) for r in P.correlation_long(none, ["a", "b"]).collect()] == [("a", "b", 0, None)]
