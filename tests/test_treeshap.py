"""Tree attributions against the average over all subsets of features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from ledgerlens.operators import explain as X
from ledgerlens.operators import histtrees as H
from ledgerlens.operators import treeshap as TS
from tests.test_histtrees import data, frame


def by_subsets(tree, x, features):
    """Shapley values of one tree: known features are followed, others weighed by training rows."""
    def expect(at, known):
        f = tree.feature[at]
        if f < 0:
            return tree.value[at]
        if f in known:
            return expect(tree.left[at] if x[f] <= tree.cut[at] else tree.right[at], known)
        return sum(tree.rows[c] / tree.rows[at] * expect(c, known) for c in (tree.left[at], tree.right[at]))

    out = np.zeros(features)
    for i in range(features):
        rest = [j for j in range(features) if j != i]
        for k in range(features):
            w = math.factorial(k) * math.factorial(features - 1 - k) / math.factorial(features)
            for some in itertools.combinations(rest, k):
                out[i] += w * (expect(0, {*some, i}) - expect(0, set(some)))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    x, y = data(500, 11)
    df = frame(spark, x, y, np.zeros(500)).withColumn("label", F.col("label").cast("double")).cache()
    return x, y, df


def test_values_equal_all_subsets(spark, learned):
    x, _, df = learned
    table = H.binned(df, "features", "label", "id", F.col("grp"))
    model, = H.train(table, [H.Fit(H.Params(rounds=3, max_leaves=20, max_depth=6, min_leaf=3, rate=0.4), frozenset({0}))])
    paths = TS.of_boosted(model)
    some = x[:12].copy()
    some[3, 0] = np.nan
    found = TS.values_of(paths, some)
    trees = H.thresholds(model)
    for row, got in zip(some, found):
        filled = np.where(np.isnan(row), np.inf, row)
        assert got == pytest.approx(sum(by_subsets(t, filled, 6) for t in trees), abs=1e-9)
    bins = np.stack([np.searchsorted(e, some[:, j]) for j, e in enumerate(table.edges)], axis=1)
    f = model.start + sum(t.value[t.walk(bins)] for t in model.trees)
    assert found.sum(axis=1) + paths.base == pytest.approx(f)


@pytest.mark.parametrize("make", [
    lambda: DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=5),
    lambda: RandomForestClassifier(numTrees=8, maxDepth=5, seed=1),
    lambda: GBTClassifier(maxIter=6, maxDepth=4, seed=1),
])
def test_values_of_spark_models_add_up(spark, learned, make):
    _, _, df = learned
    model = make().fit(df)
    paths = TS.of_spark(model)
    long = TS.attributions(paths, df.limit(40), "id", "features", list("abcdef"))
    sums = {r["id"]: r["s"] + paths.base for r in long.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    for r in model.transform(df.limit(40)).collect():
        p = r["probability"][1]
        expected = 0.5 * math.log(p / (1 - p)) if isinstance(make(), GBTClassifier) else p
        assert sums[r["id"]] == pytest.approx(expected, abs=1e-9)
    assert long.columns == ["id", "feature", "input_value", "attribution"]
    assert X.global_table(long).count() <= 6


def test_a_single_leaf_explains_nothing(spark):
    tree = H.Tree(*[np.array([v]) for v in (-1, 0, 0, 0, 2.5, 10.0, 0.0)], depth=0)
    paths = TS.paths_of(TS.tree_leaves(tree.feature, tree.cut, tree.left, tree.right, tree.value, tree.rows), 3, 1.0)
    assert paths.base == 3.5 and (TS.values_of(paths, np.ones((2, 3))) == 0).all()


def test_drawn_rows_are_explained_by_many_tasks(spark, monkeypatch):
    """The draw ends in one partition; its attributions take more than one task."""
    from ledgerlens.plans import scoring as SC
    from ledgerlens.sources.tables import KEY
    seen = []
    monkeypatch.setattr(SC, "_split", lambda s, d: (None, s.range(500).withColumnRenamed("id", KEY), ["a"]))
    monkeypatch.setattr(SC, "tree_paths", lambda s, d: None)
    monkeypatch.setattr(SC, "once", lambda s, name, d, make: make())
    monkeypatch.setattr(SC, "materialize", lambda df, name: df)
    monkeypatch.setattr(SC.TS, "attributions", lambda paths, rows, *rest: seen.append(rows) or rows)
    assert SC.tree_attr(spark, "x").count() == 500
    assert seen[0].rdd.getNumPartitions() > 1


def test_top_factors_need_only_the_largest_attributions(spark):
    """Ties, zeros, NaN and a repeated key: trimmed rows give the same top factors, from fewer rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    from ledgerlens.operators import explain as X
    rng = np.random.default_rng(4)
    rows = [(i // 2 if i < 2 else i, [float(v) for v in rng.integers(-3, 4, 30)]) for i in range(40)]
    rows[5][1][7] = float("nan")
    rows[6][1][:] = [0.0] * 30
    df = spark.createDataFrame(rows, "id long, x array<double>").select("id", array_to_vector("x").alias("features"))
    names = [f"f{(7 * j) % 30}" for j in range(30)]
    coef, mean = [float(v) for v in rng.choice([-1, 1, 2], 30)], [0.0] * 30
    whole = X.linear_attributions(df, "id", "features", names, coef, mean)
    few = X.linear_attributions(df, "id", "features", names, coef, mean, largest=10)
    assert few.columns == whole.columns and few.count() == 400 and whole.count() == 1200

    def top(attr):
        return {r["id"]: [(t["feature"], str(t["shap_value"])) for t in r["top_risk_factors"]]
                for r in X.top_factors(attr, "id").collect()}

    def distinct(attr):      # the repeated key's equal factors may come in either order
        return {k: sorted(v, key=str) for k, v in top(attr).items()}

    assert distinct(few) == distinct(whole)
    assert {k: v for k, v in top(few).items() if k > 1} == {k: v for k, v in top(whole).items() if k > 1}
