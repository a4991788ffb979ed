"""Fitted stages and models: saved, loaded in a session of their own, and equal scores."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from ledgerlens.operators import histtrees as H
from ledgerlens.operators import models as MO
from ledgerlens.operators import stages as ST
from tests.test_histtrees import data, frame


@pytest.fixture(scope="module")
def learned(spark):
    x, y = data(400, 13, values=9)
    x[:, 4] = np.round(x[:, 4])
    df = frame(spark, x, y, np.zeros(400)).withColumn("label", F.col("label").cast("double")).withColumn(
        "weight", F.lit(1.0)).withColumn("fold", (F.col("id") % 3).cast("int")).cache()
    return df, H.binned(df, "features", "label", "id", F.col("grp"))


def again(spark, model, cls, folder):
    """The model as another session reads it."""
    path = f"file://{folder}/m"
    model.write().overwrite().save(path)
    spark.newSession()
    return cls.load(path)


def same(a, b, df):
    one = {r["id"]: r["score"] for r in a.transform(df).select("id", "score").collect()}
    two = {r["id"]: r["score"] for r in b.transform(df).select("id", "score").collect()}
    assert one == two and len(one) > 0
    return one


def boosted_by_trees(df, rounds, rate):
    """SAMME with a Spark tree of depth 1 and an aggregate of its error in each round."""
    n = df.count()
    cur = df.select("id", MO.FEATURES, MO.LABEL).withColumn("w", F.lit(1.0 / n)).cache()
    out = []
    for _ in range(rounds):
        stump = DecisionTreeClassifier(featuresCol=MO.FEATURES, labelCol=MO.LABEL, weightCol="w", maxDepth=1).fit(cur)
        miss = MO.stump_expr(stump) != F.col(MO.LABEL)
        s = cur.agg(F.sum(F.when(miss, F.col("w")).otherwise(0.0)).alias("e"), F.sum("w").alias("t")).first()
        alpha = rate * math.log((s["t"] - s["e"]) / s["e"])
        root = stump._java_obj.rootNode()
        # Spark prunes a split whose sides predict the same
        split = root.split() if root.getClass().getSimpleName() == "InternalNode" else None
        out.append((split.featureIndex(), split.threshold(), alpha) if split else (None, root.prediction(), alpha))
        cur = cur.withColumn("w", F.when(miss, F.col("w") * math.exp(alpha)).otherwise(F.col("w")))
    return out


@pytest.mark.parametrize("blocks", [False, True])
def test_stumps_equal_fitted_trees(spark, learned, monkeypatch, blocks):
    df, table = learned
    if blocks:
        monkeypatch.setattr(H, "TASK_ROWS", 100)
        table = H.binned(df, "features", "label", "id", F.col("grp"))
        assert table.rdd().getNumPartitions() > 1
    found = H.train_stumps(table, frozenset({0}), 8, 0.5)
    assert len(found) == 8
    for s, (f, t, alpha) in zip(found, boosted_by_trees(df, 8, 0.5)):
        assert s.weight == pytest.approx(alpha)
        if f is None:
            assert s.left == s.right == t
        else:
            assert (s.feature, s.threshold) == (f, pytest.approx(t))


def test_models_survive_saving(spark, learned, tmp_path):
    df, table = learned
    ada = ST.AdaBoostModel.of(H.train_stumps(table, frozenset({0}), 20, 0.3))
    scores = same(ada, again(spark, ada, ST.AdaBoostModel, tmp_path / "ada"), df)
    labels = {r["id"]: r["label"] for r in df.collect()}
    assert np.mean([(s > 0.5) == labels[i] for i, s in scores.items()]) > 0.65
    svm = ST.CalibratedSVC(400.0).fit(df)
    same(svm, again(spark, svm, ST.CalibratedSVCModel, tmp_path / "svm"), df)
    boosted, = H.train(table, [H.Fit(H.Params(rounds=5, min_leaf=5, rate=0.3), frozenset({0}))])
    model = ST.BoostedModel.of(boosted)
    scores = same(model, again(spark, model, ST.BoostedModel, tmp_path / "gbt"), df)
    for r in H.block_margins(table, [boosted], ["m"]).collect():
        assert scores[r["key"]] == pytest.approx(1 / (1 + math.exp(-r["margin"])))


def test_pipeline_from_raw_rows_survives_saving(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.random() < 0.4), ["x", "y", None, "z"][i % 4], f"c{i % 13}" if i % 11 else None,
             float(rng.lognormal(0, 2)), None if i % 9 == 0 else float(rng.normal()),
             math.inf if i % 50 == 0 else float(i), 7.0) for i in range(200)]
    schema = "id long, target int, seg string, town string, amount double, score_1 double, wide double, fixed double"
    raw = spark.createDataFrame(rows, schema)
    keep = ["id", "target"]
    fitted = Pipeline(stages=[
        ST.Cleaning(keep, ["seg", "town"], ["amount"]), ST.OneHot("seg"), ST.Labels("town"), ST.Scaling(keep),
        ST.Assembling(keep), LogisticRegression(featuresCol="features", labelCol="target", regParam=0.1)]).fit(raw)
    path = f"file://{tmp_path}/pipeline"
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    # unseen categories, a missing number, an infinite one
    odd = spark.createDataFrame([(900, 0, "new", "nowhere", 1.0, None, -math.inf, 7.0), (901, 1, None, None, 2.0, 0.5, 3.0, None)], schema)
    for df in (raw, odd):
        a = {r["id"]: r["probability"] for r in fitted.transform(df).collect()}
        b = {r["id"]: r["probability"] for r in loaded.transform(df).collect()}
        assert a == b and not any(math.isnan(v) for p in b.values() for v in p)
    stages = loaded.stages
    assert stages[0].own["drop"] == ["fixed"] and "Missing" not in stages[1].own["values"]
    encoded = stages[2].transform(stages[1].transform(stages[0].transform(odd))).collect()
    assert encoded[0]["seg_x"] == encoded[0]["seg_y"] == encoded[0]["seg_z"] == 0
    assert sorted(r["town"] for r in encoded)[-1] == 14       # 13 towns and the word for missing


def test_too_many_values_for_one_hot(spark):
    df = spark.createDataFrame([(f"v{i}",) for i in range(10)], "c string")
    with pytest.raises(ValueError):
        ST.OneHot("c").fit(df)
