"""Property tests for the operators without an SQL oracle (SURVEY 5 (3))."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlens.operators import explain as X
from ledgerlens.operators import knn as K


def _points(spark, n=400, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 3, (5, dim))
    lab = rng.integers(0, 5, n)
    x = centers[lab] + rng.normal(0, 1, (n, dim))
    rows = [(int(i), [float(v) for v in x[i]], int(lab[i] == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, vec array<double>, y int"), x, (lab == 0).astype(int)


def test_knn_is_exact(spark):
    df, x, _ = _points(spark)
    got = {}
    for r in K.knn(df, df, 4, block=90).collect():
        got.setdefault(r.q_id, []).append((r.nn_rank, r.nn_id))
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        want = list(np.lexsort((np.arange(len(x)), d[i]))[:4])
        assert [nid for _, nid in sorted(got[i])] == want


def test_smote_points_lie_between_neighbours(spark):
    df, x, y = _points(spark)
    out = K.smote(df, "y", 1, k=5).collect()
    n_min = int(y.sum())
    assert len(out) == (len(y) - n_min) - n_min
    for r in out:
        b, nb, new = x[r.base_id], x[r.nn_id], np.array(r.vec)
        assert 0.0 <= r.gap < 1.0
        assert np.allclose(new, b + r.gap * (nb - b))
        assert y[r.base_id] == 1 and y[r.nn_id] == 1


def test_enn_all_rule(spark):
    df, x, y = _points(spark)
    kept = {r.id for r in K.enn(df, "y", k=3, keep_class=1).collect()}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        nn = np.lexsort((np.arange(len(x)), d[i]))[:3]
        drop = y[i] != 1 and any(y[j] != y[i] for j in nn)
        assert (i not in kept) == drop


def _frame(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.5, n) > 0).astype(float)
    return spark.createDataFrame([(int(i), Vectors.dense(x[i].tolist()), float(y[i])) for i in range(n)],
                                 ["id", "features", "label"]), x


def test_permutation_attributions_sum_to_prediction_gap(spark):
    df, x = _frame(spark)
    m = DecisionTreeClassifier(maxDepth=3, seed=1).fit(df)
    bg = x.mean(axis=0).tolist()
    names = ["a", "b", "c", "d"]
    attr = X.permutation_attributions(m, df.limit(40), "id", "features", names, bg, orders=3)
    sums = {r.id: r.s for r in attr.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    p = {r.id: r.p for r in m.transform(df.limit(40)).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    bgdf = spark.createDataFrame([(0, Vectors.dense(bg))], ["id", "features"])
    pb = m.transform(bgdf).select(vector_to_array("probability")[1]).first()[0]
    for k, s in sums.items():
        assert s == pytest.approx(p[k] - pb, abs=1e-9)


def test_permutation_attributions_of_repeated_and_null_keys(spark, monkeypatch):
    """Each row has its own values, also if its key comes twice or is null, and whatever the batches."""
    monkeypatch.setattr(X, "STEP_VALUES", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df, x = _frame(spark)
        m = DecisionTreeClassifier(maxDepth=3, seed=1).fit(df)
        bg = x.mean(axis=0).tolist()
        some = [(1, Vectors.dense(x[0])), (1, Vectors.dense(x[0])), (None, Vectors.dense(x[1]))]
        rows = spark.createDataFrame(some, ["id", "features"]).coalesce(1)
        got = X.permutation_attributions(m, rows, "id", "features", ["a", "b", "c", "d"], bg, orders=3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 12
    score = {tuple(r.features): r.p for r in m.transform(rows.union(spark.createDataFrame([(9, Vectors.dense(bg))], ["id", "features"])))
             .select("features", vector_to_array("probability")[1].alias("p")).collect()}
    for k, n in ((1, 2), (None, 1)):
        want = score[tuple(x[0 if k else 1])] - score[tuple(bg)]
        assert sum(r.attribution for r in got if r.id == k) == pytest.approx(n * want, abs=1e-9)
        assert {(r.feature, r.input_value) for r in got if r.id == k} == set(zip("abcd", x[0 if k else 1]))


def test_shap_perm_explains_every_test_row(spark, monkeypatch):
    from ledgerlens.plans import modeling as MD
    from ledgerlens.plans import scoring as SC
    rows = [(i, float(i % 3 == 0), 1.0, Vectors.dense([i % 7, i % 3])) for i in range(2100)]
    fm = spark.createDataFrame(rows, [SC.KEY, "label", "weight", "features"])
    monkeypatch.setattr(SC, "_split", lambda *_: (fm, fm, ["a", "b"]))
    monkeypatch.setattr(MD, "fitted", lambda *_: DecisionTreeClassifier(maxDepth=2).fit(fm))
    got = SC.q_shap_perm(spark, "").groupBy(SC.KEY).count().collect()
    assert len(got) == 2100 and all(r["count"] == 2 for r in got)


def test_linear_attributions_reconstruct_margin(spark):
    df, x = _frame(spark)
    m = LogisticRegression(regParam=0.01).fit(df)
    coef, mean = m.coefficients.toArray().tolist(), x.mean(axis=0).tolist()
    attr = X.linear_attributions(df, "id", "features", ["a", "b", "c", "d"], coef, mean)
    sums = {r.id: r.s for r in attr.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    margin = x @ np.array(coef) - np.dot(coef, mean)
    for k, s in sums.items():
        assert s == pytest.approx(margin[k], abs=1e-9)


def test_rule_score_truncates_and_clips(spark):
    df = spark.createDataFrame([(150000.0, 55000.0, 680.0), (1.0, 1e9, 850.0), (1e9, 1.0, 300.0)],
                               "loan double, income double, credit double")
    got = [r.s for r in df.select(X.rule_score(F.col("loan"), F.col("income"), F.col("credit")).alias("s")).collect()]
    assert got == [min(100, max(0, int(150000 / 55001 * 100 - 40))), 0, 100]


def test_stump_expression_equals_model(spark):
    from ledgerlens.operators.models import stump_expr
    df, _ = _frame(spark)
    m = DecisionTreeClassifier(maxDepth=1, seed=1).fit(df)
    a = [r.p for r in m.transform(df).select("prediction").withColumnRenamed("prediction", "p").collect()]
    b = [r.p for r in df.select(stump_expr(m).alias("p")).collect()]
    assert a == b


def test_best_round_waits_for_its_patience():
    from ledgerlens.operators.models import best_round
    assert best_round([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert best_round([3.0, 2.0, 2.5, 2.4, 1.0], patience=3) == 5
    assert best_round([1.0]) == 1 and best_round([2.0, 1.0, 1.0], patience=50) == 2


def test_early_stop_equals_the_full_fit(spark):
    from ledgerlens.operators import models as MO
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + rng.normal(0, 1.5, 400) > 0).astype(float)
    df = spark.createDataFrame([(int(i), Vectors.dense(x[i].tolist()), float(y[i]), 1.0) for i in range(400)],
                               ["id", "features", "label", "weight"])
    train, val = df.where("id < 300"), df.where("id >= 300")
    est = MO.boosted(24, 0.3, 3, 0.8, 1, "0.8", weighted=True)
    full = est.fit(train)
    losses = list(full.evaluateEachIteration(val))
    got = MO.early_stopped(est, train, val, patience=4)
    best = MO.best_round(losses, 4)
    assert got.getNumTrees == best
    assert list(got.evaluateEachIteration(val)) == pytest.approx(losses[:best])
    assert MO.probability(got, val, ["id"]).count() == 100


def test_smote_with_few_neighbours_keeps_every_sample(spark):
    rows = [(i, [float(i), 0.0], int(i < 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, y int")
    assert K.smote(df, "y", 1, k=5).count() == 32
    with pytest.raises(ValueError):
        K.smote(df.where("id = 0 or y = 0"), "y", 1)


def test_knn_skips_points_without_a_distance(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got = sorted((r.q_id, r.nn_rank, r.nn_id, r.distance) for r in K.knn(df, df, 2).collect())
    assert got == [(1, 1, 6, 0.0), (1, 2, 2, 1.0), (2, 1, 1, 1.0), (2, 2, 6, 1.0), (6, 1, 1, 0.0), (6, 2, 2, 1.0)]


def test_streams_never_return_part_of_their_input(spark, tmp_path):
    from ledgerlens.streaming.scoring import score_stream
    src = str(tmp_path / "in")
    spark.range(0, 400, 1, 20).selectExpr("id", "id * 2.0 as v").write.parquet(src)
    schema = spark.read.parquet(src).schema
    run = lambda n, **kw: score_stream(spark, src, schema, lambda d: d, str(tmp_path / f"out{n}"),
                                       str(tmp_path / f"ck{n}"), **kw)
    assert run(1, files_per_trigger=4).count() == 400
    with pytest.raises(TimeoutError):
        run(2, files_per_trigger=1, timeout_s=1)


def test_stream_counts_drop_only_late_rows(spark, tmp_path):
    import datetime as dt
    from ledgerlens.streaming.drift import windowed_bin_counts
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    src = str(tmp_path / "ev")
    # the last is late; the watermark that drops it is the one of the batch before the last
    files = [[(day(1), 0.5), (day(2), 1.5)], [(day(20), 0.5)], [(day(21), 1.5)], [(day(2), 0.5)]]
    for rows in files:
        spark.createDataFrame(rows, "ts timestamp, value double").coalesce(1).write.mode("append").parquet(src)
        import time
        time.sleep(1.1)                     # files are read in the order of their times
    edges = spark.createDataFrame([([0.0, 1.0, 2.0],)], "edges array<double>")
    schema = spark.read.parquet(src).schema
    out = windowed_bin_counts(spark, src, "*.parquet", schema, edges, str(tmp_path / "sink"), str(tmp_path / "ck"))
    got = sorted((r.window_start.day, r.bin, r.n) for r in out.collect())
    assert sum(n for _, _, n in got) == 4 and all(n == 1 for _, _, n in got)


def test_constant_columns_and_tiny_inputs(spark):
    from ledgerlens.operators import profile as P
    from ledgerlens.operators import split as SP
    df = spark.createDataFrame([(i, 3.0, "g") for i in range(5)], "id long, v double, g string")
    h = P.density_histogram(df, "v", 4).orderBy("bin").collect()
    want, edges = np.histogram([3.0] * 5, 4, density=True)
    assert [r.density for r in h] == pytest.approx(want.tolist()) and h[0].bin_lo == edges[0]
    assert sum(r["count"] for r in P.grouped_histogram(df, "v", "g", 4).collect()) == 5
    assert P.kde_curve(df, "v", 50).count() == 0
    assert SP.position_windows(df.limit(3), "id", 4).count() == 0


def test_sorted_labels_number_all_values(spark):
    from ledgerlens.operators import prep as PR
    names = [f"n{(i * 7919) % 3001:05d}" for i in range(6000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = {r.label: r.idx for r in PR.sorted_labels(df, "name").collect()}
    assert got == {n: i for i, n in enumerate(sorted({n for n in names if n}))}
    enc = PR.label_encode(df, "name").where("name = 3001").count()
    assert enc == 1


def test_a_vector_is_shuffled_once_for_each_lot():
    """Lots are as many as the cores need until they are full: twice the rows are twice the shuffle, not four times."""
    for rows in (30_000, 60_000, 120_000, 240_000):
        assert K.lots(rows, K.BLOCK, 12) == 10
    assert K.lots(0, K.BLOCK, 12) == K.lots(2000, K.BLOCK, 12) == 1 and K.lots(5000, K.BLOCK, 12) == 3
    assert K.lots(6 * 120_000, K.BLOCK, 12) == 11 and K.lots(10 * K.LOT * 7, K.BLOCK, 12) == 70


def test_blocks_of_a_lot_give_the_nearest_of_all():
    rng = np.random.default_rng(5)
    q, p = rng.integers(0, 3, (40, 4)).astype(float), rng.integers(0, 3, (70, 4)).astype(float)     # many ties
    q_id, p_id = rng.permutation(40), rng.permutation(70)
    far = np.sqrt(((q[:, None] - p[None]) ** 2).sum(2))
    want = [(q_id[i], p_id[j], far[i, j]) for i in np.argsort(q_id)
            for j in [j for j in np.lexsort((p_id, far[i])) if p_id[j] != q_id[i]][:5]]
    for block in (7, 33, 1000):
        got = K.nearest_by_blocks(q_id, q, p_id, p, 5, block)
        assert sorted(zip(*(c.tolist() for c in got))) == sorted((int(a), int(b), float(d)) for a, b, d in want)
