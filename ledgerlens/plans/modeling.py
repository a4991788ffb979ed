"""Model queries (I1-I13, J1) on the cleaned applicant feature matrix.

The matrix (cleaned, encoded, inf -> median, scaled with train statistics,
assembled) is written once per session and scale factor to the checkpoint
folder; every model query reads it. Results are each model's K7 record on the
test split (property-checked: rows / ranges, not SQL).
"""

from __future__ import annotations

import random
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import functions as F

from ledgerlens.operators import balance as B
from ledgerlens.operators import histtrees as H
from ledgerlens.operators import metrics as M
from ledgerlens.operators import models as MO
from ledgerlens.operators import prep as PR
from ledgerlens.operators import split as SP
from ledgerlens.operators import stages as ST
from ledgerlens.plans import evaluation as EV
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.session import materialize
from ledgerlens.sources.tables import KEY, TARGET, read_table

_CACHE: dict = {}


def feature_matrix(spark, sf_dir):
    """(key, label, weight, split, fold, is_validation, features) and the feature names."""
    ck = (spark.sparkContext.applicationId, sf_dir)
    if ck in _CACHE:
        return _CACHE[ck]
    from ledgerlens.plans.cleaning import encoded
    df, _ = encoded(spark, sf_dir)
    names = [c for c in df.columns if c not in (KEY, TARGET, "split")]
    df = PR.inf_to_median(df, names)
    sp = PR.scale_params(df, names)
    df = PR.apply_scale(df, sp).withColumn(MO.LABEL, F.col(TARGET).cast("double"))
    train = df.where(F.col("split") == "train")
    folds = SP.kfold(train.select(KEY, TARGET), KEY, TARGET, 5).select(KEY, "fold")
    val = SP.tail_indicator(train.select(KEY), KEY, 0.15).select(KEY, "is_validation")
    df = df.join(folds, KEY, "left").join(val, KEY, "left")
    w = B.class_weights(train, TARGET).select(TARGET, F.col("class_weight").alias(MO.WEIGHT))
    df = df.join(F.broadcast(w), TARGET)  # one row per class
    out = materialize(MO.assemble(df, names).select(KEY, TARGET, MO.LABEL, MO.WEIGHT, "split", "fold",
                                                    "is_validation", MO.FEATURES))
    _CACHE[ck] = (out, names)
    return out, names


def fitted_lr(spark, sf_dir):
    """The balanced logistic regression (I1), fitted once per session and scale factor."""
    ck = ("lr", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        tr, _, _ = _split(spark, sf_dir)
        _CACHE[ck] = MO.logistic(_n_weight(tr)).fit(tr)
    return _CACHE[ck]


def fitted(spark, sf_dir, name, make, rows="train"):
    """Fit ``make()`` once per session / scale factor / name (queries share fits)."""
    ck = (name, spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        tr, _, _ = _split(spark, sf_dir)
        _CACHE[ck] = make().fit(tr)
    return _CACHE[ck]


def _split(spark, sf_dir):
    fm, names = feature_matrix(spark, sf_dir)
    return fm.where(F.col("split") == "train"), fm.where(F.col("split") == "test"), names


def parallelism(spark) -> int:
    return max(2, min(16, spark.sparkContext.defaultParallelism))


def together(spark, fits) -> list:
    """The results of independent fits, which run at the same time: one alone may keep few cores busy."""
    fits = list(fits)
    with ThreadPool(min(len(fits), parallelism(spark))) as pool:
        return pool.map(lambda fit: fit(), fits, chunksize=1)


def _record(scored, name):
    return round_doubles(M.eval_record(scored, "score", MO.LABEL, name))


def _n_weight(train):
    return train.agg(F.sum(MO.WEIGHT)).first()[0]


@query("cv_rules", sql=f"""WITH d AS (
  SELECT v.model, v.score, l.toxic AS label, CAST(l.doc_id % 6 AS INTEGER) AS fold FROM labels l JOIN documents d USING (doc_id),
  LATERAL (VALUES {', '.join(f"('{n}', {e})" for n, (_, e) in EV.SCORERS.items())}) v(model, score)),
g AS (SELECT model, fold, score, sum(label) AS pos, sum(1 - label) AS neg FROM d GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER (PARTITION BY model, fold ORDER BY score DESC) AS tp FROM g),
f AS (SELECT model, fold, sum(neg * (2 * tp - pos)) / nullif(2.0 * sum(pos) * sum(neg), 0) AS auc FROM c GROUP BY model, fold),
t AS (SELECT model, avg(auc) FILTER (WHERE fold < 5) AS cv_mean_auc, stddev_pop(auc) FILTER (WHERE fold < 5) AS cv_std,
             min(auc) FILTER (WHERE fold < 5) AS cv_min, max(auc) FILTER (WHERE fold < 5) AS cv_max,
             max(auc) FILTER (WHERE fold = 5) AS test_auc FROM f GROUP BY model)
SELECT model, {', '.join(f'{EV.R(c)} AS {c}' for c in ('cv_mean_auc', 'cv_std', 'cv_min', 'cv_max', 'test_auc'))},
       {EV.R('abs(cv_mean_auc - test_auc)')} AS overfit_gap,
       CASE WHEN abs(cv_mean_auc - test_auc) < 0.02 THEN '✅ Generalises' ELSE 'Possible overfit' END AS status FROM t""")
def q_cv_rules(spark, sf_dir):
    """I9's table for the scoring rules: AUC on five folds of the documents and on a sixth part as test."""
    from ledgerlens.operators import curves as C
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(lab, "doc_id")
    rules = F.array(*[F.struct(F.lit(n).alias("model"), rule().alias("score")) for n, (rule, _) in EV.SCORERS.items()])
    rows = docs.select((F.col("doc_id") % 6).cast("int").alias("fold"), "label", F.inline(rules))
    by = ("model", "fold")
    counts = materialize(C.score_counts(rows, by=by), "fold-counts")
    auc = C.areas(C.cumulative_counts(counts, by=by), by)
    return round_doubles(cv_table(auc.select(
        "model", F.when(F.col("fold") < 5, "fold").otherwise("test").alias("kind"), F.col("roc_auc").alias("auc"))))


@query("train_lr")
def q_train_lr(spark, sf_dir):
    """I1 + J1 + K7: balanced L2 logistic regression (C = 0.1)."""
    _, te, _ = _split(spark, sf_dir)
    return _record(MO.probability(fitted_lr(spark, sf_dir), te, [MO.LABEL]), "Logistic Regression")


def fitted_svm(spark, sf_dir) -> ST.CalibratedSVCModel:
    ck = ("svm", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        tr, _, _ = _split(spark, sf_dir)
        tr3 = SP.kfold(tr, KEY, TARGET, 3, col="fold3")
        _CACHE[ck] = ST.CalibratedSVC(_n_weight(tr), fold_col="fold3").fit(tr3)
    return _CACHE[ck]


@query("train_svm")
def q_train_svm(spark, sf_dir):
    """Linear SVM (C = 0.1) with 3-fold sigmoid calibration."""
    _, te, _ = _split(spark, sf_dir)
    return _record(fitted_svm(spark, sf_dir).transform(te).select(MO.LABEL, "score"), "SVM (Linear)")


@query("train_tree")
def q_train_tree(spark, sf_dir):
    """Decision tree, depth 10, 50 per leaf, balanced weights."""
    _, te, _ = _split(spark, sf_dir)
    return _record(MO.probability(fitted(spark, sf_dir, "tree", MO.tree), te, [MO.LABEL]), "Decision Tree")


@query("train_rf")
def q_train_rf(spark, sf_dir):
    """I4: random forest 200 x depth 12, 50 per leaf, sqrt features."""
    _, te, _ = _split(spark, sf_dir)
    return _record(MO.probability(fitted(spark, sf_dir, "rf", MO.forest), te, [MO.LABEL]), "Random Forest")


def fitted_ada(spark, sf_dir) -> ST.AdaBoostModel:
    ck = ("ada", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        _CACHE[ck] = ST.AdaBoostModel.of(H.train_stumps(binned_matrix(spark, sf_dir), ALL_TRAIN, 200, 0.1))
    return _CACHE[ck]


@query("train_ada")
def q_train_ada(spark, sf_dir):
    """AdaBoost (SAMME) of 200 stumps, learning rate 0.1."""
    _, te, _ = _split(spark, sf_dir)
    return _record(fitted_ada(spark, sf_dir).transform(te).select(MO.LABEL, "score"), "AdaBoost")


@query("train_gbt")
def q_train_gbt(spark, sf_dir):
    """Gradient boosting 200 x depth 5, lr 0.05, subsample 0.8, 50 per leaf."""
    _, te, _ = _split(spark, sf_dir)
    m = fitted(spark, sf_dir, "gbt", MO.boosted)
    return _record(MO.probability(m, te, [MO.LABEL]), "Gradient Boosting")


#: Groups of the binned rows: test rows, and training rows by 5-fold, 3-fold and validation slice.
TEST_GROUP = -1


def _group(fold: int, fold3: int, tail: int) -> int:
    return (fold * 3 + fold3) * 2 + tail


def groups_where(keep) -> frozenset:
    """Groups of training rows with ``keep(fold, fold3, tail)``."""
    return frozenset(_group(f, g, t) for f in range(5) for g in range(3) for t in range(2) if keep(f, g, t))


ALL_TRAIN = groups_where(lambda f, g, t: True)


def binned_matrix(spark, sf_dir) -> H.Binned:
    """The feature matrix as written blocks of bytes, once per session: every boosted fit below reads it.
    Bins come from training rows."""
    ck = ("binned", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        tr, te, _ = _split(spark, sf_dir)
        fold3 = SP.kfold(tr.select(KEY, TARGET), KEY, TARGET, 3, col="fold3").select(KEY, "fold3")
        keep = [KEY, MO.LABEL, MO.FEATURES]
        group = (F.col("fold") * 3 + F.col("fold3")) * 2 + F.col("is_validation").cast("int")
        rows = tr.join(fold3, KEY).select(*keep, group.alias("group")).union(
            te.select(*keep, F.lit(TEST_GROUP).alias("group")))
        _CACHE[ck] = H.binned(rows, MO.FEATURES, MO.LABEL, KEY, F.col("group"), H.bin_edges(tr, MO.FEATURES))
    return _CACHE[ck]


#: fixed values: the two boosted candidates. A is limited by depth, B by leaves and depth.
GBT_A = H.Params(rounds=300, rate=0.05, max_leaves=64, max_depth=6, min_leaf=1, min_hessian=1.0, l2=1.0,
                 rows=0.8, columns=0.8, balance="positive")
GBT_B = H.Params(rounds=500, rate=0.05, max_leaves=63, max_depth=7, min_leaf=20, rows=0.8, columns=0.8,
                 balance="balanced")
PATIENCE = 50   # fixed value


def early_fit() -> H.Fit:
    return H.Fit(replace(GBT_B, patience=PATIENCE), groups_where(lambda f, g, t: not t), groups_where(lambda f, g, t: t))


def fitted_early(spark, sf_dir) -> H.Boosted:
    """I8's model, fitted once per session and scale factor."""
    ck = ("leafwise", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        _CACHE[ck], = H.train(binned_matrix(spark, sf_dir), [early_fit()], parallelism(spark))
    return _CACHE[ck]


def _block_scores(table, models, names, groups):
    """(model, group, key, label, score) of the given rows."""
    return H.block_margins(table, models, names, groups).withColumn("score", 1 / (1 + F.exp(-F.col("margin"))))


def fitted_weighted(spark, sf_dir) -> H.Boosted:
    """I7's model, fitted once per session and scale factor."""
    ck = ("weighted", spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        fit = H.Fit(GBT_A, groups_where(lambda f, g, t: not t))
        _CACHE[ck], = H.train(binned_matrix(spark, sf_dir), [fit], parallelism(spark))
    return _CACHE[ck]


@query("train_gbt_weighted")
def q_train_gbt_weighted(spark, sf_dir):
    """Boosted trees 300 x depth 6, lr 0.05, row/column sampling 0.8, positive
    class weighted n0/n1, trained without the last 15 % (held out, as in the reference)."""
    scored = _block_scores(binned_matrix(spark, sf_dir), [fitted_weighted(spark, sf_dir)], ["m"], [{TEST_GROUP}])
    return _record(scored.withColumnRenamed("label", MO.LABEL), "GBT (positive weight)")


@query("train_gbt_early")
def q_train_gbt_early(spark, sf_dir):
    """I8: leaf-wise boosted trees, up to 500 x 63 leaves x depth 7, lr 0.05, row/column sampling 0.8, balanced
    class weights, stopped at the best round of the tail 15 % validation slice (patience 50)."""
    table = binned_matrix(spark, sf_dir)
    scored = _block_scores(table, [fitted_early(spark, sf_dir)], ["m"], [{TEST_GROUP}])
    return _record(scored.withColumnRenamed("label", MO.LABEL), "GBT (early stop)")


@query("leafwise_trees")
def q_leafwise_trees(spark, sf_dir):
    """I8: the fitted trees: leaves, depth, gain and training rows of each round, and the loss on the watched rows."""
    m = fitted_early(spark, sf_dir)
    rows = [(k + 1, int((t.feature < 0).sum()), int(t.depth), float(t.gain.sum()), int(t.rows[0]), float(loss))
            for k, (t, loss) in enumerate(zip(m.trees, m.losses))]
    return round_doubles(spark.createDataFrame(
        rows, "round int, leaves int, depth int, gain double, n_rows long, validation_loss double"), 6)


GAP_OK, GAP_TEXTS = 0.02, ("✅ Generalises", "Possible overfit")  # fixed values


def cv_table(folds):
    """I9 from (model, kind 'fold' or 'test', auc): mean, population std, range, gap, status."""
    cv = F.when(F.col("kind") == "fold", F.col("auc"))
    g = folds.groupBy("model").agg(
        F.avg(cv).alias("cv_mean_auc"), F.stddev_pop(cv).alias("cv_std"), F.min(cv).alias("cv_min"),
        F.max(cv).alias("cv_max"), F.max(F.when(F.col("kind") == "test", F.col("auc"))).alias("test_auc"))
    gap = F.abs(F.col("cv_mean_auc") - F.col("test_auc"))
    return g.select("*", gap.alias("overfit_gap"),
                    F.when(gap < GAP_OK, GAP_TEXTS[0]).otherwise(GAP_TEXTS[1]).alias("status"))


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    """5-fold stratified CV ROC-AUC of three candidates vs their test ROC-AUC. The ten boosted fold
    models, and the two that the test rows are scored with, are trained together on the binned blocks."""
    from ledgerlens.operators import curves as C
    table = binned_matrix(spark, sf_dir)
    tr, te, _ = _split(spark, sf_dir)
    fits, names, held = [], [], []
    for name, p in (("GBT (early stop)", GBT_B), ("GBT (positive weight)", GBT_A)):
        for k in range(5):
            fits.append(H.Fit(p, groups_where(lambda f, g, t, k=k: f != k)))
            names.append(f"{name}|fold")
            held.append(groups_where(lambda f, g, t, k=k: f == k))
        # the models that are evaluated on the test rows learn without the validation slice
        early = name == "GBT (early stop)"
        fits.append(early_fit() if early else H.Fit(p, groups_where(lambda f, g, t: not t)))
        names.append(f"{name}|test")
        held.append({TEST_GROUP})
    models = H.train(table, fits, parallelism(spark))
    at = F.split("model", r"\|")
    boosted = _block_scores(table, models, names, held).select(
        at[0].alias("model"), F.concat_ws("-", at[1], F.when(at[1] == "fold", F.floor(F.col("group") / 6))).alias("part"),
        "label", "score")

    def forest(k):
        fit_rows, rest = (tr, te) if k is None else (tr.where(F.col("fold") != k), tr.where(F.col("fold") == k))
        return MO.probability(MO.forest().fit(fit_rows), rest, [MO.LABEL]).select(
            F.lit("Random Forest").alias("model"), F.lit("test" if k is None else f"fold-{k}").alias("part"),
            F.col(MO.LABEL).cast("int").alias("label"), "score")

    with ThreadPool(parallelism(spark)) as pool:      # fits wait on the scheduler more than they compute
        rows = boosted
        for scored in pool.map(forest, (*range(5), None)):
            rows = rows.union(scored)
    by = ("model", "part")
    counts = materialize(C.score_counts(rows, by=by), "fold-counts")
    auc = C.areas(C.cumulative_counts(counts, by=by), by)
    return round_doubles(cv_table(auc.select(
        "model", F.element_at(F.split("part", "-"), 1).alias("kind"), F.col("roc_auc").alias("auc"))))


SEARCHES = {
    "search_rf": ("Random Forest (Tuned)", lambda: MO.forest(n_trees=50), 10,
                  {"maxDepth": (5, 12, "int"), "minInstancesPerNode": (20, 100, "int"),
                   "featureSubsetStrategy": ["sqrt", "log2", "0.3"]}, {"numTrees": 250}),
}


def fitted_forest_search(spark, sf_dir, key: str):
    """The best draw refitted with its full number of trees, once per session and scale factor."""
    ck = (key, spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        _, make, n_iter, space, refit = SEARCHES[key]
        tr, _, _ = _split(spark, sf_dir)
        tr3 = SP.kfold(tr.drop("fold"), KEY, TARGET, 3, col="fold")
        cvm = MO.random_search(make(), space, n_iter, MO.few_parts(tr3, tr.count()), "fold", parallelism(spark))
        best = cvm.bestModel
        est = make()
        chosen = {est.getParam(p.name): v for p, v in best.extractParamMap().items() if p.name in space}
        chosen.update({est.getParam(k): v for k, v in refit.items()})
        _CACHE[ck] = est.copy(chosen).fit(tr)
    return _CACHE[ck]


def _search_query(key):
    label, _, n_iter, _, _ = SEARCHES[key]

    def run(spark, sf_dir):
        _, te, _ = _split(spark, sf_dir)
        return _record(MO.probability(fitted_forest_search(spark, sf_dir, key), te, [MO.LABEL]), label)
    run.__name__ = f"q_{key}"
    run.__doc__ = f"I10-I12: random search ({n_iter} draws, 3-fold CV on ROC-AUC), refit of the best."
    return run


query("search_rf")(_search_query("search_rf"))

#: fixed values: (base of the draws, ranges, rounds of the refit). Ranges are (low, width) of a uniform draw
#: or (low, high) of a whole number below high.
BOOSTED_SEARCHES = {
    "search_gbt_a": ("GBT A (Tuned)", replace(GBT_A, rounds=50, rows=1.0, columns=1.0),
                     {"rate": (0.01, 0.1), "max_depth": (4, 9), "rows": (0.6, 0.35), "columns": (0.6, 0.35),
                      "min_hessian": (5, 30), "min_gain": (0.0, 0.5)}, 400),
    "search_gbt_b": ("GBT B (Tuned)", replace(GBT_B, rounds=50, max_depth=0),
                     {"rate": (0.01, 0.1), "max_depth": (4, 10), "max_leaves": (31, 127), "rows": (0.6, 0.35),
                      "columns": (0.6, 0.35), "min_leaf": (20, 100)}, 500),
}
DRAWS = 20   # fixed value


def drawn_params(key: str) -> list[H.Params]:
    _, base, space, _ = BOOSTED_SEARCHES[key]
    rng, out = random.Random(MO.SEED), []
    for _ in range(DRAWS):
        draw = {n: rng.randrange(lo, hi) if isinstance(hi, int) else rng.uniform(lo, lo + hi) for n, (lo, hi) in space.items()}
        if "max_leaves" not in draw:
            draw["max_leaves"] = 1 << draw["max_depth"]        # depth alone limits such a tree
        out.append(replace(base, **draw))
    return out


def searched(spark, sf_dir, key: str):
    """Mean 3-fold ROC-AUC of every draw, from one training of all draws and folds: (draw, auc)."""
    from ledgerlens.operators import curves as C
    table, draws = binned_matrix(spark, sf_dir), drawn_params(key)
    fits = [H.Fit(p, groups_where(lambda f, g, t, k=k: g != k)) for p in draws for k in range(3)]
    names = [f"{d}" for d in range(DRAWS) for _ in range(3)]
    held = [groups_where(lambda f, g, t, k=k: g == k) for _ in draws for k in range(3)]
    scored = _block_scores(table, H.train(table, fits, parallelism(spark)), names, held).select(
        "model", F.pmod(F.floor(F.col("group") / 2), F.lit(3)).alias("part"), "label", "score")
    by = ("model", "part")
    counts = materialize(C.score_counts(scored, by=by), "draw-counts")
    auc = C.areas(C.cumulative_counts(counts, by=by), by)
    return auc.groupBy(F.col("model").cast("int").alias("draw")).agg(F.avg("roc_auc").alias("auc"))


def fitted_search(spark, sf_dir, key: str) -> tuple[H.Boosted, list]:
    """The best draw refitted on all training rows with its full number of rounds, and all draws' means."""
    ck = (key, spark.sparkContext.applicationId, sf_dir)
    if ck not in _CACHE:
        means = sorted(searched(spark, sf_dir, key).collect(), key=lambda r: (-r["auc"], r["draw"]))
        best = replace(drawn_params(key)[means[0]["draw"]], rounds=BOOSTED_SEARCHES[key][3])
        model, = H.train(binned_matrix(spark, sf_dir), [H.Fit(best, ALL_TRAIN)], parallelism(spark))
        _CACHE[ck] = model, means
    return _CACHE[ck]


def _boosted_search(key):
    def run(spark, sf_dir):
        model, _ = fitted_search(spark, sf_dir, key)
        scored = _block_scores(binned_matrix(spark, sf_dir), [model], ["m"], [{TEST_GROUP}])
        return _record(scored.withColumnRenamed("label", MO.LABEL), BOOSTED_SEARCHES[key][0])
    run.__name__ = f"q_{key}"
    run.__doc__ = f"I11 / I12: random search ({DRAWS} draws, 3-fold CV on ROC-AUC), refit of the best."
    return run


for _key in BOOSTED_SEARCHES:
    query(_key)(_boosted_search(_key))


@query("search_draws")
def q_search_draws(spark, sf_dir):
    """Every draw's parameters and mean 3-fold ROC-AUC, best first."""
    binned_matrix(spark, sf_dir)                           # the searches share it
    found = together(spark, (lambda key=key: fitted_search(spark, sf_dir, key)[1] for key in BOOSTED_SEARCHES))
    rows = []
    for key, means in zip(BOOSTED_SEARCHES, found):
        draws = drawn_params(key)
        for place, r in enumerate(means):
            p = draws[r["draw"]]
            rows.append((key, place + 1, r["draw"], p.rate, p.max_depth, p.max_leaves, p.rows, p.columns, p.min_leaf,
                         float(p.min_hessian), p.min_gain, r["auc"]))
    return round_doubles(spark.createDataFrame(
        rows, "search string, place int, draw int, rate double, max_depth int, max_leaves int, row_share double, "
              "column_share double, min_leaf int, min_hessian double, min_gain double, cv_mean_auc double"), 6)


#: fixed values: whose importances are shown, the first that was fitted
IMPORTANCE_ORDER = ["GBT B (Tuned)", "GBT A (Tuned)", "GBT (early stop)", "GBT (positive weight)",
                    "Random Forest (Tuned)", "Random Forest", "Gradient Boosting"]


def first_available(models: dict):
    """(name, model) of the first fitted model in the stated order, or None."""
    return next(((n, models[n]) for n in IMPORTANCE_ORDER if n in models), None)


def importance_sources(spark, sf_dir) -> dict:
    """How each of the models gives its importances: splits for B, gain for A, Spark's own for the others."""
    spark_ml = {"Random Forest": ("rf", MO.forest), "Gradient Boosting": ("gbt", MO.boosted)}
    return {
        "GBT B (Tuned)": lambda: fitted_search(spark, sf_dir, "search_gbt_b")[0].splits(),
        "GBT A (Tuned)": lambda: fitted_search(spark, sf_dir, "search_gbt_a")[0].gains(),
        "GBT (early stop)": lambda: fitted_early(spark, sf_dir).splits(),
        "GBT (positive weight)": lambda: fitted_weighted(spark, sf_dir).gains(),
        "Random Forest (Tuned)": lambda: fitted_forest_search(spark, sf_dir, "search_rf").featureImportances.toArray(),
        **{n: lambda k=k, make=make: fitted(spark, sf_dir, k, make).featureImportances.toArray()
           for n, (k, make) in spark_ml.items()},
    }


def ranked_importance(spark, sf_dir):
    _, _, names = _split(spark, sf_dir)
    _, values = first_available(importance_sources(spark, sf_dir))
    return MO.importances(values(), names).orderBy(F.desc("importance"), "feature")


def ranked_features(spark, sf_dir, n: int | None = None) -> list[str]:
    """Feature names by falling importance (as many as the matrix is wide)."""
    rows = ranked_importance(spark, sf_dir)
    return [r["feature"] for r in (rows.limit(n) if n else rows).collect()]


@query("importance")
def q_importance(spark, sf_dir):
    """Feature importances of the first fitted model in the stated order, top 20."""
    return ranked_importance(spark, sf_dir).limit(20)


@query("importance_all")
def q_importance_all(spark, sf_dir):
    """The three most important features of every model in that order, with the model's place."""
    _, _, names = _split(spark, sf_dir)
    sources = importance_sources(spark, sf_dir)
    binned_matrix(spark, sf_dir).rdd()                     # the boosted fits share it
    shown = [n for n in IMPORTANCE_ORDER if n in sources]
    rows = []
    for place, (name, values) in enumerate(zip(shown, together(spark, (sources[n] for n in shown)))):
        top = sorted(zip(map(float, values), names), key=lambda r: (-r[0], r[1]))[:3]
        rows += [(name, place + 1, k + 1, f, v) for k, (v, f) in enumerate(top)]
    return round_doubles(spark.createDataFrame(
        rows, "model string, place int, rank int, feature string, importance double"), 6)
