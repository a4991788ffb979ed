"""Model training, tuning and scoring on Spark ML.

The solvers are Spark ML's distributed estimators; the reference's settings are
mapped onto them (sklearn ``C`` -> ``regParam = 1 / (C * sum(w))``, balanced
class weights -> ``weightCol``, ``min_samples_leaf`` -> ``minInstancesPerNode``,
``subsample`` -> ``subsamplingRate``, ``colsample`` -> ``featureSubsetStrategy``).
"""

from __future__ import annotations

import random

from pyspark import SparkContext
from pyspark.ml import Model
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier,
                                       LinearSVC, LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42  # fixed value
LABEL, FEATURES, WEIGHT = "label", "features", "weight"


def assemble(df: DataFrame, cols: list[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


# --------------------------------------------------------------------------- estimators

def logistic(n_weight: float, C: float = 0.1, max_iter: int = 1000) -> LogisticRegression:
    """L2 logistic regression, balanced weights."""
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT,
                              regParam=1.0 / (C * n_weight), elasticNetParam=0.0,
                              maxIter=max_iter, standardization=False, tol=1e-4)


def tree(max_depth: int = 10, min_leaf: int = 50) -> DecisionTreeClassifier:
    """I3."""
    return DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT,
                                  maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=SEED)


def forest(n_trees: int = 200, max_depth: int = 12, min_leaf: int = 50,
           max_features: str = "sqrt") -> RandomForestClassifier:
    """I4. Each row's node in each tree is kept from level to level, instead of walked to anew; the model
    is the same."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT,
                                  numTrees=n_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                  featureSubsetStrategy=max_features, cacheNodeIds=True, seed=SEED)


#: Rows of a partition of a forest's training rows, and rows up to which partitions stay as they are.
FOREST_ROWS, FOREST_SMALL = 24_576, 32_768


def few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of so many rows, for forests that are fitted at the same time: the fits keep the cores busy, so a
    partition need not be small, and every partition sums up and shuffles each node of each tree anew."""
    return df if rows <= FOREST_SMALL else df.coalesce(-(-rows // FOREST_ROWS))


def boosted(n_iter: int = 200, lr: float = 0.05, max_depth: int = 5, subsample: float = 0.8,
            min_leaf: int = 50, colsample: str = "all", weighted: bool = False) -> GBTClassifier:
    """Gradient-boosted trees (``weighted``: by the weight column)."""
    kw = dict(featuresCol=FEATURES, labelCol=LABEL, maxIter=n_iter, stepSize=lr, maxDepth=max_depth,
              subsamplingRate=subsample, minInstancesPerNode=min_leaf, featureSubsetStrategy=colsample,
              seed=SEED)
    if weighted:
        kw["weightCol"] = WEIGHT
    return GBTClassifier(**kw)


PATIENCE = 50  # fixed value: rounds without a better validation loss before stopping


def best_round(losses: list[float], patience: int = PATIENCE) -> int:
    """1-based round with the least loss before ``patience`` rounds pass without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` boosting rounds."""
    sc, whole = SparkContext.getOrCreate(), model._java_obj
    jvm, gateway = sc._jvm, sc._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = whole.trees()[i], whole.treeWeights()[i]
    part = jvm.org.apache.spark.ml.classification.GBTClassificationModel(whole.uid(), trees, weights)
    return GBTClassificationModel(part.copy(whole.extractParamMap()))


def early_stopped(est: GBTClassifier, train: DataFrame, validation: DataFrame,
                  patience: int = PATIENCE) -> GBTClassificationModel:
    """I8: boosting that stops ``patience`` rounds after the best one, by the model's own loss on the
    validation slice (all prefixes in one pass), and keeps the rounds up to the best.

    A round depends on the seed and the rounds before it, not on how many follow, so the fit
    starts with twice the patience and doubles its rounds until the stop lies within them."""
    whole = est.getMaxIter()
    rounds = min(whole, 2 * patience)
    while True:
        model = est.copy({est.maxIter: rounds}).fit(train)
        best = best_round(list(model.evaluateEachIteration(validation)), patience)
        if rounds >= whole or best + patience <= rounds:
            return first_trees(model, best)
        rounds = min(whole, 2 * rounds)


def positive_weight(df: DataFrame, label: str = LABEL, col: str = WEIGHT) -> DataFrame:
    """H2: weight n0/n1 on positives, 1 on negatives (``scale_pos_weight``)."""
    r = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    return df.crossJoin(F.broadcast(r)).withColumn(  # one-row side
        col, F.when(F.col(label) == 1, F.col("n0") / F.col("n1")).otherwise(F.lit(1.0))).drop("n0", "n1")


# --------------------------------------------------------------------------- scoring

def probability(model: Model, df: DataFrame, keep: list[str], out: str = "score") -> DataFrame:
    """P(class 1) for probabilistic models."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(out))


def minmax(df: DataFrame, margin: str, keep: list[str], out: str = "score") -> DataFrame:
    """Margins scaled to [0, 1] by the scored set's min/max (one-row side)."""
    r = df.agg(F.min(margin).alias("_lo"), F.max(margin).alias("_hi"))
    return df.crossJoin(F.broadcast(r)).select(
        *keep, F.try_divide(F.col(margin) - F.col("_lo"), F.col("_hi") - F.col("_lo")).alias(out))


def minmax_margin(model: Model, df: DataFrame, keep: list[str], out: str = "score") -> DataFrame:
    """The same for a margin model without probabilities."""
    m = model.transform(df).select(*keep, vector_to_array("rawPrediction")[1].alias("_m"))
    return minmax(m, "_m", keep, out)


def stump_expr(stump, features_col: str = FEATURES):
    """A fitted depth-1 tree as a column expression (prediction 0/1): the split's
    feature index, threshold and leaf predictions are read from the model, so
    an ensemble of stumps scores in one projection."""
    root = stump._java_obj.rootNode()
    if root.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(root.prediction()))
    split = root.split()
    x = vector_to_array(features_col)[int(split.featureIndex())]
    return F.when(x <= F.lit(float(split.threshold())), F.lit(float(root.leftChild().prediction()))).otherwise(
        F.lit(float(root.rightChild().prediction())))


# --------------------------------------------------------------------------- CV / search

def random_param_maps(est, space: dict, n_iter: int, seed: int = SEED):
    """``n_iter`` draws; a space value is a list (choice) or a
    (low, high, 'int'|'float'|'share') range (uniform; a share is passed as text)."""
    rng = random.Random(seed)
    maps = []
    for _ in range(n_iter):
        pm = {}
        for name, spec in space.items():
            p = est.getParam(name)
            if isinstance(spec, list):
                pm[p] = rng.choice(spec)
            else:
                lo, hi, kind = spec
                draw = rng.randrange(lo, hi) if kind == "int" else rng.uniform(lo, hi)
                pm[p] = f"{draw:.4f}" if kind == "share" else draw
        maps.append(pm)
    return maps


def random_search(est, space: dict, n_iter: int, df: DataFrame, fold_col: str = "fold",
                  parallelism: int = 4):
    """Cross-validated random search on the given fold column (ROC-AUC)."""
    cv = CrossValidator(estimator=est, estimatorParamMaps=random_param_maps(est, space, n_iter),
                        evaluator=BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC"),
                        foldCol=fold_col, parallelism=parallelism, seed=SEED)
    return cv.fit(df)


def importances(values, names: list[str]) -> DataFrame:
    """Feature importances as a (feature, importance) DataFrame."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(v) for v in values])), "feature string, importance double")
