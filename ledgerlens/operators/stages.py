"""Pipeline stages with readers and writers (A8): cleaning, encoding, scaling and the models that
Spark ML lacks.

Every fitted stage is a Spark ML ``Model``. What it learned is a ``settings`` parameter (plain
numbers and names, bounded by the number of columns), saved as metadata; label
lists and tree nodes, which may be long, are Parquet tables beside it. So a ``Pipeline`` of them
and Spark's own stages is fitted, saved and loaded as one object that takes raw rows to scores.

Unseen categories: all one-hot columns are 0; a label gets the index behind the last, as a null does.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import histtrees as H
from ledgerlens.operators import models as MO
from ledgerlens.operators import prep as PR


class _Set(Params):
    settings = Param(Params._dummy(), "settings", "what the stage was given or has learned", TypeConverters.identity)

    def __init__(self, **settings):
        super().__init__()
        self._set(settings=settings)

    @property
    def own(self) -> dict:
        return self.getOrDefault("settings")


class _Step(_Set, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator given by its settings."""


class _Done(_Set, Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model given by its settings."""


# --------------------------------------------------------------------------- cleaning

def _numeric(df: DataFrame, without=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


class Cleaning(_Step):
    """F1-F9 and F14-F15, fitted on the rows it is given: drops columns, fills, caps, takes logs, replaces
    infinite values and scales. ``keep``: columns that it leaves alone; ``categorical``: text columns."""

    def __init__(self, keep=(), categorical=(), cap=()):
        super().__init__(keep=list(keep), categorical=list(categorical), cap=list(cap))

    def _fit(self, df: DataFrame) -> CleaningModel:
        keep, cats = self.own["keep"], self.own["categorical"]
        plan = PR.drop_plan(df.drop(*keep), "", "")
        dropped = [r["column_name"] for r in plan.select("column_name").collect()]
        df = df.drop(*dropped)
        cats = [c for c in cats if c in df.columns]
        num = _numeric(df, keep)
        fills = PR.fill_values(PR.impute_params(df, num, "all"))
        df = PR.fill_with(df, fills, cats)
        bounds = {c: list(b) for c, b in PR.cap_bounds(PR.cap_params(
            df, [c for c in self.own["cap"] if c in num], "all")).items()} if self.own["cap"] else {}
        df = PR.cap_with(df, bounds)
        logs = PR.log_columns(PR.log_params(df, num, "all"))
        df = PR.log_with(df, logs)
        return CleaningModel(drop=dropped, fills=fills, categorical=cats, bounds=bounds, logs=logs)


class CleaningModel(_Done):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.own
        df = PR.fill_with(df.drop(*s["drop"]), s["fills"], s["categorical"])
        return PR.log_with(PR.cap_with(df, s["bounds"]), s["logs"])


class Scaling(_Step):
    """infinite and missing values become medians, then mean 0 and deviation 1."""

    def __init__(self, keep=()):
        super().__init__(keep=list(keep))

    def _fit(self, df: DataFrame) -> ScalingModel:
        num = _numeric(df, self.own["keep"])
        med = PR.medians(df, num)
        scaled = PR.scales(PR.scale_params(PR.without_inf(df, num).fillna(med), num, "all"))
        return ScalingModel(columns=num, medians=med, scales={c: list(v) for c, v in scaled.items()})


class ScalingModel(_Done):
    def _transform(self, df: DataFrame) -> DataFrame:
        return PR.scale_with(PR.without_inf(df, self.own["columns"]).fillna(self.own["medians"]), self.own["scales"])


class OneHot(_Step):
    """F11."""

    def __init__(self, column=""):
        super().__init__(column=column)

    def _fit(self, df: DataFrame) -> OneHotModel:
        return OneHotModel(column=self.own["column"], values=PR.onehot_values(df, self.own["column"]))


class OneHotModel(_Done):
    def _transform(self, df: DataFrame) -> DataFrame:
        return PR.onehot_with(df, self.own["column"], self.own["values"])


class Assembling(_Step):
    """All numeric columns but ``keep`` as one vector."""

    def __init__(self, keep=()):
        super().__init__(keep=list(keep))

    def _fit(self, df: DataFrame) -> AssemblingModel:
        return AssemblingModel(columns=_numeric(df, self.own["keep"]))


class AssemblingModel(_Done):
    def _transform(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.own["columns"], outputCol=MO.FEATURES, handleInvalid="keep").transform(df)


# --------------------------------------------------------------------------- stages with a table of their own

class _TableWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.table.write.mode("overwrite").parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        stage.table = self.sparkSession.read.parquet(f"{path}/table")
        return stage


class _WithTable(_Set, Model, MLReadable, MLWritable):
    def __init__(self, table: DataFrame | None = None, **settings):
        super().__init__(**settings)
        self.table = table

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class Labels(_Step):
    """F12."""

    def __init__(self, column=""):
        super().__init__(column=column)

    def _fit(self, df: DataFrame) -> LabelsModel:
        return LabelsModel(PR.sorted_labels(df, self.own["column"]), column=self.own["column"])


class LabelsModel(_WithTable):
    def _transform(self, df: DataFrame) -> DataFrame:
        return PR.label_with(df, self.own["column"], self.table)


NODES = ("tree int, node int, feature int, threshold double, left int, right int, value double, rows double, "
         "gain double")


class BoostedModel(_WithTable):
    """A model of ``histtrees`` as a stage: appends ``score``, the probability of class 1."""

    @classmethod
    def of(cls, model: H.Boosted) -> BoostedModel:
        rows = [(k, i, int(t.feature[i]), float(t.cut[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]),
                 float(t.rows[i]), float(t.gain[i]))
                for k, t in enumerate(H.thresholds(model)) for i in range(len(t.feature))]
        return cls(SparkSession.getActiveSession().createDataFrame(rows, NODES), start=model.start)

    def trees(self) -> list[H.Tree]:
        """The node table (its size is the model's) as arrays."""
        nodes = self.table.toPandas().sort_values(["tree", "node"])
        out = []
        for _, t in nodes.groupby("tree"):
            inner = int((t.feature >= 0).sum())
            out.append(H.Tree(t.feature.to_numpy(np.int32), t.threshold.to_numpy(), t.left.to_numpy(np.int32),
                              t.right.to_numpy(np.int32), t.value.to_numpy(), t.rows.to_numpy(), t.gain.to_numpy(), inner))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast((self.own["start"], self.trees()))

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            start, trees = sent.value
            rows = np.stack(x.to_list()) if len(x) else np.zeros((0, 1))
            f = np.full(len(rows), start)
            for t in trees:
                f += t.value[_fall(t, rows)]
            return pd.Series(1 / (1 + np.exp(-f)))

        return df.withColumn("score", score(vector_to_array(MO.FEATURES)))


def _fall(t: H.Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row; done as soon as all rows are in one."""
    at, every = np.zeros(len(x), np.int32), np.arange(len(x))
    for _ in range(t.depth):
        f = t.feature[at]
        if (f < 0).all():
            break
        goes = np.where(x[every, np.maximum(f, 0)] <= t.cut[at], t.left[at], t.right[at])
        at = np.where(f >= 0, goes, at)
    return at


# --------------------------------------------------------------------------- models

class CalibratedSVC(_Step):
    """K linear SVM fits on k - 1 folds, each with a sigmoid (Platt) map fitted on its held-out
    fold; the probability is the mean of the k calibrated models."""

    def __init__(self, n_weight: float = 1.0, C: float = 0.1, folds: int = 3, max_iter: int = 2000, fold_col: str = "fold"):
        super().__init__(n_weight=n_weight, C=C, folds=folds, max_iter=max_iter, fold_col=fold_col)

    def _fit(self, df: DataFrame) -> CalibratedSVCModel:
        s, parts = self.own, []
        for k in range(s["folds"]):
            tr, ho = df.where(F.col(s["fold_col"]) != k), df.where(F.col(s["fold_col"]) == k)
            svc = LinearSVC(featuresCol=MO.FEATURES, labelCol=MO.LABEL, weightCol=MO.WEIGHT,
                            regParam=1.0 / (s["C"] * s["n_weight"]), maxIter=s["max_iter"],
                            standardization=False, tol=1e-4).fit(tr)
            margins = svc.transform(ho).select(MO.LABEL, vector_to_array("rawPrediction")[1].alias("m"))
            platt = LogisticRegression(featuresCol="mv", labelCol=MO.LABEL, regParam=0.0).fit(
                MO.assemble(margins, ["m"], "mv"))
            parts.append({"coef": svc.coefficients.toArray().tolist(), "intercept": float(svc.intercept),
                          "a": float(platt.coefficients[0]), "b": float(platt.intercept)})
        return CalibratedSVCModel(parts=parts)


class CalibratedSVCModel(_Done):
    def _transform(self, df: DataFrame) -> DataFrame:
        probs = []
        for p in self.own["parts"]:
            products = F.zip_with("_x", F.lit(p["coef"]), lambda x, c: x * c)
            margin = F.aggregate(products, F.lit(0.0), lambda s, v: s + v) + F.lit(p["intercept"])
            probs.append(1 / (1 + F.exp(-(F.lit(p["a"]) * margin + F.lit(p["b"])))))
        rows = df.withColumn("_x", vector_to_array(MO.FEATURES))
        return rows.withColumn("score", sum(probs[1:], probs[0]) / len(probs)).drop("_x")


class AdaBoostModel(_Done):
    """P(class 1) = sigmoid of twice the normalised vote (SAMME, two classes)."""

    @classmethod
    def of(cls, stumps: list[H.Stump]) -> AdaBoostModel:
        return cls(**{name: [getattr(s, name) for s in stumps]
                      for name in ("feature", "threshold", "left", "right", "weight")})

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.own
        # arrays of constants: the generated code doesn't grow with the number of stumps
        stumps = F.arrays_zip(*[F.lit(s[n]).alias(n) for n in ("feature", "threshold", "left", "right", "weight")])

        def vote(total, t):
            x = F.get(F.col("_x"), F.greatest(t["feature"], F.lit(0)))
            says = F.when((t["feature"] < 0) | (x <= t["threshold"]), t["left"]).otherwise(t["right"])
            return total + t["weight"] * (2 * says - 1)

        decision = F.aggregate(stumps, F.lit(0.0), vote) / F.lit(math.fsum(s["weight"]))
        rows = df.withColumn("_x", vector_to_array(MO.FEATURES))
        return rows.withColumn("score", 1 / (1 + F.exp(-2 * decision))).drop("_x")
