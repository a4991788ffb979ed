"""L1 for trees, exact: path-dependent Shapley values in time polynomial in the depth.

A leaf's share in the model's output depends only on the features of its path. A row meets the
path's conditions on a feature or not (o = 1 or 0); unknown, the feature counts by the share z of
training rows that go that way. Over all subsets of the path's D features the product of o
or z is a polynomial in the subset's size, whose coefficients follow by multiplying in one feature at a time.
A feature's value divides its own factor out again and weighs the rest by
k! (D - 1 - k)! / D!: D squared steps per leaf and row instead of 2 to the D.

The model travels as a table of leaves, grouped by D (bounded by the model's size); rows are
explained in Arrow batches, all leaves at once. A row's values add up to f(x) - E f, where
E f weighs the leaves by their training rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import histtrees as H
from ledgerlens.session import scratch_path

#: Leaf-row pairs worked on at a time.
PAIRS = 1 << 19


@dataclass
class Leaves:
    """Leaves with D features on their path: conditions low < x <= high, shares and values."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


@dataclass
class Paths:
    leaves: list[Leaves]
    base: float                    # E f
    features: int


def tree_leaves(feature, cut, left, right, value, rows, weight: float = 1.0) -> Iterator[tuple]:
    """(path, value) of each leaf; a path maps a feature to (low, high, share)."""
    todo = [(0, {})]
    while todo:
        at, path = todo.pop()
        f = int(feature[at])
        if f < 0:
            yield path, float(value[at]) * weight
            continue
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        for child, bounds in ((int(left[at]), (low, min(high, cut[at]))), (int(right[at]), (max(low, cut[at]), high))):
            todo.append((child, {**path, f: (*bounds, share * float(rows[child]) / float(rows[at]))}))


def paths_of(leaves, features: int, start: float = 0.0) -> Paths:
    """Leaves of all trees, grouped by the number of features on their path."""
    groups: dict[int, list] = {}
    base = start
    for path, value in leaves:
        base += value * math.prod(z for *_, z in path.values())
        if path:
            groups.setdefault(len(path), []).append((path, value))
    out = []
    for _, some in sorted(groups.items()):
        out.append(Leaves(np.array([list(p) for p, _ in some], np.int64),
                          *(np.array([[c[k] for c in p.values()] for p, _ in some]) for k in range(3)),
                          np.array([v for _, v in some])))
    return Paths(out, base, features)


def of_boosted(model: H.Boosted) -> Paths:
    """Margins (log odds) of a model of ``histtrees``."""
    leaves = (leaf for t in H.thresholds(model)
              for leaf in tree_leaves(t.feature, t.cut, t.left, t.right, t.value, t.rows))
    return paths_of(leaves, len(model.edges), model.start)


def of_spark(model) -> Paths:
    """A fitted Spark tree, forest (probability of class 1) or boosted classifier (margin): its node
    table is read from where Spark's own writer puts it."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, f"nodes-{model.uid}")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    else:
        data = data.withColumn("treeID", F.lit(0))
    weights = [1.0]
    if hasattr(model, "treeWeights"):
        weights = list(model.treeWeights)
        if not type(model).__name__.startswith("GBT"):
            weights = [w / sum(weights) for w in weights]
    single = not type(model).__name__.startswith("GBT")
    trees: dict[int, list] = {}
    for r in data.collect():                       # the model's own nodes
        trees.setdefault(r["treeID"], []).append(r)
    leaves = []
    for k, nodes in sorted(trees.items()):
        nodes.sort(key=lambda r: r["id"])
        inner = [r["leftChild"] >= 0 for r in nodes]
        value = [r["impurityStats"][1] / (sum(r["impurityStats"]) or 1) if single else r["prediction"] for r in nodes]
        leaves += tree_leaves(
            [r["split"]["featureIndex"] if i else -1 for r, i in zip(nodes, inner)],
            [r["split"]["leftCategoriesOrThreshold"][0] if i else math.nan for r, i in zip(nodes, inner)],
            [r["leftChild"] for r in nodes], [r["rightChild"] for r in nodes], value,
            [r["rawCount"] for r in nodes], weights[k])
    return paths_of(leaves, model.numFeatures)


def values_of(paths: Paths, x: np.ndarray) -> np.ndarray:
    """(rows, features) Shapley values; a missing value counts as the largest."""
    x = np.where(np.isnan(x), np.inf, x)
    out = np.zeros((len(x), paths.features))
    for part in paths.leaves:
        n, d = part.feature.shape
        weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
        order = np.argsort(part.feature.ravel(), kind="stable")
        names, first = np.unique(part.feature.ravel()[order], return_index=True)
        step = max(1, PAIRS // (n * d))
        for k in range(0, len(x), step):
            v = x[k:k + step][:, part.feature]
            met = (v > part.low) & ((v <= part.high) | np.isposinf(part.high))
            poly = np.zeros((d + 1, len(v), n))
            poly[0] = 1
            for j in range(d):
                poly[1:j + 2] = poly[1:j + 2] * part.share[:, j] + met[..., j] * poly[:j + 1]
                poly[0] *= part.share[:, j]
            found = np.empty(met.shape)
            for j in range(d):
                share, on = part.share[:, j], met[..., j]
                total, rest = np.zeros(on.shape), np.zeros(on.shape)
                for m in range(d - 1, -1, -1):
                    rest = np.where(on, poly[m + 1] - share * rest, poly[m] / share)
                    total += weight[m] * rest
                found[..., j] = total * (on - share) * part.value
            found = found.reshape(len(v), -1)[:, order]
            out[k:k + step][:, names] += np.add.reduceat(found, first, axis=1)
    return out


def attributions(paths: Paths, df: DataFrame, key: str, features: str, names: list[str]) -> DataFrame:
    """Long table (key, feature, input_value, attribution)."""
    sent = df.sparkSession.sparkContext.broadcast(paths)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            v = values_of(sent.value, x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(v), pa.list_(pa.float64())), batch.column(1)], names=[key, "v", "x"])

    rows = df.select(key, vector_to_array(features).alias("x"))
    schema = rows.select(key).schema.add("v", T.ArrayType(T.DoubleType())).add("x", T.ArrayType(T.DoubleType()))
    pairs = F.arrays_zip(F.lit(names).alias("feature"), F.col("x").alias("input_value"), F.col("v").alias("attribution"))
    return rows.mapInArrow(run, schema).select(key, F.inline(pairs))
