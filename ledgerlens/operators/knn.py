"""Exact k-nearest neighbours by blocks (used by SMOTE / ENN, H4-H5).

In 64 dimensions bounds from pivots prune nothing, so every query does meet every
point, but never as rows: queries and points are dealt by a hash of their ids
into a few lots, enough for the session's cores and of about LOT rows at most. Each pair of lots is
one group; there matrix products of BLOCK by BLOCK rows give the distances, and only the k best of a
query in its group go on. The k best of a query's lots are merged by (distance, id). A row is shuffled
once for each lot of the other side, which is the number of cores' square root until lots are full.

The product loses the last digits, so it only selects: all points within its
error of the k-th best are measured again as differences, and these exact
distances decide, ties by id. Points whose vector is null or holds a null or NaN
have no distance: they are neither queries nor neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.split import hash_order

#: Rows of a matrix product's sides.
BLOCK = 2048
#: Rows of a lot, about (64 doubles each: 32 MB).
LOT = 1 << 16
NEIGHBOURS = "q_id long, nn_id long, distance double"


def measured(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, vec) as doubles, without rows that have no distance to anything."""
    v = F.col(vec).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x)))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    flat = table["vec"].combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return table["id"].to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def nearest(q_id: np.ndarray, q: np.ndarray, p_id: np.ndarray, p: np.ndarray, k: int):
    """(query, point, distance) of the k nearest points of each query, itself excluded."""
    square = (q * q).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (q @ p.T)
    same = q_id[:, None] == p_id[None, :]
    square[same] = np.inf
    kth = np.partition(square, min(k, len(p)) - 1, axis=1)[:, min(k, len(p)) - 1]
    slack = 1e-9 * (1 + (q * q).sum(1) + (p * p).sum(1).max())
    i, j = np.nonzero((square <= (kth + slack)[:, None]) & ~same)
    exact = np.sqrt(((q[i] - p[j]) ** 2).sum(1))
    order = np.lexsort((p_id[j], exact, i))
    i, j, exact = i[order], j[order], exact[order]
    first = np.searchsorted(i, np.arange(len(q)))
    keep = np.arange(len(i)) - first[i] < k
    return q_id[i[keep]], p_id[j[keep]], exact[keep]


def nearest_by_blocks(q_id: np.ndarray, q: np.ndarray, p_id: np.ndarray, p: np.ndarray, k: int, block: int = BLOCK):
    """``nearest`` with tables of ``block`` x ``block`` distances at most; a query's best are merged as they come."""
    out = []
    for at in range(0, len(q), block):
        best = [np.zeros(0, q_id.dtype), np.zeros(0, p_id.dtype), np.zeros(0)]
        for to in range(0, len(p), block):
            found = nearest(q_id[at:at + block], q[at:at + block], p_id[to:to + block], p[to:to + block], k)
            who, whom, far = (np.concatenate(c) for c in zip(best, found))
            order = np.lexsort((whom, far, who))
            who, whom, far = who[order], whom[order], far[order]
            keep = np.arange(len(who)) - np.searchsorted(who, who) < k
            best = [who[keep], whom[keep], far[keep]]
        out.append(best)
    return tuple(np.concatenate(c) for c in zip(*out))


def lots(rows: int, block: int, cores: int) -> int:
    """Into how many lots the rows of a side are dealt: pairs of lots for all cores, LOT rows at most,
    and no lot below ``block`` rows but for that."""
    return max(1, -(-rows // max(LOT, block)), min(-(-rows // block), math.ceil(math.sqrt(8 * cores))))


def knn(queries: DataFrame, points: DataFrame, k: int, id_col: str = "id", vec: str = "vec",
        block: int = BLOCK) -> DataFrame:
    """(q_id, nn_id, distance, nn_rank) for the k nearest points of each query
    (a point never neighbours itself: equal ids are excluded)."""
    qs, ps = measured(queries, id_col, vec), measured(points, id_col, vec)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    q_blocks, p_blocks = (lots(d.count(), block, cores) for d in (qs, ps))

    def dealt(df, own, n_own, other, n_other):
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q_id", "nn_id", "distance"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        return pa.table([pa.array(c) for c in nearest_by_blocks(*_matrix(left), *_matrix(right), k, block)], names=names)

    left = dealt(qs, "_qb", q_blocks, "_pb", p_blocks).groupBy("_qb", "_pb")
    right = dealt(ps, "_pb", p_blocks, "_qb", q_blocks).groupBy("_qb", "_pb")
    best = left.cogroup(right).applyInArrow(compare, NEIGHBOURS)
    w = Window.partitionBy("q_id").orderBy("distance", "nn_id")   # k rows per lot of points
    return best.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)


def enn(df: DataFrame, label: str, k: int = 3, keep_class=None, kind: str = "all",
        id_col: str = "id", vec: str = "vec") -> DataFrame:
    """H5: edited nearest neighbours. Points of the classes being cleaned (all
    but ``keep_class``) are dropped when their k neighbours (among all points)
    disagree with them: any disagreement (``kind='all'``) or a majority
    (``kind='mode'``)."""
    clean = df.where(F.col(label) != F.lit(keep_class)) if keep_class is not None else df
    nn = knn(clean, df, k, id_col, vec)
    lab = df.select(F.col(id_col).alias("nn_id"), F.col(label).alias("_nl"))
    own = df.select(F.col(id_col).alias("q_id"), F.col(label).alias("_ql"))
    votes = nn.join(lab, "nn_id").join(own, "q_id").groupBy("q_id").agg(
        F.sum((F.col("_nl") == F.col("_ql")).cast("int")).alias("_agree"), F.count(F.lit(1)).alias("_n"))
    if kind == "all":
        drop = votes.where(F.col("_agree") < F.col("_n"))
    else:
        drop = votes.where(F.col("_agree") * 2 < F.col("_n"))
    return df.join(drop.select(F.col("q_id").alias(id_col)), id_col, "left_anti")


def smote(df: DataFrame, label: str, minority, n_new: int | None = None, k: int = 5,
          id_col: str = "id", vec: str = "vec") -> DataFrame:
    """H4: synthetic minority samples x_i + gap * (x_nn - x_i), gap in [0, 1),
    neighbour among the k nearest minority points. Sample j uses base point
    j mod n_min (hash order), neighbour rank and gap from md5(j) -- deterministic.
    Default count = n_majority - n_minority (balanced)."""
    from ledgerlens.operators.split import exact_rank
    mino = df.where(F.col(label) == F.lit(minority)).select(id_col, F.col(vec).cast("array<double>").alias(vec))
    if n_new is None:
        c = df.agg(F.count_if(F.col(label) == F.lit(minority)).alias("a"), F.count(F.lit(1)).alias("n")).first()
        n_new = max(0, (c["n"] - c["a"]) - c["a"])
    n_min = mino.count()
    if n_min < 2:
        raise ValueError(f"SMOTE needs two minority points at least, there are {n_min}")
    k = min(k, n_min - 1)  # a point has no more neighbours than that
    ranked = exact_rank(mino, id_col, []).select(id_col, vec, (F.col("rank") - 1).alias("_idx"))
    nn = knn(mino, mino, k, id_col, vec)
    spark = df.sparkSession
    h = F.md5(F.concat(F.col("sample_id").cast("string"), F.lit("-smote")))
    jobs = spark.range(n_new).select(
        F.col("id").alias("sample_id"),
        (F.col("id") % n_min).alias("_idx"),
        ((F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % k) + 1).alias("_nr"),
        (F.conv(F.substring(h, 9, 13), 16, 10).cast("double") / float(16 ** 13)).alias("gap"))
    base = jobs.join(ranked.withColumnRenamed(id_col, "base_id").withColumnRenamed(vec, "_b"), "_idx")
    pick = base.join(nn.select(F.col("q_id").alias("base_id"), F.col("nn_rank").alias("_nr"), "nn_id"),
                     ["base_id", "_nr"])
    pick = pick.join(mino.select(F.col(id_col).alias("nn_id"), F.col(vec).alias("_x")), "nn_id")
    new_vec = F.zip_with("_b", "_x", lambda b, x: b + F.col("gap") * (x - b))
    return pick.select("sample_id", "base_id", "nn_id", "gap", new_vec.alias(vec), F.lit(minority).alias(label))
