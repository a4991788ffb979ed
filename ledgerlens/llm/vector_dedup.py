"""Near-duplicate vectors by cross-polytope hashing.

Equal vectors of a label are taken together first. Each distinct vector is turned
by random signs and fast Hadamard transforms (three times per hash); the axis, with its
sign, that it comes closest to is its hash, and ``k`` hashes side by side are a
bucket of one of ``tables`` tables. Multiprobe: a vector also enters the
``probes`` - 1 buckets that it misses most narrowly. Vectors that share a bucket are candidate pairs;
their cosine is computed in double precision from the original components.

``k`` follows the number of vectors, so that buckets stay small; the number of
tables is then set so that a pair at exactly the threshold is missed with
probability MISS at most, as simulated with such pairs.

Pairs are never listed: a bucket multiplies blocks of vectors and returns per
vector the number of its links and one vector that it hangs together with. A pair
counts only in the first bucket that both are in, so sums over buckets are exact.
Buckets of more than BLOCK vectors are split in blocks, and each pair of blocks
goes to a task of its own.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
with a null label, have no links and are components of their own. Vectors of different
lengths are never compared. Rows that repeat a vec_id count as one
vector each; a null vec_id has links but no component.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.components import components

THRESHOLD = 0.93
PROBES, MISS, BUCKET = 4, 1e-4, 64
BLOCK = 1024
#: Pairs and rows that a task compares at a time.
PAIRS, ROWS = 1 << 20, 1 << 15
SEED = 42
HASHED = "label int, key long, at int, rep long, n long, vector array<float>, codes binary"
FOUND = "rep long, links long, hangs_on long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix, in log2(d) passes."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


@lru_cache(maxsize=16)
def signs(d: int, hashes: int) -> np.ndarray:
    return np.random.default_rng([SEED, d]).choice([-1.0, 1.0], size=(hashes, 3, d))


def codes_of(x: np.ndarray, k: int, tables: int, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, probes) bucket codes; the first probe is the bucket itself."""
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    unit = np.zeros((len(x), d))
    unit[:, :x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    turn, near = signs(d, k * tables), min(probes, d)
    out = np.empty((len(x), tables, probes), np.int64)
    for t in range(tables):
        code, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for j in range(k):
            r = unit
            for q in range(3):
                r = hadamard(r * turn[t * k + j, q])
            axis = np.argsort(-np.abs(r), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(r, axis, 1)
            own = 2 * axis + (value > 0)
            short = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            code = (code[:, :, None] * (2 * d) + own[:, None, :]).reshape(len(x), -1)
            cost = (cost[:, :, None] + short[:, None, :]).reshape(len(x), -1)
            best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            code, cost = np.take_along_axis(code, best, 1), np.take_along_axis(cost, best, 1)
        out[:, t] = np.pad(code, ((0, 0), (0, probes - code.shape[1])), "edge")
    return out


@lru_cache(maxsize=32)
def plan_tables(rows: int, dim: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(k, tables): ``rows`` vectors of a label in buckets of about BUCKET, and a pair
    at the threshold missed with probability ``miss`` at most."""
    d = 1 << max(1, (dim - 1).bit_length())
    k = max(1, min(4, math.ceil(math.log(max(rows * PROBES / BUCKET, 2)) / math.log(2 * d))))
    rng = np.random.default_rng([SEED, dim, 1])
    x, y = rng.normal(size=(2, 4000, max(dim, 2)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(1 - threshold ** 2) * y
    a, b = codes_of(x, k, 2), codes_of(y, k, 2)
    met = float(np.mean((a[:, :, :, None] == b[:, :, None, :]).any((2, 3))))
    return k, max(1, math.ceil(math.log(miss) / math.log(max(1 - met, 1e-9))))


def code_type(k: int, dim: int) -> str:
    d = 1 << max(1, (dim - 1).bit_length())
    return "<i4" if (2 * d) ** k < 1 << 31 else "<i8"


def pairs_within(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j of each run of rows."""
    n = size * (size - 1) // 2
    run = np.repeat(np.arange(len(size)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    # pairs of a run go by j: 0 before 1, then 0 and 1 before 2, ...
    j = ((1 + np.sqrt(1 + 8 * k.astype(float))) / 2).astype(np.int64)
    j -= j * (j - 1) // 2 > k
    j += j * (j + 1) // 2 <= k
    i = k - j * (j - 1) // 2
    return start[run] + i, start[run] + j


def linked_pairs(x: np.ndarray, start: np.ndarray, split: np.ndarray, threshold: float):
    """Pairs at the threshold within runs of rows from ``start``; of a run whose ``split`` isn't -1
    only pairs across it. Runs up to BUCKET rows are taken together, longer ones by matrix."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    end = np.append(start[1:], len(x))
    size = end - start
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    small = (size <= BUCKET) & (split < 0)
    runs = np.flatnonzero(small & (size > 1))
    n = np.cumsum(size[runs] * (size[runs] - 1) // 2)
    for at in range(0, int(n[-1]) if len(n) else 0, PAIRS):
        some = runs[(n > at) & (n <= at + PAIRS)]
        i, j = pairs_within(start[some], size[some])
        for part in range(0, len(i), 1 << 15):
            a, b = i[part:part + (1 << 15)], j[part:part + (1 << 15)]
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            found.append((a[near], b[near]))
    for r in np.flatnonzero(~small):
        lo, hi, cut = start[r], end[r], split[r]
        left, right = (np.arange(lo, hi),) * 2 if cut < 0 else (np.arange(lo, cut), np.arange(cut, hi))
        for at in range(0, len(left), 512):
            i, j = np.nonzero(unit[left[at:at + 512]] @ unit[right].T >= threshold)
            i, j = left[at + i], right[j]
            found.append((i[i < j], j[i < j]) if cut < 0 else (i, j))
    return tuple(np.concatenate(side) for side in zip(*found))


def links_of(i: np.ndarray, j: np.ndarray, codes: np.ndarray, n: np.ndarray, rep: np.ndarray, table: int,
             code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From linked pairs of rows in buckets of one table: (vector, links that no earlier bucket
    has, a vector that it hangs together with)."""
    links, low = np.zeros(len(rep), np.int64), np.arange(len(rep))
    first = np.ones(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        ci, cj, own = codes[i[part]], codes[j[part]], code[i[part]]
        for t in range(table):
            first[part] &= ~(ci[:, t, :, None] == cj[:, t, None, :]).any((1, 2))
        same = (ci[:, table, :, None] == cj[:, table, None, :]) & (ci[:, table, :, None] < own[:, None, None])
        first[part] &= ~same.any((1, 2))
    np.add.at(links, i[first], n[j[first]])
    np.add.at(links, j[first], n[i[first]])
    while True:                          # least row that each hangs together with
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if (new == low).all():
            break
        low = new[new]
    seen = np.unique(np.concatenate((i, j)))
    return rep[seen], links[seen], rep[low[seen]]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"),
                          F.col("embedding").cast("array<float>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    valid = rows.filter(good)
    reps = valid.groupBy("label", "vector").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn(
        "rep", F.coalesce("least", F.xxhash64("label", "vector")))
    reps = shared.written(reps, "vectors")
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    most = 1 << max(1, (most - 1).bit_length())
    plan = lambda d: plan_tables(most, d, threshold)  # noqa: E731  the same on every executor

    def hash_rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lists = part.column(part.schema.get_field_index("vector"))
                lengths = np.diff(lists.offsets.to_numpy())
                label, rep, n = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("label", "rep", "n"))
                for d in np.unique(lengths):
                    own = np.flatnonzero(lengths == d)
                    kept = lists.take(pa.array(own))
                    x = kept.flatten().to_numpy().reshape(len(own), d).astype(np.float64)
                    k, tables = plan(int(d))
                    codes = codes_of(x, k, tables)
                    each = tables * PROBES
                    # the same code can be probed twice only where codes run out
                    once = np.ones(codes.shape, bool)
                    for p in range(1, PROBES):
                        once[:, :, p] = (codes[:, :, p, None] != codes[:, :, :p]).all(2)
                    row, table, probe = np.nonzero(once)
                    raw = codes.reshape(len(own), each).astype(code_type(k, int(d)))
                    binary = pa.array([r.tobytes() for r in raw], pa.binary())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(label[own][row], pa.int32()),
                        pa.array(codes[row, table, probe]), pa.array((table + (int(d) << 8)).astype(np.int32)),
                        pa.array(rep[own][row]), pa.array(n[own][row]),
                        kept.take(pa.array(row)), binary.take(pa.array(row))],
                        names=[c.split()[0] for c in HASHED.split(", ")])

    hashed = shared.written(reps.select("label", "rep", "n", "vector").mapInArrow(hash_rows, HASHED), "hashed")
    bucket = ["label", "at", "key"]
    # only buckets over the block size are split: at most rows / block of them
    large = hashed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
    large = shared.written(large.select(*bucket, F.ceil(F.col("size") / block).cast("int").alias("parts")), "large")
    met = hashed.join(large, bucket, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a member of part p of a split bucket meets every part, in a group of these two parts
    met = met.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.withColumn("a", F.least("part", "other")).withColumn("b", F.greatest("part", "other"))
    group = [*bucket, "a", "b"]
    met = met.repartition(*group).sortWithinPartitions("at", "label", "key", "a", "b", "part")

    def verify(batches):
        """Whole groups of one table at a time."""
        held: list[pa.RecordBatch] = []

        def compare():
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            at = t["at"][0].as_py()
            d, table = at >> 8, at & 255
            k, tables = plan(d)
            column = {c: t[c].to_numpy() for c in (*group, "part", "n", "rep")}
            change = np.ones(t.num_rows, bool)
            change[1:] = False
            for c in group:
                change[1:] |= column[c][1:] != column[c][:-1]
            start = np.flatnonzero(change)
            across = column["a"][start] != column["b"][start]
            second = np.cumsum(np.concatenate(([0], column["part"] == column["a"])))
            firsts = second[np.append(start[1:], t.num_rows)] - second[start]
            split = np.where(across, start + firsts, -1)
            x = t["vector"].chunk(0).flatten().to_numpy().reshape(t.num_rows, d).astype(np.float64)
            i, j = linked_pairs(x, start, split, threshold)
            seen, of = np.unique(np.concatenate((i, j)), return_inverse=True)
            raw = t["codes"].take(pa.array(seen)).to_pylist()
            codes = np.frombuffer(b"".join(raw), code_type(k, d)).reshape(len(seen), tables, PROBES)
            out = links_of(of[:len(i)], of[len(i):], codes, column["n"][seen], column["rep"][seen], table,
                           column["key"][seen])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                              names=["rep", "links", "hangs_on"])

        for batch in batches:
            while batch.num_rows:
                # up to where the table changes, or where a group ends once there are enough rows
                keys = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in group]
                ends = np.zeros(batch.num_rows, bool)
                for k in keys:
                    ends[:-1] |= k[:-1] != k[1:]
                if held:
                    last = held[-1].slice(held[-1].num_rows - 1)
                    was = [last.column(last.schema.get_field_index(c))[0].as_py() for c in group]
                    rows = sum(h.num_rows for h in held)
                    now = [k[0] for k in keys]
                    if was[1] != now[1] or rows >= ROWS and was != now:
                        yield compare()
                        continue
                else:
                    rows = 0
                at = keys[1]
                stop = np.flatnonzero(ends & ((np.append(at[1:], at[-1]) != at) | (np.arange(len(at)) + rows >= ROWS)))
                to = int(stop[0]) + 1 if len(stop) else batch.num_rows
                held.append(batch.slice(0, to))
                batch = batch.slice(to)
        if held:
            yield compare()

    columns = [*group, "part", "rep", "n", "vector", "codes"]
    found = shared.written(met.select(*columns).mapInArrow(verify, FOUND), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    tied = components(found.select("rep", "hangs_on"), "rep", "hangs_on").withColumnRenamed("node", "rep")
    # a representative without an id is no component's name: take the least real id of each
    ids = reps.join(links, "rep", "left").join(tied, "rep", "left").withColumn(
        "root", F.coalesce("component_id", "rep"))
    names = ids.groupBy("root").agg(F.min("least").alias("name"))
    ids = ids.join(names, "root").select("label", "vector", "name",
                                         (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = valid.join(ids, ["label", "vector"]).select("vec_id", "n_links", F.col("name").alias("component_id"))
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.table(spark, sf_dir, "embeddings"))


#: All pairs of a label, and the closure of their links.
OP2_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
      WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_dot_product(e, e) > 0),
links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e)
    WHERE a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(vec_id, root) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id WHERE r.root < l.b),
least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, least.component_id,
       e.vec_id = least.component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""
