"""Best-fit-decreasing packing into binary id matrices.

Documents longer than a row are split into full rows and a rest, without loss.
The pieces of a block go, longest first, each to the open row whose free space
fits it best; a segment tree over the free spaces 0 to capacity finds the
smallest one that is large enough in log2(capacity) steps. Full or unmatched
rows are padded.

The operator writes one Parquet row per matrix row: ``input_ids`` (little-endian
unsigned 16 bits, padded with ``pad_id``), ``cu_seqlens`` (signed 32 bits: 0, then
where each segment ends), ``position_ids`` (unsigned 16 bits, from 0 in every
segment and 0 in the padding), and which documents the segments come from. Rows of
a task are numbered within matrices of ``MATRIX_ROWS``.

Memory is bounded by the block; nothing is shuffled. Nulls: a null text has the
end id only, a null doc_id is carried. Rows that repeat a doc_id are packed each
for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import shared
from ledgerlens.llm.tokens import END_ID, ids_of

CAPACITY = 2048
BLOCK_TOKENS = 4 << 20
MATRIX_ROWS = 512
PAD_ID = 0
_TASK_BITS = 33

ROWS = T.StructType([
    T.StructField("matrix_id", T.LongType()), T.StructField("row", T.IntegerType()),
    T.StructField("input_ids", T.BinaryType()), T.StructField("cu_seqlens", T.BinaryType()),
    T.StructField("position_ids", T.BinaryType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType()))])
ARROW = pa.schema([("matrix_id", pa.int64()), ("row", pa.int32()), ("input_ids", pa.binary()),
                   ("cu_seqlens", pa.binary()), ("position_ids", pa.binary()),
                   ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))])


class SpaceTree:
    """Segment tree over free spaces: how many open rows have each one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, space: int, n: int) -> None:
        k = self.leaves + space
        while k:
            self.count[k] += n
            k >>= 1

    def at_least(self, space: int) -> int:
        """The smallest free space of ``space`` or more, -1 if there is none."""
        k = self.leaves + space
        if self.count[k]:
            return space
        while k > 1:
            if not k & 1 and self.count[k + 1]:     # the nearest subtree to the right
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.count[2 * k] else 2 * k + 1
                return k - self.leaves
            k >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Rows of pieces; ties go by the pieces' order."""
    tree, open_rows, rows = SpaceTree(capacity), [[] for _ in range(capacity + 1)], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        space = tree.at_least(lengths[i])
        if space < 0:
            space, r = capacity, len(rows)
            rows.append([])
        else:
            tree.add(space, -1)
            r = open_rows[space].pop()
        rows[r].append(i)
        space -= lengths[i]
        if space:
            tree.add(space, 1)
            open_rows[space].append(r)
    return rows


def matrix_row(ids: list[np.ndarray], capacity: int, pad_id: int) -> tuple[bytes, bytes, bytes]:
    ends = np.cumsum([0] + [len(x) for x in ids])
    row = np.full(capacity, pad_id, "<u2")
    row[:ends[-1]] = np.concatenate(ids)
    position = np.zeros(capacity, "<u2")
    for a, b in zip(ends[:-1], ends[1:]):
        position[a:b] = np.arange(b - a)
    return row.tobytes(), ends.astype("<i4").tobytes(), position.tobytes()


def pack_matrices(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                  pad_id: int = PAD_ID, block: int = BLOCK_TOKENS) -> DataFrame:
    """docs (doc_id, text) -> matrix rows."""

    def pack(batches):
        first, n = TaskContext.get().partitionId() << _TASK_BITS, 0
        pieces, tokens = [], 0

        def flush():
            nonlocal pieces, tokens, n
            out = []
            for members in best_fit_decreasing([len(p[2]) for p in pieces], capacity):
                own = [pieces[i] for i in members]
                out.append((first + n // MATRIX_ROWS, n % MATRIX_ROWS,
                            *matrix_row([p[2] for p in own], capacity, pad_id),
                            [p[0] for p in own], [p[1] for p in own]))
                n += 1
            pieces, tokens = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], f.type) for k, f in enumerate(ARROW)], schema=ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py(), end_id)
                if ids.max() > 0xFFFF:
                    raise ValueError("ids over 65535 don't fit 16 bits")
                ids = ids.astype(np.uint16)
                for at in range(0, len(ids), capacity):
                    pieces.append((doc_id, at, ids[at:at + capacity]))
                tokens += len(ids)
                if tokens >= block:
                    yield flush()
        yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, ROWS)


def op7_matrix_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the matrices, reads them back and lists their segments."""
    rows = shared.written(pack_matrices(shared.table(spark, sf_dir, "documents")), "matrices")
    return segments(rows)


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment of the written matrices: where it lies, whence it is, and
    the crc32 of its ids and of its positions."""
    word = lambda k: F.conv(F.concat(*[  # noqa: E731  a little-endian signed 32-bit number that isn't negative
        F.hex(F.substring("cu_seqlens", 4 * k + b, 1)) for b in (4, 3, 2, 1)]), 16, 10).cast("long")
    each = rows.select("matrix_id", "row", "input_ids", "position_ids", "cu_seqlens",
                       F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("segment", "of"))
    each = each.withColumn("offset", word(F.col("segment"))).withColumn("end", word(F.col("segment") + 1))
    part = lambda c: F.crc32(F.substring(F.col(c), 2 * F.col("offset") + 1, 2 * (F.col("end") - F.col("offset"))))
    return each.select(F.col("of.doc_ids").alias("doc_id"), F.col("of.starts").alias("start"),
                       (F.col("end") - F.col("offset")).alias("length"), "matrix_id", "row", "segment",
                       "offset", part("input_ids").alias("ids_crc32"),
                       part("position_ids").alias("positions_crc32"))
