"""Minimum-bin-slack packing of token documents into fixed windows.

Documents are cut into full windows and a rest; each full window is a sequence of
its own. The rests of a block of documents form a multiset of lengths. For each
window the longest length left is set, and a subset-sum dynamic programme over
bitsets finds the multiset of other lengths that comes closest to capacity; the
snapshots before each step give the counts back. A filling without slack is
repeated as often as the counts allow. If slack remains, the longest document
left is cut to close it (the cut loses nothing: its rest goes back). So only the
last window of a block is short; its pieces go on to the next block, and those of
a task's last block are packed once more with those of other tasks.

Memory is bounded by the block, texts are never shuffled, and a lost task is
computed anew from its own input. The pieces are written once to the shared
folder. Nulls: a null text has the end id only; a null doc_id is carried. Rows that
repeat a doc_id are packed each for itself.
"""

from __future__ import annotations

from collections import defaultdict

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
#: Tasks whose last pieces are packed together: at most this many short windows.
TASKS_TOGETHER = 512
_TASK_BITS = 33

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("task", T.LongType()), T.StructField("ids", T.BinaryType())])
ARROW = pa.schema([(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES])


def closest_fill(counts: dict[int, int], lengths: list[int], target: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near below ``target``
    as can be. ``lengths``: those with a count, longest first."""
    reach, steps, mask = 1, [], (1 << (target + 1)) - 1
    for length in lengths:
        if length > target:
            continue
        left, k = min(counts[length], target // length), 1
        while left > 0:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, k = left - k, 2 * k
        if reach >> target:
            break
    total, taken = reach.bit_length() - 1, defaultdict(int)
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += k
            total -= length * k
    return taken


def windows(lengths: np.ndarray, capacity: int = CAPACITY):
    """Pack pieces of ``lengths`` (1 to capacity). Yields windows, lists of
    (piece, start in it, length); all are full but, maybe, the last."""
    stock = defaultdict(list)
    for i, length in enumerate(lengths.tolist()):
        stock[length].append((i, 0))
    counts = {k: len(v) for k, v in stock.items()}
    order = sorted(counts, reverse=True)

    def take(length):
        counts[length] -= 1
        i, at = stock[length].pop()
        return i, at, length

    while True:
        order = [x for x in order if counts[x]]
        if not order:
            return
        anchor = order[0]
        counts[anchor] -= 1
        taken = closest_fill(counts, order, capacity - anchor) if anchor < capacity else {}
        counts[anchor] += 1
        need = defaultdict(int, taken)
        need[anchor] += 1
        slack = capacity - sum(k * n for k, n in need.items())
        for _ in range(1 if slack else min(counts[k] // n for k, n in need.items())):
            window = [take(k) for k, n in need.items() for _ in range(n)]
            if slack and (rest := next((x for x in order if counts[x]), 0)):
                # every length left is longer than the slack: cut the longest
                i, at, length = take(rest)
                window.append((i, at, slack))
                tail = length - slack
                stock[tail].append((i, at + slack))
                counts[tail] = counts.get(tail, 0) + 1
                order = sorted({*order, tail}, reverse=True)
            yield window


class Packer:
    """Packs the documents of one task, block by block."""

    def __init__(self, task: int, first_id: int, capacity: int, block: int):
        self.task, self.next_id, self.capacity, self.block = task, first_id, capacity, block
        self.rest: list[tuple] = []       # (doc_id, start, doc_tokens, ids)
        self.tokens = 0
        self.out: list[tuple] = []

    def put(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        cap = self.capacity
        full = len(ids) // cap * cap
        for at in range(0, full, cap):
            self.emit(doc_id, start + at, ids[at:at + cap], doc_tokens, self.next_id, 0)
            self.next_id += 1
        if len(ids) > full:
            self.rest.append((doc_id, start + full, doc_tokens, ids[full:].copy()))
            self.tokens += len(ids) - full

    def emit(self, doc_id, start, ids, doc_tokens, sequence, offset) -> None:
        self.out.append((doc_id, start, len(ids), doc_tokens, sequence, offset, self.task,
                         ids.astype("<u4").tobytes()))

    def pack(self, last: bool = False, close: bool = False) -> None:
        """``last``: hand the short window's pieces out; ``close``: as a sequence."""
        pieces, self.rest, self.tokens = self.rest, [], 0
        for window in windows(np.array([len(p[3]) for p in pieces], np.int64), self.capacity):
            short = sum(x[2] for x in window) < self.capacity
            offset = 0
            for i, at, length in window:
                doc_id, start, doc_tokens, ids = pieces[i]
                part = ids[at:at + length]
                if short and not last:
                    self.rest.append((doc_id, start + at, doc_tokens, part))
                    self.tokens += length
                elif short and not close:
                    self.emit(doc_id, start + at, part, doc_tokens, None, None)
                else:
                    self.emit(doc_id, start + at, part, doc_tokens, self.next_id, offset)
                    offset += length
            self.next_id += 1

    def flush(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(ARROW)], schema=ARROW)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   block: int = BLOCK_TOKENS) -> DataFrame:
    """docs (doc_id, text) -> pieces with their ids (little-endian unsigned 32 bits),
    sequence and offset there."""

    def first(batches):
        task = TaskContext.get().partitionId()
        packer, waiting = Packer(task, task << _TASK_BITS, capacity, block), 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, batch.column(1)):
                ids = ids_of(text.as_py(), end_id)
                packer.put(doc_id, 0, ids, len(ids))
                waiting += len(ids)
                if packer.tokens >= block:
                    packer.pack()
                if waiting >= block:
                    yield packer.flush()
                    waiting = 0
        packer.pack(last=True)
        yield packer.flush()

    def second(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        rows = rows.sort_by([("task", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        packer = Packer(group, (1 << 62) + (group << _TASK_BITS), capacity, block)
        for r in rows.to_pylist():
            packer.put(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
        packer.pack(last=True, close=True)
        return pa.Table.from_batches([packer.flush()])

    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(first, PIECES)
    pieces = shared.written(pieces, "pieces")
    rest = (pieces.filter("sequence_id is null")
            .groupBy(F.expr(f"task div {TASKS_TOGETHER}").alias("tasks")).applyInArrow(second, PIECES))
    return pieces.filter("sequence_id is not null").unionByName(rest).drop("task")


def op3_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack_documents(shared.table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
