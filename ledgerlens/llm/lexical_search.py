"""Ranked lexical search with range-maximum tables.

Index: documents are read in blocks of about BLOCK_BYTES of text; a block becomes one row
with its documents in ascending doc_id order and a posting list (document, occurrences)
per term. Nothing is shuffled and every row of the input is in exactly one block.

Search: what a term adds to a document's score is its weight times its impact there. A
block gives every posting list of a query term a sparse table, whose level j holds the
largest impact, and where it is, of each 2**j neighbouring postings; the largest impact of a term
in any interval of documents is then the larger of two entries. The sum over the query's
terms bounds every score in the interval. Best first: the interval with the
highest bound is split at its document of largest impact; that document is scored
exactly and the two intervals beside it get bounds of their own. A query ends in a block
when no bound reaches its K-th best score. Intervals are taken WIDTH at a time, so that the table look-ups are
vectors; a task carries the K best of each query from block to block and returns them
once, and two steps of K best per hash slice and K best of those follow.

Queries come in groups of at most QUERY_BYTES of text (or one longer query), which go to
all tasks; the weights need only the document counts of the group's own terms. Nothing else grows on the
driver.

Defined results: a null or empty text has no terms; a document without terms counts
neither in N nor in L and is never found. Rows that repeat a doc_id are documents of their
own; a null doc_id ranks behind equal scores. Item rows that repeat an id and a text are
one query, rows that repeat an id with another text have ranks of their own. Terms of any length are whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import LETTERS, LOWER_MAP, DIGITS, Texts, slices, words_of

K, B = 10, 75
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 1 << 16
QUERY_BYTES = 4 << 20
#: Intervals that are split at a time.
WIDTH = 64
#: A document's number in its block is kept below its impact in one whole number.
DOC_BITS = 20
DOC_MASK = (1 << DOC_BITS) - 1
NO_ID = np.iinfo(np.int64).max
#: Bytes of terms, in lower case, all others as spaces.
TERM_MAP = np.where(LETTERS | DIGITS, LOWER_MAP, 32).astype(np.uint8)
INDEX = ("n_docs long, n_terms long, ids binary, sizes binary, terms array<string>, "
         "lengths binary, docs binary, counts binary")
SLICES = 64


def terms_of(texts: Texts):
    """Words of ``texts``: their documents, their numbers, and the distinct words."""
    words = words_of(Texts(TERM_MAP[texts.data], texts.offsets))
    codes, distinct = words.codes()
    return words.doc, codes, distinct


def block_row(ids: np.ndarray, texts: Texts) -> list:
    """One index row: posting lists by term, each in ascending document order."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    doc, code, distinct = terms_of(texts)
    sizes = np.bincount(place[doc], minlength=len(ids))
    pair, counts = np.unique(code * len(ids) + place[doc], return_counts=True)
    lengths = np.bincount(pair // max(len(ids), 1), minlength=len(distinct))
    return [int((sizes > 0).sum()), int(sizes.sum()), ids[order].tobytes(), sizes.astype(np.int64).tobytes(),
            distinct.to_pylist(), lengths.astype(np.int32).tobytes(),
            (pair % max(len(ids), 1)).astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()]


def build_index(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) -> the written index, one row per block of documents."""
    def build(batches: Iterator[pa.RecordBatch]):
        names = [f.split()[0] for f in INDEX.split(", ")]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 3]
        for batch, texts in slices(batches, "text", BLOCK_BYTES):
            ids = pc.fill_null(batch.column(0), NO_ID).to_numpy(zero_copy_only=False)
            for k in range(0, len(ids), BLOCK_ROWS):
                at = texts.offsets[k:k + BLOCK_ROWS + 1]
                row = block_row(ids[k:k + BLOCK_ROWS], Texts(texts.data[at[0]:at[-1]], at - at[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, types)], names=names)

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return shared.written(narrow.mapInArrow(build, INDEX), "lexical-index")


class Block:
    """Posting lists of one block for the terms of ``vocabulary``, and their sparse tables."""

    def __init__(self, row: dict, vocabulary: pa.Array, n_all: int, l_all: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        number = pc.index_in(pa.array(row["terms"], pa.string()), vocabulary)
        number = pc.fill_null(number, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        asked = np.flatnonzero(number >= 0)
        asked = asked[np.argsort(number[asked])]
        lengths, begins = lengths[asked], begins[asked]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(begins - (ends - lengths), lengths)
        docs = np.frombuffer(row["docs"], np.int32)[at].astype(np.int64)
        counts = np.frombuffer(row["counts"], np.int32)[at].astype(np.int64)
        m = 100 - B + (B * sizes[docs] * n_all) // max(l_all, 1)
        impact = (1_000_000_000 * counts) // (1000 * counts + 8 * m)
        own = np.repeat(number[asked], lengths)
        self.keys = (own << DOC_BITS) | docs
        # per term of the vocabulary: where its list begins and ends
        self.begin = np.zeros(len(vocabulary), np.int64)
        self.end = np.zeros(len(vocabulary), np.int64)
        self.begin[number[asked]], self.end[number[asked]] = ends - lengths, ends
        # the smallest of equally strong documents first
        level = (impact << DOC_BITS) | (DOC_MASK - docs)
        self.table = [level]
        longest = int(lengths.max()) if len(lengths) else 0
        step = 1
        while 2 * step <= longest:
            nxt = level.copy()
            np.maximum(level[:-step], level[step:], out=nxt[:-step])
            self.table.append(nxt)
            level, step = nxt, 2 * step
        # look-ups take any level: one long array, a level after the other
        self.width = total
        self.table = np.concatenate(self.table)

    def strongest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Largest impact, with its document, of postings lo to hi; 0 where there are none."""
        out = np.zeros(lo.shape, np.int64)
        some = lo < hi
        a, b = lo[some], hi[some]
        level = np.frexp(b - a)[1].astype(np.int64) - 1
        base = level * self.width
        out[some] = np.maximum(self.table[base + a], self.table[base + b - (1 << level)])
        return out

    def search(self, terms: np.ndarray, weight: np.ndarray, best: tuple[np.ndarray, np.ndarray],
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores, ids; highest score, then smallest id first) with this block's documents."""
        here = self.begin[terms] < self.end[terms]
        terms, weight = terms[here], weight[here]
        if not len(terms):
            return best
        prefix = terms << DOC_BITS
        lo, hi = self.begin[terms][None, :], self.end[terms][None, :]
        top = self.strongest(lo, hi)
        bound, first = (top >> DOC_BITS) @ weight, np.zeros(1, np.int64)
        while True:
            open_ = self._open(bound, first, best, k)
            if not open_.any():
                return best
            lo, hi, top, bound, first = lo[open_], hi[open_], top[open_], bound[open_], first[open_]
            take = np.lexsort((first, -bound))[:WIDTH]
            left = np.ones(len(bound), bool)
            left[take] = False
            # each interval is split at the document where one term adds most
            strong = np.argmax((top[take] >> DOC_BITS) * weight, axis=1)
            doc = DOC_MASK - (top[take, strong] & DOC_MASK)
            at = np.searchsorted(self.keys, prefix[None, :] | doc[:, None])
            at = np.clip(at, lo[take], hi[take])
            hit = at < hi[take]
            hit[hit] = (self.keys[at[hit]] & DOC_MASK) == np.broadcast_to(doc[:, None], hit.shape)[hit]
            impact = np.zeros(at.shape, np.int64)
            impact[hit] = self.table[at[hit]] >> DOC_BITS
            best = _best(np.concatenate((best[0], impact @ weight)),
                         np.concatenate((best[1], self.ids[doc])), k)
            lo2, hi2 = np.concatenate((lo[take], at + hit)), np.concatenate((at, hi[take]))
            first2 = np.concatenate((first[take], doc + 1))
            top2 = self.strongest(lo2, hi2)
            bound2 = (top2 >> DOC_BITS) @ weight
            lo, hi, top = (np.concatenate((a[left], b)) for a, b in ((lo, lo2), (hi, hi2), (top, top2)))
            bound, first = np.concatenate((bound[left], bound2)), np.concatenate((first[left], first2))

    def _open(self, bound, first, best, k) -> np.ndarray:
        """Intervals that may hold one of the k best: a higher score, or an equal one of a smaller id."""
        if len(best[0]) < k:
            return bound > 0
        least = self.ids[np.minimum(first, len(self.ids) - 1)]
        return (bound > best[0][-1]) | ((bound == best[0][-1]) & (least < best[1][-1]))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    order = order[score[order] > 0]
    return score[order], ids[order]


def query_groups(queries: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Distinct (item, text) rows in lists of about QUERY_BYTES of text."""
    group, size = [], 0
    for row in queries.select(item, text).distinct().toLocalIterator():
        body = (row[1] or "").encode()
        if group and size + len(body) > QUERY_BYTES:
            yield group
            group, size = [], 0
        group.append((row[0], body))
        size += len(body)
    if group:
        yield group


def _asked(group: list[tuple]) -> tuple[pa.Array, list[list[tuple[int, int]]]]:
    """The group's distinct terms, and per query (term number, occurrences)."""
    offsets = np.concatenate(([0], np.cumsum([len(b) for _, b in group])))
    texts = Texts(np.frombuffer(b"".join(b for _, b in group), np.uint8), offsets)
    doc, code, distinct = terms_of(texts)
    counts = [Counter() for _ in group]
    for d, c in zip(doc.tolist(), code.tolist()):
        counts[d][c] += 1
    return distinct, [sorted(c.items()) for c in counts]


def document_counts(index: DataFrame, vocabulary: pa.Array) -> np.ndarray:
    """In how many documents each term of ``vocabulary`` occurs."""
    asked = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        total = np.zeros(len(asked.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                number = pc.index_in(pa.array(row["terms"], pa.string()), asked.value)
                known = pc.is_valid(number).to_numpy(zero_copy_only=False)
                total[number.drop_null().to_numpy()] += np.frombuffer(row["lengths"], np.int32)[known]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    for row in (index.select("terms", "lengths").mapInArrow(count, "term long, df long")
                .groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()):
        out[row.term] = row.df
    return out


def weight_of(n_all: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))


def _group_results(index: DataFrame, group: list[tuple], n_all: int, l_all: int, k: int) -> DataFrame:
    """The k best documents of each query by task: query number, doc_id, score, part."""
    vocabulary, counts = _asked(group)
    df = document_counts(index, vocabulary)
    weight = np.array([weight_of(n_all, d) if d else 0 for d in df.tolist()], np.int64)
    plans = []
    for terms in counts:
        number = np.array([t for t, _ in terms], np.int64)
        times = np.array([c for _, c in terms], np.int64)
        use = weight[number] > 0 if len(number) else np.zeros(0, bool)
        plans.append((number[use], (weight[number] * times)[use] if len(number) else times))
    sent = index.sparkSession.sparkContext.broadcast((vocabulary, plans))

    def find(batches):
        words, asked = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, words, n_all, l_all)
                best = [block.search(*plan, found, k) for plan, found in zip(asked, best)]
        query = np.repeat(np.arange(len(asked)), [len(s) for s, _ in best])
        score = np.concatenate([s for s, _ in best])
        ids = np.concatenate([i for _, i in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ids, mask=ids == NO_ID), pa.array(score)],
            names=["query", "doc_id", "score"])

    return (index.select("ids", "sizes", "terms", "lengths", "docs", "counts")
            .mapInArrow(find, "query long, doc_id long, score long")
            .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SLICES))))


def search(index: DataFrame, queries: DataFrame, k: int = K, item: str = "item_id",
           text: str = "text") -> DataFrame:
    """queries (item, text, ...) -> item, rank, doc_id, score of the k best documents with a
    score above 0, equal scores by ascending doc_id."""
    spark = index.sparkSession
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_all, l_all = total.n or 0, total.l or 0
    item_type = queries.schema[item].dataType.simpleString()
    found = spark.createDataFrame([], f"item {item_type}, query long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in query_groups(queries, item, text):
        rows = _group_results(index, group, n_all, l_all, k)
        for keys in (["query", "part"], ["query"]):
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            rows = rows.withColumn("rank", rank).filter(F.col("rank") <= k)
        items = spark.createDataFrame([(i, q) for q, (i, _) in enumerate(group)],
                                      f"item {item_type}, query long")
        found = found.union(shared.written(
            rows.join(F.broadcast(items), "query").select("item", "query", "rank", "doc_id", "score"), "found"))
    return found.select(F.col("item").alias(item), "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(shared.table(spark, sf_dir, "documents"))
    return search(index, shared.table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row_key,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_all, sum(len(terms))::BIGINT AS l_all FROM words),
posting AS (
  SELECT row_key, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_key, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM words)
  GROUP BY row_key, doc_id, n, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM posting, total GROUP BY term, n_all),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, row_key,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_all) // l_all))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN posting USING (term), total
  GROUP BY item_id, doc_id, row_key),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
