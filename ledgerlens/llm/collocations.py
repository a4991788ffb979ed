"""Phrase collocations from a weighted de Bruijn graph.

A text is cut into pieces and those into words. Edges of the graph are the grams of LONGEST
words, weighted by how often they occur; an edge leads from the node of its first
LONGEST - 1 words to that of its last ones, so edges overlap in a node. Every word
position gives exactly one row: its edge, or, near the end of a piece, the shorter gram
that is left there. The count of a shorter gram is therefore the flow out of it plus its
piece ends: the sum over the grams one word longer that begin with it, and the ends that
are just it. Nodes follow from edges, three words from nodes, and so on down to words.

Nodes that one edge enters and one leaves, both of the node's whole flow, are
unary. Paths through them are compacted by pointer doubling: a passage
that repeats becomes one path of one weight, of any length.

Phrases below the least count can't matter, nor can any that contains them. So a first
reading counts pairs of neighbouring words by hash, and pieces also end where a pair is too
rare. The pairs that stay are sent as a bit table of at most FILTER_BITS bits; a hash
that strays into it only ends a piece later, which changes no count of a phrase that is frequent.
Counts of words and of frequent phrases stay exact.

At scale: grams are combined per slice of text and again before the shuffle, so a frequent
gram is one row per task; no list of a phrase's occurrences is ever gathered, and the best per
language are found in hash slices first.

Defined results: a null text is empty; a null lang is ``und``, as is that name itself.
Repeated rows count each time, and doc_id plays no part. Pieces and words of any length are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import LOWER_MAP, Texts, Words, slices, strings, words_of

LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
#: The characters between pieces, of which all but line ends are marks here.
PIECE_MAP = LOWER_MAP.copy()
PIECE_MAP[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 10
SLICE = 8 << 20
FILTER_BITS, BITS_PER_PAIR = 1 << 27, 16
SLICES = 64
MAX_ROUNDS = 60
SEED = 42
GRAMS = "lang string, k int, gram string, c long"


class Slice:
    """Words of some texts, their languages, and which neighbours share a piece."""

    def __init__(self, batch: pa.RecordBatch, texts: Texts):
        self.words: Words = words_of(Texts(PIECE_MAP[texts.data], texts.offsets))
        self.codes, self.distinct = self.words.codes()
        lang = batch.column(batch.schema.get_field_index("lang")).fill_null(NO_LANG).dictionary_encode()
        self.langs = lang.dictionary
        self.lang = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.words.doc]
        marks = np.concatenate(([0], np.cumsum(self.words.data == 10)))
        piece = marks[self.words.starts]
        self.joined = (self.words.doc[1:] == self.words.doc[:-1]) & (piece[1:] == piece[:-1])

    def __len__(self) -> int:
        return len(self.codes)

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of (language, word, next word) for each word that has a next one, and those words."""
        at = np.flatnonzero(self.joined)
        one = xxhash.xxh3_64_intdigest
        word, lang = (np.fromiter((one(w, SEED) for w in d.to_pylist()), np.uint64, len(d))
                      for d in (self.distinct, self.langs))
        key = word[self.codes[at]] * np.uint64(0x9E3779B97F4A7C15) + word[self.codes[at + 1]]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + lang[self.lang[at]]
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return key ^ (key >> np.uint64(31)), at


def pair_counts(docs: DataFrame) -> DataFrame:
    """(key, c) of every pair of neighbouring words of a language, by hash."""
    def count(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, "text", SLICE):
            keys, times = np.unique(Slice(batch, texts).pair_keys()[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=["key", "c"])

    return (docs.select("lang", "text").mapInArrow(count, "key long, c long")
            .groupBy("key").agg(F.sum("c").alias("c")))


def pair_filter(docs: DataFrame, least: int = LEAST) -> np.ndarray:
    """Bits of the hashes of all pairs that occur ``least`` times or more. Their number is a power
    of two that follows the number of pairs, up to FILTER_BITS."""
    kept = shared.written(pair_counts(docs).filter(F.col("c") >= least).select("key"), "pairs")
    bits = 1 << 15
    while bits < min(FILTER_BITS, BITS_PER_PAIR * kept.count()):
        bits *= 2
    place = F.shiftrightunsigned("key", 64 - bits.bit_length() + 1) + 1
    rows = (kept.groupBy(F.bitmap_bucket_number(place).alias("at"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")))
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.collect():          # at most FILTER_BITS bits
        part = np.frombuffer(row.bits, np.uint8)
        out[(row.at - 1) * len(part):row.at * len(part)] = part
    return out


def longest_of(part: Slice, kept: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """The longest gram at each word, up to ``longest`` words and the end of its piece or a pair
    that ``kept`` lacks: distinct ones with their counts."""
    n = len(part)
    if not n:
        return
    keys, at = part.pair_keys()
    place = (keys >> np.uint64(64 - (len(kept) * 8).bit_length() + 1)).astype(np.int64)
    on = np.zeros(n, bool)
    on[at] = (kept[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
    length = np.ones(n, np.int64)
    alive = on.copy()
    for k in range(1, longest):
        length[alive] += 1
        rest = max(n - k, 0)
        alive[:rest] &= on[k:k + rest]
        alive[rest:] = False
    # all words one space apart: a gram is a stretch of that
    size = part.words.ends - part.words.starts
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    text = np.full(int(ends[-1]) + 1, 32, np.uint8)
    text[np.arange(int(size.sum())) + np.repeat(np.arange(n), size)] = part.words.data[part.words.inside]
    for k in range(1, longest + 1):
        at = np.flatnonzero(length == k)
        key = part.lang[at]
        for j in range(k):
            key, first = _numbered(key, part.codes[at + j], len(part.distinct))
        if not len(at):
            continue
        own = at[first]
        span = ends[own + k - 1] - begins[own]
        total = np.concatenate(([0], np.cumsum(span)))
        grams = strings(total, text[np.arange(int(total[-1])) + np.repeat(begins[own] - total[:-1], span)])
        yield pa.RecordBatch.from_arrays(
            [part.langs.take(pa.array(part.lang[own])), pa.array(np.full(len(own), k, np.int32)), grams,
             pa.array(np.bincount(key, minlength=len(own)).astype(np.int64))], names=["lang", "k", "gram", "c"])


def _numbered(key: np.ndarray, code: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 for distinct (key, code), and where each occurs first."""
    number, _ = pd.factorize(key * codes + code)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
    return number, first


def edges_and_ends(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, k, gram, c): edges (k = longest) with their weights, and shorter grams with their
    number of piece ends. The counts of a language add up to its words."""
    sent = docs.sparkSession.sparkContext.broadcast(pair_filter(docs, least))

    def read(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, "text", SLICE):
            yield from longest_of(Slice(batch, texts), sent.value, longest)

    found = (docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(read, GRAMS)
             .groupBy("lang", "k", "gram").agg(F.sum("c").alias("c")))
    return shared.written(found, "grams")


def head(gram, words) -> Column:
    """The first ``words`` words (a number or a column)."""
    return F.call_function("substring_index", gram, F.lit(" "), F.lit(words))


def tail(gram, words) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), -F.lit(words))


def frequent_grams(grams: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, k, gram, a): all grams of 1 to ``longest`` words with a count of ``least`` or more,
    by the flow out of them and the piece ends."""
    flow = grams.filter(F.col("k") == longest).select("lang", "gram", F.col("c").alias("a"))
    out = None
    for k in range(longest, 0, -1):
        kept = flow.filter(F.col("a") >= least).select("lang", F.lit(k).alias("k"), "gram", "a")
        out = kept if out is None else out.union(kept)
        if k > 1:
            ends = grams.filter(F.col("k") == k - 1).select("lang", "gram", F.col("c").alias("a"))
            flow = (flow.select("lang", head(F.col("gram"), k - 1).alias("gram"), "a").union(ends)
                    .groupBy("lang", "gram").agg(F.sum("a").alias("a")))
    return shared.written(out, "frequent-grams")


def compact_paths(frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, path, weight, edges): the edges of ``frequent`` (all of them at or above its least
    count), joined where the node between two carries just their weight. Each edge is in one path.

    An edge can't be longer than the flow of its nodes, so equal weights say that nothing else
    enters or leaves there and no piece begins or ends. Such chains have no cycles, as every
    occurrence of one's node would need another before it in its piece."""
    edges = frequent.filter(F.col("k") == longest).select("lang", "gram", F.col("a").alias("weight"))
    nodes = frequent.filter(F.col("k") == longest - 1).select("lang", F.col("gram").alias("node"),
                                                              F.col("a").alias("weight"))
    into = edges.select("lang", tail(F.col("gram"), longest - 1).alias("node"), "weight", F.col("gram").alias("before"))
    out_of = edges.select("lang", head(F.col("gram"), longest - 1).alias("node"), "weight", "gram")
    before = into.join(nodes, ["lang", "node", "weight"]).join(out_of, ["lang", "node", "weight"])
    # root: as far back as known; steps: how many edges that is
    now = shared.written(
        edges.join(before.select("lang", "gram", "before"), ["lang", "gram"], "left").select(
            "lang", "gram", "weight", F.coalesce("before", "gram").alias("root"),
            F.col("before").isNotNull().cast("long").alias("steps")), "paths")
    for _ in range(MAX_ROUNDS):
        far = now.filter("steps > 0").select("lang", F.col("gram").alias("root"), F.col("root").alias("far"),
                                             F.col("steps").alias("more"))
        moved = now.join(far, ["lang", "root"], "left")
        if moved.filter("far is not null").isEmpty():
            break
        now = shared.written(moved.select("lang", "gram", "weight", F.coalesce("far", "root").alias("root"),
                                          (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "paths")
    else:
        raise RuntimeError(f"paths did not settle in {MAX_ROUNDS} rounds")
    links = F.array_sort(F.collect_list(F.struct("steps", tail(F.col("gram"), 1).alias("word"))))
    return (now.groupBy("lang", "root", "weight").agg(links.alias("links"))
            .select("lang", F.concat_ws(" ", head(F.col("root"), longest - 1), F.col("links.word")).alias("path"),
                    "weight", F.size("links").cast("long").alias("edges")))


def covered(frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, gram, a): grams inside a longer frequent one that occurs ``a`` times. One word
    longer is enough, as counts between equal ones are equal. Nodes come from the compacted paths."""
    words = F.split("path", " ", -1)
    at = F.sequence(F.lit(1), F.size("words") - (longest - 2))
    nodes = (compact_paths(frequent, longest).select("lang", words.alias("words"), F.col("weight").alias("a"))
             .select("lang", F.explode(F.transform(at, lambda i: F.array_join(
                 F.slice("words", i, longest - 1), " "))).alias("gram"), "a"))
    inner = frequent.filter((F.col("k") > 2) & (F.col("k") < longest)).select(
        "lang", F.explode(F.array(head(F.col("gram"), F.col("k") - 1),
                                  tail(F.col("gram"), F.col("k") - 1))).alias("gram"), "a")
    return nodes.union(inner).distinct()


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases at their lowest cut, the first of equal ones.
    Products are whole decimals, exact up to 38 digits. ``frequent`` must hold all parts."""
    parts = frequent.select("lang", "gram", "a")
    phrases = frequent.filter("dropped is null and k > 1")
    cuts = (phrases.select("lang", "gram", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "k")
            .select("lang", F.col("gram").alias("phrase"), "a", "cut",
                    head(F.col("gram"), F.col("cut")).alias("first"),
                    tail(F.col("gram"), F.col("k") - F.col("cut")).alias("rest"))
            .join(parts.select("lang", F.col("gram").alias("first"), F.col("a").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("gram").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
            .join(totals, "lang"))
    score = F.expr("cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))"
                   " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """docs (lang, text, ...) -> lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases
    of 2 to ``longest`` words by score, count and phrase."""
    grams = edges_and_ends(docs, least, longest)
    frequent = frequent_grams(grams, least, longest)
    # a row per language: small enough to be sent to all tasks, which Spark decides by its size
    totals = shared.written(grams.groupBy("lang").agg(F.sum("c").alias("n")), "totals")
    inside = covered(frequent, longest).withColumn("dropped", F.lit(True))
    marked = frequent.join(inside, ["lang", "gram", "a"], "left")
    rows = scored(marked, totals)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(shared.table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
word AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM word, (VALUES (1), (2), (3), (4), (5)) AS s(k) WHERE len(w) >= k)),
frequent AS (SELECT lang, k, gram, count(*) AS a FROM gram GROUP BY lang, k, gram HAVING count(*) >= 100),
candidate AS (
  SELECT * FROM frequent AS f WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM frequent AS h WHERE h.lang = f.lang AND h.k > f.k AND 100 * h.a >= 100 * f.a
      AND contains(' ' || h.gram || ' ', ' ' || f.gram || ' '))),
cut AS (
  SELECT c.lang, c.gram, c.a, t.n, j,
         array_to_string(string_split(c.gram, ' ')[1:j], ' ') AS first,
         array_to_string(string_split(c.gram, ' ')[j + 1:], ' ') AS rest
  FROM candidate AS c JOIN total AS t USING (lang), (VALUES (1), (2), (3), (4)) AS s(j) WHERE j < c.k),
score AS (
  SELECT cut.lang, cut.gram AS phrase, cut.a, l.a AS l, r.a AS r, cut.n, j,
         ((1000::HUGEINT * cut.a * cut.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cut JOIN frequent AS l ON l.lang = cut.lang AND l.gram = cut.first
           JOIN frequent AS r ON r.lang = cut.lang AND r.gram = cut.rest),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM score),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
