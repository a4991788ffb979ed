"""SimHash near-duplicates by meeting in the middle of Hamming balls.

Documents with equal fingerprints form a class; its smallest doc_id stands for
it. Every distinct fingerprint emits all variants within half the radius (for
radius 2: itself and 64 one-bit changes). Fingerprints within the radius share a
variant, and one shuffle brings these together. A variant is shared by at most
as many fingerprints as it emits itself (65), whatever the data, so each hangs
on the smallest there; the pairs are then deduplicated, verified by their
distance, and joined to components.

Nulls: a null text is empty and has fingerprint zero, as any text without words.
A document with a null id gets a fingerprint and the component of its class, null
if no document there has an id. Rows that repeat an id with another text are
documents of their own. Very long texts are hashed whole, in arrays of their own size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.components import components
from ledgerlens.llm.textbytes import slices, words_of

SHINGLE, RADIUS, SEED = 3, 2, 42
VOTE_ROWS = 1 << 15
#: Text bytes that a task hashes at a time; a longer text is read whole.
SLICE = 1 << 20


def fingerprints_of(texts, size: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text over its word shingles, repeats included."""
    words = words_of(texts, lower=True)
    lens = words.ends - words.starts
    # all words of all texts, each followed by one space
    ends = np.cumsum(lens + 1) - 1
    begins = ends - lens
    joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    joined[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = words.data[words.inside]
    joined = joined.tobytes()
    n = np.bincount(words.doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(n)))
    # a text with fewer words than a shingle has one shingle of all of them
    per = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(per)[:-1])), per) + np.arange(per.sum())
    last = np.minimum(at + size - 1, np.repeat(first[1:], per) - 1)
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[b:e], SEED) for b, e in zip(begins[at].tolist(), ends[last].tolist())],
                      dtype=">u8")
    votes = np.zeros((len(texts), 64), np.int64)
    doc = np.repeat(np.arange(len(texts)), per)
    for k in range(0, len(hashes), VOTE_ROWS):
        bits = np.unpackbits(hashes[k:k + VOTE_ROWS].view(np.uint8).reshape(-1, 8), axis=1)
        own = doc[k:k + VOTE_ROWS]
        cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        votes[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > per[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                     name: str = "fingerprint", size: int = SHINGLE) -> DataFrame:
    """``keep`` columns (all by default) and the fingerprint as a long."""
    keep = docs.columns if keep is None else keep
    schema = docs.select(*keep).schema.add(name, "long")

    def mark(batches):
        for batch, texts in slices(batches, text, SLICE):
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(fingerprints_of(texts, size).view(np.int64))], names=[*keep, name])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(mark, schema)


def ball(fp: Column, radius: int) -> Column:
    """All fingerprints within ``radius`` bits of ``fp``."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
    return F.transform(signed, lambda m: fp.bitwiseXOR(m))


def link_fingerprints(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """classes (fp, rep) -> (rep, component_id) of those that have a link.

    An odd radius needs balls of (radius + 1) / 2 on either side; pairs beyond the
    radius that meet there are dropped by their distance, so a star is no longer
    enough and each variant's pairs are listed; a ball bounds their number."""
    half = (radius + 1) // 2
    variants = classes.select("fp", "rep", F.explode(ball(F.col("fp"), half)).alias("variant"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2")))
    if radius % 2 == 0:
        # all that share a variant are within the radius of each other: a star links them
        groups = variants.groupBy("variant").agg(F.collect_list(F.struct("rep", "fp")).alias("all"))
        pairs = groups.filter(F.size("all") > 1).select(
            F.array_min("all").alias("least"), F.explode("all").alias("other")).select(
            F.col("least.rep").alias("rep"), F.col("least.fp").alias("fp"),
            F.col("other.rep").alias("rep2"), F.col("other.fp").alias("fp2")).filter("rep <> rep2")
    else:
        a = variants.repartition("variant")
        b = a.select("variant", F.col("rep").alias("rep2"), F.col("fp").alias("fp2"))
        pairs = a.join(b, "variant").filter("rep < rep2").select("rep", "fp", "rep2", "fp2")
    edges = pairs.distinct().filter(distance <= radius)
    return components(edges, "rep", "rep2").withColumnRenamed("node", "rep")


def _found(docs: DataFrame, size: int, radius: int) -> DataFrame:
    """doc_id, fp, row, first of every row. ``row`` is (doc_id, hash of the text), so that
    an id with several texts links nothing; ``first`` is the smallest row of the component."""
    row = F.struct("doc_id", F.xxhash64("text").alias("digest"))
    keyed = docs.select("doc_id", "text", row.alias("row"))
    marked = shared.written(with_fingerprint(keyed, keep=["doc_id", "row"], name="fp", size=size), "fingerprints")
    classes = marked.filter("doc_id is not null").groupBy("fp").agg(F.min("row").alias("rep"))
    classes = shared.written(classes, "fingerprint-classes")
    linked = link_fingerprints(classes, radius)
    ids = classes.join(linked, "rep", "left").select("fp", F.coalesce("component_id", "rep").alias("first"))
    return marked.join(ids, "fp", "left")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, fp (long), component_id."""
    return _found(docs, size, radius).select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def keep_first(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of every component, with its columns. Rows that
    repeat an id and its text count as one document (if they differ in other columns, any of them stays), those that repeat an id with another
    text as documents of their own; those without id all stay."""
    lost = (_found(docs, size, radius).filter("doc_id is not null and row <> first")
            .select("row.doc_id", "row.digest").distinct())
    own = shared.free_prefix(docs.columns, "_digest")
    left = (docs.filter("doc_id is not null").withColumn(own, F.xxhash64("text"))
            .join(lost.withColumnRenamed("digest", own), ["doc_id", own], "left_anti"))
    return (left.dropDuplicates(["doc_id", own]).select(*docs.columns)
            .union(docs.filter("doc_id is null")))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(shared.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
