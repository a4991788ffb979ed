"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its terms are the words (case of A-Z folded; a word is
cut after every TERM_BYTES bytes, so that texts without spaces have terms too) and a
term's weight S is how often it occurs. For sample k every term draws, from a
hash of itself and k alone, r and c from Gamma(2, 1) and b uniformly; then

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1),

and the term with the least a gives the sample (term, t). Two texts have equal samples
with probability sum(min(S1, S2)) / sum(max(S1, S2)), their generalised Jaccard
similarity. A fingerprint holds SAMPLES of them, each as an 8-bit code of (term, t); code 0 is kept
for texts without terms. Different samples share a code once in CODES times, so the share s of equal
codes gives the likeness (s - 1 / CODES) / (1 - 1 / CODES), and 0 where that is negative.

At scale: draws are made once per distinct (term, weight) of a slice of texts, not per
text. Documents meet the next one in ascending doc_id order by one range shuffle; a
task streams its sorted rows and holds a slice of them. Only the first and last row of
each partition leave it, through a written table; they are joined by partition number, and
the driver sees only the numbers of the partitions that have rows.

Defined results: a null text is empty; a text without terms has the fingerprint of zeros,
which is like any other such (1) and like no other text. Rows that repeat a doc_id follow
each other by the hash of their text; a null doc_id comes before all others. The next
document of a single one is itself. Long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import texts_of, words_of

SAMPLES, CODES = 128, 255
TERM_BYTES = 16
SEED = 42
#: Text bytes that a task works on at a time, and rows of draws and of terms held in one array.
SLICE, DRAWS, ROWS = 1 << 20, 1 << 8, 1 << 9
FIRST, LAST = "first", "last"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 32-bit function of ``x`` (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


@lru_cache(maxsize=4)
def _salts(samples: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, size=(5, samples), dtype=np.uint32)


def _uniform(half: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1, a step of 2**-23 apart, for each row and salt."""
    x = _mixed(half[:, None] ^ salts)
    x >>= np.uint32(9)
    u = x.astype(np.float32)
    u += np.float32(0.5)
    u *= np.float32(2.0 ** -23)
    return u


def draws_of(term: np.ndarray, weight: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """(rows, samples) keys of terms (64-bit hashes) with their weights; the least key of a
    text's terms is its sample. Upper bits order by ln a, the lowest 16 are the code."""
    salts, low, high = _salts(samples), term.astype(np.uint32), (term >> np.uint64(32)).astype(np.uint32)
    r = -np.log(_uniform(low, salts[0]) * _uniform(high, salts[1]))
    c = -np.log(_uniform(low, salts[2]) * _uniform(high, salts[3]))
    b = _uniform(low, salts[4])
    t = np.floor(np.log(weight).astype(np.float32)[:, None] / r + b)
    ln_a = np.log(c) - r * (t - b + 1)
    # floats as whole numbers of the same order
    order = ln_a.view(np.int32)
    order ^= (order >> np.int32(31)) & np.int32(0x7FFFFFFF)
    code = term[:, None] + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    code *= np.uint64(0xD6E8FEB86659FD93)
    code >>= np.uint64(48)
    return (order.astype(np.int64) << 16) | np.maximum(code, np.uint64(1)).astype(np.int64)


def terms_of(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: the text and the number of the (term, weight) of each term of each text,
    text by text; the hash and the weight behind each of those numbers."""
    words = words_of(texts, lower=True)
    lens = words.ends - words.starts
    if (lens > TERM_BYTES).any():
        parts = -(-lens // TERM_BYTES)
        part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        words.starts = np.repeat(words.starts, parts) + part * TERM_BYTES
        words.ends = np.minimum(words.starts + TERM_BYTES, np.repeat(words.ends, parts))
        words.doc = np.repeat(words.doc, parts)
        size = np.concatenate(([0], np.cumsum(words.ends - words.starts))).astype(np.int32)
        # pieces of characters are no valid strings, so binary
        column = pa.BinaryArray.from_buffers(pa.binary(), len(size) - 1, [
            None, pa.py_buffer(size), pa.py_buffer(np.ascontiguousarray(words.data[words.inside]))])
    else:
        column = words.strings().cast(pa.binary())
    found = column.dictionary_encode()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = max(len(found.dictionary), 1)
    one = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((one(w, SEED) for w in found.dictionary.to_pylist()), np.uint64, len(found.dictionary))
    pair, at = pd.factorize(words.doc * n + code)
    weight = np.bincount(pair, minlength=len(at)).astype(np.int64)
    doc, code = at // n, at % n
    top = int(weight.max()) + 1 if len(weight) else 1
    kind, own = pd.factorize(code * top + weight)
    return doc, kind, hashes[own // top], own % top


def fingerprints_of(texts, samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) codes: 0 without terms, else 1 to CODES."""
    doc, kind, term, weight = terms_of(texts)
    out = np.zeros((len(texts), samples), np.uint8)
    if not len(doc):
        return out
    keys = np.empty((len(term), samples), np.int64)
    for k in range(0, len(term), DRAWS):
        keys[k:k + DRAWS] = draws_of(term[k:k + DRAWS], weight[k:k + DRAWS], samples)
    least = np.full((len(texts), samples), np.iinfo(np.int64).max)
    # factorize lists the terms text by text
    for k in range(0, len(doc), ROWS):
        own = doc[k:k + ROWS]
        cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        best = np.minimum.reduceat(keys[kind[k:k + ROWS]], cut, axis=0)
        least[own[cut]] = np.minimum(least[own[cut]], best)
    some = np.bincount(doc, minlength=len(texts)) > 0
    out[some] = 1 + (least[some] & 0xFFFF) % CODES
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    share = (a == b).mean(axis=-1)
    return np.clip((share - 1 / CODES) / (1 - 1 / CODES), 0, 1)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _marks(texts: list[str]) -> np.ndarray:
    return fingerprints_of(texts_of(pa.array(texts, pa.large_string())))


def _binary(codes: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in codes], pa.binary())


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _rows(ids: pa.Array, texts: list[str], marks: np.ndarray, other: list[str], other_marks: np.ndarray,
          next_marks: np.ndarray) -> dict:
    """Result columns of texts, their edited texts and what follows them."""
    return {"doc_id": ids, "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in other], pa.string()),
            "fp": _binary(marks), "edited_fp": _binary(other_marks),
            "near_edited": pa.array(likeness(marks, other_marks), pa.float64()),
            "near_next": pa.array(likeness(marks, next_marks), pa.float64())}


def _some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, list[str]]]:
    """(partition, ids, texts) in ranges of about SLICE bytes."""
    for batch in batches:
        size = texts_of(batch.column(2)).offsets
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE, "right")) - 1)
            to = min(to, batch.num_rows)
            part = batch.slice(at, to - at)
            yield part.column(0)[0].as_py(), part.column(1), [t or "" for t in part.column(2).to_pylist()]
            at = to


def _result_schema(id_type: T.DataType) -> T.StructType:
    return (T.StructType().add("doc_id", id_type).add("n_chars", "long").add("edited_sha256", "string")
            .add("fp", "binary").add("edited_fp", "binary").add("near_edited", "double")
            .add("near_next", "double"))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_chars, edited_sha256, fp, edited_fp (binary, a
    byte a sample), near_edited, near_next: each document against its edited text, which takes
    its end from the next document, and against that document."""
    spark = docs.sparkSession
    result = _result_schema(docs.schema["doc_id"].dataType)
    names = result.names
    order = ["doc_id", "digest", "tie"]
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("digest"),
                        # splits equal rows over partitions; decides nothing
                        F.monotonically_increasing_id().alias("tie"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def run(batches):
        held = None                  # last row so far: id, text, fingerprint
        for part, ids, texts in _some_texts(batches):
            old = [] if held is None else [held[1]]
            whole = old + texts
            other = [edited(a, b) for a, b in zip(whole, whole[1:])]
            # texts and edited texts share most terms, and so their draws
            marks = _marks(texts + other)
            marks, other_marks = marks[:len(texts)], marks[len(texts):]
            if held is None:
                yield edge(part, FIRST, ids[:1], texts[0], marks[:1])
            else:
                ids, marks = pa.concat_arrays([held[0], ids]), np.concatenate((held[2], marks))
            n = len(whole) - 1
            if n:
                found = _rows(ids[:n], whole[:n], marks[:n], other, other_marks, marks[1:])
                yield batch_of(found, n, part, None, None)
            held = (ids[n:], whole[n], marks[n:])
        if held is not None:
            yield edge(part, LAST, *held)

    def edge(part, kind, ids, text, mark):
        found = {"doc_id": ids, "fp": _binary(mark)}
        return batch_of(found, 1, part, kind, text)

    def batch_of(found, n, part, kind, text):
        types = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "edited_fp": pa.binary(),
                 "near_edited": pa.float64(), "near_next": pa.float64()}
        columns = [found[c] if c in found else pa.nulls(n, types[c]) for c in names]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.string()),
             pa.array([text] * n, pa.string())], names=[*names, "part", "edge", "text"])

    schema = T.StructType([*result.fields]).add("part", "integer").add("edge", "string").add("text", "string")
    found = shared.written(rows.mapInArrow(run, schema), "weighted-samples")
    ends = found.filter("edge is not null")
    parts = sorted(r.part for r in ends.filter(F.col("edge") == FIRST).select("part").collect())
    if not parts:
        return found.select(*names)
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]])), "part int, next_part int")
    lasts = ends.filter(F.col("edge") == LAST).select("part", "doc_id", "text", "fp")
    firsts = ends.filter(F.col("edge") == FIRST).select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    pairs = (lasts.join(follows, "part").join(firsts, "next_part")
             .select("doc_id", "text", "fp", "next_text", "next_fp"))

    def close(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                text = row.column(1).to_pylist()
                other = [edited(text[0], row.column(3)[0].as_py())]
                found = _rows(row.column(0), text, _codes(row.column(2)), other, _marks(other),
                              _codes(row.column(4)))
                yield pa.RecordBatch.from_arrays([found[c] for c in names], names=names)

    return found.filter("edge is null").select(*names).union(pairs.mapInArrow(close, result))


def op11_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_next(shared.table(spark, sf_dir, "documents"))
    text = {new: F.lower(F.hex(old)).alias(new)
            for old, new in (("fp", "fingerprint"), ("edited_fp", "edited_fingerprint"))}
    return found.select("doc_id", "n_chars", "edited_sha256", text["fingerprint"],
                        text["edited_fingerprint"], "near_edited", "near_next")
