"""Subword lattice likelihood of whole documents.

A text is lower-cased (A-Z) and read as words and one end. A word, with the
vocabulary's word-begin mark before it, is a lattice of bytes: every piece of an existing
unigram vocabulary that spells a stretch of it is an edge, and so is every single
byte. The probability of a word is the sum over all segmentations of the product
of their pieces' probabilities, by a forward recursion in log space; that of a
text is the product over its words and the end, a piece of its own. Pieces with
the mark only begin words and the mark is itself a piece, so the words' lattices
are independent given the text's words, and the sum over all texts is at most 1.

The vocabulary's scores give the first probabilities: log probabilities as they
are, or, where the scores are merge ranks (whole numbers -0, -1, ...), Zipf's law
over the ranks. Then ROUNDS of expected counts over all training words (forward and
backward, all segmentations) fit them to the corpus, smoothed with PRIOR
pseudo-counts of the first probabilities.

At scale: texts are read in blocks of about BLOCK_BYTES; a block returns a row per distinct
word with its counts by document, so a frequent word has one row per block and no
text is shuffled. Counts are summed per word before and after the shuffle; the
lattice is computed once per distinct word; the words' figures return to their
block by two joins on hashed keys. Memory is bounded by a block, and only the
vocabulary's pieces (their number is fixed by its file) go through the driver.

Nulls: a null text is empty: one token, the end. Rows that repeat a doc_id are scored
each for itself. A null doc_id is scored and belongs to the training rows. Without
training rows N and V are 0, all tokens unknown.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import SLICE_BYTES, slices, strings, words_of

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD = 7, 2
BLOCK_BYTES = 16 << 20
ROUNDS, PRIOR = 2, 10_000.0
#: The mark of a word's begin, as in the vocabulary file, and its symbol in a lattice: not a byte, so that
#: the same character inside a word is spelled as any other.
MARK, BEGIN = "▁", 256
#: Share of all first probability that single bytes get.
BYTE_SHARE = 1e-4
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
NONE, PREFIX = -1, -2


@dataclass
class Pieces:
    """Pieces, and beginnings of pieces, by the hash of their bytes. The last index is
    the end of a text."""

    spelled: list[tuple[int, ...]]      # bytes, or BEGIN and bytes
    log_p: np.ndarray

    def __post_init__(self):
        self.longest = max(map(len, self.spelled))
        known = {_hash_of(p[:n]): PREFIX for p in self.spelled for n in range(1, len(p))}
        known |= {_hash_of(p): i for i, p in enumerate(self.spelled)}
        if len(known) < len({p[:n] for p in self.spelled for n in range(1, len(p) + 1)}):
            raise ValueError("two pieces or beginnings of pieces have one hash")
        keys = np.fromiter(known, np.uint64, len(known))
        order = np.argsort(keys)
        self.keys, self.index = keys[order], np.fromiter(known.values(), np.int64, len(known))[order]
        # first bits of a key -> where to look, so that a lookup is one or two steps
        self.shift = np.uint64(64 - 19)
        self.slot = np.searchsorted(self.keys >> self.shift, np.arange((1 << 19) + 1, dtype=np.uint64))
        self.depth = int(np.diff(self.slot).max())

    def find(self, key: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, PREFIX where pieces only begin so, else NONE."""
        bucket = (key >> self.shift).astype(np.int64)
        at, end = self.slot[bucket], self.slot[bucket + 1]
        out = np.full(len(key), NONE, np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            pos = at[left]
            hit = self.keys[pos] == key[left]
            out[left[hit]] = self.index[pos[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out

    @property
    def end(self) -> int:
        return len(self.spelled)


def _hash_of(piece: tuple[int, ...]) -> int:
    h = 0
    for b in piece:
        h = ((h + b + 1) * int(MULTIPLIER)) & ((1 << 64) - 1)
        h ^= h >> 29
    return h


def symbols_of(word: str) -> tuple[int, ...]:
    """A word as its lattice reads it."""
    return (BEGIN, *word.encode())


def load_pieces(name: str = VOCABULARY) -> Pieces:
    """Pieces of a sentencepiece file and their first probabilities."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    n = model.get_piece_size()
    own = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                       or model.is_unused(i))]
    spelled, score = [], []
    for i in own:
        text = model.id_to_piece(i)
        # the mark within a piece stands for a space, which no word has
        if MARK not in text[1:] and len(text.encode()) > 1:
            spelled.append(symbols_of(text[1:]) if text[:1] == MARK else tuple(text.encode()))
            score.append(model.get_score(i))
        elif len(text.encode()) == 1:
            continue                      # single bytes are pieces below
    if (BEGIN,) not in spelled:               # a word's first piece may be any
        spelled.append((BEGIN,))
        score.append(min(score))
    score = np.array(score)
    ranks = (score == np.round(score)).all()
    weight = 1 / (2.7 - score) if ranks else np.exp(score - score.max())
    spelled += [(b,) for b in range(256)]
    first = np.concatenate((weight / weight.sum() * (1 - BYTE_SHARE), np.full(256, BYTE_SHARE / 256)))
    first = np.concatenate((first * (1 - 1e-3), [1e-3]))
    return Pieces(spelled, np.log(first))


def edges_of(chars: np.ndarray, pieces: Pieces):
    """Lattice of equally long words, a row each: (begin, length, rows, piece) per
    stretch that is a piece in some rows, ordered by where it ends."""
    rows, n = chars.shape
    found: list[list] = [[] for _ in range(n + 1)]
    for i in range(n):
        # only rows whose stretch so far begins a piece are followed further
        alive, h = np.arange(rows), np.zeros(rows, np.uint64)
        for length in range(1, min(pieces.longest, n - i) + 1):
            h = (h + chars[alive, i + length - 1] + np.uint64(1)) * MULTIPLIER
            h ^= h >> np.uint64(29)
            piece = pieces.find(h)
            here = piece >= 0
            if here.any():
                found[i + length].append((i, length, alive[here], piece[here]))
            on = piece != NONE
            alive, h = alive[on], h[on]
            if not len(alive):
                break
    return found


def forward(found: list[list], rows: int, log_p: np.ndarray) -> np.ndarray:
    """Log probability of every prefix, (positions, rows)."""
    alpha = np.full((len(found), rows), -np.inf)
    alpha[0] = 0.0
    for end in range(1, len(found)):
        for begin, _, at, piece in found[end]:
            alpha[end, at] = np.logaddexp(alpha[end, at], alpha[begin, at] + log_p[piece])
    return alpha


def backward(found: list[list], rows: int, log_p: np.ndarray) -> np.ndarray:
    beta = np.full((len(found), rows), -np.inf)
    beta[-1] = 0.0
    for end in range(len(found) - 1, 0, -1):
        for begin, _, at, piece in found[end]:
            beta[begin, at] = np.logaddexp(beta[begin, at], beta[end, at] + log_p[piece])
    return beta


def by_length(words: pa.Array, most: int = 1 << 21):
    """(rows, characters) of equally long words with the mark before them."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    size = np.diff(offsets)
    for n in np.unique(size):
        own = np.flatnonzero(size == n)
        step = max(1, most // ((int(n) + 3) * 8))
        for k in range(0, len(own), step):
            rows = own[k:k + step]
            chars = np.empty((len(rows), n + 1), np.uint64)
            chars[:, 0] = BEGIN
            chars[:, 1:] = data[offsets[rows][:, None] + np.arange(n)]
            yield rows, chars


def word_log_p(words: pa.Array, pieces: Pieces) -> np.ndarray:
    """Marginal natural-log probability of each word."""
    out = np.empty(len(words))
    for rows, chars in by_length(words):
        out[rows] = forward(edges_of(chars, pieces), len(rows), pieces.log_p)[-1]
    return out


def expected_counts(words: pa.Array, times: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected number of uses of each piece over all segmentations of the words."""
    out = np.zeros(len(pieces.log_p))
    for rows, chars in by_length(words):
        found = edges_of(chars, pieces)
        alpha, beta = (f(found, len(rows), pieces.log_p) for f in (forward, backward))
        for end in range(1, len(found)):
            for begin, _, at, piece in found[end]:
                share = np.exp(alpha[begin, at] + pieces.log_p[piece] + beta[end, at] - alpha[-1, at])
                out += np.bincount(piece, share * times[rows[at]], len(out))
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(shared.id_bucket(doc_id, FOLDS) == HELD, F.lit(False))


BLOCKS = "block long, word string, training long, docs binary"
PAIR = np.dtype([("doc", "<u4"), ("times", "<u4")])
DIRECTORY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("held", "u1"), ("tokens", "<i8")])
_SCHEMA = pa.schema([("block", pa.int64()), ("word", pa.string()), ("training", pa.int64()), ("docs", pa.binary())])


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def block_rows(block: int, texts, doc_id: pa.Array, held: np.ndarray) -> pa.RecordBatch:
    """A row per distinct word of the texts: its training count, and its count in each
    text that has it. A last row without a word lists the texts."""
    words = words_of(texts, lower=True)
    codes, distinct = words.codes()
    n, size = len(texts), len(distinct)
    pair, times = np.unique(codes * n + words.doc, return_counts=True)
    word, doc = pair // n, pair % n
    training = np.bincount(word, np.where(held[doc], 0, times), size).astype(np.int64)
    docs = np.empty(len(pair), PAIR)
    docs["doc"], docs["times"] = doc, times
    listing = np.zeros(n, DIRECTORY)
    listing["null"] = doc_id.is_null().to_numpy(zero_copy_only=False)
    listing["doc_id"] = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
    listing["held"], listing["tokens"] = held, np.bincount(words.doc, minlength=n) + 1
    ends = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=size)))) * PAIR.itemsize
    payload = _binary(np.append(ends, ends[-1] + listing.nbytes),
                      np.frombuffer(docs.tobytes() + listing.tobytes(), np.uint8))
    names = pa.concat_arrays([distinct, pa.array([None], pa.string())])
    return pa.RecordBatch.from_arrays([pa.array(np.full(size + 1, block)), names,
                                       pa.array(np.append(training, 0)), payload], schema=_SCHEMA)


def to_blocks(docs: DataFrame) -> DataFrame:
    from ledgerlens.llm.textbytes import Texts

    def read(batches):
        task, n = TaskContext.get().partitionId(), 0
        parts, ids, held, size = [], [], [], 0

        def close():
            nonlocal parts, ids, held, size, n
            lens = np.concatenate([np.diff(p.offsets) for p in parts])
            texts = Texts(np.concatenate([p.data for p in parts]), np.concatenate(([0], np.cumsum(lens))))
            out = block_rows((task << 32) + n, texts, pa.concat_arrays(ids), np.concatenate(held))
            parts, ids, held, size, n = [], [], [], 0, n + 1
            return out

        for batch, texts in slices(batches, "text", SLICE_BYTES):
            parts.append(texts)
            ids.append(batch.column(0))
            held.append(batch.column(2).to_numpy(zero_copy_only=False).astype(bool))
            size += len(texts.data)
            if size >= BLOCK_BYTES:
                yield close()
        if parts:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held"))
    return rows.mapInArrow(read, BLOCKS)


def fit_pieces(words: DataFrame, ends: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Expectation maximisation over the training words (word, c)."""
    first = np.exp(pieces.log_p)
    for _ in range(rounds):
        now = pieces

        def count(batches):
            total = np.zeros(len(now.log_p))
            for batch in batches:
                total += expected_counts(batch.column(0), batch.column(1).to_numpy(), now)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

        found = (words.filter("c > 0").select("word", "c").mapInArrow(count, "piece long, n double")
                 .groupBy("piece").agg(F.sum("n").alias("n")).collect())      # a row per piece at most
        total = np.zeros(len(first))
        for r in found:
            total[r.piece] = r.n
        total[now.end] = ends
        weight = total + PRIOR * first
        pieces = Pieces(pieces.spelled, np.log(weight / weight.sum()))
    return pieces


def score_documents(docs: DataFrame, pieces: Pieces | None = None, rounds: int = ROUNDS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = shared.written(to_blocks(docs), "blocks")
    words = (blocks.filter("word is not null").groupBy("word").agg(F.sum("training").alias("c")))
    words = shared.written(words, "words")

    def trained(batches):
        for batch in batches:
            listed = [np.frombuffer(x, DIRECTORY) for x in batch.column(0).to_pylist()]
            n = [int((x["held"] == 0).sum()) for x in listed]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    ends = blocks.filter("word is null").select("docs").mapInArrow(trained, "n long").agg(F.sum("n")).first()[0] or 0
    known = words.filter("c > 0").agg(F.count(F.lit(1)), F.sum("c")).first()
    distinct, total = known[0] + (ends > 0), (known[1] or 0) + ends
    fitted = fit_pieces(words, ends, pieces or load_pieces(), rounds)
    low = math.log10(1 / (total + 1 * (distinct + 1)))
    end = (ends, low + math.log10(ends + 1), float(fitted.log_p[fitted.end]) / math.log(10))

    def spell(batches):
        for batch in batches:
            p = word_log_p(batch.column(0), fitted) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=["word", "c", "log_p"])

    figures = words.mapInArrow(spell, "word string, c long, log_p double")
    # listings have no word and take no part in the join
    listings = blocks.filter("word is null").select("block", F.lit(None).cast("long").alias("c"),
                                                    F.lit(None).cast("double").alias("log_p"), "docs")
    rows = blocks.filter("word is not null").join(figures, "word").select("block", "c", "log_p", "docs").union(listings)

    def add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_list = table["c"].is_null().to_numpy(zero_copy_only=False)
        listing = np.frombuffer(table["docs"].filter(pa.array(is_list))[0].as_py(), DIRECTORY)
        own = table.filter(pa.array(~is_list)).combine_chunks()
        n = len(listing)
        n_known, base, score = np.zeros(n), np.zeros(n), np.zeros(n)
        if own.num_rows:
            packed = own["docs"].chunk(0) if isinstance(own["docs"], pa.ChunkedArray) else own["docs"]
            offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
            pairs = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(PAIR)
            each = np.diff(offsets) // PAIR.itemsize
            c = own["c"].to_numpy()
            times, doc = pairs["times"].astype(float), pairs["doc"]
            spread = lambda v: np.bincount(doc, times * np.repeat(v, each), n)
            n_known, base, score = spread(c > 0), spread(np.log10(c + 1.0)), spread(own["log_p"].to_numpy())
        tokens = listing["tokens"]
        base = base + low * (tokens - 1) + end[1]
        return pa.table({
            "doc_id": pa.array(listing["doc_id"], mask=listing["null"] == 1),
            "held_out": pa.array(listing["held"] == 1), "n_tokens": pa.array(tokens),
            "n_known": pa.array(np.rint(n_known).astype(np.int64) + (end[0] > 0)),
            "train_tokens": pa.array(np.full(n, total, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score + end[2])})

    return rows.groupBy("block").applyInArrow(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                              "train_tokens long, base_score double, score double")


def op1_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
