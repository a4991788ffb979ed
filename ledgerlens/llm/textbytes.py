"""Words, lines and counts of whole Arrow text columns, on their UTF-8 bytes.

A word is a run of bytes other than space and the control bytes 09-0D; as these
are ASCII, cutting the bytes never cuts a character. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def byte_set(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SPACE = byte_set(b" \t\n\x0b\x0c\r")
UPPER = byte_set(bytes(range(65, 91)))
LOWER_MAP = np.arange(256, dtype=np.uint8)
LOWER_MAP[65:91] += 32


@dataclass
class Texts:
    """Bytes of some texts, and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """True entries of a per-byte mask in each text."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def texts_of(column: pa.Array) -> Texts:
    column = pc.fill_null(column, "") if column.null_count else column
    size = len(column)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not size:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset:column.offset + size + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Consecutive row ranges of about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        at, rows = 0, batch.num_rows
        while at < rows:
            to = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), rows)
            lo, hi = texts.offsets[at], texts.offsets[to]
            yield batch.slice(at, to - at), Texts(texts.data[lo:hi], texts.offsets[at:to + 1] - lo)
            at = to


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    data: np.ndarray      # the bytes that the positions are in
    inside: np.ndarray    # per byte: in a word

    def __len__(self) -> int:
        return len(self.starts)

    def strings(self) -> pa.StringArray:
        size = np.concatenate(([0], np.cumsum(self.ends - self.starts)))
        return strings(size, self.data[self.inside])

    def codes(self) -> tuple[np.ndarray, pa.StringArray]:
        """Each word's number, and the distinct words."""
        found = self.strings().dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def strings(offsets: np.ndarray, data: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)),
                                       pa.py_buffer(np.ascontiguousarray(data)))


def words_of(texts: Texts, lower: bool = False) -> Words:
    data = LOWER_MAP[texts.data] if lower else texts.data
    inside = ~SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, data, inside)
    first = np.zeros(len(data), bool)
    first[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
    begins, ends = first.copy(), np.empty(len(data), bool)
    begins[0] = True
    begins[1:] |= ~inside[:-1]
    begins &= inside
    ends[-1] = True
    ends[:-1] = first[1:] | ~inside[1:]
    ends &= inside
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(ends) + 1,
                 np.searchsorted(texts.offsets, starts, "right") - 1, data, inside)


def repeated_in(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each (doc, key) occurs; keys are numbers from 0."""
    if not len(key):
        return np.zeros(0, np.int64)
    codes, _ = pd.factorize(doc * (int(key.max()) + 1) + key)
    return np.bincount(codes)[codes]


def windows_of(words: Words, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every n-word window within a text, and the windows' numbers."""
    if len(codes) < n:
        none = np.zeros(0, np.int64)
        return none, none
    at = np.flatnonzero(words.doc[:len(codes) - n + 1] == words.doc[n - 1:])
    key = codes[at]
    for k in range(1, n):
        nxt = codes[at + k]
        key, _ = pd.factorize(key * (int(nxt.max()) + 1 if len(nxt) else 1) + nxt)
    return at, key.astype(np.int64)


#: The characters that count as symbols.
SYMBOLS = byte_set(b"#*$%&|<>")
DIGITS = byte_set(b"0123456789")
MARKS = byte_set(b"!?")
STOPS = byte_set(b".,;:")
LETTERS = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def counts_of(texts: Texts) -> dict[str, np.ndarray]:
    """Long counts per text: words, lines, characters and their repeats."""
    n, data = len(texts), texts.data
    words = words_of(texts)
    head = (data & 0xC0) != 0x80
    n_words = np.bincount(words.doc, minlength=n)
    codes, _ = words.codes()
    out = {"n_words": n_words, "word_chars": texts.per_doc(words.inside & head),
           "n_symbols": texts.per_doc(SYMBOLS[data])}
    # lines
    newline = data == 10
    at = np.flatnonzero(newline)
    begin = np.sort(np.concatenate((texts.offsets[:-1], at + 1)))
    end = np.sort(np.concatenate((texts.offsets[1:], at)))
    full = np.searchsorted(words.starts, end) > np.searchsorted(words.starts, begin)
    lines = strings(np.concatenate(([0], np.cumsum(end - begin))), data[~newline])
    lines = lines.filter(pa.array(full)).dictionary_encode()
    line = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_doc = np.searchsorted(texts.offsets, begin[full], "right") - 1
    n_lines = np.bincount(line_doc, minlength=n)
    distinct = pd.unique(line_doc * (len(lines.dictionary) + 1) + line)
    out["n_dup_lines"] = n_lines - np.bincount(distinct // (len(lines.dictionary) + 1), minlength=n)
    # words in 3-word windows that the text holds twice or more
    first, window = windows_of(words, codes, 3)
    again = first[repeated_in(words.doc[first], window) > 1]
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[again + k] = True
    out["n_repeat_words"] = np.bincount(words.doc[covered], minlength=n)
    # beyond the base: what the cutoffs and the classifier look at
    times = repeated_in(words.doc, codes)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, words.doc, times)
    same = np.zeros(len(codes), bool)
    if len(codes) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & (words.doc[1:] == words.doc[:-1])
    out |= {"n_lines": n_lines, "n_chars": texts.per_doc(head),
            "n_upper": texts.per_doc(UPPER[data]), "n_letters": texts.per_doc(LETTERS[data] & head),
            "n_digits": texts.per_doc(DIGITS[data]), "n_marks": texts.per_doc(MARKS[data]),
            "n_stops": texts.per_doc(STOPS[data]), "top_word": top,
            "n_distinct": np.rint(np.bincount(words.doc, 1.0 / np.maximum(times, 1), n)).astype(np.int64),
            "n_doubled": np.bincount(words.doc[same], minlength=n),
            "n_long_words": np.bincount(words.doc[words.ends - words.starts > 18], minlength=n)}
    return {k: v.astype(np.int64) for k, v in out.items()}


COUNT_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
                 "n_chars", "n_upper", "n_letters", "n_digits", "n_marks", "n_stops", "top_word",
                 "n_distinct", "n_doubled", "n_long_words"]
