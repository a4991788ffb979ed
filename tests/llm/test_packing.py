"""Packing: every id in exactly one piece, sequences gapless, little padding."""

import collections
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import matrix_packing, slack_packing, tokens

from .helpers import no_docs, odd_docs, odd_rows

ODD_TEXTS = ["", " ", "a  b\n\n\tc", "<|endoftext|> hi", "it's 'll 12345 ünïcödé 漢字🙂 x　 y", "a" * 5000,
             " " * 3000 + "x", "\r\n \r\n", "don'T", "\x00\x1f", " " * 150_000 + "z", None]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_ids_are_those_of_tokenizers(text):
    got = tokens.ids_of(text)
    assert got[-1] == 1
    assert got[:-1].tolist() == tokens.file_encoder().encode(text or "", add_special_tokens=False).ids


def test_closest_fill_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(200):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 30, 5)}
        target = int(rng.integers(1, 80))
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        taken = slack_packing.closest_fill(counts, sorted(counts, reverse=True), target)
        assert all(n <= counts[k] for k, n in taken.items())
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= target)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_windows_are_full_but_the_last(lengths):
    windows = list(slack_packing.windows(np.array(lengths, np.int64), 64))
    held = collections.defaultdict(list)
    for w in windows:
        for i, at, n in w:
            held[i].append((at, n))
    for i, length in enumerate(lengths):
        at = 0
        for a, n in sorted(held[i]):
            assert a == at
            at += n
        assert at == length
    sums = [sum(n for _, _, n in w) for w in windows]
    assert sum(s < 64 for s in sums) <= 1 and all(s <= 64 for s in sums)


def check_pieces(rows, expected, place, crc_type):
    by, at = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        at[place(r)].append((r["offset"], r["length"]))
    for doc_id, texts in expected.items():
        if doc_id is None or len(texts) > 1:
            assert sum(r["length"] for r in by[doc_id]) == sum(map(len, texts))
            continue
        start = 0
        for r in sorted(by[doc_id], key=lambda r: r["start"]):
            part = texts[0][start:start + r["length"]].astype(crc_type)
            assert r["start"] == start and r["ids_crc32"] == zlib.crc32(part.tobytes())
            start += r["length"]
        assert start == len(texts[0])
    for segments in at.values():
        end = 0
        for a, n in sorted(segments):
            assert a == end
            end += n
        assert end <= 2048
    return len(at)


@pytest.fixture(scope="module")
def expected():
    out = collections.defaultdict(list)
    for i, t, _, _ in odd_rows():
        out[i].append(tokens.ids_of(t))
    return out


@pytest.mark.parametrize("parts, block", [(1, 1 << 22), (5, 3000)])
def test_slack_packing_is_lossless(spark, expected, parts, block):
    docs = odd_docs(spark).repartition(parts)
    rows = slack_packing.digest(slack_packing.pack_documents(docs, block=block)).collect()
    n = check_pieces([r.asDict() for r in rows], expected, lambda r: r["sequence_id"], "<u4")
    total = sum(len(x) for texts in expected.values() for x in texts)
    assert n == -(-total // 2048)                 # only the last sequence is padded
    assert slack_packing.pack_documents(no_docs(spark)).count() == 0


def test_space_tree_finds_the_tightest():
    rng = np.random.default_rng(1)
    tree, held = matrix_packing.SpaceTree(100), collections.Counter()
    for _ in range(2000):
        space = int(rng.integers(0, 101))
        if rng.random() < 0.5 and held[space]:
            tree.add(space, -1)
            held[space] -= 1
        elif rng.random() < 0.3:
            tree.add(space, 1)
            held[space] += 1
        want = int(rng.integers(0, 101))
        assert tree.at_least(want) == min((s for s, n in held.items() if n and s >= want), default=-1)


def test_best_fit_decreasing_equals_linear_search():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 2049, 400).tolist()
    free, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            r = free.index(min(fits))
        else:
            r = len(free)
            free.append(2048)
            rows.append([])
        free[r] -= lengths[i]
        rows[r].append(i)
    got = matrix_packing.best_fit_decreasing(lengths)
    assert len(got) == len(rows)
    assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in rows)


def test_matrices_are_lossless(spark, expected):
    rows = matrix_packing.pack_matrices(odd_docs(spark).repartition(3), block=5000)
    for r in rows.collect():
        cu = np.frombuffer(r.cu_seqlens, "<i4")
        ids, pos = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(pos) == 2048 and cu[0] == 0 and len(cu) == len(r.doc_ids) + 1
        assert not ids[cu[-1]:].any() and not pos[cu[-1]:].any()
        for a, b in zip(cu[:-1], cu[1:]):
            assert pos[a:b].tolist() == list(range(b - a))
    found = [r.asDict() for r in matrix_packing.segments(rows).collect()]
    check_pieces(found, expected, lambda r: (r["matrix_id"], r["row"]), "<u2")
    assert matrix_packing.pack_matrices(no_docs(spark)).count() == 0
