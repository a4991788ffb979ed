"""Counts, SimHash and quality rules against brute force."""

import collections
import math

import pyarrow as pa
import pytest
import xxhash

from ledgerlens.llm import components, quality_rules, simhash_dedup
from ledgerlens.llm.textbytes import counts_of, texts_of

from .helpers import WORD, closure, lower, no_docs, odd_docs, odd_rows


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": len(again),
            "n_chars": len(text), "n_distinct": len(set(words)),
            "top_word": max(collections.Counter(words).values(), default=0),
            "n_doubled": sum(a == b for a, b in zip(words, words[1:]))}


def brute_fingerprint(text, size=3):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [t for _, t, _, _ in odd_rows()] + ["\n", "a\n", "\na", "a b c a b c", "#*$%&|<> x", " x y", "é" * 3]


@pytest.mark.parametrize("at, to", [(0, None), (3, 9)])
def test_counts_equal_brute_force(at, to):
    texts = TEXTS[at:to]
    got = counts_of(texts_of(pa.array(TEXTS).slice(at, len(texts))))
    for k, text in enumerate(texts):
        for name, value in brute_counts(text).items():
            assert got[name][k] == value, (name, (text or "")[:20])


def test_fingerprints_equal_brute_force():
    got = simhash_dedup.fingerprints_of(texts_of(pa.array(TEXTS)))
    assert [int(x) for x in got] == [brute_fingerprint(t) for t in TEXTS]


def test_simhash_components(spark):
    rows = {r for r in odd_rows()}
    out = simhash_dedup.near_duplicates(odd_docs(spark)).collect()
    assert len(out) == len(odd_rows())
    fp = {i: brute_fingerprint(t) for i, t, _, _ in rows if i is not None}
    want = closure(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2])
    for r in out:
        if r.doc_id is not None:
            assert (r.fp & (1 << 64) - 1, r.component_id) == (fp[r.doc_id], want[r.doc_id])
    assert sorted(r.component_id for r in out if r.doc_id is None) == [1, 4]
    kept = simhash_dedup.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted({*want.values()}) and ids.count(None) == 2
    assert simhash_dedup.keep_first(no_docs(spark)).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_at_every_radius(spark, radius):
    base = 0x0123456789ABCDEF
    flips = [0, 1, 1 << 63, 3, 7, 15, 1 << 5 | 1 << 9 | 1 << 40, 0xFF00]
    fps = [f - (1 << 64) if f >> 63 else f for f in (base ^ f for f in flips)] + [-1, -2, 0, 5]
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {r.rep: r.component_id for r in simhash_dedup.link_fingerprints(classes, radius).collect()}
    mask = (1 << 64) - 1
    ids = range(len(fps))
    want = closure(ids, [(a, b) for a in ids for b in ids
                         if a < b and ((fps[a] ^ fps[b]) & mask).bit_count() <= radius])
    assert {i: got.get(i, i) for i in ids} == want


def test_components_of_paths_stars_and_nulls(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = path + star + [(5, 5), (None, 3), (200, None), (7, 6), (7, 6)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component_id for r in components.components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(df.limit(0), "a", "b").count() == 0


def test_binomial_tail_is_exact():
    for n, p in [(1, 0.3), (20, 0.05), (300, 0.01)]:
        for k in (0, 1, n // 2, n):
            want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality_rules.binomial_at_most(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_are_strictest_safe_ones(spark):
    # 2000 good documents per stratum; symbol and doubled-word ratios so that a known share exceeds each cutoff
    rows = []
    for i in range(2000):
        rows.append((i, "en", 100, 0 if i >= 3 else 90, 0 if i < 1990 else 32))
        rows.append((10_000 + i, None, 100, 0 if i >= 1500 else 90, 0))
    rows += [(50_000 + i, "few", 100, 0, 0) for i in range(20)]
    names = [c for c in quality_rules.COUNT_COLUMNS if c not in ("n_words", "n_symbols", "n_doubled")]
    df = spark.createDataFrame([(*r, *[0] * len(names)) for r in rows],
                               "doc_id long, lang string, n_words long, n_symbols long, n_doubled long, "
                               + ", ".join(f"{c} long" for c in names))
    alpha, delta = 0.01, 0.05
    got = {r.stratum: (r.cutoff, r.n_good, r.n_rejected)
           for r in quality_rules.choose_cutoffs(df, "lang", alpha=alpha, delta=delta).collect()}
    level = delta / 3
    assert quality_rules.binomial_at_most(3, 2000, alpha) <= level < quality_rules.binomial_at_most(13, 2000, alpha)
    # 3 documents over 0.35, 13 over 0.3 or either rule; beyond 0.9 three quarters would go; 20 prove nothing
    assert got == {"en": (0.35, 2000, 3), None: (0.9, 2000, 0)}


@pytest.mark.parametrize("copies", [1, 4000])
def test_copies_prove_nothing(spark, copies):
    """One good document without symbols, however often it occurs, is one trial."""
    prose = " ".join(f"w{i}" for i in range(80))
    junk = " ".join(f"#{i}" for i in range(80))
    docs = spark.createDataFrame([(1, prose, "en")] * copies + [(2, junk, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1)] * 3, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert kept == {1: True, 2: True}


def test_equal_texts_of_many_ids_are_one_trial_and_enough_texts_prove(spark):
    prose = " ".join(f"w{i}" for i in range(80))
    junk = " ".join(f"#{i}" for i in range(80))
    for same, wanted in ((True, True), (False, False)):
        rows = [(i, prose + ("" if same else f" v{i}"), "en") for i in range(300)] + [(999, junk, "en")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
        kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
        assert kept[999] is wanted and all(kept[i] for i in range(300))


def test_rules_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1), (99, 1)], "doc_id long, quality int")
    out = quality_rules.judge(odd_docs(spark), labels).collect()
    assert len(out) == len(odd_rows())
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for i, text, _, _ in odd_rows():
        want = brute_counts(text)
        assert any(all(r[c] == want[c] for c in want) for r in by[i])
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)          # too few labels to prove a cutoff
    kept = quality_rules.keep_good(odd_docs(spark), labels)
    assert kept.columns == odd_docs(spark).columns and kept.count() == sum(r.kept for r in out)
    assert {(r["kept"], r["q_n_words"], r["_q_n_words"]) for r in kept.collect()} == {("x", 9, 9)}
    assert quality_rules.judge(no_docs(spark), labels).count() == 0
    assert quality_rules.judge(odd_docs(spark), labels.limit(0)).count() == len(odd_rows())


def test_texts_that_share_an_id_are_judged_on_their_own(spark):
    a, b, c = ("alpha beta gamma delta " * 9, "one two three four five " * 9, "unique words stand here " * 9)
    rows = [(1, a), (5, a), (5, c), (6, a), (6, b), (7, b), (7, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [brute_fingerprint(t) for t in (a, b, c)]
    assert all((x ^ y).bit_count() > 4 for x in fps for y in fps if x != y)
    kept = sorted((r.doc_id, r.text) for r in simhash_dedup.keep_first(docs).collect())
    assert kept == [(1, a), (5, c), (6, b)]
    found = {(r.doc_id, r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()}
    assert found == {(1, 1), (5, 1), (5, 5), (6, 1), (6, 6), (7, 6)}
