"""Fingerprints, ranked search and collocations against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import collocations, lexical_search, weighted_sampling
from tests.llm.helpers import WORD, lower, no_docs, odd_docs, odd_rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# --- consistent weighted sampling -------------------------------------------------

def bag(text):
    words = [w.encode() for w in WORD.findall(lower(text or ""))]
    return Counter(w[i:i + 16] for w in words for i in range(0, len(w), 16))


def jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def sampled(df):
    return [r.asDict() for r in df.collect()]


def test_likeness_is_the_generalised_jaccard_similarity(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(60)] + ["extraordinarily" * 3])
    texts = [" ".join(rng.choice(words[:rng.integers(3, 61)], rng.integers(1, 120))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = sorted(sampled(weighted_sampling.with_next(docs)), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == list(range(300))
    near, true = [], []
    for i, (row, text) in enumerate(zip(rows, texts)):
        after = texts[(i + 1) % 300]
        changed = text[:len(text) - len(text) // 4] + after[:len(text) // 4]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        near += [row["near_edited"], row["near_next"]]
        true += [jaccard(bag(text), bag(changed)), jaccard(bag(text), bag(after))]
    error = np.array(near) - np.array(true)
    spread = np.sqrt((np.array(true) * (1 - np.array(true)) / weighted_sampling.SAMPLES).mean())
    assert abs(error.mean()) < 0.01 and error.std() < 1.2 * spread


def test_weight_is_sampled_consistently():
    """A set with the weights of another and more keeps each sample unless a new one wins."""
    one = weighted_sampling._marks(["a b c d"])
    more = weighted_sampling._marks(["a a a b c d"])
    assert 0.3 < (one == more).mean() < 0.95            # 4 / 6
    assert (weighted_sampling._marks(["A b  c\td"]) == one).all()


def test_odd_documents_get_fingerprints(spark):
    rows = sampled(weighted_sampling.with_next(odd_docs(spark)))
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in odd_rows())
    by_hash = {}
    for row in rows:
        assert by_hash.setdefault(row["edited_sha256"], row["edited_fp"]) == row["edited_fp"]
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    one = {r["doc_id"]: r for r in rows}
    assert one[1]["fp"] == one[2]["fp"] and one[1]["near_next"] == 1
    assert one[4]["fp"] == one[5]["fp"] == one[6]["fp"] == bytes(weighted_sampling.SAMPLES)
    assert one[4]["near_next"] == one[5]["near_next"] == 1 and one[6]["near_next"] == 0
    assert one[10]["n_chars"] == 30_000 and one[10]["near_edited"] > 0.3


def test_single_and_no_documents(spark):
    assert weighted_sampling.with_next(no_docs(spark)).collect() == []
    row, = sampled(weighted_sampling.with_next(spark.createDataFrame([(5, "one two thr")], "doc_id long, text string")))
    assert row["near_next"] == 1
    assert row["n_chars"] == 11 and row["edited_sha256"] == hashlib.sha256(b"one two ton").hexdigest()


# --- ranked search ----------------------------------------------------------------

def ranked(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_all, l_all = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b, n in bags:
            m = 25 + (75 * n * n_all) // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in TERM.findall(lower(text or "")) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: r[:2])


def found(docs, items, spark, **options):
    index = lexical_search.build_index(docs)
    rows = lexical_search.search(index, items, **options).collect()
    return sorted(map(tuple, rows), key=lambda r: r[:2])


ITEMS = "item_id long, text string, query string, score string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


@pytest.mark.parametrize("width", [1, 3, 64])
def test_search_equals_scoring_every_document(spark, monkeypatch, width):
    monkeypatch.setattr(lexical_search, "WIDTH", width)
    rng = np.random.default_rng(width)
    words = np.array([f"t{i}" for i in range(40)])
    p = 1 / np.arange(1, 41)
    texts = [" ".join(rng.choice(words, rng.integers(0, 40), p=p / p.sum())) for _ in range(400)]
    texts[30:90] = [texts[30]] * 60                     # equal scores
    rows = [(int(i), t) for i, t in zip(rng.permutation(400), texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = [(q, " ".join(rng.choice(words, rng.integers(1, 12)))) for q in range(12)] + [(50, texts[30])]
    assert found(docs, items_of(spark, asked), spark) == ranked(rows, asked)


def test_search_over_many_blocks_and_query_groups(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", 10)
    rows = [(i, t) for i, t, *_ in odd_rows() if i != 13]
    asked = [(1, "The0 w1 the0, END"), (2, "two;ONE"), (3, None), (4, ""), (5, "漢字 çödé"), (6, "nowhere")]
    narrow = odd_docs(spark).filter("doc_id is null or doc_id <> 13")
    assert found(narrow, items_of(spark, asked), spark) == ranked(rows, asked)

    one_row = lexical_search.build_index(narrow.repartition(9))
    assert one_row.count() > 3
    assert sorted(map(tuple, lexical_search.search(one_row, items_of(spark, asked)).collect()),
                  key=lambda r: r[:2]) == ranked(rows, asked)


def test_search_repeats_and_empty_tables(spark):
    asked = items_of(spark, [(1, "shout"), (1, "shout"), (None, "one")])
    rows = lexical_search.search(lexical_search.build_index(odd_docs(spark)), asked).collect()
    assert [(r.rank, r.doc_id) for r in rows if r.item_id == 1] == [(1, 13), (2, 13)]
    assert [r.doc_id for r in rows if r.item_id is None][:3] == [7, 8, 14]
    nothing = lexical_search.build_index(no_docs(spark))
    assert lexical_search.search(nothing, asked).collect() == []
    assert lexical_search.search(lexical_search.build_index(odd_docs(spark)),
                                 items_of(spark, []).limit(0)).collect() == []


# --- collocations -----------------------------------------------------------------

def phrases(rows, least, top):
    grams, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, 6):
                grams.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    kept = {g: c for g, c in grams.items() if c >= least}

    def inside(g):
        lang, w = g
        return any(h[0] == lang and len(h[1]) > len(w) and c >= kept[g]
                   and any(h[1][i:i + len(w)] == w for i in range(len(h[1]))) for h, c in kept.items())

    out = {}
    for g, a in kept.items():
        lang, w = g
        if len(w) > 1 and not inside(g):
            cuts = [(1000 * a * words[lang] // (kept[lang, w[:k]] * kept[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), kept[lang, w[:k]], kept[lang, w[k:]]))
    return sorted((lang, rank + 1, p.decode(), -a, left, right, words[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def mined(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("least, top", [(2, 2000), (3, 7), (25, 50)])
def test_collocations_equal_counting_every_phrase(spark, least, top):
    rng = np.random.default_rng(least)
    passage = "once upon a time there lived, a king and his three sons. In old  towns\tof brick"
    rows = [(["en", "de", None][i % 3], " ".join(rng.choice(list("abcdefg") + ["é;", "x,", "Y\n"], 60))
             + (" " + passage if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert mined(collocations.collocations(docs, least, top)) == phrases(rows, least, top)


def test_collocations_of_odd_documents(spark):
    rows = [(lang, text) for _, text, lang, _ in odd_rows() if text is None or len(text) < 100_000]
    docs = odd_docs(spark).filter("text is null or length(text) < 100000")
    assert mined(collocations.collocations(docs, 2, 50)) == phrases(rows, 2, 50)
    assert collocations.collocations(no_docs(spark)).collect() == []
    # one piece of 40,000 words: only phrases that no longer one of their count holds stay
    assert {r[2]: r[3] for r in mined(collocations.collocations(odd_docs(spark)))} == {
        "long words": 20_000, "long words long words": 19_999,
        "long words long words long": 19_998, "words long words long words": 19_998}


def test_passages_are_one_path(spark):
    passage = "once upon a time there lived a king"
    rows = [("en", passage)] * 4 + [("en", "far away " + passage + " of old")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    frequent = collocations.frequent_grams(collocations.edges_and_ends(docs, 2), 2)
    paths = {(r.path, r.weight, r.edges) for r in collocations.compact_paths(frequent).collect()}
    assert paths == {(passage, 7, 4), ("far away once upon a time", 3, 2), ("there lived a king of old", 3, 2)}
