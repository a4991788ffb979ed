"""Lattice likelihood, positive-unlabelled quality and mixing."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import mixing, pu_quality, subword_lm, tokens

from .helpers import WORD, lower, no_docs, odd_docs, odd_rows


# ------------------------------------------------------------------ lattice

def segmentations(data, pieces):
    """Product of piece probabilities of every segmentation, listed one by one."""
    if not data:
        yield 1.0
    for n in range(1, len(data) + 1):
        if data[:n] in pieces:
            for rest in segmentations(data[n:], pieces):
                yield pieces[data[:n]] * rest


def test_forward_sums_all_segmentations():
    pieces = subword_lm.load_pieces()
    p = dict(zip(pieces.spelled, np.exp(pieces.log_p)))
    words = ["a", "the", "then", "théo", "漢", "x1", "the", "hello"]
    got = subword_lm.word_log_p(pa.array(words), pieces)
    for w, lp in zip(words, got):
        assert lp == pytest.approx(math.log(sum(segmentations(subword_lm.symbols_of(w), p))), abs=1e-9)
    assert np.exp(pieces.log_p).sum() == pytest.approx(1)


def test_the_mark_inside_a_word_begins_no_piece(spark):
    pieces = subword_lm.load_pieces()
    p = dict(zip(pieces.spelled, np.exp(pieces.log_p)))
    assert all(subword_lm.BEGIN not in s[1:] for s in p)
    one, a, the = subword_lm.word_log_p(pa.array(["a▁the", "a", "the"]), pieces)
    assert one == pytest.approx(math.log(sum(segmentations(subword_lm.symbols_of("a▁the"), p))))
    assert one < a + the - 1


def test_scores_end_to_end_equal_listed_segmentations(spark):
    """Without fitting, a text's score is the product over its words and the end."""
    pieces = subword_lm.load_pieces()
    p = dict(zip(pieces.spelled, np.exp(pieces.log_p)))
    texts = {1: "The  then\tthe", 2: "a▁b", 3: "théo x1 the", 4: None, 5: "漢"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    end = float(pieces.log_p[pieces.end])
    for r in subword_lm.score_documents(docs, rounds=0).collect():
        logs = [math.log(sum(segmentations(subword_lm.symbols_of(w), p))) for w in WORD.findall(lower(texts[r.doc_id] or ""))]
        assert r.score == pytest.approx((math.fsum(logs) + end) / math.log(10))


def test_expected_counts_spell_the_words():
    pieces = subword_lm.load_pieces()
    words, times = pa.array(["the", "then", "漢字", "x" * 50]), np.array([3.0, 1.0, 2.0, 1.0])
    got = subword_lm.expected_counts(words, times, pieces)
    size = np.array([len(s) for s in pieces.spelled] + [0])
    want = sum(t * len(subword_lm.symbols_of(w)) for w, t in zip(words.to_pylist(), times))
    assert (got * size).sum() == pytest.approx(want)


def test_scores_of_odd_rows(spark):
    out = subword_lm.score_documents(odd_docs(spark), rounds=1).collect()
    assert len(out) == len(odd_rows())
    toks = [(i, WORD.findall(lower(t or "")) + [None]) for i, t, _, _ in odd_rows()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(x for i, words in toks if not held(i) for x in words)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, held(i), len(w), sum(c[x] > 0 for x in w), n,
                   round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in toks)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                  round(r.base_score, 6)) for r in out)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    same = {r.doc_id: r.score for r in out}
    assert same[1] == pytest.approx(same[2]) and same[7] == pytest.approx(same[14])
    assert same[5] == same[6] > same[7]
    assert subword_lm.score_documents(no_docs(spark)).count() == 0
    only_held = odd_docs(spark).filter("pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2")
    for r in subword_lm.score_documents(only_held).collect():
        assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0)


# ------------------------------------------------------------------ quality

def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (6000, 15)), rng.normal(-1.5, 1, (2000, 15))
    model = pu_quality.fit(good[:3000], np.vstack((good[3000:], bad[:1000])))
    assert model.prior == pytest.approx(0.75, abs=0.08)
    assert (model.score(good) >= 0.3).mean() > 0.98
    assert (model.score(bad[1000:]) >= 0.3).mean() < 0.05


def test_quality_learns_from_training_labels_only(spark):
    junk = "SPAM!! ### " * 60
    prose = lambda i: " ".join(f"word{(i * k) % 97} and{k % 13}" for k in range(1, 90)) + "."
    rows = [(i, junk if i % 4 == 0 else prose(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, int(i % 4 != 0)) for i in range(400)]
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = [(i, 1 - q if i in held else q) for i, q in labels]
    score = lambda x: {r.doc_id: r.score for r in pu_quality.with_score(
        docs, pu_quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int")), keep=["doc_id"]).collect()}
    right = score(labels)
    assert right == score(wrong)                      # held-out labels change nothing
    assert np.mean([(right[i] >= 0.3) == (i % 4 != 0) for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in right.values())


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1), (99, 1)], "doc_id long, quality int")
    for held, n in ((labels, 18), (labels.limit(0), 18)):
        out = pu_quality.with_score(odd_docs(spark), pu_quality.train(odd_docs(spark), held), "_s")
        scores = out.select("doc_id", "_s").collect()
        assert len(scores) == n and all(0 <= r._s <= 1 for r in scores)
    assert pu_quality.keep_quality(no_docs(spark), labels).count() == 0
    assert pu_quality.keep_quality(odd_docs(spark), labels).columns == odd_docs(spark).columns


# ------------------------------------------------------------------ mixing

def test_rake_meets_the_marginals():
    rng = np.random.default_rng(0)
    at = [rng.integers(0, 3, 200), rng.integers(0, 4, 200)]
    tokens = rng.integers(1, 1000, 200).astype(float)
    goals = [np.array([0.5, 0.3, 0.2]), np.array([0.25] * 4)]
    f, g = mixing.rake(tokens, at, goals)
    weight = tokens * f[at[0]] * g[at[1]]
    for where, goal in zip(at, goals):
        assert np.bincount(where, weight) / weight.sum() == pytest.approx(goal, abs=1e-8)


def test_scale():
    tokens, factor = np.array([10.0, 20.0, 30.0]), np.array([1.0, 2.0, 4.0])
    assert mixing.scale_for(tokens, factor, None) == 0.25
    s = mixing.scale_for(tokens, factor, 0.8)
    assert (tokens * np.minimum(1, s * factor)).sum() == pytest.approx(48)
    assert mixing.scale_for(tokens[:0], factor[:0], 0.5) == 1.0


def test_sample_has_the_target_weights(spark):
    rows = [(i, " ".join(f"longword{(i + k) % 50}" for k in range(20)), "en" if i % 3 else "de",
             "hot" if i % 2 else f"s{i % 4}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    goal = {"source": {"hot": 0.2, "s0": 0.4, "s2": 0.4}, "lang": {"en": 0.5, "de": 0.5}}
    out = mixing.mix_report(docs, targets=goal, fraction=0.3).toPandas()
    assert len(out) == 4000 and out.probability.between(0, 1).all()
    kept = out[out.kept]
    for dim, target in goal.items():
        expected = (out.n_tokens * out.probability).groupby(out[dim]).sum()
        if out.probability.max() < 1:
            assert (expected / expected.sum()).to_dict() == pytest.approx(target, abs=1e-6)
        got = kept.groupby(dim).n_tokens.sum() / kept.n_tokens.sum()
        assert got.to_dict() == pytest.approx(target, abs=0.05)
    assert kept.n_tokens.sum() / out.n_tokens.sum() == pytest.approx(0.3, abs=0.04)
    again = {r.doc_id for r in mixing.keep_mixed(docs.repartition(7), targets=goal, fraction=0.3).collect()}
    assert again == set(kept.doc_id)


def test_mixing_odd_rows(spark):
    out = mixing.mix_report(odd_docs(spark)).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r.probability <= 1 for r in out)
    assert len({r.kept for r in out if r.doc_id == 13}) == 1
    kept = mixing.keep_mixed(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(map(str, (r.doc_id for r in out if r.kept))) == sorted(str(r.doc_id) for r in kept.collect())
    assert mixing.keep_mixed(no_docs(spark)).count() == 0 and mixing.mix_report(no_docs(spark)).count() == 0


def test_one_rare_document_does_not_shrink_the_sample(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, " ".join(f"longword{(i + k) % 50}" for k in range(20)), "en" if i % 3 else "de",
             f"s{i % 4}") for i in range(1500)]

    def share(rows):
        out = mixing.mix_report(spark.createDataFrame(rows, schema)).toPandas()
        return (out.n_tokens * out.probability).sum() / out.n_tokens.sum()

    before = share(rows)
    for lang in ("xx", None):
        assert share([*rows, (9999, "few words", lang, "s1")]) == pytest.approx(before, abs=0.01)
    assert before == pytest.approx(mixing.FRACTION, abs=1e-6)


def tail_docs(spark):
    """A third of the rows in one source, the others in 400, which all are far below
    1/256 of the tokens."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"longword{w}" for w in rng.integers(0, 50, rng.integers(1, 6))),
             ("en", "de", None)[rng.integers(3)], "hot" if i % 3 == 0 else f"s{rng.integers(400)}")
            for i in range(6000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("cells", [mixing.DRIVER_CELLS, 0])
def test_every_value_of_a_long_tail_meets_its_target(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "DRIVER_CELLS", cells)
    if not cells:
        monkeypatch.setattr(mixing, "MAP_VALUES", 100)       # sources are joined, languages sent
        monkeypatch.setattr(mixing, "TOLERANCE", 1e-5)       # enough for what is asserted
    out = mixing.mix_report(tail_docs(spark), fraction=0.1).toPandas().fillna({"lang": "-"})
    assert out.source.nunique() == 401
    for dim in ("source", "lang", "topic"):
        share = out.groupby(dim).n_tokens.sum() / out.n_tokens.sum()
        target = share ** mixing.TEMPER / (share ** mixing.TEMPER).sum()
        raked = (out.n_tokens * out.weight).groupby(out[dim]).sum() / (out.n_tokens * out.weight).sum()
        assert raked.to_dict() == pytest.approx(target.to_dict(), rel=1e-2)
    assert (out.n_tokens * out.probability).sum() / out.n_tokens.sum() == pytest.approx(0.1, rel=1e-6)


def test_spread_scale_is_that_of_the_driver(spark):
    tokens, factor = np.array([10, 20, 30, 5]), np.array([1.0, 2.0, 4.0, 300.0])
    raked = spark.createDataFrame(list(zip(tokens.tolist(), factor.tolist())), "n long, f double")
    for fraction in (None, 0.01, 0.3, 0.8, 0.99):
        assert mixing._scale_spread(raked, fraction) == pytest.approx(mixing.scale_for(tokens, factor, fraction))


@pytest.mark.parametrize("cells", [mixing.DRIVER_CELLS, 0])
def test_a_target_for_a_rare_value_is_met(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "DRIVER_CELLS", cells)
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-5)
    rows = [(i, "longword " * 20, None if i % 2 else "en", "wiki" if i % 1000 < 2 else "hot") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    goal = {"source": {"hot": 0.7, "wiki": 0.3}, "lang": {None: 0.5, "en": 0.5}}
    out = mixing.mix_report(docs, targets=goal).toPandas()
    expected = (out.n_tokens * out.probability).groupby(out.source).sum()
    assert (expected / expected.sum()).to_dict() == pytest.approx(goal["source"], abs=1e-3)
    wiki = out[out.source == "wiki"]
    assert len(wiki) == 8 and wiki.kept.all()                # each as likely as can be


def test_weights_are_the_ids_that_are_packed(spark):
    out = mixing.with_topic(odd_docs(spark).select("doc_id", "text"), prefix="_").collect()
    assert len(out) == len(odd_rows()) and all(r._n_tokens == len(tokens.ids_of(r.text)) for r in out)


def test_a_hot_id_does_not_fill_the_sample(spark):
    """An id on thousands of rows, with one text or many, stays within the bound."""
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(words[:5 + i % 40])) for i in range(600)]
    rows += [(7, "hot text that repeats")] * 5000 + [(9, f"hot id with text {i}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4, 7, 9)], "doc_id long, quality int")
    x_p, x_u = pu_quality.draw_sample(docs, labels, 400, 400)
    assert 320 <= len(x_p) <= 480 and 320 <= len(x_u) <= 480
    once = spark.createDataFrame(list(dict.fromkeys(rows)), "doc_id long, text string")
    y_p, y_u = pu_quality.draw_sample(once, labels, 400, 400)
    assert sorted(map(tuple, x_p)) == sorted(map(tuple, y_p)) and sorted(map(tuple, x_u)) == sorted(map(tuple, y_u))
