"""Vector near-duplicates, web archives and preference pairs."""

import hashlib
import io
import random

import numpy as np
import pytest
import zstandard

from ledgerlens.llm import preference_format, vector_dedup, warc_dict

from .helpers import closure

# ------------------------------------------------------------------ vectors


def test_hadamard_is_orthonormal():
    h = vector_dedup.hadamard(np.eye(64))
    assert np.allclose(h @ h.T, np.eye(64))


def test_planned_tables_rarely_miss():
    for rows in (100, 1 << 20):
        k, tables = vector_dedup.plan_tables(rows, 64)
        rng = np.random.default_rng(5)
        x, g = rng.normal(size=(2, 3000, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        g -= (x * g).sum(1, keepdims=True) * x
        g /= np.linalg.norm(g, axis=1, keepdims=True)
        y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * g
        a, b = vector_dedup.codes_of(x, k, tables), vector_dedup.codes_of(y, k, tables)
        met = (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean()
        assert met >= 0.998


@pytest.mark.parametrize("block", [1024, 16])
def test_links_and_components_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for size in (60, 5, 1, 1, 2):
            centre = rng.normal(size=16)
            for _ in range(size):
                v = centre + rng.normal(size=16) * 0.25
                rows.append((n, v.astype(np.float32).tolist(), label))
                n += 1
    rows += [(n + k, rows[k][1], rows[k][2]) for k in range(20)]              # exact copies
    n += 20
    rows += [(n, [2 * x for x in rows[0][1]], 0), (n + 1, rows[0][1], None), (n + 2, None, 0), (n + 3, [], 0),
             (n + 4, [0.0] * 16, 0), (n + 5, [float("nan")] * 16, 0), (n + 6, [1.0, None] + [0.0] * 14, 0),
             (n + 7, [float("inf")] * 16, 0), (n + 8, rows[0][1][:4], 0)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, n long")
    out = {r.vec_id: r for r in vector_dedup.near_duplicates(df, block=block).collect()}
    unit = {}
    for i, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(np.float32(v), float)
            unit[i] = (label, x / np.linalg.norm(x))
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0]
             and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93]
    want = closure([r[0] for r in rows], pairs)
    links = {i: 0 for i in want}
    for p in pairs:
        for i in p:
            links[i] += 1
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in out.items()} == {
        i: (links[i], want[i], want[i] == i) for i in want}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(None, [1.0, 2.0], 0), (3, [1.0, 2.0], 0), (3, [1.0, 2.0], 0)], df.schema)
    assert [(r.n_links, r.component_id) for r in vector_dedup.near_duplicates(df).collect()] == [(2, 3)] * 3


# ------------------------------------------------------------------ archives

def test_archive_round_trip_and_random_access():
    rng = random.Random(0)
    words = ["alpha", "beta", "gamma", "delta"]
    payloads = [" ".join(rng.choices(words, k=rng.randrange(0, 300))).encode() for _ in range(300)]
    payloads += [b"", b"\r\n\r\nWARC/1.1\r\n", bytes(range(256)) * 2000]
    records = [warc_dict.record_bytes(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None)
               for i, p in enumerate(payloads)]
    data, dict_bytes = warc_dict.archive_bytes(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and dict_bytes > 0
    read = list(warc_dict.read_archive(io.BytesIO(data)))
    assert [b.partition(b"\r\n\r\n")[2] for _, b in read] == payloads
    # one record alone, from its own frame
    known = zstandard.ZstdCompressionDict(data[8:8 + dict_bytes])
    first = zstandard.ZstdDecompressor(dict_data=known).decompressobj().decompress(data[8 + dict_bytes:])
    assert first == records[0]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records[:300])
    assert len(data) - dict_bytes < plain


@pytest.mark.parametrize("records", [[], [b"x"], [b"abc" * 10] * 3])
def test_archives_of_few_records(records):
    data, _ = warc_dict.archive_bytes([warc_dict.record_bytes(1, "u", r, "d", None) for r in records])
    assert [b.partition(b"\r\n\r\n")[2] for _, b in warc_dict.read_archive(io.BytesIO(data))] == records
    with pytest.raises(ValueError):
        list(warc_dict.read_archive(io.BytesIO(b"\x28\xb5\x2f\xfd" + data[4:])))


def test_pages_come_back(spark):
    long = "<p>ü " + "x" * 200
    rows = [(1, "u1", None), (2, None, ""), (3, "u\r\nX: y", "short"), (4, "u", "short"), (5, "u", long), (6, "u", long),
            (7, "u", long), (5, "u", long), (None, "u", long), (None, "u", "y" * 150), (8, "u", "z" * 99), (9, "u", "z" * 99),
            (10, "u", "w" * 100), (11, "u", "w" * 100), (12, "u", "q" * 2_000_000)]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    from ledgerlens.llm import shared
    folder = shared.new_path(spark, "warc")
    files = warc_dict.write_archives(warc_dict.decide(pages), folder, archive=1000)
    assert files.count() > 2
    got = warc_dict.read_archives(files).collect()
    key = lambda r: tuple(str(x) for x in r)
    want = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        first = min(same, default=None) if len(payload) >= 100 else None
        again = first is not None and first != page
        want.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                     "revisit" if again else "response", first if again else None))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    none = warc_dict.write_archives(warc_dict.decide(pages.limit(0)), shared.new_path(spark, "warc"))
    assert none.count() == 0 and warc_dict.read_archives(none).count() == 0


# ------------------------------------------------------------------ preference pairs

def brute_pair(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def render(turns):
        text, spans = "", []
        for role, body in turns:
            text += f"<|{'unknown' if role is None else role}|>\n"
            end = (body or "") + "<|end|>\n"
            if role == "assistant":
                spans.append((len(text), len(end)))
            text += end
        return text, spans

    return (n, render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:]))


def test_pairs_equal_brute_force(spark):
    rng = random.Random(1)
    talks = {}
    for p in range(40):
        talk = [(rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "bb", "", None, "çé🙂"]))
                for _ in range(rng.randrange(0, 7))]
        other = talk[:rng.randrange(0, len(talk) + 1)] + [(rng.choice(["user", "assistant"]), "x")
                                                          for _ in range(rng.randrange(0, 3))]
        talks[p] = (talk, other)
    rows = [(p, side, 2 * k, r, t, 1) for p, pair in talks.items() for side, turns in zip(("chosen", "rejected"), pair)
            for k, (r, t) in enumerate(turns)]
    rows += [(None, "chosen", 0, "user", "lost", 1), (3, "neither", 0, "user", "lost", 1)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string, prompt long")
    got = {r.pair_id: r for r in preference_format.format_pairs(turns).collect()}
    assert set(got) == {p for p, (a, b) in talks.items() if a or b}
    for p, r in got.items():
        spans = lambda s: [tuple(x) for x in s]
        assert (r.prompt_turns, r.prompt, r.chosen, spans(r.chosen_spans), r.rejected,
                spans(r.rejected_spans)) == brute_pair(*talks[p])
    assert preference_format.format_pairs(turns.limit(0)).count() == 0


def test_swapped_replies_and_native_plan(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (2, 0, "assistant", "b0"),
            (2, 1, "assistant", "b1"), (4, 0, "user", "alone"), (None, 0, "assistant", "z"), (5, None, "assistant", None)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = preference_format.swapped_replies(talks)
    text = {(r.pair_id, r.side, r.turn): r.text for r in pairs.collect()}
    assert text[1, "chosen", 1] == "a1" and text[1, "rejected", 1] == "b1" and text[1, "rejected", 2] == "r"
    assert text[2, "rejected", 0] == "b0" and text[2, "rejected", 1] == ""
    assert text[4, "rejected", 0] == "alone" and (5, "rejected", None) in text
    plan = preference_format.format_pairs(pairs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
