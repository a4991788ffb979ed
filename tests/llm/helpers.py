"""Small inputs with the hard cases, and brute-force text rules."""

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # names that operators use themselves
        "n_words long, kept string, score string, fp string, component_id string, topic string, "
        "n_tokens string, weight string, word string, length string, q_n_words long, "
        "_q_n_words long, _quality_score string, _mix_topic string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, ties and repeats."""
    prose = " ".join(f"w{i % 37} the{i % 11} of{i % 5}" for i in range(80))
    return [
        (1, prose, "en", "a"), (2, prose, "en", "a"), (3, prose + " end", None, "b"), (4, None, "en", None),
        (5, "", "de", "b"), (6, " \t\n ", "de", "b"), (7, "one", "de", "b"), (8, "One TWO", "fr", "b"),
        (9, "Ünï çödé 漢字 " * 40, "fr", "b"), (10, "x" * 30_000, "fr", "a"),
        (11, "long words " * 20_000, "en", "a"), (None, prose, "en", "a"), (None, None, None, None),
        (12, "a\nb\na\n\na b\n", "en", "b"), (13, "SHOUT!! " * 100, "en", "b"), (13, "SHOUT!! " * 100, "en", "b"),
        (14, "one", "de", "b"), (15, "a b a b a b a b", "es", "b"),
    ]


def odd_docs(spark):
    return spark.createDataFrame([(i, t, la, s, len(t or ""), 7, *["x"] * 9, 9, 9, "x", "x") for i, t, la, s in odd_rows()], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def closure(nodes, links):
    """Smallest node that each reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
