"""The registered queries of the subpackage on a whole test table."""

import pytest

import __spark_entry__ as E
from ledgerlens.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = {"op2": "embeddings", "op5": None, "op8": "pages", "op12": "benchmark", "op13": None}
COLUMNS = {
    "op1": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op2": {"vec_id", "n_links", "component_id", "kept"},
    "op3": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op4": {"doc_id", "fingerprint", "component_id"},
    "op6": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op8": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op10": {"doc_id", "held_out", "score", "predicted"},
    "op11": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op12": {"item_id", "rank", "doc_id", "score"},
    "op13": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
}
ONE_EACH = ("op1", "op2", "op4", "op6", "op8", "op9", "op10", "op11")


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(E.queries())
    assert set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, name):
    op = name.split("_")[0]
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    assert COLUMNS.get(op, set()) <= set(df.columns)
    table = TABLES.get(op, "documents")
    if table:
        whole = spark.read.parquet(f"{SF}/{table}.parquet")
        key = whole.columns[0]
        ids = [r[0] for r in whole.select(key).collect()]
        assert {r[key] for r in rows} == set(ids)
        if op in ONE_EACH:
            assert len(rows) == len(ids)
    elif op == "op5":
        talks = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
        assert len(rows) == talks
    else:
        assert rows
