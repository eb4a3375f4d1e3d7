"""The registered queries against their SQL, and without it against their operators' columns."""

import __spark_entry__ as entry
import pytest
from check import compare
from conftest import SMALL

from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SMALL, name) is None


def test_ten_queries_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert set(QUERIES) < set(names)


COLUMNS = {
    "op2_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op4_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op5_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op6_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op9_language_id": {"doc_id", "language", "posterior", "accepted"},
    "op10_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = entry.queries()[name](spark, SMALL)
    assert COLUMNS[name] <= set(found.columns)
    assert found.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
