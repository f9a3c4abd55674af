"""The registered queries against their SQL, and over odd tables."""

from __future__ import annotations

import pytest

from conftest import SF_DIR
from loomframe.llm.queries import CHECKS, QUERIES
from loomframe.session import drop_staged
from oracle_check import compare, connect

#: Columns that each query has to return.
COLUMNS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op6_quality_classifier": "doc_id held_out score predicted",
    "op7_nearest_neighbours": "query_id rank vec_id score",
    "op8_simhash_near_dedup": "doc_id fingerprint component_id",
    "op9_toxicity": "doc_id held_out score predicted",
    "op11_phrase_collocations": "lang rank phrase a l r n score",
    "op12_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_language_id": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, name):
    ok, note, _ = compare(spark, connect(SF_DIR), name, SF_DIR, QUERIES, CHECKS)
    assert ok, note
    drop_staged(spark)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    assert got.count() > 0
    drop_staged(spark)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    for table in ("documents", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
    drop_staged(spark)
