"""The registered queries on the smallest tables: SQL where there is some, else sizes and reruns."""

import pytest

from exactsync.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
EXPECTED = {
    "op1_mixing": "doc_id size source_size target taken",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_quality": "doc_id held_out score predicted",
    "op4_language_id": "doc_id held_out lang_pred score",
    "op5_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op6_vector_dedup": "vec_id n_links component_id kept",
    "op7_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op8_nearest": "query_id rank vec_id score",
    "op9_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op11_url_filter": "page_id host path rule verdict",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_source_divergence": "lang source part item value rank",
}


def test_all_are_registered():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_one_row_per_document(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.columns == EXPECTED[name].split()
    rows = df.count()
    if name == "op8_nearest":
        assert rows == 20 * spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id % 20 = 0").count()
    elif name == "op7_packing":
        assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    elif name == "op13_source_divergence":
        groups = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "source").distinct()
        assert df.where("part = 'pair'").select("lang", "source").distinct().count() <= groups.count() and rows
    else:
        source = {"op6_vector_dedup": "embeddings", "op11_url_filter": "pages"}.get(name, "documents")
        assert rows == spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
