"""Every registered query of the subpackage over the smallest tables: columns and rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
# the columns that each result has to begin with, by query
COLUMNS = {
    "op1_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_line_tokens": "doc_id section start end n_tokens n_crossing token_share",
    "op3_tiled_benchmark": "doc_id item_id item_words matched_words coverage n_tiles",
    "op4_signature_ngrams": "doc_id n_shingles component_id",
    "op5_minimax_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_sentence_toxicity": "doc_id held_out score predicted",
    "op7_byte_language": "doc_id held_out lang_pred score",
    "op8_trigram_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9_lattice_vectors": "vec_id n_links component_id kept",
    "op10_surrogate_personal_data": "doc_id text n_entities kinds",
    "op11_max_sketch_search": "item_id rank doc_id score",
    "op12_class_ngrams": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op13_truncated_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset",
}
PER_DOCUMENT = [q for q in COLUMNS if q.split("_")[0] in ("op4", "op5", "op6", "op7", "op8", "op10", "op12")]


def test_all_are_registered():
    own = {q for q in driver.queries() if q.startswith("op") and q[2].isdigit() or q == "pipeline"}
    assert own == set(COLUMNS)


@pytest.mark.parametrize("name", [q for q in COLUMNS if q != "pipeline"])
def test_columns_and_rows(spark, name):
    out = driver.queries()[name](spark, SF_DIR)
    assert out.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    if name in PER_DOCUMENT:
        documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        assert out.select("doc_id").exceptAll(documents.select("doc_id")).count() == 0
        assert out.count() == documents.count()
    else:
        assert out.count() > 0
