import pytest

import __spark_entry__ as entry
from homesense.llm.queries import QUERIES
from homesense.plans.compare import compare, duckdb_with_views

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op2_language_id": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op3_embedding_neardup": [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    "op4_license_scan": [("doc_id", "bigint"), ("n_matches", "int"), ("best_dice", "double"), ("licenses", "string")],
    "op5_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op6_substring_dedup": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")],
    "op7_lm_score": [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"),
                     ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
    "op8_decontamination": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"),
                            ("items_sha256", "string"), ("contaminated", "boolean")],
    "op9_packing": [("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                    ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op10_sharding": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                      ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
    "op11_prefix_trie": [("conv_id", "bigint"), ("depth", "bigint"), ("parent_conv_id", "bigint"), ("n_convs", "bigint"),
                         ("n_children", "bigint"), ("n_leaves", "bigint"), ("saved_tokens", "bigint"), ("ends_sha256", "string")],
    "op12_quality": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
                     ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("llr", "double"), ("base_failed", "boolean"),
                     ("kept", "boolean")],
    "op13_search": [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")],
}
#: Results that are not one row per document or vector.
OTHER_ROWS = {"op11_prefix_trie", "op13_search"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    fn, sql = QUERIES[name]
    out = fn(spark, SF)
    assert out.dtypes == COLUMNS[name]
    pdf = out.toPandas()
    key = out.columns[0]
    ids = [] if name in OTHER_ROWS else \
        spark.read.parquet(f"{SF}/{'embeddings' if key == 'vec_id' else 'documents'}.parquet").select(key).toPandas()[key]
    if name == "op9_packing":
        assert set(pdf.doc_id) == set(ids)
    elif name not in OTHER_ROWS:
        assert sorted(pdf[key]) == sorted(ids)
    if sql:
        ok, why = compare(pdf, duckdb_with_views(SF).sql(sql).df())
        assert ok, why
