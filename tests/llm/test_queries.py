import __spark_entry__ as contract

COLUMNS = {
    "op1": "doc_id size text_crc32 law shard slot grown_shard",
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id fingerprint component_id",
    "op8": "doc_id size source_size target taken",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10": "doc_id held_out lang_pred score",
    "op11": "doc_id n_bytes n_tokens over_limit",
    "op12": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13": "item_id rank doc_id score",
}


def test_registered_queries_have_the_stated_columns_and_all_rows(spark, sf_dir):
    names = {name.split("_")[0]: name for name in contract.queries() if name.startswith("op")}
    assert names.keys() == COLUMNS.keys() and "pipeline" in contract.queries()
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for key, columns in COLUMNS.items():
        df = contract.queries()[names[key]](spark, sf_dir)
        assert set(columns.split()) <= set(df.columns), key
        assert df.count() == n or key == "op13", key  # op13 has rows per item
