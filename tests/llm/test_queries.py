import os

import duckdb
import pytest

from playpulse.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ["conversations", "documents", "embeddings", "labels", "pages"]
FIRST = {
    "op1_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op2_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
    "op4_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op6_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op9_secret_scans": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op12_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op13_conversation_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op10_topk_search": "query_id bigint, rank int, vec_id bigint, score bigint",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(FIRST))
def test_result_columns(spark, name):
    df = queries.SPARK[name](spark, SF)
    assert ", ".join(" ".join(x) for x in df.dtypes).startswith(FIRST[name])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.SPARK[name](spark, SF)
    found = con.execute(queries.SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, found.fetchall()))
