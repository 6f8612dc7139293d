import duckdb
import pytest

import __spark_entry__ as entry
import check
from floodmark.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries()) and set(LLM_ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert check.rows(df.collect(), df.columns, sorted(names)) == check.rows(cur.fetchall(), names, sorted(names))


CONTRACT = {
    "op1_minhash_near_dedup": "doc_id bigint n_shingles bigint component_id bigint kept boolean",
    "op2_secret_scan": "doc_id bigint n_assign bigint n_access bigint n_hex bigint base_sha256 string spans string",
    "op5_language_id": "doc_id bigint held_out boolean lang_pred string score double",
    "op6_url_filter": "page_id bigint host string path string rule string verdict string",
    "op7_pii": "doc_id bigint n_email bigint n_ip bigint n_card bigint n_phone bigint base_sha256 string spans string",
    "op8_byte_level_bpe": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string",
    "op10_quality_rules": "doc_id bigint n_words bigint word_chars bigint n_symbols bigint n_dup_lines bigint n_repeat_words bigint base_failed boolean kept boolean",
    "op11_conversation_prefix_trie": "conv_id bigint depth bigint parent_conv_id bigint n_convs bigint n_children bigint n_leaves bigint saved_tokens bigint ends_sha256 string",
    "op12_embedding_whitening": "vec_id bigint component int n bigint deviation bigint whitened double explained double identity_error double",
    "op13_token_counts": "doc_id bigint n_bytes bigint n_tokens bigint over_limit boolean",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    df = LLM_QUERIES[name](spark, SF)
    want = CONTRACT[name].split()
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in want[::2]} == dict(zip(want[::2], want[1::2]))
    if name.startswith(("op11", "op12")):
        return
    assert df.count() == spark.read.parquet(f"{SF}/{'pages' if name.startswith('op6') else 'documents'}.parquet").count()
