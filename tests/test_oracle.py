"""Registered queries against their DuckDB oracle on the smallest tables."""

import pytest

from textspark.plans import ORACLE, QUERIES
from textspark.plans.oracle_check import compare, duck_connection

FAST = ["s1_load_corpus", "p1_bpe_chunks", "p2_word_split", "p4_top_chunks", "t5_clean_utterance",
        "t11_recent_chats", "s2_parse_dialogue_lines", "d3_format_dialogue", "d4_dedup_exact_first",
        "d6_corpus_summary", "v2_word_vocab", "v7_bpe_train", "e3_bpe_encode", "e5_decode_words",
        "w1_contiguous_split", "w2_sliding_windows", "l3_cross_entropy", "l8_best_checkpoint",
        "g3_softmax", "g6_generate", "g13_validate_requests", "g17_stream_corpus_counts"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], con)
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["chunk", "freq"]
