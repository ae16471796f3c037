"""Token counts against the tokenizers library on hand-made and generated texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textspark.llm.bpe_count import PieceCounter, load_merges, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = PieceCounter(load_merges(PATH))

TEXTS = ["", " ", "hello  world\n\n\tit's 12345 ½ ", "naïve façade 日本語 \U0001f600\U0001f468‍\U0001f469",
         "a<|endoftext|>b <|endoftext|> <|endoftext|><|endoftext|>", "<|endoftext", "x" * 5000, "ab" * 3000,
         "\x00\x01  　 end", "We'll they'VE don't", " " * 700 + "z", "́combining é"]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", TEXTS)
def test_hand_made(text):
    assert COUNTER.count(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode("utf-8")
    assert COUNTER.count(text) == library(text)


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(99, None, "y"), (None, "null id", "z"), (0, TEXTS[0], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = token_counts(df, PATH, limit=5).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()), library(t or ""), library(t or "") > 5) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts(df.limit(0), PATH).count() == 0
