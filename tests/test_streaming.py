import json
import os
import uuid

from pyspark.sql import functions as F

from textspark.functions import constants as K
from textspark.operators import encode as E
from textspark.operators import lm as L
from textspark.session import ensure_checkpoint_dir
from textspark.streaming import corpus_counts
from textspark.streaming import requests as RS
from textspark.operators import pretok


corpus_counts_schema = "chunk string, freq bigint"


def _dir(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"test-{name}-{uuid.uuid4().hex}")


def test_request_stream_answers_and_rejects(spark):
    docs = spark.createDataFrame([(0, "abcab cabca bcabc\n" * 10)], "doc_id long, text string")
    tok = E.CharTokenizer.train(docs)
    model = L.fit_ngram(tok.encode(docs), tok.vocab.count())
    payloads = [{"prompt": "ab", "max_new_tokens": 3, "temperature": 0},
                {"prompt": "   "},
                {"prompt": "ca", "max_new_tokens": "2", "temperature": 0.5, "seed": 3},
                {"prompt": "x", "chat": "yes"}]
    src = _dir(spark, "req")
    spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)],
                          "request_id bigint, payload string").write.parquet(src)
    out = _dir(spark, "out")
    RS.serve(RS.request_stream(spark, src), tok, model, _dir(spark, "ck"), out)
    got = {r.request_id: r for r in spark.read.parquet(out).collect()}
    assert got[0].error is None and got[0].prompt == "ab" and len(got[0].continuation) == 3
    assert got[1].error == K.MSG_EMPTY_PROMPT
    assert got[2].error is None and got[2].new_tokens == 2
    assert got[3].error == K.MSG_CHAT_BOOL


def test_stream_counts_equal_batch(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(["a b  c\n", "a a b", "c\n\nd", "the theme"])]
    src = _dir(spark, "docs")
    df = spark.createDataFrame(rows, corpus_counts.DOC_SCHEMA)
    df.repartition(4).write.parquet(src)
    out = _dir(spark, "counts")
    stream = corpus_counts.chunk_count_stream(spark, src, max_files_per_trigger=1)
    corpus_counts.run_to_table(stream, _dir(spark, "ck2"), out, compact_every=2)
    local = out.removeprefix("file:")
    assert len(os.listdir(os.path.join(local, "snapshot"))) == 1 and len(os.listdir(os.path.join(local, "delta"))) < 2
    # what a killed compaction may leave: a snapshot without its success mark, and parts that one covers
    spark.createDataFrame([("a", 99)], corpus_counts_schema).write.parquet(os.path.join(out, "snapshot", "upto=77"))
    os.remove(os.path.join(local, "snapshot", "upto=77", "_SUCCESS"))
    spark.createDataFrame([("a", 1)], corpus_counts_schema).write.mode("overwrite").parquet(os.path.join(out, "delta", "epoch=0"))
    streamed = {r.chunk: r.freq for r in corpus_counts.latest_counts(spark, out).collect()}
    batch = {r.chunk: r.freq for r in pretok.chunk_frequencies(df).collect()}
    assert streamed == batch
