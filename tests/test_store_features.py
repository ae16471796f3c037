import os
import uuid

import pytest
from pyspark.sql import functions as F

from textspark.operators import encode as E
from textspark.operators import features as X
from textspark.operators import lm as L
from textspark.session import ensure_checkpoint_dir
from textspark.sources import store


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"test-{name}-{uuid.uuid4().hex}")


def test_tokenizer_save_load_and_json_round_trip(spark):
    docs = spark.createDataFrame([(0, "the theme then thy thaw\n")], "doc_id long, text string")
    tok = E.BpeTokenizer.train(docs, 12)
    path = _scratch(spark, "tok")
    store.save_tokenizer(tok, path)
    loaded = store.load_tokenizer(spark, path)
    again = store.tokenizer_from_json(spark, store.tokenizer_to_json(loaded))
    want = sorted((r.token, r.id) for r in tok.vocab.collect())
    assert sorted((r.token, r.id) for r in again.vocab.collect()) == want
    assert [r[:3] for r in again.merge_rows] == [r[:3] for r in tok.merge_rows]
    enc = again.encode(docs)
    assert again.decode(enc).first()["decoded"] == "the theme then thy thaw\n"
    with pytest.raises(Exception):
        store.save_tokenizer(tok, path)          # refuses to overwrite


def test_model_save_load_defaults(spark):
    docs = spark.createDataFrame([(0, "abcabcab")], "doc_id long, text string")
    tok = E.CharTokenizer.train(docs)
    m = L.fit_ngram(tok.encode(docs), tok.vocab.count())
    path = _scratch(spark, "model")
    store.save_model(m, path)
    loaded, meta = store.load_model(spark, path)
    assert meta["epoch"] == 0 and meta["val_loss"] == float("inf")
    assert sorted(map(tuple, loaded.pairs.collect())) == sorted(map(tuple, m.pairs.collect()))
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, _scratch(spark, "missing"))


def test_destination_rules():
    assert store.destination("/x", "/base", "/data/corpus.txt") == "/x"
    assert store.destination(None, "/base", "/data/dialog_corpus.txt") == "/base/dialog_corpus"
    assert store.destination(None, "/base", None) == "/base"


def test_embedding_lookup_positions_and_usage(spark):
    table = spark.createDataFrame([(i, [float(i), float(10 * i)]) for i in range(4)],
                                  "vec_id long, embedding array<float>")
    toks = spark.createDataFrame([(0, [1, 3, 1])], "doc_id long, ids array<int>")
    looked = X.embedding_lookup(toks, table)
    got = sorted((r.pos, list(r.embedding)) for r in looked.collect())
    assert got == [(0, [1.0, 10.0]), (1, [3.0, 30.0]), (2, [1.0, 10.0])]
    pos = table.select(F.col("vec_id").alias("pos"), "embedding")
    added = sorted((r.pos, list(r.embedding)) for r in X.add_positions(looked, pos, 4).collect())
    assert added == [(0, [1.0, 10.0]), (1, [4.0, 40.0]), (2, [3.0, 30.0])]
    usage = {r.vec_id: r.uses for r in X.row_usage(toks, table).collect()}
    assert usage == {0: 0, 1: 2, 2: 0, 3: 1}


def test_unfinished_and_refused_saves_cannot_be_seen(spark):
    import dataclasses
    import pytest
    from textspark.operators import lm
    df = spark.createDataFrame([(0, "abcab cab ba")], "doc_id long, text string")
    tok = E.CharTokenizer.train(df)
    enc = tok.encode(df)
    m = lm.fit_ngram(enc, tok.vocab.count())
    path = _scratch(spark, "atomic")
    want = lm.counted_scores(enc, m.vocab_size)
    bad = dataclasses.replace(m, pairs=m.pairs.withColumn("n", F.col("n") + 1))
    with pytest.raises(ValueError):
        store.save_model(bad, path, scores=want)
    bad.pairs.write.parquet(os.path.join(path, "version-7", "pairs"))          # as left by a killed save
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, path)
    store.save_model(m, path, scores=want, tokenizer=tok)
    with pytest.raises(FileExistsError):
        store.save_model(m, path)
    with pytest.raises(ValueError):
        store.save_model(bad, path, overwrite=True, scores=want)
    assert store.load_model(spark, path)[0].pairs.agg(F.sum("n")).first()[0] == m.pairs.agg(F.sum("n")).first()[0]
    assert store.load_model_tokenizer(spark, path).vocab.count() == tok.vocab.count()
    store.save_model(bad, path, overwrite=True)
    assert store.load_model(spark, path)[0].pairs.agg(F.sum("n")).first()[0] > m.pairs.agg(F.sum("n")).first()[0]


def test_a_large_file_is_read_by_many_tasks_in_order(spark, tmp_path):
    from textspark.sources.corpus import load_text_lines
    lines = [f"line {i} " + "é" * (i % 90) for i in range(20_000)]
    lines[7] = ""
    (tmp_path / "b.txt").write_bytes("\n".join(lines).encode())
    (tmp_path / "a.txt").write_bytes("first\r\n\nlast of a\n".encode())
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, "100000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = [r.text for r in load_text_lines(spark, str(tmp_path)).orderBy("doc_id").collect()]
    finally:
        spark.conf.set(name, before)
    assert got == ["first\r", "", "last of a", *lines]
    with pytest.raises(Exception):
        load_text_lines(spark, str(tmp_path / "missing"))
