"""Encoding by join: any vocabulary size, repeated keys, imported and byte-level merge tables."""

import json
import os
import uuid

from pyspark.sql import functions as F

from textspark.operators import encode as E
from textspark.session import ensure_checkpoint_dir
from textspark.sources import store


def _json_tokenizer(spark, stoi, merges, kind=None):
    body = {"stoi": stoi, "merges": merges} | ({"type": kind} if kind else {})
    return store.tokenizer_from_json(spark, spark.createDataFrame([(json.dumps(body),)], "value string"))


def test_rows_that_share_a_key_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "b"), (1, "a b"), (2, ""), (3, None)], "doc_id long, text string")
    tok = E.WordTokenizer.train(df)
    rows = tok.decode(tok.encode(df)).collect()
    assert sorted((r.doc_id, r.text or "", r.decoded) for r in rows) == [
        (1, "a b", "a b"), (1, "a b", "a b"), (1, "b", "b"), (2, "", ""), (3, "", "")]
    assert all(len(r.ids) == len((r.text or "").split()) for r in rows)


def test_large_vocabulary(spark):
    stoi = {"<pad>": 0, "<unk>": 1} | {f"w{i}": i + 2 for i in range(60_000)}
    tok = E.WordTokenizer(spark.createDataFrame(list(stoi.items()), "token string, id int"))
    df = spark.createDataFrame([(0, "w59999 w0 nothing w31")], "doc_id long, text string")
    assert list(tok.encode(df).first().ids) == [60_001, 2, 1, 33]


def test_imported_merges_take_the_lowest_rank_first(spark):
    stoi = {t: i for i, t in enumerate(["<pad>", "<unk>", "<bos>", "<eos>", "a", "b", "c", "ab", "abc"])}
    tok = _json_tokenizer(spark, stoi, [["ab", "c"], ["a", "b"]])
    df = spark.createDataFrame([(0, "abc")], "doc_id long, text string")
    assert list(tok.encode(df).first().ids) == [8]


def test_type_names_the_class(spark):
    assert isinstance(_json_tokenizer(spark, {"<unk>": 0, "a": 1}, [], "char"), E.CharTokenizer)
    assert isinstance(_json_tokenizer(spark, {"<pad>": 0, "<unk>": 1}, [], "word"), E.WordTokenizer)


def test_byte_level_tokenizer_is_reloaded_as_such(spark):
    docs = spark.createDataFrame([(0, "h\u00e9 \u65e5\u672c h\u00e9")], "doc_id long, text string")
    tok = E.ByteBpeTokenizer.train(docs, 3)
    path = os.path.join(ensure_checkpoint_dir(spark), f"test-bytes-{uuid.uuid4().hex}")
    store.save_tokenizer(tok, path)
    loaded = store.load_tokenizer(spark, path)
    again = store.tokenizer_from_json(spark, store.tokenizer_to_json(loaded))
    want = list(tok.encode(docs).first().ids)
    for t in (loaded, again):
        enc = t.encode(docs)
        assert isinstance(t, E.ByteBpeTokenizer) and list(enc.first().ids) == want
        assert t.decode(enc).first().decoded == "h\u00e9 \u65e5\u672c h\u00e9"


def test_marks_inside_texts_survive(spark):
    text = "a\x03\x02b plain"
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    for tok in (E.BpeTokenizer.train(docs, 4), E.ByteBpeTokenizer.train(docs, 4)):
        assert tok.decode(tok.encode(docs)).first().decoded == text


def test_join_path_gives_the_same_ids_and_texts(spark):
    texts = ["Hello, (world)! don't  stop", None, "", "zz é \U0001f600 hello", "hello " * 50, "hello " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for tok in (E.CharTokenizer.train(docs.where("doc_id = 0")), E.WordTokenizer.train(docs), E.BpeTokenizer.train(docs, 9),
                E.ByteBpeTokenizer.train(docs, 9)):
        inside = tok.decode(tok.encode(docs)).orderBy("doc_id").collect()
        del tok._shared
        tok.vocab_bytes = 0
        joined = tok.decode(tok.encode(docs)).orderBy("doc_id").collect()
        assert [(list(r.ids), r.decoded) for r in inside] == [(list(r.ids), r.decoded) for r in joined]


def test_unknown_id_is_an_error(spark):
    import pytest
    tok = E.WordTokenizer.train(spark.createDataFrame([("a b",)], "text string"))
    for bad in (99, -1):
        with pytest.raises(Exception, match="unknown token id"):
            tok.decode(spark.createDataFrame([([bad],)], "ids array<int>")).collect()


def test_chars_by_code_point(spark):
    from textspark.operators.encode import CharTokenizer
    vocab = spark.createDataFrame([("<unk>", 0), ("a", 1), ("é", 2), ("\U0001f600", 3), ("\n", 4)], "token string, id int")
    rows = [(0, "aéA\n"), (1, None), (2, ""), (3, "\U0001f600x\U0001f600"), (4, "<unk>"), (5, "a" * 70_000)] + [(i, "aé") for i in range(6, 700)]
    df = spark.createDataFrame(rows, "k int, text string").coalesce(1)
    got = {r.k: r.ids for r in CharTokenizer(vocab).encode(df).collect()}
    assert got[0] == [1, 2, 1, 4] and got[1] == [] and got[2] == [] and got[3] == [3, 0, 3] and got[4] == [0] * 5
    assert got[5] == [1] * 70_000 and all(got[i] == [1, 2] for i in range(6, 700))


def test_counts_in_tasks_stop_at_row_ends(spark, monkeypatch):
    from collections import Counter
    from textspark.operators import lm
    monkeypatch.setattr(lm, "COUNT_IDS", 3)  # taken over by the tasks with the function
    rows = [[1, 2, 1, 2, 1], None, [], [7], [2, 2, 2, 2], [2_000_000_000, 1]] * 3
    df = spark.createDataFrame([(r,) for r in rows], "ids array<int>").repartition(2)
    full = [r for r in rows if r]
    assert {r.token: r.n for r in lm.token_counts(df).collect()} == Counter(i for r in full for i in r)
    pairs = {(r.context, r.token): r.n for r in lm.token_counts(df, pairs=True).collect()}
    assert pairs == Counter(p for r in full for p in zip(r, r[1:]))
    assert lm.token_counts(df.where("false"), pairs=True).count() == 0


def test_large_vocabulary_shuffles_a_chunk_once_for_a_block(spark, monkeypatch):
    """Not once for each occurrence; several blocks, equal rows, nulls and unknown words give the ids of the task path."""
    rows = [(i % 7, f"common word{i % 5} " * 400 + f"rare{i}", [str(i)]) for i in range(60)] + [(1, None, None), (1, "", []), (None, "x", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    tok = E.WordTokenizer.train(df.where("doc_id > 2"))
    want = sorted(map(repr, tok.encode(df).collect()))
    del tok._shared
    tok.vocab_bytes = 0
    monkeypatch.setattr(E, "BLOCK_BYTES", 100_000)
    seen, plain = [], tok.block_table
    monkeypatch.setattr(tok, "block_table", lambda words: seen.append(words.groupBy(E.BLOCK).count().collect()) or plain(words))
    out = tok.encode(df)
    assert sorted(map(repr, out.collect())) == want and out.columns == ["doc_id", "text", "tags", "ids"]
    assert len(seen[0]) > 3 and sum(r["count"] for r in seen[0]) <= 6 * len(seen[0]) + 61  # 48,061 occurrences


def test_batches_are_worked_on_in_slices(spark):
    import pyarrow as pa
    import pyarrow.compute as pc
    big = E.SLICE_VALUES // 2
    texts = pa.array(["a" * big, None, "b" * big, "c", "d" * (3 * big), "", "e"])
    parts = list(E.row_slices(texts, pc.utf8_length(texts)))
    assert [len(p) for p in parts] == [3, 1, 1, 2] and pa.concat_arrays(parts).equals(texts)
    docs = spark.createDataFrame([(i, "ab cd " * 3_000) for i in range(200)] + [(200, None)], "doc_id long, text string").coalesce(1)
    for tok in (E.CharTokenizer.train(docs), E.BpeTokenizer.train(docs, 3)):
        back = tok.decode(tok.encode(docs)).selectExpr("count(*) as n", "count_if(coalesce(text, '') = decoded) as ok").first()
        assert (back.n, back.ok) == (201, 201)


def test_model_is_counted_in_one_pass_over_the_texts(spark):
    """The ids are neither kept nor encoded twice, and small tables of the model are looked up without dealing rows by context."""
    from collections import Counter
    from textspark.operators import lm
    rows = [[1, 2, 1, 2, 1], None, [], [7], [2, 2, 2, 2]]
    df = spark.createDataFrame([(r,) for r in rows], "ids array<int>").repartition(2)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def counted(ids):
        seen.add(1)
        return ids

    m = lm.fit_ngram(df.select(counted("ids").alias("ids")), 9)
    assert seen.value == len(rows)
    full = [r for r in rows if r]
    assert {(r.context, r.token): r.n for r in m.pairs.collect()} == Counter(p for r in full for p in zip(r, r[1:]))
    assert {r.token: r.n_w for r in m.unigrams.collect()} == Counter(i for r in full for i in r) and m.n_tokens == 10
    assert {r.context: r.n_c for r in m.contexts.collect()} == {1: 2, 2: 5}
    plan = m.log_prob(m.pairs.select("context", "token"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 3
