"""BPE chunks cut, counted and encoded by arrays: the pattern's rule, the merge loop's rule."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textspark.functions.text import bpe_chunks
from textspark.operators import bpe as B
from textspark.operators import encode as E
from textspark.operators import pretok

ODD = ["a", "b", "e", "é", "́", "1", "²", "_", " ", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "!", ".", "'", "‍",
       "\U0001f600", "\U00010400", "一", "͸", "\x00", "퟿", "￿"]


def _texts(n, seed=5):
    rng = random.Random(seed)
    made = ["".join(rng.choices(ODD, k=rng.randint(0, 12))) for _ in range(n)]
    return made + ["", None, " ", "  ", " a", "a ", "a  ", "  a", "\n a", " \na", "\n", "a\n", None, "plain words  only\n\n here "]


def test_cut_chunks_follow_the_pattern(spark):
    texts = _texts(600)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", bpe_chunks("text").alias("c"))
    want = [r.c or [] for r in df.orderBy("i").collect()]
    classes = pretok.char_classes(spark)
    for column in (pa.array(texts, pa.string()), pa.array(["zz", *texts], pa.string()).slice(1)):
        chunks, bounds = pretok.cut_chunks(column, classes)
        flat = chunks.to_pylist()
        assert [flat[a:b] for a, b in zip(bounds, bounds[1:])] == want
    for text, c in zip(texts, want):                           # each alone: ASCII and other texts take different ways
        chunks, bounds = pretok.cut_chunks(pa.array([text], pa.string()), classes)
        assert chunks.to_pylist() == c and bounds.tolist() == [0, len(c)]


def test_classes_are_those_of_the_pattern(spark):
    points = [i for i in range(0x3000) if not 0xD800 <= i < 0xE000] + [0x1F600, 0x10400, 0x10FFFF]
    df = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string")
    from textspark.functions.patterns import S, W
    kind = F.when(F.col("c").rlike(rf"(?U)[{W}]"), "w").when(F.col("c").rlike(rf"(?U)[{S}]"), " ").otherwise("!")
    classes = pretok.char_classes(spark)
    assert all(chr(classes[r.i]) == r.k for r in df.select("i", kind.alias("k")).collect())


def test_malformed_utf8_is_cut_as_the_jvm_reads_it(spark):
    df = spark.sql("select cast(unhex('61FF2062') as string) as text")
    want = df.select(bpe_chunks("text").alias("c")).first().c
    raw = pa.array([b"a\xff b"], pa.binary())
    column = pa.StringArray.from_buffers(1, raw.buffers()[1], raw.buffers()[2])
    assert pretok.cut_chunks(column, pretok.char_classes(spark))[0].to_pylist() == want


def test_counts_in_parts_are_whole(spark, monkeypatch):
    texts = _texts(300, 6)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = {r.chunk: r["count"] for r in df.select(F.explode(bpe_chunks("text")).alias("chunk")).groupBy("chunk").count().collect()}
    for rows in (pretok.COUNT_ROWS, 3):
        monkeypatch.setattr(pretok, "COUNT_ROWS", rows)
        assert {r.chunk: r.freq for r in pretok.chunk_frequencies(df).collect()} == want


def test_merges_of_many_chunks_at_once():
    rng = random.Random(3)
    chunks = sorted({"".join(rng.choices("aab cé\U0001f600", k=rng.randint(1, 14))) for _ in range(800)})
    for case in range(30):
        symbols, ranks = list("abc "), {}
        for r in range(rng.choice([0, 1, 4, 12])):
            pair = rng.choice(symbols), rng.choice(symbols)
            ranks.setdefault(pair, r)
            symbols.append(pair[0] + pair[1])
        order = list(ranks)
        rng.shuffle(order)                                     # also a merge before the one it needs
        ranks = {pair: 3 * i for i, pair in enumerate(order)}
        ids = {s: i for i, s in enumerate(dict.fromkeys(symbols + ["é"])) if rng.random() < 0.9}
        table = B.MergeTable(ids, ranks, 77)
        for dense in (table.dense, None):
            table.dense = dense
            flat, size = table.encode(pa.array(chunks))
            want = [[ids.get(s, 77) for s in B.lowest_rank_symbols(c, ranks)] for c in chunks]
            ends = np.cumsum(size)
            assert [flat[e - n:e].tolist() for e, n in zip(ends, size)] == want
    assert B.MergeTable({}, {}, 1).encode(pa.array([], pa.string()))[0].tolist() == []


def test_tokenizer_ids_are_those_of_the_loop(spark):
    texts = _texts(200, 7) + ["the theme of the thesis, then the other three"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    tok = E.BpeTokenizer.train(df, 12)
    ids = {r.token: r.id for r in tok.vocab.collect()}
    ranks = {(a, b): r for r, a, b, *_ in tok.merge_rows}
    pieces = {r.doc_id: r.c or [] for r in df.select("doc_id", bpe_chunks("text").alias("c")).collect()}
    for r in tok.encode(df).collect():
        assert r.ids == [ids[s] for c in pieces[r.doc_id] for s in B.lowest_rank_symbols(c, ranks)]


def test_encoding_reads_each_text_once(spark, tmp_path):
    """A filter on the ids had every text encoded twice."""
    from textspark.plans import QUERIES
    spark.createDataFrame([(0, "aab aab"), (1, ""), (2, None), (2, "b"), (None, "aab")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    for name, rows in (("e3_bpe_encode", [0, 2, None]), ("e4_decode_concat", [0, 2, None])):
        df = QUERIES[name](spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x)) == rows
