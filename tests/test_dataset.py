import pytest
from pyspark.sql import functions as F

from textspark.operators import dataset as W
from textspark.operators import lm as L


def _docs(spark, sizes):
    rows, nxt = [], 0
    for d, n in enumerate(sizes):
        rows.append((d, list(range(nxt, nxt + n))))
        nxt += n
    return spark.createDataFrame(rows, "doc_id long, ids array<int>"), list(range(nxt))


@pytest.mark.parametrize("sizes,ctx,stride", [([7, 0, 3, 40, 1, 1, 2, 25], 8, 4), ([200], 8, 8), ([5] * 30, 6, 5)])
def test_packed_windows_equal_list_slices(spark, sizes, ctx, stride):
    df, stream = _docs(spark, sizes)
    got = {r.k: (list(r.x), list(r.y)) for r in W.packed_windows(df, ctx, stride).collect()}
    want = {}
    for i, s in enumerate(range(0, len(stream) - ctx, stride)):
        want[i] = (stream[s:s + ctx], stream[s + 1:s + ctx + 1])
    assert got == want


def test_per_document_windows(spark):
    df, _ = _docs(spark, [20, 3])
    got = [(r.doc_id, r.start, list(r.x)) for r in W.per_document_windows(df, 8, 8).orderBy("start").collect()]
    assert got == [(0, 0, list(range(8))), (0, 8, list(range(8, 16)))]
    assert [r.doc_id for r in W.short_documents(df, 8).collect()] == [1]


def test_window_arguments():
    with pytest.raises(ValueError):
        W.check_window_args(0, 1)
    with pytest.raises(ValueError):
        W.check_window_args(4, 0)


def test_short_stream_is_an_error(spark):
    df, _ = _docs(spark, [3, 2])
    with pytest.raises(ValueError):
        W.require_stream_length(df, 8)
    with pytest.raises(ValueError):
        W.packed_windows(df, 8, 4)


def test_split_matches_python_cut(spark):
    texts = ["abc", "defgh", "", "ij", "klmnopq"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = W.contiguous_split(df, 0.3).orderBy("doc_id", "split").collect()
    full = "".join(texts)
    cut = int(len(full) * (1 - 0.3))
    assert "".join(r.text for r in out if r.split == 0) == full[:cut]
    assert "".join(r.text for r in out if r.split == 1) == full[cut:]


def test_ordered_batches_drop_last(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    b = W.ordered_batches(df, 4, drop_last=True)
    assert sorted({r.batch_id for r in b.collect()}) == [0, 1]
    assert W.ordered_batches(df, 4).select(F.max("batch_id")).first()[0] == 2


def test_shuffled_batches_stable_under_repartition(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a = {r.k: r.batch_id for r in W.shuffled_batches(df, 3, 1, 8).collect()}
    b = {r.k: r.batch_id for r in W.shuffled_batches(df.repartition(7), 3, 1, 8).collect()}
    assert a == b and len(a) == 96


def test_training_order_is_a_permutation(spark):
    import numpy as np
    for size in (1, 2, 5, 100, 1000, 4097):
        orders = [W.permute(np.arange(size), size, seed, epoch) for seed, epoch in ((1, 0), (1, 1), (2, 0))]
        assert all(sorted(o) == list(range(size)) for o in orders)
        if size >= 100:
            assert len({tuple(o) for o in orders}) == 3 and all(abs(np.corrcoef(np.arange(size), o)[0, 1]) < 0.3 for o in orders)
    df = spark.range(10).withColumnRenamed("id", "k")
    rows = W.shuffled_batches(df, 3, 1, 4, drop_last=False).collect()
    assert sorted((r.batch_id, r.place) for r in rows) == [(i // 4, i % 4) for i in range(10)]


def test_bits_per_char_formula(spark):
    import math
    r = spark.range(1).select(L.bits_per_char(F.lit(2 * math.log(2)), F.lit(2.0)).alias("b")).first()
    assert r.b == pytest.approx(1.0)
    r = spark.range(1).select(L.bits_per_char(F.lit(math.log(2)), F.lit(4.0)).alias("b")).first()
    assert r.b == pytest.approx(0.25)


def test_best_checkpoint_equal_minimum_not_marked(spark):
    log = spark.createDataFrame([(1, 3.0), (2, 2.5), (3, 2.5), (4, 2.7), (5, 2.1)], "step long, val_loss double")
    got = [r.improved for r in L.best_checkpoints(log).orderBy("step").collect()]
    assert got == [True, True, False, False, True]


def test_split_reads_texts_once_beside_the_cut(spark, tmp_path):
    """The total comes from the written lengths, so the plan of the split scans the texts a single time."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, "x" * i) for i in range(1, 21)], "doc_id long, text string").write.parquet(path)
    split = W.contiguous_split(spark.read.parquet(path))
    assert split.agg({"split": "sum"}).first()[0] > 0
    assert split._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
