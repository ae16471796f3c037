import numpy as np
from pyspark.sql import functions as F

from textspark.operators import encode as E
from textspark.operators import generate as G
from textspark.operators import lm as L


def _model(spark):
    import random
    rnd = random.Random(0)
    # uneven counts, so the best next token is unique for every context
    text = "".join(rnd.choices("abcd \n", weights=[9, 7, 5, 3, 2, 1], k=4000))
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    tok = E.CharTokenizer.train(docs)
    enc = tok.encode(docs)
    return tok, L.fit_ngram(enc, tok.vocab.count())


def _prompts(spark, tok, temperature, top_k, seed, n=6, stop=None):
    p = spark.createDataFrame([(i, t) for i, t in enumerate(["ab", "b", "c", "zz"])], "pid long, text string")
    return tok.encode(p, key_cols=("pid",)).select(
        "pid", "ids", F.lit(n).alias("max_new_tokens"), F.lit(float(temperature)).alias("temperature"),
        F.lit(top_k).alias("top_k"), F.lit(seed).cast("bigint").alias("seed"),
        (F.lit(stop) if stop is not None else F.lit(None)).cast("array<int>").alias("stop_ids"))


def test_top_k_keeps_ties(spark):
    cands = spark.createDataFrame([(1, 1, -1.0, 1), (1, 2, -2.0, 1), (1, 3, -2.0, 1), (1, 4, -3.0, 1), (1, None, -4.0, 5)],
                                  "context int, token int, logp double, n_tokens long")
    assert sorted(r.token for r in G.filtered_distribution(cands, 1.0, 2).collect()) == [1, 2, 3]
    rows = G.filtered_distribution(cands, 1.0, 5).collect()      # the fifth best is one of five that tie
    assert len(rows) == 5 and abs(sum(r.prob * r.n_tokens for r in rows) - 1) < 1e-12


def test_every_distribution_sums_to_one(spark):
    tok, m = _model(spark)
    for df in (m.next_token_probs(), G.filtered_distribution(G.candidates(m), 0.7, 0), G.filtered_distribution(G.candidates(m), 0.7, 3)):
        sums = df.groupBy("context").agg(F.sum(F.col("prob") * F.col("n_tokens")).alias("s")).collect()
        assert sums and all(abs(r.s - 1) < 1e-9 for r in sums)


def test_chooser_against_all_ids_written_out():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 12))
        tokens = rng.permutation(size)[:int(rng.integers(0, size + 1))]
        counts = np.sort(rng.integers(1, 4, len(tokens)))[::-1]
        order = np.lexsort((tokens, -counts))
        tokens, counts = tokens[order], counts[order]
        t, k, u = float(rng.uniform(0.2, 2)), int(rng.integers(0, size + 2)), float(rng.uniform())
        n = np.zeros(size)
        n[tokens] = counts
        score = np.log(n + 1) / t
        stay = np.ones(size, bool) if k == 0 else score >= np.sort(score)[::-1][min(k, size) - 1]
        ids = [i for i in range(size) if n[i] and stay[i]] + [i for i in range(size) if not n[i] and stay[i]]
        share = np.cumsum(np.exp(score[ids])) / np.exp(score[ids]).sum()
        want = ids[min(int(np.searchsorted(share, u, side="right")), len(ids) - 1)]
        assert G.Chooser(size, 1.0).choose(0, tokens, counts, t, k, u) == want


def test_draw_frequencies():
    """The share of draws of each id, unseen ones too, is near its probability."""
    tokens, counts, chooser = np.array([3, 0]), np.array([5, 2]), G.Chooser(6, 1.0)
    drawn = np.bincount([chooser.choose(0, tokens, counts, 1.0, 0, G.uniform("key", i)) for i in range(20_000)], minlength=6) / 20_000
    assert np.abs(drawn - np.array([3, 1, 1, 6, 1, 1]) / 13).max() < 0.015


def test_rounds_of_a_partitioned_model_give_the_same_texts(spark, monkeypatch):
    tok, m = _model(spark)
    monkeypatch.setattr(G, "GROUP_REQUESTS", 2)
    p = _prompts(spark, tok, 0.9, 4, 3, 5).unionByName(_prompts(spark, tok, 0.0, 0, None, 3)).withColumn("pid", F.monotonically_increasing_id())
    p = p.unionByName(p.limit(1).withColumns({"ids": F.array().cast("array<int>"), "pid": F.lit(99).cast("bigint")})).cache()
    a = sorted((r.pid, list(r.ids), r.new_tokens) for r in G.generate(m, p).collect())
    b = sorted((r.pid, list(r.ids), r.new_tokens) for r in G.generate(m, p, kernel_bytes=0).collect())
    assert a == b and len(a) == 9


def test_top_k_one_equals_greedy(spark):
    tok, m = _model(spark)
    greedy = {r.pid: list(r.ids) for r in G.generate(m, _prompts(spark, tok, 0.0, 0, None)).collect()}
    top1 = {r.pid: list(r.ids) for r in G.generate(m, _prompts(spark, tok, 0.9, 1, 5)).collect()}
    assert greedy == top1


def test_seed_is_stable(spark):
    tok, m = _model(spark)
    p = _prompts(spark, tok, 1.0, 0, 42)
    a = {r.pid: list(r.ids) for r in G.generate(m, p).collect()}
    b = {r.pid: list(r.ids) for r in G.generate(m, p.repartition(3)).collect()}
    assert a == b


def test_stop_keeps_prefix_and_stop_token(spark):
    tok, m = _model(spark)
    nl = [r.id for r in tok.newline_token_ids().collect()]
    full = {r.pid: list(r.ids) for r in G.generate(m, _prompts(spark, tok, 0.0, 0, None, 12)).collect()}
    stopped = {r.pid: (list(r.ids), r.new_tokens) for r in
               G.generate(m, _prompts(spark, tok, 0.0, 0, None, 12, nl)).collect()}
    for pid, (ids, n) in stopped.items():
        assert full[pid][:len(ids)] == ids
        if len(ids) < len(full[pid]):
            assert ids[-1] in nl


def test_prompt_file_prep(spark):
    lines = spark.createDataFrame([(0, "  "), (1, "hello\\nthere"), (2, " QUIT "), (3, "after")], "ord int, line string")
    got = [(r.ord, r.prompt) for r in G.prompt_file_prep(lines).collect()]
    assert got == [(1, "hello\nthere")]
