"""Headline benchmark: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is materialized fully with the ``noop`` sink (no collect).
Queries: P4 chunk counts, V7 BPE training (500 merges), E3 BPE encoding of all
documents, W2 packed windows, L1-L6 bigram fit + held-out evaluation, G6
greedy generation (32 steps) for the benchmark prompts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from textspark.functions import constants as K  # noqa: E402
from textspark.operators import dataset as W  # noqa: E402
from textspark.operators import encode as E  # noqa: E402
from textspark.operators import generate as G  # noqa: E402
from textspark.operators import lm as L  # noqa: E402
from textspark.operators import pretok  # noqa: E402
from textspark.session import build_session  # noqa: E402
from textspark.sources.tables import benchmark, documents  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(4, cpus))
    times, info = {}, {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    docs = documents(spark, sf_dir)
    timed("p4_chunk_frequencies", lambda: run(pretok.chunk_frequencies(docs)))

    tok = timed("v7_bpe_train_500", lambda: E.BpeTokenizer.train(docs, 500))
    info["bpe_rounds"] = tok.__dict__.get("rounds")
    info["bpe_merges"] = len(tok.merge_rows)

    encoded = timed("e3_bpe_encode", lambda: _materialize(tok.encode(docs)))
    timed("w2_sliding_windows", lambda: run(W.packed_windows(encoded, K.CONTEXT_LENGTH, K.STRIDE)))

    def lm_eval():
        from textspark.session import reliable_checkpoint
        split = W.contiguous_split(docs, K.VAL_RATIO)
        ctok = E.CharTokenizer.train(split.where("split = 0"))
        v = ctok.vocab.count()
        train = reliable_checkpoint(ctok.encode(split.where("split = 0")))
        val = reliable_checkpoint(ctok.encode(split.where("split = 1")))
        model = L.fit_ngram(train, v)
        ce = L.cross_entropy(model, val)
        cpt = W.chars_per_token(val)
        row = ce.select("loss", cpt.select("chars_per_token").scalar().alias("cpt")).first()
        info["val_loss"] = round(row["loss"], 4)
        info["bits_per_char"] = round(row["loss"] / row["cpt"] / 0.6931471805599453, 4)
        return ctok, model

    ctok, model = timed("l1_l6_fit_evaluate", lm_eval)

    def gen():
        p = ctok.encode(benchmark(spark, sf_dir).withColumnRenamed("item_id", "pid"), key_cols=("pid",))
        p = p.select("pid", "ids", F.lit(32).alias("max_new_tokens"), F.lit(0.0).alias("temperature"),
                     F.lit(0).alias("top_k"), F.lit(None).cast("bigint").alias("seed"),
                     F.lit(None).cast("array<int>").alias("stop_ids"))
        run(G.generate(model, p, 32))

    timed("g6_generate_32", gen)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus, "info": info}))


def _materialize(df):
    from textspark.session import reliable_checkpoint
    return reliable_checkpoint(df)


if __name__ == "__main__":
    main()
