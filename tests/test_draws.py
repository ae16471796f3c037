"""Requests of a batch completed together give the tokens of one at a time."""

import random

import numpy as np
import pyarrow as pa

from textspark.operators import generate as G

KINDS = pa.schema([("pid", pa.int64()), ("ids", pa.list_(pa.int32())), ("budget", pa.int32()), ("temperature", pa.float64()),
                   ("top_k", pa.int32()), ("key", pa.string()), ("stop_ids", pa.list_(pa.int32()))])


def _one(lists, chooser, r):
    """The rule for a request, token by token."""
    ids, n = list(r["ids"]), 0
    while n < (r["budget"] or 0):
        at = ids[-1] if ids and ids[-1] in lists else G.UNSEEN
        u = G.uniform(r["key"], n) if r["temperature"] else 0.0
        ids.append(chooser.choose(at, *lists.get(at, (np.zeros(0, np.int32), np.zeros(0, np.int64))), r["temperature"], r["top_k"], u))
        n += 1
        if ids[-1] in r["stop_ids"]:
            break
    return ids, n


def test_batches_equal_single_requests(monkeypatch):
    rng = random.Random(1)
    for size, alpha, entries in ((40, 1.0, G.CACHE_ENTRIES), (40, 0.0, 30), (12, 1.0, 30)):
        monkeypatch.setattr(G, "CACHE_ENTRIES", entries)
        lists = {}
        for c in [G.UNSEEN, *range(0, 12, 2)]:
            tokens = np.array(rng.sample(range(12), rng.randint(1, 12)), np.int32)
            lists[c] = tokens, np.array(sorted((rng.choice([1, 2, 50]) for _ in tokens), reverse=True), np.int64)
        rows = [{"pid": i, "ids": [rng.randrange(size) for _ in range(rng.randint(0, 3))], "budget": rng.choice([None, 0, 1, 7, 30]),
                 "temperature": rng.choice([0.0, 0.3, 1.0, 2.0]), "top_k": rng.choice([0, 1, 3, 12, 13, 5000]), "key": f"k{i % 90}",
                 "stop_ids": rng.choice([[], [3, 4]])} for i in range(150)]
        draws = G.Draws(G.Chooser(size, alpha), lists)
        for part in (rows[:100], rows[100:], []):
            ids, made = G.complete(draws, pa.RecordBatch.from_pylist(part, KINDS))
            assert list(zip(ids.to_pylist(), made.to_pylist())) == [_one(lists, G.Chooser(size, alpha), r) for r in part]


def test_top_k_beyond_the_successors_is_one_setting():
    chooser = G.Chooser(50, 1.0)
    tokens, counts = np.arange(10, dtype=np.int32), np.arange(10, 0, -1)
    for k in range(0, 30_000, 1500):
        chooser.shares("c", tokens, counts, 0.7, k)
    assert len(chooser.kept) == 1
    assert chooser.shares("c", tokens, counts, 0.7, 10)[2] == 0.0 and len(chooser.kept) == 2     # the tail is cut


def test_request_files_are_as_many_as_tasks(spark, tmp_path, monkeypatch):
    from textspark.plans import QUERIES, misc_queries as M
    rows = spark.range(4000).selectExpr("id as event_id", "id as user_id", "'view' as event_type", "'{\"k\": 1}' as props")
    rows.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    seen = []

    def stream(spark, src):
        seen.append(len(spark.read.parquet(src).inputFiles()))
        raise StopIteration
    monkeypatch.setattr(M, "char_setup", lambda *a: None)
    monkeypatch.setattr(M.req_stream, "request_stream", stream)
    try:
        QUERIES["g16_stream_score"](spark, str(tmp_path))
    except (AttributeError, StopIteration):
        pass
    assert seen == [8]


def test_a_payload_is_parsed_once(spark):
    from textspark.operators.requests import validate_requests
    df = validate_requests(spark.range(5).selectExpr("id as request_id", "'{}' || id as payload"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1, plan
