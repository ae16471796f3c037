import json

import pytest

from textspark.functions import constants as K
from textspark.operators.requests import validate_requests


def _run(spark, payloads):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "request_id long, payload string")
    return {r.request_id: r for r in validate_requests(df).collect()}


def test_defaults_and_values(spark):
    out = _run(spark, [{"prompt": "ROMEO:"},
                       {"prompt": "x", "max_new_tokens": "20", "temperature": 0, "top_k": 0, "seed": 7},
                       {"prompt": "x", "chat": True}, {"prompt": "x", "max_new_tokens": 7.9}])
    a, b, c, d = out[0], out[1], out[2], out[3]
    assert (a.error, a.prompt, a.max_new_tokens, a.temperature, a.top_k, a.seed, a.chat) == \
        (None, "ROMEO:", K.MAX_NEW_TOKENS, K.TEMPERATURE, K.TOP_K, None, False)
    assert (b.max_new_tokens, b.temperature, b.top_k, b.seed) == (20, 0.0, 0, 7)
    assert c.chat is True and c.error is None
    assert d.max_new_tokens == 7            # a JSON float truncates like int()


BAD = [
    ({"prompt": ""}, K.MSG_EMPTY_PROMPT),
    ({"prompt": "   "}, K.MSG_EMPTY_PROMPT),
    ({"prompt": 5}, K.MSG_EMPTY_PROMPT),
    ({"prompt": "x" * 5000}, K.MSG_LONG_PROMPT),
    ({"prompt": "x", "max_new_tokens": K.MAX_NEW_TOKENS_LIMIT + 1}, "max_new_tokens must be between 1 and 500."),
    ({"prompt": "x", "max_new_tokens": 0}, "max_new_tokens must be between 1 and 500."),
    ({"prompt": "x", "temperature": -1}, "temperature must be between 0.0 and 2.0."),
    ({"prompt": "x", "temperature": "hot"}, "temperature must be a number."),
    (["not", "an", "object"], K.MSG_NOT_OBJECT),
    ({"prompt": "x", "chat": "yes"}, K.MSG_CHAT_BOOL),
    ({"prompt": "x", "max_new_tokens": "5.0"}, "max_new_tokens must be a number."),
    ({"prompt": "", "max_new_tokens": 0}, K.MSG_EMPTY_PROMPT),          # first failure wins
    ({"prompt": "x", "seed": "99999999999999999999"}, "seed must be between 0 and 4294967295."),
    ({"prompt": "x", "top_k": 1e30}, "top_k must be between 0 and 100000."),
    ({"prompt": "x", "seed": -1e30}, "seed must be between 0 and 4294967295."),
]


@pytest.mark.parametrize("payload,message", BAD)
def test_rejections(spark, payload, message):
    r = _run(spark, [payload])[0]
    assert r.error == message
    assert r.prompt is None and r.max_new_tokens is None


def test_stream_query_keeps_the_budgets(spark, sf_dir, monkeypatch):
    from textspark.operators.requests import validate_requests
    from textspark.plans import QUERIES, misc_queries as M
    seen = []

    def serve(requests, tok, model, checkpoint, out):
        seen.append(requests)
        validate_requests(M.request_payloads(spark, sf_dir)).limit(0).selectExpr("*", "0 as epoch").drop("raw").write.parquet(out)
    payload = spark.createDataFrame([(i, '{"prompt": "ab", "max_new_tokens": %s}' % n) for i, n in enumerate((0, 3, 501))],
                                    "request_id long, payload string")
    monkeypatch.setattr(M, "request_payloads", lambda *a: payload)
    monkeypatch.setattr(M, "char_setup", lambda *a: type("Setup", (), {"tok": None, "model": None}))
    monkeypatch.setattr(M.req_stream, "request_stream", lambda spark, src: validate_requests(spark.read.parquet(src)))
    monkeypatch.setattr(M.req_stream, "serve", serve)
    QUERIES["g16_stream_score"](spark, sf_dir)
    got = {r.request_id: (r.max_new_tokens, r.error is None) for r in seen[0].collect()}
    assert got[1] == (3, True) and not got[0][1] and not got[2][1]
