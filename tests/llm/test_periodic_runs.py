"""Periodic runs against a brute-force finder, hand-made texts and the registered query."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textspark.llm.periodic_runs import find_runs, maximal_runs


def smallest_period(w):
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def brute(words, least=6, exponent=4):
    """Maximal stretches for each q; those whose smallest period is q."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q) and smallest_period(words[i:j + q]) == q:
                out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    words = [t.split() for t in texts]
    names = {}
    t = np.array([names.setdefault(w, len(names)) for ws in words for w in ws], np.int32)
    first = np.cumsum([0] + [len(w) for w in words])
    start, end, period = maximal_runs(t, first)
    got = [[] for _ in texts]
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
        i = int(np.searchsorted(first, s, "right")) - 1
        got[i].append((s - int(first[i]), e - s, p))
    return got


def agrees(texts):
    assert found(texts) == [brute(t.split()) for t in texts]


HAND = ["", "a", "a a a a a", "a a a a a a", "x a a a a a a y", "a b " * 4, "a b " * 4 + "a", "a b " * 9 + "c",
        "a a a a a a b " * 5, "a b a b a b a b c " * 6, "a b c " * 3, "w " * 1000, "q r s t u v " * 200 + "z",
        "a " * 7 + "b " * 7, "a b " * 5 + "b a " * 5]


def test_hand_made():
    agrees(HAND)
    for t in HAND:
        agrees([t])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60).map(" ".join), max_size=6))
def test_two_words(texts):
    agrees(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=7), st.integers(1, 9)), max_size=8))
def test_repeated_blocks(blocks):
    agrees([" ".join(w for b, times in blocks for w in b * times)])


def test_long_texts():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for p in (1, 2, 37, 250, 611):
        block = [rng.choice(vocabulary) for _ in range(p)]
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(301)] + (block * 2000)[:3000]))
    agrees(texts)


def test_word_rule_and_edges(spark):
    rows = [(1, "a\tb a\x0bb a\nb a b\r\x0c a", "x"), (2, None, "y"), (3, "", "z"), (None, "a " * 8, "n"), (1, "a " * 8, "x"),
            (4, "ü\xa0ü é  " * 5, "u")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = sorted(((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(df).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == [(1, 8, [(0, 8, 1)], "a"), (1, 9, [(0, 9, 2)], "a b"), (2, 0, [], ""), (3, 0, [], ""),
                   (4, 10, [(0, 10, 2)], "ü\xa0ü é "), (None, 8, [(0, 8, 1)], "a")]
    assert find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        maximal_runs(np.zeros(3, np.int32), np.array([0, 3]), exponent=2)


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, w, q in runs for i in range(s + q, s + w)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{w},{q}\n" for s, w, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query(spark, sf_dir):
    from textspark.llm.queries import QUERIES
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, sf_dir).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        if len((d.text or "").split()) < 3000:
            assert got[d.doc_id] == expected(d.doc_id, d.text), d.doc_id
