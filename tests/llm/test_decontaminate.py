"""Benchmark passages against a plain search, hand-made rows and the query's oracle."""

import random
import re

import pytest

from textspark.llm.decontaminate import find_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10, shingle=3, share=1.0):
    wins = []
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        wins += [("" if item is None else str(item), w[i:i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for item, win in wins:
            size = min(shingle, len(win))
            m = len(win) - size + 1
            for i in range(len(w) - len(win) + 1):
                same = sum(w[i + x:i + x + size] == win[x:x + size] for x in range(m))
                if same >= share * m - 1e-9:
                    hit |= set(range(i, i + len(win)))
                    named.add(item)
        out.append((doc, len(w), tuple(sorted(hit)), tuple(sorted(named))))
    return sorted(out, key=repr)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, items string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, row int")
    rows = find_passages(d, b, **kw).collect()
    return sorted(((r.id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r["items"]))
                   for r in rows), key=repr)


def test_hand_made(spark):
    ten = "One two, three four FIVE six seven eight nine ten"
    items = [(1, ten), (2, "short item"), (3, "..."), (4, None), (None, "lonely"), (10, ten + " eleven"), (2, "née Ünder")]
    docs = [(1, "x one TWO three-four five six seven eight nine ten y"), (2, "one two three four five six seven eight nine tenx"),
            (3, None), (4, ""), (5, "a short item a short item."), (6, "née Ünder, lonely"), (None, ten), (5, ten + " " + ten),
            (7, "two three four five six seven eight nine ten eleven"), (8, "nÉe under"), (9, "short")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, []) == brute(docs, [])
    assert got(spark, [], items) == []
    with pytest.raises(ValueError):
        got(spark, docs, items, share=0)


@pytest.mark.parametrize("kw", [{}, {"window": 4, "shingle": 2}, {"window": 6, "shingle": 2, "share": 0.6}, {"window": 1}])
def test_random(spark, kw):
    rng = random.Random(str(kw))
    text = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = [(i, text(rng.randint(0, 14))) for i in range(12)]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(items)[1], text(rng.randint(0, 9))]
        docs.append((i, " ".join(parts)))
    assert got(spark, docs, items, **kw) == brute(docs, items, **{"window": 10, **kw})


def test_long_and_common(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    items = [(1, passage), (2, "p3 p4"), (3, "z " * 30)]
    docs = [(i, f"t{i} " + passage) for i in range(300)] + [(1000, "q " * 200_000 + passage + " z" * 12)]
    rows = got(spark, docs, items)
    assert len(rows) == 301
    for doc, n, hit, named in rows:
        if doc < 1000:
            assert (n, hit, named) == (16, tuple(range(1, 16)), ("1", "2"))
        else:
            assert (n, hit, named) == (200_027, tuple(range(200_000, 200_027)), ("1", "2", "3"))


def test_oracle(spark, sf_dir):
    from textspark.llm.queries import ORACLE, QUERIES
    from textspark.plans.oracle_check import compare, duck_connection
    name = "op13_passage_join"
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], duck_connection(sf_dir))
    assert r["ok"], r
