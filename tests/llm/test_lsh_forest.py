"""LSH forest near-duplicates against brute force on hand-made and generated texts."""

import random
import re

import numpy as np

import pytest

from textspark.llm import lsh_forest
from textspark.llm.common import Scratch
from textspark.llm.lsh_forest import LEVELS, POOL, candidates, exact_pairs, lcp_neighbours, near_duplicates
from textspark.llm.texthash import shingle_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    w = WORDS.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def corpus(seed=5):
    r = random.Random(seed)
    vocab = [f"w{n}" for n in range(400)]
    base = [[r.choice(vocab) for _ in range(r.randint(5, 120))] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:
        for _ in range(r.randint(1, 25)):  # near copies, more than a region holds
            c = list(b)
            for _ in range(r.randint(0, max(1, len(c) // 40))):
                c[r.randrange(len(c))] = r.choice(vocab)
            texts.append("\n".join(c))
    passage = " ".join(r.choice(vocab) for _ in range(60))
    texts += [passage + " " + " ".join(r.choice(vocab) for _ in range(60)) for _ in range(20)]
    texts += [texts[3]] * 30
    return texts


def test_against_brute_force(spark):
    rows = list(enumerate(corpus()))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    want = brute(rows, 4, 80)
    assert {r.id: r.component_id for r in got} == want
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert {r.id: r.n_shingles for r in got} == {i: len(shingles(t, 4)) for i, t in rows}


def test_nulls_empty_short_repeated_long(spark):
    long = " ".join(f"x{i}" for i in range(50_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", "b"), (4, "One two", "c"), (5, "one TWO", None), (6, "one", "d"),
            (7, long, "e"), (8, long + " tail", "f"), (None, "one two", "g"), (9, "é é é é é", "h"), (9, "é é é é é", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((str(r.id), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, words=4).collect())
    assert got == sorted([("1", 0, 1, True), ("2", 0, 2, True), ("3", 0, 3, True), ("4", 1, 4, True), ("5", 1, 4, False),
                          ("6", 1, 6, True), ("7", 49_997, 7, True), ("8", 49_998, 7, False), ("None", 1, None, True),
                          ("9", 1, 9, True), ("9", 1, 9, True)])
    assert near_duplicates(df.limit(0), words=4).count() == 0


def test_shingle_hashes_tell_sequences_apart():
    texts = ["a b c d e", "a b c d", "a b c", "ab c d e", "", "a  b\tc\nd e", "A B c d e"]
    raw = "".join(texts).encode()
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = [tuple(s) for s in shingle_hashes(np.frombuffer(raw, np.uint8), off, 4)]
    assert [len(s) for s in got] == [2, 1, 1, 1, 0, 2, 2]
    assert got[0] == got[5] == got[6] and got[1][0] in got[0] and len({got[1], got[2], got[3]}) == 3


def test_regions_deepen_until_they_are_small():
    g = np.random.default_rng(1)
    keys = np.unique(g.integers(0, 3, (300, 8)).astype(np.uint32), axis=0)
    pairs, large = lcp_neighbours(np.zeros(len(keys), int), keys, 3, 4)
    prefix = {}
    for row in keys:
        for d in range(3, 9):
            prefix[tuple(row[:d])] = prefix.get(tuple(row[:d]), 0) + 1
    found = {tuple(sorted(p)) for p in pairs[:, :2].tolist()}
    for i, j in ((i, j) for i in range(len(keys)) for j in range(i + 1, len(keys))):
        shared = int(np.cumprod(keys[i] == keys[j]).sum())
        if any(prefix[tuple(keys[i][:d])] <= 4 for d in range(3, shared + 1)):
            assert (i, j) in found
    assert set(large) == {i for i, row in enumerate(keys) if prefix[tuple(row[:3])] > 4}


def test_pairs_among_many_texts_on_one_template(spark):
    template = " ".join(f"t{i}" for i in range(60))
    own = [[f"u{n}_{i}" for i in range(10)] for n in range(4000)]  # 60 of 80 words: no link
    own += [own[n][:3] + [f"v{n}_{i}" for i in range(7)] for n in range(40)]  # 63 of 77 with row n
    rows = [(i, " ".join([template, *o])) for i, o in enumerate(own)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r.id: r.component_id for r in got} == {i: i if i < 4000 else i - 4000 for i in range(4040)}


def test_region_over_several_partitions_is_large(spark):
    rows = [(i, i, bytes(2 * POOL)) for i in range(30)]
    classes = spark.createDataFrame(rows, "id long, component long, sig binary")
    names = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.enabled": "false"}
    old = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        got = candidates(classes, 0, Scratch(spark, "test")).where("kind = 2").select("ord", "key", "a").distinct().collect()
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
    assert {(r.ord, r.a) for r in got} == {(o, i) for o in range(LEVELS[0][0]) for i in range(30)}


@pytest.mark.parametrize("salt_rows", [7, 4096])
def test_exact_join_finds_every_pair_across_components(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(lsh_forest, "SALT_ROWS", salt_rows)
    r = random.Random(3)
    base = [f"t{i}" for i in range(18)]
    texts = {i: base + r.sample([f"u{n}" for n in range(12)], r.randint(1, 6)) for i in range(150)}
    comp = {i: 0 if i % 3 == 0 else i - i % 2 for i in texts}  # a third of the rows are one component
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "id long, body string")
    todo = spark.createDataFrame(list(comp.items()), "id long, component long")
    got = {(p.a, p.b) for p in exact_pairs(todo, frame, 1, 80, Scratch(spark, "test")).collect()}
    links = {(i, j) for i in texts for j in texts if i < j and comp[i] != comp[j]
             and 100 * len(set(texts[i]) & set(texts[j])) >= 80 * len(set(texts[i]) | set(texts[j]))}
    assert len(links) > 500 and links <= got
    assert all(a < b and comp[a] != comp[b] for a, b in got)


def test_shared_passage_over_the_shorter_prefix_is_not_joined(spark):
    passage = [f"t{i}" for i in range(84)]  # 84 of 100 words: in the longer prefix of all rows, the shorter of none
    rows = [(i, " ".join(passage + [f"u{i}_{n}" for n in range(16)])) for i in range(60)]
    todo = spark.createDataFrame([(i, i) for i, _ in rows], "id long, component long")
    scratch = Scratch(spark, "test")
    assert exact_pairs(todo, spark.createDataFrame(rows, "id long, body string"), 1, 80, scratch).count() == 0
    assert spark.read.parquet(next(p for p in scratch._paths.values() if p.endswith("shared"))).count() == 0
