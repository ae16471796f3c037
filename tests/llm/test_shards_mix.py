"""Sharding and mixing against plain Python, with hot, null and empty sources."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from textspark.llm.entropy_balance import mix_sources
from textspark.llm.stratified_shards import stratified_shards

SCHEMA = "doc_id long, text string, source string, shard string, size string"


def corpus():
    rows = []
    for i in range(700):
        source = "hot" if i % 3 else (None, "a", "é", "b", "c")[i % 5]
        rows.append((i, " ".join(["word"] * (1 + (i * 37) % 90)), source, "x", "y"))
    return rows + [(None, "null id", "a", "", ""), (3, "repeated", "b", "", ""), (3, "repeated", "b", "", ""),
                   (900, None, "a", "", ""), (901, "", "empty", "", ""), (902, " \n", "empty", "", "")]


def key(i, seed=0):
    return int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16)


def test_shards_equal_a_plain_sort(spark):
    rows = corpus()
    got = stratified_shards(spark.createDataFrame(rows, SCHEMA), shards=7).collect()
    groups = defaultdict(list)
    for i, t, s, *_ in rows:
        body = (t or "").encode()
        groups[s].append((key(i), -1 if i is None else i, len(body) + 16, zlib.crc32(body)))
    ranked = []
    for s, members in groups.items():
        for rank, m in enumerate(sorted(members)):
            ranked.append(((2 * rank + 1) / (2 * len(members)), s is None, s or "", *m))
    ranked.sort()
    want, seen = [], Counter()
    for p, (_, _, s, _, i, size, crc) in enumerate(ranked):
        shard = p * 7 // len(ranked)
        want.append((i, size, crc, shard, seen[shard]))
        seen[shard] += 1
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    hot = Counter(r.shard for r in got if r.source == "hot")
    assert max(hot.values()) - min(hot.values()) <= 2 and max(seen.values()) - min(seen.values()) <= 1


def test_few_rows_and_none(spark):
    df = spark.createDataFrame(corpus()[:3], SCHEMA)
    assert sorted((r.shard, r.slot) for r in stratified_shards(df, shards=40).collect()) == [(0, 0), (13, 0), (26, 0)]
    assert stratified_shards(df.limit(0)).count() == 0


def targets(sizes, weights=(5, 2, 1), percent=150):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(sizes.values()) * percent / 100 - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: 2 * sizes[s] for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {**fixed, **share}
        fixed.update(above)


def test_mix_meets_targets(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes, taken, rates = Counter(), Counter(), defaultdict(float)
    for i, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    want = targets(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert r.copies in (math.floor(r.rate), min(2, math.floor(r.rate) + 1)) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        rates[r.source] += r.rate * r.size
    for s, t in want.items():
        assert rates[s] == pytest.approx(t, rel=2e-4, abs=1e-6)  # the dual's solution
        assert abs(taken[s] - t) <= 2e-4 * t + 3 + 0.5 * max(1, sizes[s] // 200)
    # an exponential tilt: the log odds of the rates are in proportion to the sizes
    for s in sizes:
        tilt = {round(math.log(r.rate / (2 - r.rate)) / r.size, 6) for r in got if r.source == s and r.size and 0 < r.rate < 2}
        assert len(tilt) <= 1
    again = mix_sources(df.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_of_little(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    assert mix_sources(df.limit(0)).count() == 0
    one = mix_sources(df.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].copies in (1, 2)
    none = mix_sources(df.where("source = 'empty'")).collect()
    assert [(r.copies, r.taken, r.target) for r in none] == [(1, 0, 0.0)] * 2


def test_low_rates_take_their_share_over_blocks(spark):
    """One huge source at a rate far below one document a block, beside sources that fill the mix."""
    from textspark.llm.entropy_balance import mix_in_place, mix_sources
    rows = [(i, "w w w", "a") for i in range(20_000)] + [(100_000 + i, "x " * 50, f"b{i % 40:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.source: (r.t, r.target) for r in mix_sources(df, weights=(1, 400, 400)).groupBy("source").agg(
        {"taken": "sum", "target": "max"}).toDF("source", "t", "target").collect()}
    for taken, target in got.values():
        assert abs(taken - target) <= max(0.02 * target, 51), got
    scratch_df = df.repartition(4)
    words = {}
    for r in mix_in_place(scratch_df, weights=(1, 400, 400)).collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    assert all(abs(words.get(s, 0) - t) <= max(0.05 * t, 4 * 51) for s, (_, t) in got.items())
