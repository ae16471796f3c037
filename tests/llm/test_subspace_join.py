"""Subspace pigeonhole join against the full matrix of cosines."""

import numpy as np
import pytest

from textspark.llm import subspace_join as S
from textspark.llm.subspace_join import link_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, min_cos):
    good = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows
            if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, root = {i: 0 for i, *_ in rows if i is not None}, {i: i for i, *_ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a, x) in enumerate(good):
        for j, b, y in good[:n]:
            if x == y and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= min_cos:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in links}


def vectors(dim, seed=2):
    g = np.random.default_rng(seed)
    base = g.standard_normal((40, dim))
    out = [b + s * g.standard_normal(dim) / np.sqrt(dim) * np.linalg.norm(b) for b in base for s in (0, 0.1, 0.25, 0.3, 0.4, 0.5)]
    hub = g.standard_normal(dim)
    out += [hub + 0.2 * g.standard_normal(dim) / np.sqrt(dim) * np.linalg.norm(hub) for _ in range(60)]
    out += [hub] * 25
    return [(i, [float(np.float32(x)) for x in v], i % 2 if i < 240 else 0) for i, v in enumerate(out)]


@pytest.mark.parametrize("dim,chunk", [(64, 2048), (64, 16), (3, 2048), (1, 50)])
def test_against_all_cosines(spark, monkeypatch, dim, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rows = vectors(dim)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in link_vectors(df, 0.93).collect()}
    assert got == brute(rows, 0.93)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [1.0, 0.0], 0), (10, [2.0, 0.0], 0), (11, [1.0, 0.0], 1),
            (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [1e-38, 1e-39], 0), (15, [3e38, 1e38], 0)]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, (None, [1.0, 0.0], 0), (8, [1.0, 0.0], 0)]], SCHEMA)
    got = link_vectors(df, 0.93).collect()
    want = brute(rows, 0.93)
    assert len(got) == len(rows) + 2
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by_id[None] == (0, None, True)
    extra = {8, 9, 10, 14, 15}  # these also link with the repeated row of 8
    for i, (n, c) in want.items():
        assert by_id[i] == (n + (i in extra), c, i == c)
    assert link_vectors(df.limit(0)).count() == 0
    assert link_vectors(df.where("label is null")).count() == 1


def test_disk_follows_the_input(spark, monkeypatch):
    """One label of many chunks: files of shuffles and of written tables, as seen while it runs."""
    import os
    import threading

    from textspark.llm.common import Scratch

    monkeypatch.setattr(S, "CHUNK", 128)
    g = np.random.default_rng(5)
    rows = [(i, [float(v) for v in x], 0, "x") for i, x in enumerate(g.standard_normal((3000, 64)).astype(np.float32))]
    df = spark.createDataFrame(rows, SCHEMA)
    bases, make = [], Scratch.__init__

    def noted(self, *a):
        make(self, *a)
        bases.append(self.base.removeprefix("file:"))

    monkeypatch.setattr(Scratch, "__init__", noted)
    local = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def used(name, tops):
        total = 0
        for top in tops:
            for d, _, names in os.walk(top):
                for x in names:
                    try:
                        total += os.path.getsize(f"{d}/{x}") if x.startswith(name) else 0
                    except OSError:  # it went meanwhile
                        pass
        return total

    before, most, done = used("shuffle_", local), [0], threading.Event()

    def watch():
        while not done.wait(0.02):
            most[0] = max(most[0], used("shuffle_", local) - before + used("part-", bases))

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        assert link_vectors(df, 0.93).where("n_links = 0").count() == 3000
    finally:
        done.set()
        thread.join()
    assert 0 < most[0] < 6 * 3000 * 64 * 4


@pytest.mark.parametrize("size", [3 << 10, 10 << 10])
def test_rounds_of_a_large_label(spark, monkeypatch, size):
    """Chunks of few bytes: odd and even circles of more than four."""
    monkeypatch.setattr(S, "CHUNK_BYTES", size)
    rows = vectors(64, 4)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in link_vectors(df, 0.93).collect()}
    assert got == brute(rows, 0.93)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name, "false") == "false"  # put back


@pytest.mark.parametrize("k", range(1, 10))
def test_each_two_chunks_meet_once(spark, k):
    rows = spark.range(40 * k).selectExpr("1 label", "2 dim", "id", "1 n", "array(float(id), 1f) vec")
    chunks = spark.createDataFrame([(1, 2, k)], "label int, dim int, k int").where("k > 1")
    met = []
    for distance in range(1, max(1, k // 2) + 1):
        dealt = S.deal(rows, chunks, distance).select("task", "step", "id").collect()
        assert len(dealt) <= 2 * 40 * k
        for task in {r.task for r in dealt}:
            own, other = ({r.id for r in dealt if (r.task, r.step) == (task, step)} for step in (0, 1))
            if distance == 1:
                met += [(a, b) for a in own for b in own if a < b]
            met += [(min(a, b), max(a, b)) for a in own for b in other]
    assert sorted(met) == [(a, b) for a in range(40 * k) for b in range(a + 1, 40 * k)]


@pytest.mark.parametrize("min_cos", [0.93, 0.3, -0.5])
@pytest.mark.parametrize("dim", [1, 5, 64, 200])
def test_match_in_cells(monkeypatch, dim, min_cos):
    monkeypatch.setattr(S, "CELL", 16)
    monkeypatch.setattr(S, "PAIRS", 50)
    x = np.array([v for _, v, _ in vectors(dim)], np.float32)
    x = np.unique(x, axis=0)
    n = np.ones(len(x), np.int64)
    ids = np.arange(len(x)) // 2 * 2  # equal ids do not meet
    u = S.unit(x)
    cos = np.array([(u * v).sum(1) for v in u])
    half = len(x) // 3
    sides = [S.Side(i, n[:len(i)], v) for i, v in ((np.arange(len(x)), x), (ids[:half], x[:half]), (ids[half:], x[half:]))]
    budget = 2 * (1 - min_cos) + S.SLACK
    own = np.concatenate([np.stack(p, 1) for p in S.match(sides[0], sides[0], min_cos, budget)])
    name = sides[0].ids
    assert sorted(tuple(sorted(p)) for p in name[own].tolist()) == [
        (i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if cos[i, j] >= min_cos]
    pairs = [p for i, j in S.match(sides[1], sides[2], min_cos, budget) for p in zip(sides[1].ids[i].tolist(), sides[2].ids[j].tolist())]
    assert sorted(pairs) == sorted((int(ids[i]), int(ids[j])) for i in range(half) for j in range(half, len(x))
                                   if cos[i, j] >= min_cos and ids[i] != ids[j])


def test_signed_zeros_are_one_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0, "x"), (2, [1.0, -0.0], 0, "x"), (3, [-0.0, 1.0], 0, "x")], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in link_vectors(df).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}
