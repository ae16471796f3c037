"""The conversation trie against a plain-Python trie; centroid sums against direct sums."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from textspark.llm.prefix_trie import centroid_totals, prefix_trie, whole_conversations
from textspark.llm.queries import rebuilt_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}


def rebuild(convs):
    h = lambda c: zlib.crc32(str(c).encode()) % 9
    return {c: convs.get(c - c % 5, [])[:h(c)] + own[h(c):] for c, own in convs.items()}


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = {q for q in below if len(q) == len(p) + 1}
        parents = {q[:-1] for q in below if q}
        leaves = [q for q in below if q not in parents]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(p))))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.sampled_from(["any", "chain", "star"]))
def test_centroid_totals(seed, shape):
    parent = [0] + [{"any": x % i, "chain": i - 1, "star": 0}[shape] for i, x in enumerate(seed) if i]
    values = [(x, 1) for x in seed]
    want = [list(v) for v in values]
    for i in range(len(parent) - 1, 0, -1):
        for k in (0, 1):
            want[parent[i]][k] += want[i][k]
    assert centroid_totals(parent, values) == want


def made(seed):
    rng = random.Random(seed)
    rows, texts = [], ["", "hé", "b", None]
    for c in range(40):
        for t in range(rng.randint(0, 12)):
            rows.append((c, rng.choice([t, t, t, None]) if c % 7 == 0 else t, rng.choice(["user", "bot", None]), rng.choice(texts), "x"))
    rows += [(100, t, "user", f"deep {t}", "x") for t in range(60)] + [(101, t, "user", f"deep {t}", "x") for t in range(35)]
    rows += [(200 + c, t, "user", "same", "x") for c in range(30) for t in range(3)]
    rows += rows[:3] + [(None, 1, "user", "no conversation", "x"), (-3, 0, "u", "negative", "x")]
    return rows


def test_trie(spark):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie(whole_conversations(df))) == brute(turns_of(rows))
    # rounds of joins for every component of more than 3 nodes
    assert got(prefix_trie(rebuilt_conversations(df), limit=3)) == brute(rebuild(turns_of(rows)))
    assert got(prefix_trie(whole_conversations(df.limit(0)))) == []


def test_turnless(spark):
    rows = [(c, 0, "user", "only") for c in (1, 6, 11, 16, 21, 22)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = brute(rebuild(turns_of(rows)))
    assert got(prefix_trie(rebuilt_conversations(df))) == want
    assert any(r[1] == 0 and r[-1] != hashlib.sha256(b"").hexdigest() for r in want)


def test_query(spark, sf_dir):
    from textspark.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_prefix_trie"](spark, sf_dir)) == brute(rebuild(turns_of(rows)))


def test_oracle(spark, sf_dir):
    from textspark.llm.queries import ORACLE, QUERIES
    from textspark.plans.oracle_check import compare, duck_connection
    name = "op12_prefix_trie"
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], duck_connection(sf_dir))
    assert r["ok"], r
