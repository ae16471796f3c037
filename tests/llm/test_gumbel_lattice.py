"""Gumbel top-k segmentations: distribution, distinctness, scores, round trip, edge rows."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from textspark.llm import gumbel_lattice as G

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = G.load_model(PATH)
LEX = G.Lexicon(MODEL)
WEIGHT = dict(zip(MODEL["pieces"], MODEL["weight"]))


def marked(text):
    return ("▁" + text).replace(" ", "▁") if text else ""


def segmentations(text):
    """All of them, by recursion: (lengths of the pieces, log weight)."""
    if not text:
        return [((), 0.0)]
    out = []
    for n in range(1, min(len(text), 16) + 1):
        w = WEIGHT.get(text[:n])
        if w is None and n == 1:
            w = MODEL["byte_weight"] * len(text[0].encode())
        if w is not None:
            out += [((n, *rest), w + x) for rest, x in segmentations(text[n:])]
    return out


def sample(texts, keys, k, seed=1, cut=G.CUT):
    chars, offsets = [], [0]
    for t in texts:
        chars += [ord(c) for c in marked(t)]
        offsets.append(len(chars))
    return G.sample_chunk(np.array(chars, np.uint32), np.array(offsets), np.array(keys), k, seed, LEX, MODEL, cut)


def lengths(result, row):
    return tuple(result["paths"].length[result["paths"].first[row]:result["paths"].first[row + 1]])


@pytest.mark.parametrize("text", ["the cat 日x", "a  b", "abc"])
def test_samples_follow_the_distribution(text):
    found = segmentations(marked(text))
    total = np.logaddexp.reduce([w for _, w in found])
    p = {s: math.exp(w - total) for s, w in found}
    n = 4000
    _, results, threshold = sample([text] * n, range(n), min(3, len(p)))
    first = Counter(lengths(results[0], i) for i in range(n))
    for s, q in p.items():
        assert abs(first[s] / n - q) < 0.04
    if len(p) > 1:  # without replacement: p(b) * p(a) / (1 - p(a)) summed over the first draw a
        second = Counter(lengths(results[1], i) for i in range(n))
        for b in p:
            want = sum(p[a] * p[b] / (1 - p[a]) for a in p if a != b)
            assert abs(second[b] / n - want) < 0.04
    for i in range(50):
        drawn = [lengths(r, i) for r in results]
        assert len(set(drawn)) == len(drawn)
        assert all(math.isclose(math.log(p[s]), r["logp"][i], abs_tol=1e-8) for s, r in zip(drawn, results))
    values = np.stack([r["value"] for r in results] + [threshold])
    assert (np.diff(values, axis=0) < 0).all()
    # inclusion scores make an unbiased estimate of the whole mass
    estimate = np.mean(sum(np.exp(r["logp"]) / -np.expm1(-np.exp(r["logp"] - threshold)) for r in results))
    assert abs(estimate - 1) < 0.05


def test_cut_changes_nothing_and_rows_stand_alone():
    words = ["hello", "world", "straße", "日本語", "xyzzy", "the", "of"]
    g = np.random.default_rng(3)
    texts = [" ".join(g.choice(words, 120)) for _ in range(15)]
    a, b = sample(texts, range(15), 4), sample(texts, range(15), 4, cut=np.inf)
    assert all((x["paths"].length == y["paths"].length).all() for x, y in zip(a[1], b[1])) and np.allclose(a[2], b[2])
    alone = sample([texts[7]], [7], 4)
    assert all(lengths(x, 7) == lengths(y, 0) for x, y in zip(a[1], alone[1]))


def test_rows_and_round_trip(spark):
    texts = ["", None, "a", "Hello  wörld\n\n日本語 \U0001f600 x\x00", " lead and trail ", "z" * 20_000, "y " * 5000, "\t", "the same", "the same"]
    rows = [(i, t, str(i)) for i, t in enumerate(texts)] + [(None, "null id", "n"), (8, "the same", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = G.sample_encodings(df, PATH, k=3)
    got = out.withColumn("back", G.decode_ids(PATH)("ids")).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
        text = "null id" if r.id is None else texts[r.id] or ""
        assert r.back == text == library.decode(list(r.ids)) and 0 < r.inclusion <= 1 or r.inclusion == 0 and r.log_prob < -30
    assert [len(by[i]) for i in (0, 1, 2)] == [1, 1, len(segmentations(marked("a")))]
    assert by[0][0].inclusion == 1.0 and list(by[0][0].ids) == []
    assert len({tuple(r.ids) for r in by[3]}) == 3 and len(by[8]) == 6
    assert len({(r.sample, tuple(r.ids)) for r in by[8]}) == 3  # equal rows, equal samples
    assert G.sample_encodings(df.limit(0), PATH).count() == 0
    again = G.sample_encodings(df.repartition(4), PATH, k=3).collect()
    rows = [Counter((r.id, r.sample, tuple(r.ids), round(r.perturbed, 6)) for r in x) for x in (got, again)]
    assert rows[0] == rows[1]


def test_decoding_edge_cases(spark):
    df = spark.createDataFrame([(None,), ([],), ([1, 2],), ([3 + 0x80],)], "ids array<int>")
    assert [r[0] for r in df.select(G.decode_ids(PATH)("ids")).collect()] == [None, "", "", "�"]
    with pytest.raises(Exception, match="outside the vocabulary"):
        spark.createDataFrame([([40_000],)], "ids array<int>").select(F.length(G.decode_ids(PATH)("ids"))).collect()


def test_log_inclusion_of_long_texts(spark):
    rng = np.random.default_rng(3)
    long = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(900))
    df = spark.createDataFrame([(0, long), (1, "a few words"), (2, "")], "doc_id long, text string")
    rows = G.sample_encodings(df, PATH, k=2).collect()
    assert all(np.isfinite(r.log_inclusion) and r.log_inclusion <= 0 for r in rows)
    assert all(abs(np.exp(r.log_inclusion) - r.inclusion) < 1e-12 for r in rows)


def test_kept_units_change_nothing(monkeypatch):
    g = np.random.default_rng(5)
    words = ["hello", "world", "straße", "日本語", "xyzzy", "the", "of", "a\x01b", "  ", "ofthe"]
    chunks = [[" ".join(g.choice(words, g.integers(0, 40))) for _ in range(20)] for _ in range(6)]
    chunks.insert(3, ["", "z" * 3000 + " " + "z" * 3000])
    for limit in (G.KNOWN, 30, 5000):  # kept throughout, begun anew again and again, left out where too long
        monkeypatch.setattr(G, "KNOWN", limit)
        known = {}
        for texts in chunks:
            chars, offsets = [], [0]
            for t in texts:
                chars += [ord(c) for c in marked(t)]
                offsets.append(len(chars))
            args = np.array(chars, np.uint32), np.array(offsets), np.arange(len(texts)), 3, 1, LEX, MODEL
            (lat, got, low), (plain, want, least) = G.sample_chunk(*args, known=known), G.sample_chunk(*args)
            assert (low == least).all() and len(got) == len(want)
            for a, b in zip(got, want):
                assert (a["logp"] == b["logp"]).all() and (a["value"] == b["value"]).all()
                for x, y in zip(G.piece_ids(lat, a["paths"], LEX, MODEL), G.piece_ids(plain, b["paths"], LEX, MODEL)):
                    assert (x == y).all()
            known = lat.add_repeated(known)
            assert not known or len(known["left"]) <= limit
        assert bool(known) == (limit != 30) or len(known["left"]) <= 30


def test_decode_handles_bytes_that_are_no_text(spark):
    table = MODEL["bytes"]
    space = next(i for i, b in enumerate(table) if b == b" ")
    bad, begin = int(MODEL["byte_ids"][0xE6]), 1
    rows = [(1, [bad, space]), (2, None), (3, []), (4, [space, space]), (5, [begin]), (6, [int(b) for b in MODEL["byte_ids"][list("日".encode())]])]
    out = spark.createDataFrame(rows, "k int, ids array<int>").select("k", G.decode_ids(PATH)("ids").alias("t")).orderBy("k")
    assert [r.t for r in out.collect()] == ["\ufffd ", None, "", " ", "", "日"]
    with pytest.raises(Exception, match="outside the vocabulary"):
        spark.createDataFrame([([len(table)],)], "ids array<int>").select(G.decode_ids(PATH)("ids").alias("t")).collect()
