"""Quality classifier: held-out accuracy, no leak of labels or ids, edge rows."""

import random
import zlib

from textspark.llm.subword_clf import classify, fit_quality, score_texts


def corpus(n=500):
    r = random.Random(9)
    syllables = "ka lo mi ter sun dra pel on in er th an".split()
    docs, labels = [], []
    for i in range(n):
        words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(20, 80))]
        bad = i % 5 == 0
        if bad:
            kind = i % 3
            words = ([w.upper() + "!!" for w in words] if kind == 0 else [words[0]] * len(words) if kind == 1
                     else [w + "###" for w in words])
        docs.append((i, " ".join(words), "src"))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus()
    rows = classify(*frames(spark, docs, labels)).collect()
    truth = dict((i, q) for i, q, _ in labels)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(200)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (classify(*frames(spark, docs, x)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_edge_rows(spark):
    docs, labels = corpus(100)
    extra = [(900, None, ""), (901, "", ""), (902, " \n", ""), (None, "null id", ""), (903, docs[1][1] * 400, ""), (1, docs[1][1], "")]
    d, lab = frames(spark, docs + extra, labels + [(1, 1, 0), (None, 1, 0), (5, None, 0), (7, 3, 0), (9999, 0, 0)])
    rows = classify(d, lab).collect()
    assert len(rows) == len(docs) + len(extra) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[900] == by[901] and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert classify(d.limit(0), lab).count() == 0
    unlabelled = classify(d, lab.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    pull, bias = fit_quality(d, lab, sample=10)
    assert score_texts(d, pull, bias, "text", "new").columns == [*d.columns, "new"]
