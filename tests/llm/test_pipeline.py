"""Pipeline: each stage on its own input, planted cases, edge rows, clashing columns."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from textspark.llm.common import Scratch  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _judgement string, component_id string, copies string"


def documents():
    r = random.Random(4)
    syllables = "ka lo mi ter sun dra pel on in er th an".split()
    vocab = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(300)] + ["the", "of"] * 40
    clean = [" ".join(r.choice(vocab) for _ in range(r.randint(60, 120))) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 4}") for i, t in enumerate(clean)]
    near = clean[5].split()
    near[0] = "changed"
    rows += [(100, clean[3], "en", "s0"), (101, " ".join(near), "en", "s1"), (102, "too short", "en", "s0"),
             (103, " ".join([clean[7].split()[0]] * 200), "en", "s2"), (104, None, None, None), (105, "", "en", "s0"),
             (106, " ".join(w.upper() + "!!" for w in clean[9].split()), "en", "s3"), (1, clean[1], "en", "s1"),
             (None, clean[2] + " null id words here", "en", None)]
    return [(*r, len(r[1] or ""), "x", "y", "z") for r in rows]


@pytest.fixture(scope="module")
def folder(spark):
    path = Scratch(spark, "tables").path("sf")
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(50)] + [(106, 0, 0), (103, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs, scratch = spark.read.parquet(f"{folder}/documents.parquet"), Scratch(spark, "stages")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = scratch.save(stage(spark, docs, folder), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before
            kept.append([r.doc_id for r in docs.collect()])
    rules, classed, deduped, mixed = kept
    assert not {102, 103, 104, 105, 106} & set(rules) and set(range(60)) | {100, 101, None} <= set(rules)
    assert set(range(60)) <= set(classed)
    assert 100 not in deduped and 101 not in deduped and set(range(60)) | {None} == set(deduped) and len(deduped) == 61
    assert set(mixed) <= set(deduped) and max(map(mixed.count, set(mixed))) <= 2
    assert docs.where("not round_trip").count() == 0
    assert docs.count() == corpus_pipeline.SAMPLES * len(mixed)


def test_run_equals_the_stages_and_takes_nothing(spark, folder):
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() > 30
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_rows_without_an_id_or_with_one_id_are_mixed_one_by_one(spark):
    r = random.Random(9)
    rows = [(None if i % 3 else 7, " ".join("w" for _ in range(r.randint(5, 40))) + f" {i}", "en", f"s{i % 2}", 0, "x", "y", "z")
            for i in range(300)]
    docs = Scratch(spark, "mixed").save(spark.createDataFrame(rows, SCHEMA).repartition(3), "docs")
    got = corpus_pipeline.source_mix(spark, docs, "").collect()
    words = {s: sum(len(x[1].split()) for x in rows if x[3] == s) for s in ("s0", "s1")}
    total = 1.5 * sum(words.values())
    target = {"s0": min(total * 5 / 7, 2 * words["s0"])}
    target["s1"] = total - target["s0"]
    for s in words:
        assert abs(sum(len(x.text.split()) for x in got if x.source == s) - target[s]) <= 30
    assert {x.doc_id for x in got} == {None, 7}
