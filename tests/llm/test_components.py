"""Connected components: paths, stars, cycles, strings as ids, nulls and repeats."""

import random

from textspark.llm.common import Scratch
from textspark.llm.components import connected_components


def run(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}")
    return {r.node: r.component for r in connected_components(df, "a", "b", Scratch(spark, "cc")).collect()}


def test_shapes(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    random.Random(1).shuffle(path)
    star = [(500, i) for i in range(501, 540)]
    cycle = [(701, 705), (705, 703), (703, 701), (701, 705)]
    got = run(spark, path + star + cycle + [(900, 900), (None, 3), (4, None)])
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 540)} | {i: 701 for i in (701, 703, 705)} | {900: 900}
    assert got == want


def test_strings_and_nothing(spark):
    assert run(spark, [("b", "c"), ("c", "a"), ("z", "y")], "string") == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}
    assert run(spark, []) == {}
