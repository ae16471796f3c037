import pytest
from pyspark.sql import functions as F

from textspark.functions import text as T
from textspark.operators import dialogue as D

CLEAN_CASES = [
    ("Say , Jim , how about it ?", "Say, Jim, how about it?"),
    ("I ’ m sure it ’ s fine !", "I'm sure it's fine!"),
    ("I ' Ve got it", "I've got it"),
    ("It costs $ 5 ( or so ) ...", "It costs $5 (or so)..."),
    ("  extra   spaces  ", "extra spaces"),
    ("a ' b ' c ' D", "a'b ' c'd"),
]


def test_clean_utterance(spark):
    df = spark.createDataFrame(CLEAN_CASES, "raw string, expected string")
    got = df.select("expected", T.clean_utterance("raw").alias("got")).collect()
    assert [r.got for r in got] == [r.expected for r in got]


def test_split_lines_follows_python(spark):
    texts = ["a\nb", "a b\x85c", "a\r\nb\n", "x\n\n", "", "\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.split_lines("t")).collect()]
    assert got == [t.splitlines() for t in texts]


def test_unicode_chunks_match_python_pattern(spark):
    import regex  # noqa: F401  (Python's own re is the reference semantics)
    import re
    pat = re.compile(r" ?\w+| ?[^\w\s]+|\s+(?!\S)|\s+")
    texts = ["Hello  world!\n\nBye", "x²‿y", "naïve café", "a‍b", "😀 ok", "\n\nB", "tail  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r[0]) for r in df.select(T.bpe_chunks("t")).collect()]
    assert got == [pat.findall(t) for t in texts]


def test_format_dialogue_alternates(spark):
    df = spark.createDataFrame([(1, 0, "Hi ."), (1, 1, "Hello ."), (1, 2, "Bye .")], "conv_id long, turn long, text string")
    lines = D.block_strings(D.format_dialogue(df)).collect()
    assert lines[0].block == "User: Hi .\nBot: Hello .\nUser: Bye ."


def test_parse_raw_dialogues(spark):
    raw = "Hi , there . __eou__ Hello ! __eou__\nOnly one turn . __eou__\n"
    files = spark.createDataFrame([(0, raw)], "split_ord int, text string")
    lines = D.lines_from_files(files)
    parsed = D.parse_dialogue_lines(lines).collect()
    assert [list(r.turns) for r in parsed] == [["Hi, there.", "Hello!"]]


def test_dedup_keeps_first_and_counts(spark):
    convs = [(0, 0, "Hi."), (0, 1, "Hello."), (1, 0, "Bye."), (1, 1, "See you."), (2, 0, "Hi."), (2, 1, "Hello.")]
    df = spark.createDataFrame(convs, "conv_id long, turn long, text string")
    lines = D.format_dialogue(df)
    kept_lines, kept = D.dedup_conversations(lines, ["conv_id"])
    assert sorted(r.conv_id for r in kept.collect()) == [0, 1]
    summary = D.corpus_summary(kept_lines, kept).first()
    corpus = "User: Hi.\nBot: Hello.\n\nUser: Bye.\nBot: See you.\n"
    assert summary.duplicates == 1
    assert summary.characters == len(corpus)
    assert summary.lines == corpus.count("\n")
    ordered = D.corpus_lines(kept_lines.withColumn("ord", F.col("conv_id")), "ord").orderBy("ord", "idx")
    assert "".join(r.line + "\n" for r in ordered.collect()) == corpus


@pytest.mark.parametrize("ratio", [0.0, 1.0, -0.5])
def test_bad_val_ratio(ratio):
    from textspark.operators.dataset import check_val_ratio
    with pytest.raises(ValueError):
        check_val_ratio(ratio)


def test_contractions_in_texts_that_hold_the_marks(spark):
    cases = {"a\x01Bc d": "a\x01Bc d", "\x02x ' Y\x01 ' Z": "\x02x'y\x01 ' Z", "it ' S\x01\x05Up \x01\x04 he ' LL": "it's\x01\x05Up \x01\x04 he'll",
             "\x01\x03 A ' B": "\x01\x03 A'b"}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    from textspark.functions.text import rejoin_contractions
    assert {r.t: r.o for r in df.select("t", rejoin_contractions("t").alias("o")).collect()} == cases
