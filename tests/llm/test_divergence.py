"""Divergence rules: base counts and distances against plain Python, guards and edge rows."""

import math
import random
import re
from collections import Counter

from textspark.llm.divergence import judge_documents

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def js(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    d = sum(a * math.log2(a / c) for a, c in zip(p, m) if a) + sum(b * math.log2(b / c) for b, c in zip(q, m) if b)
    return math.sqrt(max(d, 0) / 2)


def classes(text):
    counts = [0] * 6
    for c in "".join(WORDS.findall(text)):
        k = (0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c.isalpha()
             else 4 if c in "#*$%&|<>" else 5)
        counts[k] += 1
    return counts


PROSE = "the cat of the house and the dog ran to the end of a long road while it rained é".split()


def texts():
    clean = [" ".join(PROSE[(i * k + i) % len(PROSE)] + ("x" * (i % 3)) for i in range(70 + k)) for k in range(12)]
    junk = [" ".join(f"{w.upper()}###" for w in clean[k].split()) for k in range(2)]
    edge = [None, "", " \n\t ", "a b c", "one two three four five " * 30, "line a\nline a\n \n\nline a\nline b",
            "a b c d e a b c d", "a b c d e f a b c d e", "x " * 5000, "é" * 3000]
    return clean + junk + edge


def test_base_counts_and_distances(spark):
    rows = [(i, t, "en" if i % 2 == 0 or (t or "").isupper() else "de") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.judgement for r in judge_documents(df, max_class=0.4).collect()}
    pooled, chars = {}, {}
    for _, t, lang in rows:
        pooled.setdefault(lang, Counter()).update(WORDS.findall(t or ""))
        chars[lang] = [a + b for a, b in zip(chars.get(lang, [0] * 6), classes(t or ""))]
    for i, t, lang in rows:
        r, want = got[i], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        if want[0] < 50:
            assert r.class_distance is None and r.word_distance is None and r.kept == (not r.base_failed)
            continue
        total, mine = sum(pooled[lang].values()), Counter(WORDS.findall(t))
        common = [w for w, n in pooled[lang].items() if n >= 0.005 * total]
        q = [pooled[lang][w] / total for w in common]
        p = [mine[w] / want[0] for w in common]
        assert math.isclose(r.word_distance, js([*p, 1 - sum(p)], [*q, 1 - sum(q)]), abs_tol=1e-7)
        c, ref = classes(t), chars[lang]
        assert math.isclose(r.class_distance, js([x / sum(c) for x in c], [x / sum(ref) for x in ref]), abs_tol=1e-7)
        assert r.kept == (not r.base_failed and r.class_distance <= 0.4 and r.word_distance <= 0.40)


def test_unknown_language_extra_columns_and_empty(spark):
    text = " ".join(PROSE * 5)
    df = spark.createDataFrame([(1, text, None, "x"), (2, text, "en", None), (2, text, "en", None), (None, None, None, None)],
                               "doc_id long, text string, lang string, _ref_lang string")
    out = judge_documents(df)
    assert out.columns == [*df.columns, "judgement"]
    rows = out.collect()
    assert len(rows) == 4 and sum(r.judgement.word_distance is None for r in rows) == 2
    assert judge_documents(df.limit(0)).count() == 0


def test_small_languages_and_texts_without_known_words(spark):
    r = random.Random(3)
    names = ["".join(r.choices("abcdefghij", k=6)) for _ in range(30_000)]
    often, middle, rare = names[:13], names[13:313], names[313:]

    def text(n, share):
        return " ".join(r.choice(r.choices((often, middle, rare), (0.4 * share, 0.6 * share, 1 - share))[0]) for _ in range(n))
    rows = [(i, text(600, 0.45), "aa") for i in range(2500)] + [(5000, text(600, 0.0), "aa")]
    rows += [(6000 + i, text(90, 0.9), "bb") for i in range(12)]  # under 1/1000 of all words
    rows += [(7000, " ".join(f"{w.upper()}###" for w in text(90, 0.9).split()), "bb")]
    got = {x.doc_id: x.judgement for x in judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [i for i, j in got.items() if not j.kept] == [5000, 7000]
    assert all(j.class_distance is not None for j in got.values())
