"""Quality rules by distribution divergence (dealt operator 3, native).

Per language, the corpus gives two reference distributions: classes of characters, and the
words that are at least ``common_share`` of the language's words (at most 1/common_share of
them) with one bin for all others. Both come from one word count over all texts. A document
is compared with its language's references by Jensen-Shannon distance (square root of the
divergence in bits, 0 to 1) and is rejected beyond a limit.

The few words of that histogram cover too little of a text to tell that all are missing. So a
third distance compares the share of words of a finer set (at least ``known_share`` of the
language's words, one word for each of ``SLOTS`` hashed slots) with the share in the language;
its limit is ``max_known`` of what a text with none of these words has in that language.

Documents under ``min_words`` words, or of a language with under ``MIN_LANG_WORDS`` words, are not
compared; whether a language is judged does not depend on the others. References are joined
by language, by a broadcast where Spark's statistics allow it.

All of it is one expression per text (split once, hashes of 5-word windows, sorted only where
a window repeats), without Python, joins of texts or shuffles of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATORS, WORD, Scratch, fresh, let

#: Character classes, each counted after the ones before it were taken out.
CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", r"[\p{L}\p{M}]+", "[#*$%&|<>]+")
SYMBOLS = 4  # its place in CLASSES
WINDOW = 5
MIN_LANG_WORDS = 100
SLOTS = 1024


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def class_counts(chars: Column) -> Column:
    """Counts of the characters of each class, and of all others."""
    def nest(rest, k, counts):
        if k == len(CLASSES):
            return F.array(*counts, F.length(rest).cast("bigint"))
        return let(F.regexp_replace(rest, CLASSES[k], ""), lambda left: nest(
            left, k + 1, [*counts, (F.length(rest) - F.length(left)).cast("bigint")]))
    return nest(chars, 0, [])


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of counts and a probability array; null if there are no counts."""
    def half(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def distance(total):
        terms = F.zip_with(counts, reference, lambda c, q: half(c / total, q) + half(q, c / total))
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)) / 2)
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return let(total.cast("double"), lambda t: F.when(t > 0, distance(t)))


def repeated_words(words: Column) -> Column:
    """Words that lie in 5-word windows found twice or more in the text."""
    def covered(places):
        gaps = F.transform(places, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def repeats(sorted_windows):
        def twin(x, i, j):
            return F.coalesce(F.get(sorted_windows, j)["h"] == x["h"], F.lit(False))
        return F.filter(sorted_windows, lambda x, i: twin(x, i, i + 1) | ((i > 0) & twin(x, i, F.greatest(i - 1, F.lit(0)))))

    def count(windows):
        places = let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                     lambda s: F.sort_array(F.transform(repeats(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
            let(places, covered))

    def windows(hashes):
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count)))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SEPARATORS))) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def word_counts(words: Column, common: Column) -> Column:
    """Counts of the common words, and of all other words."""
    def counts(hits):
        each = F.transform(common, lambda c: F.size(F.filter(hits, lambda w: w == c)).cast("bigint"))
        return F.concat(each, F.array((F.size(words) - F.size(hits)).cast("bigint")))
    longest = F.array_max(F.transform(common, lambda c: F.octet_length(c)))
    return let(longest, lambda top: let(
        F.filter(words, lambda w: (F.octet_length(w) <= top) & F.array_contains(common, w)), counts))


def slot_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def known_words(words: Column, known: Column) -> Column:
    """Counts of the words that are in their slot of ``known``, and of all others."""
    hits = F.size(F.filter(words, lambda w: F.coalesce(F.get(known, slot_of(w)) == w, F.lit(False)))).cast("bigint")
    return let(hits, lambda n: F.array(n, F.size(words).cast("bigint") - n))


def judgement(text: Column, common: Column, word_ref: Column, class_ref: Column, known: Column, known_ref: Column,
              min_words: int, max_class: float, max_word: float, max_known: float) -> Column:
    """One struct per text: the base counts, the distances, ``base_failed`` and ``kept``."""
    def judge(words, chars, classes):
        long_enough = (F.size(words) >= min_words) & common.isNotNull()
        measured = F.struct(
            F.size(words).cast("bigint").alias("n_words"), F.length(chars).cast("bigint").alias("word_chars"),
            classes[SYMBOLS].alias("n_symbols"), duplicate_lines(text).alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.when(long_enough, js_distance(classes, class_ref)).alias("class_distance"),
            F.when(long_enough, js_distance(word_counts(words, common), word_ref)).alias("word_distance"),
            F.when((F.size(words) >= min_words) & known.isNotNull(),
                   js_distance(known_words(words, known), known_ref)).alias("known_distance"))

        def verdict(m):
            failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
            far = F.coalesce((m["class_distance"] > max_class) | (m["word_distance"] > max_word), F.lit(False))
            none = js_distance(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint")), known_ref)
            far = far | F.coalesce(m["known_distance"] > max_known * none, F.lit(False))
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "known_distance"]
            return F.struct(*[m[n].alias(n) for n in names], failed.alias("base_failed"), (~failed & ~far).alias("kept"))
        return let(measured, verdict)
    return let(words_of(text), lambda w: let(F.array_join(w, ""), lambda chars: let(
        class_counts(chars), lambda classes: judge(w, chars, classes))))


def language_references(docs: DataFrame, text_col: str, lang_col: str, common_share: float,
                        known_share: float, scratch: Scratch) -> DataFrame:
    """``lang, common, word_ref, class_ref, known, known_ref``: counts over all words of all texts."""
    words = docs.select(F.col(lang_col).alias("lang"), F.explode(words_of(F.col(text_col))).alias("word"))
    counts = scratch.save(words.where("lang is not null").groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    large = scratch.save(totals.where(f"total >= {MIN_LANG_WORDS}"), "languages")
    sums = [F.sum(F.col("n") * F.col("c")[k]).cast("double").alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    classes = (counts.select("lang", "n", class_counts(F.col("word")).alias("c")).groupBy("lang").agg(*sums))
    chars = sum((F.col(f"c{k}") for k in range(1, len(CLASSES) + 1)), F.col("c0"))
    classes = classes.select("lang", F.array(*[F.col(f"c{k}") / chars for k in range(len(CLASSES) + 1)]).alias("class_ref"))
    slots = (counts.join(large, "lang").where(F.col("n") >= F.col("total") * known_share)
             .groupBy("lang", "total", slot_of(F.col("word")).alias("slot")).agg(F.max(F.struct("n", "word")).alias("w"))
             .groupBy("lang", "total").agg(F.sum("w.n").alias("hits"), F.map_from_entries(F.collect_list(F.struct("slot", "w.word"))).alias("at")))
    share = F.col("hits") / F.col("total")
    slots = slots.select("lang", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.try_element_at("at", i)).alias("known"),
                         F.array(share, 1 - share).alias("known_ref"))
    often = (counts.join(large, "lang").where(F.col("n") >= F.col("total") * common_share)
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word",
                                                                       (F.col("n") / F.col("total")).alias("p")))).alias("w")))
    other = 1 - F.aggregate("w", F.lit(0.0), lambda s, x: s + x["p"])
    often = often.select("lang", F.transform("w", lambda x: x["word"]).alias("common"),
                         F.concat(F.transform("w", lambda x: x["p"]), F.array(other)).alias("word_ref"))
    return scratch.save(classes.join(slots, "lang").join(often, "lang", "left"), "references")


def judge_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common_share: float = 0.005,
                    min_words: int = 50, max_class: float = 0.34, max_word: float = 0.40,
                    known_share: float = 0.0005, max_known: float = 0.5, out: str = "judgement") -> DataFrame:
    """``docs`` with one more struct column ``out`` (see :func:`judgement`).

    A null text counts as empty (0 words: base_failed). A null language or one of few
    words has no reference: only the base rules judge. A language none of whose words is common enough has
    none either. Repeated rows are judged alike; an empty table stays empty. All
    columns of ``docs`` stay; ``out`` should not be one of them."""
    scratch = Scratch(docs.sparkSession, "divergence")
    ref = {c: fresh(docs, f"_ref_{c}") for c in ("lang", "common", "word_ref", "class_ref", "known", "known_ref")}
    refs = (language_references(docs, text_col, lang_col, common_share, known_share, scratch)
            .select(*[F.col(c).alias(n) for c, n in ref.items()]))
    return docs.join(refs, F.col(lang_col) == F.col(ref["lang"]), "left").withColumn(out, judgement(
        F.coalesce(F.col(text_col), F.lit("")), *[F.col(ref[c]) for c in ("common", "word_ref", "class_ref", "known", "known_ref")],
        min_words, max_class, max_word, max_known)).drop(*ref.values())
