"""Scalar text rules (T1-T11) as Spark Column expressions.

All of them are built-in functions only (no Python UDF), so they run inside
whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .patterns import CHUNK, LINE_BREAKS, S, W, WHITESPACE_RUN, WORD


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- T1 -------------------------------------------------------------------
def replace_chars(col) -> Column:
    """Nine fixed Unicode -> ASCII replacements (one pass, like str.replace in turn:
    the targets never overlap the sources)."""
    src = "".join(a for a, _ in K.CHAR_REPLACEMENTS)
    dst = "".join(b for _, b in K.CHAR_REPLACEMENTS)
    return F.translate(_c(col), src, dst)


# --- T2 -------------------------------------------------------------------
def collapse_whitespace(col) -> Column:
    """Python ``" ".join(s.split())``: Unicode whitespace runs -> one space, trimmed."""
    return F.trim(F.regexp_replace(_c(col), WHITESPACE_RUN, " "))


# --- T3 -------------------------------------------------------------------
def rejoin_contractions(col) -> Column:
    """``(\\w) ' (\\w+)`` -> ``\\1'`` + lower(``\\2``), leftmost non-overlapping.

    Java replacement strings cannot change case, so each match is marked, the text is split on
    the marks, and the marked part is lowered. Marks are \x01\x05 ... \x02; a \x01 or \x02 of the
    text itself is first written as \x01\x03 or \x01\x04 (no word characters, so no match changes).
    """
    escaped = F.replace(F.replace(_c(col), F.lit("\u0001"), F.lit("\u0001\u0003")), F.lit("\u0002"), F.lit("\u0001\u0004"))
    marked = F.regexp_replace(escaped, rf"(?U)([{W}]) ' ([{W}]+)", "$1'\u0001\u0005$2\u0002")
    parts = F.split(marked, "\u0001\u0005")
    fixed = F.transform(
        parts,
        lambda x, i: F.when(i == 0, x).otherwise(
            F.concat(F.lower(F.substring_index(x, "\u0002", 1)),
                     F.substring(x, F.locate("\u0002", x) + 1, 1 << 30))),
    )
    joined = F.array_join(fixed, "")
    return F.replace(F.replace(joined, F.lit("\u0001\u0004"), F.lit("\u0002")), F.lit("\u0001\u0003"), F.lit("\u0001"))


# --- T4 -------------------------------------------------------------------
def fix_punctuation(col) -> Column:
    c = F.regexp_replace(_c(col), r" ([.,?!;:%)])", "$1")
    c = F.regexp_replace(c, r"\( ", "(")
    return F.regexp_replace(c, r"(?U)\$ (\p{Nd})", "\\$$1")


# --- T5 -------------------------------------------------------------------
def clean_utterance(col) -> Column:
    """T1 -> T2 -> T3 -> T4, in this order."""
    return fix_punctuation(rejoin_contractions(collapse_whitespace(replace_chars(col))))


# --- T6 -------------------------------------------------------------------
def lowercase(col) -> Column:
    return F.lower(_c(col))


# --- T7 -------------------------------------------------------------------
def wrap_chat_prompt(col) -> Column:
    return F.concat(F.lit(K.CHAT_USER_PREFIX + " "), collapse_whitespace(col),
                    F.lit("\n" + K.CHAT_BOT_PREFIX))


# --- T8 -------------------------------------------------------------------
def unescape_newlines(col) -> Column:
    return F.replace(_c(col), F.lit("\\n"), F.lit("\n"))


# --- T9 -------------------------------------------------------------------
def strip_unicode(col) -> Column:
    """Python ``str.strip()`` (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), rf"(?U)^[{S}]+|[{S}]+$", "")


def first_line_reply(col) -> Column:
    return strip_unicode(F.substring_index(_c(col), "\n", 1))


# --- T10 ------------------------------------------------------------------
def continuation_after_prompt(text_col, shown_prompt_col) -> Column:
    return F.substring(_c(text_col), F.length(_c(shown_prompt_col)) + 1, 1 << 30)


# --- T11 ------------------------------------------------------------------
JS_SPACE = r"(?U)[\s\x{FEFF}]+"


def chat_title(col, width: int = 40) -> Column:
    """First prompt with whitespace runs folded, trimmed, cut to 40 characters."""
    folded = F.regexp_replace(_c(col), JS_SPACE, " ")
    trimmed = F.regexp_replace(folded, r"^ | $", "")
    return F.substring(trimmed, 1, width)


def context_tail(col, chars: int = 1000) -> Column:
    return F.right(_c(col), F.lit(chars))


# --- pre-tokenization (P1-P3) --------------------------------------------
def bpe_chunks(col) -> Column:
    return F.regexp_extract_all(_c(col), F.lit(CHUNK), 0)


def word_split(col) -> Column:
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD), 0)


def char_split(col) -> Column:
    """Every code point; empty text gives an empty array."""
    c = _c(col)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


def split_lines(col) -> Column:
    """Python ``str.splitlines()`` (no trailing empty piece)."""
    c = _c(col)
    trimmed = F.regexp_replace(c, rf"(?:{LINE_BREAKS})\z", "")
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, LINE_BREAKS))
