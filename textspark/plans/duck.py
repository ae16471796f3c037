"""SQL text helpers for the DuckDB oracle strings (RE2 regex, DuckDB lambdas)."""

from __future__ import annotations

from ..functions import constants as K

# Python's str.split() whitespace, spelled for RE2
PY_SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORDC = r"[\p{L}\p{N}_]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def replace_chars(x: str) -> str:
    src = "".join(a for a, _ in K.CHAR_REPLACEMENTS)
    dst = "".join(b for _, b in K.CHAR_REPLACEMENTS)
    return f"translate({x}, {lit(src)}, {lit(dst)})"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{PY_SPACE}+', ' ', 'g'))"


def rejoin_contractions(x: str) -> str:
    marked = (f"regexp_replace({x}, '({WORDC}) '' ({WORDC}+)', "
              f"'\\1''' || chr(1) || '\\2' || chr(2), 'g')")
    return (f"array_to_string(list_transform(string_split({marked}, chr(1)), lambda p, i: "
            f"case when i = 1 then p else lower(split_part(p, chr(2), 1)) || "
            f"substr(p, strpos(p, chr(2)) + 1) end), '')")


def fix_punct(x: str) -> str:
    a = f"regexp_replace({x}, ' ([.,?!;:%)])', '\\1', 'g')"
    b = f"regexp_replace({a}, '\\( ', '(', 'g')"
    return f"regexp_replace({b}, '\\$ (\\p{{Nd}})', '$\\1', 'g')"


def clean(x: str) -> str:
    return fix_punct(rejoin_contractions(collapse_ws(replace_chars(x))))


def strip_py(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"
