"""Runs of repeating words, found on a grammar of the words (dealt operator 11).

The words of a chunk of texts are numbered and compressed by Re-Pair in rounds: an occurrence
of a repeated pair is replaced where its pair is more frequent than both pairs that overlap it
(ties by first appearance, equal pairs in a row from the left). What no longer shrinks is
joined in twos up to one symbol a text. Texts of a chunk share the grammar, so a passage that
many of them hold is looked at once.

Each nonterminal X = L R is looked at when it is made. A stretch of period q and length
>= ``exponent`` * q (4 or more) that crosses the boundary holds 2 q words on one side of it,
so two comparisons a side leave few q; those are extended exactly to both sides inside X. The
stretches are translated to every place where X is put, and stretches of one period that
share a period or more are merged. A maximal run lies inside the lowest node of the
derivation that covers it and crosses that node's boundary, so each is found in full.

The work is n log n words in numpy for each text, memory a chunk's (a longer text is a chunk
of its own). There is no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks
from .texthash import arrow_bytes

#: Text bytes whose words are compressed together.
CHUNK_BYTES = 1 << 20
#: Re-Pair ends when a round replaces less than this share of the symbols.
LEAST_GAIN = 1 / 64

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _alike(t: np.ndarray, i: int, j: int, most: int) -> int:
    """Length of the longest common prefix of ``t[i:]`` and ``t[j:]``, at most ``most``."""
    done, step = 0, 16
    while done < most:
        w = min(step, most - done)
        differ = t[i + done:i + done + w] != t[j + done:j + done + w]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done += w
        step *= 4
    return done


def _numbered(counts: np.ndarray):
    """For each k, counts[k] rows (k, 1), (k, 2), ... as two arrays."""
    k = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return k, np.arange(len(k)) - before[k] + 1


def crossing(t: np.ndarray, lo, mid, hi, least: int, exponent: int) -> list[tuple[int, int, int, int]]:
    """Stretches ``(k, start, end, period)`` of ``t[lo[k]:hi[k]]`` that cross ``mid[k]`` and
    have ``max(least, exponent * period)`` words or more; the smallest period of each."""
    found = []
    whole = hi - lo
    for right in (True, False):
        side = (hi - mid) if right else (mid - lo)
        top = np.where((side >= (least + 1) // 2) & (whole >= least), np.minimum(whole // exponent, side // 2), 0)
        k, q = _numbered(top)
        at = mid[k] if right else mid[k] - 1
        step = q if right else -q
        ok = t[at] == t[at + step]
        k, q, at, step = k[ok], q[ok], at[ok], step[ok]
        # as far as the half of such a stretch must reach, the last pair of equal words
        last = np.maximum((least + 1) // 2 - q, q) - 1
        far = np.where(last + q < side[k], last, 0)
        ahead = far if right else -far
        ok = (t[at + ahead] == t[at + ahead + step]) & (last + q < side[k])
        found.append((k[ok], q[ok], np.full(int(ok.sum()), right)))
    k, q, right = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, k))
    back = t[::-1]
    n = len(t)
    out: dict[tuple[int, int, int], int] = {}
    now, seen = -1, []
    for x, p, r in zip(k[order].tolist(), q[order].tolist(), right[order].tolist()):
        if x != now:
            now, seen, a, b, c = x, [], int(lo[x]), int(mid[x]), int(hi[x])
        # 2 p words beside the boundary that lie in a stretch whose period divides p: the same stretch
        if any(p % p0 == 0 and (s <= b and b + 2 * p <= e if r else s <= b - 2 * p and b <= e) for p0, s, e in seen):
            continue
        i = b if r else b - 1 - p
        end = i + p + _alike(t, i, i + p, c - p - i)
        start = i - _alike(back, n - i, n - i - p, i - a)
        seen.append((p, start, end))
        if start < b < end and end - start >= max(least, exponent * p):
            out.setdefault((x, start, end), p)
    return [(x, s, e, p) for (x, s, e), p in out.items()]


def _pairs_to_replace(sym: np.ndarray, doc: np.ndarray):
    """Places whose pair is replaced in this Re-Pair round, and the number of each one's pair."""
    code, _ = pd.factorize(sym[:-1] * (int(sym.max()) + 1) + sym[1:])
    inside = doc[:-1] == doc[1:]
    count = np.bincount(code[inside], minlength=int(code.max()) + 1)
    weight = np.where(inside & (count[code] > 1), count[code] * (len(count) + 1) + (len(count) - code), -1)
    edge = np.flatnonzero(np.concatenate(([True], weight[1:] != weight[:-1])))      # where a row of equal pairs begins
    row = weight[edge]
    before, after = np.concatenate(([-1], row[:-1])), np.concatenate((row[1:], [-1]))
    best = (row >= 0) & (row > before) & (row > after)
    lengths = np.diff(np.append(edge, len(weight)))
    which, place = _numbered(np.where(best, (lengths + 1) // 2, 0))
    chosen = edge[which] + 2 * (place - 1)
    return chosen, code[chosen]


def _neighbours(doc: np.ndarray):
    """Every second place of each text with a neighbour in it, each a pair of its own."""
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    chosen = np.flatnonzero((rank[:-1] % 2 == 0) & (doc[:-1] == doc[1:]))
    return chosen, chosen


def maximal_runs(t: np.ndarray, first: np.ndarray, least: int = 6, exponent: int = 4):
    """Runs of texts laid end to end: ``t`` numbers the words, text i is
    ``t[first[i]:first[i + 1]]``. Arrays ``start, end, period`` (places in ``t``), sorted by
    start and period."""
    if exponent < 4 or least < 2:
        raise ValueError("runs have four periods or more and two words or more")
    sym, at = t.astype(np.int64), np.arange(len(t) + 1)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found: list[tuple[np.ndarray, int, int]] = []
    repair = True
    while len(sym) > 1:
        chosen, code = _pairs_to_replace(sym, doc) if repair else _neighbours(doc)
        if not len(chosen):
            if not repair:
                break
            repair = False
            continue
        repair = repair and len(chosen) >= LEAST_GAIN * len(sym)
        number, names = pd.factorize(code)
        one = np.empty(len(names), np.int64)
        one[number[::-1]] = chosen[::-1]                                             # where each pair is first
        lo = at[one]
        hits = crossing(t, lo, at[one + 1], at[one + 2], least, exponent)
        if hits:
            order = np.argsort(number, kind="stable")
            starts = at[chosen[order]]
            bound = np.searchsorted(number[order], np.arange(len(names) + 1))
            for x, s, e, p in hits:
                found.append((starts[bound[x]:bound[x + 1]] + (s - lo[x]), e - s, p))
        sym[chosen] = int(sym.max()) + 1 + number
        stay = np.ones(len(sym), bool)
        stay[chosen + 1] = False
        sym, doc, at = sym[stay], doc[stay], np.append(at[:-1][stay], len(t))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start = np.concatenate([s for s, _, _ in found])
    end = start + np.repeat([w for _, w, _ in found], [len(s) for s, _, _ in found])
    period = np.repeat([p for _, _, p in found], [len(s) for s, _, _ in found])
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(end + period * (len(t) + 1)) - period * (len(t) + 1)
    new = np.concatenate(([True], (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])))
    group = np.flatnonzero(new)
    start, end, period = start[group], np.maximum.reduceat(end, group), period[group]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _chunk(texts: list[bytes], least: int, exponent: int):
    """Per text: number of words, runs, the words that stay joined by one space."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words, first, t = [], [0], []
    for text in texts:
        own = text.split()           # bytes.split() cuts at \\t \\n \\v \\f \\r and space
        t.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
        words.append(own)
        first.append(first[-1] + len(own))
    first = np.array(first)
    t = np.concatenate(t) if t else np.zeros(0, np.int32)
    start, end, period = maximal_runs(t, first, least, exponent)
    stay = np.ones(len(t), bool)
    for s, e, p in zip(start, end, period):
        stay[s + p:e] = False
    bound = np.searchsorted(start, first)
    for i, own in enumerate(words):
        a, z = bound[i], bound[i + 1]
        runs = [{"start": int(s - first[i]), "length": int(e - s), "period": int(p)}
                for s, e, p in zip(start[a:z], end[a:z], period[a:z])]
        kept = compress(own, stay[first[i]:first[i + 1]].tolist()) if a < z else own
        yield len(own), runs, b" ".join(kept)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6,
              exponent: int = 4) -> DataFrame:
    """One row per row of ``docs``: ``id, n_words, runs, collapsed``.

    ``runs`` (start, length, period in words; sorted by start, then period) are the maximal
    stretches of smallest period q and length >= max(``least``, ``exponent`` * q);
    ``collapsed`` is the text without the words that any run has after its first q words,
    joined by one space. Words are runs of characters other than space and \\t to \\r.

    Null and empty texts have no words, no runs and an empty ``collapsed``; ids may be null or
    repeat, rows are judged each on its own; no rows give no rows; other columns are not
    read, so their names cannot clash. Texts of any length are taken whole."""
    schema = pa.schema([("id", _arrow_type(docs, id_col)), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        ("collapsed", pa.string())])

    def judge(batches):
        for batch in batches:
            raw, offsets = arrow_bytes(batch.column(1))
            for i, j in byte_chunks(offsets, CHUNK_BYTES):
                texts = [raw[a:b].tobytes() for a, b in zip(offsets[i:j], offsets[i + 1:j + 1])]
                n, runs, kept = zip(*_chunk(texts, least, exponent))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                                       pa.array(runs, schema.field("runs").type),
                                       pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        judge, f"id {kind}, n_words bigint, runs {RUN}, collapsed string")


def _arrow_type(df: DataFrame, name: str):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)


def best_run(runs):
    """The run of the greatest exact length / period (ties: smallest start, then period), null if none."""
    def order(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a > b, -1).when(a < b, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))
