"""Token counts by heap-and-linked-list byte-pair merging (dealt operator 6).

A piece of text starts as a linked list of its bytes; a heap holds the adjacent pairs that a
merge rule knows, by rank and place. The lowest is popped, the pair joined and its two new
neighbours pushed, until the heap is empty: the count is the bytes minus the merges made, and
no token id is looked up or kept. A piece of n bytes costs n log n, however long it is.

The merge rules (a fixed table of 50,000 pairs) go to the tasks as one broadcast variable.
Texts are cut into pieces by the vocabulary's own pattern; equal pieces of a worker are
counted once and kept in a dictionary of bounded size.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks
from .texthash import arrow_bytes

#: Pieces whose count a worker keeps.
CACHE_PIECES = 1_000_000


def byte_symbols() -> dict[int, str]:
    """Bytes as the printable characters of byte-level vocabularies: printable Latin-1 stands
    for itself, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def load_merges(path: str) -> dict:
    """``merges`` (pair of symbol numbers -> rank, joined symbol), ``special`` strings and the
    split pattern of a tokenizers file with a byte-level BPE model."""
    import public_tokenizers
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    number: dict[str, int] = {c: b for b, c in byte_symbols().items()}
    merges: dict[tuple[int, int], tuple[int, int]] = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        joined = number.setdefault(a + b, 256 + len(merges))
        merges[number[a], number[b]] = (rank, joined)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    return {"merges": merges, "special": special, "pattern": public_tokenizers.PATTERN}


def count_piece(piece: bytes, merges: dict) -> int:
    """Tokens of one piece: its bytes less the merges that the heap allows."""
    n = len(piece)
    if n < 2:
        return n
    symbol = list(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*m, i) for i in range(n - 1) if (m := merges.get((symbol[i], symbol[i + 1])))]
    heapq.heapify(heap)
    made = 0
    while heap:
        rank, joined, i = heapq.heappop(heap)
        if symbol[i] < 0 or (j := after[i]) >= n:
            continue
        if merges.get((symbol[i], symbol[j])) != (rank, joined):
            continue  # one of the two has been joined with another since
        made += 1
        symbol[i], symbol[j] = joined, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if m := merges.get((joined, symbol[k])):
                heapq.heappush(heap, (*m, i))
        h = before[i]
        if h >= 0 and (m := merges.get((symbol[h], joined))):
            heapq.heappush(heap, (*m, h))
    return n - made


class PieceCounter:
    """Counts the tokens of texts with one rule table; keeps the counts of pieces it has met."""

    def __init__(self, spec: dict):
        import regex
        self.spec = spec  # kept alive, so that its identity stays its own
        self.merges, self.known = spec["merges"], {}
        self.pieces = regex.compile(spec["pattern"]).findall
        self.special = None
        if spec["special"]:
            longest_first = sorted(spec["special"], key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, longest_first)))

    def count(self, text: str) -> int:
        parts, total = [text], 0
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        known = self.known
        for part in parts:
            for piece, times in Counter(self.pieces(part)).items():
                n = known.get(piece)
                if n is None:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    n = count_piece(piece.encode("utf-8"), self.merges)
                    if len(piece) < 64:
                        known[piece] = n
                total += n * times
        return total


_counters: dict[int, PieceCounter] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``<id>, n_bytes, n_tokens, over_limit`` for every row, over whole texts.

    A null text counts as empty: 0 bytes, 0 tokens. Special strings inside a text are one token
    each, as the file's library does by default. Null ids and repeated rows pass through; an
    empty table gives no rows; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(tokenizer_path))

    def run(batches):
        key = id(shared.value)
        counter = _counters.get(key) or _counters.setdefault(key, PieceCounter(shared.value))
        for batch in batches:
            raw, off = arrow_bytes(batch.column(1))
            view, counts = raw.tobytes() if len(raw) < 1 << 20 else memoryview(raw), []
            for i, j in byte_chunks(off, 1 << 20):
                counts.extend(counter.count(str(view[off[k]:off[k + 1]], "utf-8")) for k in range(i, j))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
