"""Benchmark passages inside documents, by a prefix-filtered set join (dealt operator 13).

An item's windows (``window`` consecutive words; all words of a shorter item) are sets of
shingles (``shingle`` words at a place of the window). A window stands at a place of a document
if at least ``share`` of its shingles stand there at the same places; with m shingles, any
m - need + 1 of them hold one of these. So the shingles are ordered by rarity in the documents
(one counting pass), only the rarest m - need + 1 are joined with the documents' shingles (one,
when the whole window must stand there), and a joined pair is

1. bounded by place and length: the window must begin at word 0 or later and end in the text,
2. verified exactly, word by word, over the stretch of the window's size.

Both passes over the texts let through only shingles whose bit is set in a map of ``BITS`` bits
(2 MB, whatever the benchmark's size); false ones find no partner in the join. A candidate
carries the words around it, so texts are not shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .texthash import mix, prefix_hash, span_hash, text_chunks, word_spans

#: Bits of the map of shingle hashes: 512 pages of 4 KB, a proven bound of what is broadcast.
BITS = 24
_PAGE = 15

#: Word characters: digits, letters and all beyond ASCII (fixed values).
_SEP = np.ones(256, bool)
_SEP[0x30:0x3A] = _SEP[0x41:0x5B] = _SEP[0x61:0x7B] = _SEP[0x80:] = False


def _words(raw, offsets):
    """Starts, ends and hashes (A-Z folded) of the words, and where each row's words begin."""
    starts, ends, first = word_spans(raw, offsets, _SEP)
    return starts, ends, first, span_hash(prefix_hash(raw, True), starts, ends)


def _shingles(words: np.ndarray, first: np.ndarray, size: int):
    """Places whose ``size`` words lie in one row, and their hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for i in range(size):
        acc = acc * np.uint64(0x9FB21C651E98DF25) + words[i:n + i]
    end = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + size <= end)
    return at, mix(acc[at] + np.uint64(size))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``item, words, shingles`` for every window; an item without an id is named by an empty string."""
    def cut(batches):
        for batch in batches:
            for i, j, raw, offsets in text_chunks(batch.column(1)):
                starts, ends, first, hashes = _words(raw, offsets)
                whole = raw.tobytes()
                names, words, sets = [], [], []
                for r in range(j - i):
                    a, n = int(first[r]), int(first[r + 1] - first[r])
                    own = [str(whole[s:e].lower(), "utf-8") for s, e in zip(starts[a:a + n], ends[a:a + n])]
                    width = min(n, window)
                    _, h = _shingles(hashes[a:a + n], np.array([0, n]), min(shingle, width)) if n else (None, [])
                    h = np.asarray(h).view(np.int64).tolist() if n else []
                    m = width - min(shingle, width) + 1
                    for k in range(n - width + 1 if n else 0):
                        names.append(batch.column(0)[i + r])
                        words.append(own[k:k + width])
                        sets.append(h[k:k + m])
                yield pa.record_batch([pa.array([x.as_py() for x in names], pa.string()),
                                       pa.array(words, pa.list_(pa.string())),
                                       pa.array(sets, pa.list_(pa.int64()))], ["item", "words", "shingles"])

    return items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.col(text_col).cast("binary").alias("text")).mapInArrow(
        cut, "item string, words array<string>, shingles array<bigint>")


def bit_map(hashes: DataFrame, name: str) -> np.ndarray:
    """The map of the first ``BITS`` bits of 64-bit hashes, as bytes (2 MB); built page by page."""
    bit = F.shiftrightunsigned(name, 64 - BITS)
    pages = (hashes.select(F.shiftright(bit, _PAGE).alias("page"), bit.bitwiseAND(F.lit((1 << _PAGE) - 1)).alias("place"))
             .groupBy("page").agg(F.bitmap_construct_agg("place").alias("bits")).collect())
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for page, bits in pages:                     # at most 2**(BITS - _PAGE) pages
        part = np.frombuffer(bytes(bits), np.uint8)
        out[page << (_PAGE - 3):][:len(part)] = part
    return out


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)


def shingle_counts(docs: DataFrame, text_col: str, bits, sizes: list[int]) -> DataFrame:
    """``hash, n``: how often the documents have each shingle whose bit is set."""
    def run(batches):
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch.column(0)):
                _, _, first, words = _words(raw, offsets)
                for size in sizes:
                    _, hashes = _shingles(words, first, size)
                    found, n = np.unique(hashes[_marked(bits.value, hashes)], return_counts=True)
                    yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

    return (docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "hash bigint, n bigint")
            .groupBy("hash").agg(F.sum("n").alias("n")))


def candidates(docs: DataFrame, id_col: str, text_col: str, bits, sizes: list[int], window: int) -> DataFrame:
    """Each document with its number of words and its shingles whose bit is set: place, hash,
    and the words from ``before`` places ahead of it, as far as a window may reach."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, raw, offsets in text_chunks(batch.column(1)):
                starts, ends, first, words = _words(raw, offsets)
                whole = raw.tobytes()
                out: list[list] = [[] for _ in range(j - i)]
                for size in sizes:
                    at, hashes = _shingles(words, first, size)
                    keep = _marked(bits.value, hashes)
                    rows = np.searchsorted(first, at[keep], "right") - 1
                    for r, p, h in zip(rows.tolist(), at[keep].tolist(), hashes[keep].view(np.int64).tolist()):
                        a, z = max(int(first[r]), p - window + size), min(int(first[r + 1]), p + window)
                        out[r].append({"at": p - int(first[r]), "hash": h, "before": p - a, "words": [
                            str(whole[s:e].lower(), "utf-8") for s, e in zip(starts[a:z].tolist(), ends[a:z].tolist())]})
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()), pa.array(
                    out, pa.list_(pa.struct([("at", pa.int64()), ("hash", pa.int64()), ("before", pa.int32()),
                                             ("words", pa.list_(pa.string()))])))], ["id", "n_words", "found"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, found array<struct<at:bigint,hash:bigint,before:int,words:array<string>>>")


def _needed(m, share: float):
    """How many of m shingles must stand at their places."""
    return F.ceil(m * F.lit(float(share)) - F.lit(1e-9)).cast("int")


def prefix_records(windows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """``hash, at, key, words, m``: of each distinct window the rarest shingles that must be
    joined (ties by hash and place); a shingle that no document has counts 0."""
    records = windows.dropDuplicates(["key"]).select("key", "words", "shingles")
    each = records.select("key", F.posexplode("shingles").alias("at", "hash")).join(counts, "hash", "left")
    m = F.size("order")
    chosen = (each.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), "hash", "at"))).alias("order"))
        .select("key", m.alias("m"), F.explode(F.slice("order", F.lit(1), m - _needed(m, share) + 1)).alias("o"))
        .where("o.n > 0").select("key", "m", "o.hash", "o.at"))
    return chosen.join(records.select("key", "words"), "key")


def find_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 3,
                  share: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: ``id, n_words, spans, items``.

    ``spans`` are the word stretches (``start``, ``end`` exclusive; apart, in order) covered by
    places where a window of an item stands, ``items`` the ids of the items with such windows,
    as strings in code-point order. A-Z are lower-cased; words are runs of digits, letters and
    characters beyond ASCII.

    Null and empty texts have no words, so no spans; items without words have no windows. Null
    document ids are kept, rows that repeat an id are judged each on its own; rows that share an
    item id are one item, null item ids one named by an empty string. No documents give no rows;
    no items give rows without spans. Other columns are not read, so their names cannot clash.
    Texts of any length are taken whole."""
    if window < 1 or shingle < 1 or not 0 < share <= 1:
        raise ValueError("window and shingle are 1 or more, share is in (0, 1]")
    spark = docs.sparkSession
    scratch = Scratch(spark, "passages")
    windows = scratch.save(item_windows(items, item_id, item_text, window, shingle).withColumn(
        "key", F.unhex(F.sha2(F.array_join("words", " "), 256))), "windows")
    widths = [r[0] for r in windows.select(F.size("words")).distinct().collect()]       # at most ``window`` values
    sizes = sorted({min(shingle, w) for w in widths})
    own = spark.sparkContext.broadcast(bit_map(windows.select(F.explode("shingles").alias("hash")), "hash"))
    counts = scratch.save(shingle_counts(docs, text_col, own, sizes), "counts")
    records = scratch.save(prefix_records(windows, counts, share), "records")
    rarest = spark.sparkContext.broadcast(bit_map(records, "hash"))
    rows = scratch.save(candidates(docs, doc_id, text_col, rarest, sizes, window).withColumn(
        "row", F.monotonically_increasing_id()), "rows")

    found = rows.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    r = records.select("hash", "key", "m", F.col("words").alias("wanted"), F.col("at").alias("ahead"))
    width, start = F.size("wanted"), F.col("at") - F.col("ahead")
    first = F.col("before") - F.col("ahead")                                             # of the window, in ``words``
    there = F.slice("words", first + 1, width)
    if share == 1:
        stands = there == F.col("wanted")
    else:
        size = width - F.col("m") + 1
        stands = F.size(F.filter(F.sequence(F.lit(1), F.col("m")), lambda i: F.slice(there, i, size) == F.slice(
            F.col("wanted"), i, size))) >= _needed(F.col("m"), share)
    matches = scratch.save(found.join(r, "hash").where((start >= 0) & (start + width <= F.col("n_words"))).where(stands)
                           .select("row", start.alias("start"), (start + width).alias("end"), "key").distinct(), "matches")

    spans = _merged(matches)
    named = (matches.select("row", "key").distinct().join(windows.select("key", "item").distinct(), "key")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (rows.select("row", "id", "n_words").join(spans, "row", "left").join(named, "row", "left")
            .select("id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _merged(matches: DataFrame) -> DataFrame:
    """``row, spans``: the union of each row's stretches. A stretch begins a new span where it
    begins past the greatest end before it."""
    by = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = (before.isNull() | (F.col("start") > before)).cast("int")
    return (matches.select("row", "start", "end").distinct().withColumn("new", new)
            .withColumn("span", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
