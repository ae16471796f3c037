"""MinHash near-duplicates by an LSH forest (dealt operator 10).

1. One pass over the texts gives each document its distinct shingles' count, a 128-bit
   fingerprint of the set and a pool of 96 min-hash values, of which 16 bits are kept (two
   values are equal by chance once in 65,536; a key has at least three). Documents with
   equal sets form one class, so a group of any number of copies goes on as one row.
2. A forest holds several orders; an order is a seeded permutation of the pool, and its key
   the values in that order. The keys of all orders are range partitioned and sorted, so a
   hot prefix is spread over as many partitions as its rows need.
3. Candidates are neighbours by longest common prefix. A region (rows that share a prefix)
   of at most ``cap`` rows gives its rows as candidates of each other; a larger region is
   cut at the next value, and so on (the depth adapts to each region); what is large at
   full depth gives sorted neighbours. Output is linear in the rows.
4. Candidates are confirmed on the full sets of the whole texts, the nearest of each
   document first; components of the confirmed links follow, and then the candidates that
   still join two components are confirmed as well. The candidates' texts are shuffled once,
   into a table in buckets by id; every confirmation reads it without another exchange.
5. Large regions: a region whose rows ended in more than one component is
   not finished. Its rows go to the next level, a forest with more orders of greater least
   depth, whose neighbours are candidates only across components. A level misses a pair at
   the threshold with a chance of about ``(1 - t**depth) ** orders`` (1e-5 and 1e-6), if its
   rows lie in a region that gets small.
6. What is large after the last level and holds several components is finished exactly, by a
   prefix-filter join on the full sets (``exact_pairs``): no pair of such rows is missed.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components
from .texthash import mix, shingle_hashes, text_chunks

POOL = 96
#: (orders, least depth, key length) of each level
LEVELS = ((16, 3, 8), (64, 6, 12))
CAP = 16
#: Bits of the map of hashed ids (4 MB) that keeps other texts out of the texts' exchange.
BITS = 1 << 25
#: Bits of the hash that count shingles for their order in the exact join (one byte for each).
RANK_BITS = 21
#: Rows of one shingle that one salt of the exact join takes.
SALT_ROWS = 4096
WIRE = np.dtype(">u2")  # big-endian, so that bytes sort as values
_SIG = "id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, sig binary"


@lru_cache(1)
def _multipliers(seed: int = 7):
    g = np.random.Generator(np.random.PCG64(seed))
    a = g.integers(1, 2**63, POOL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, g.integers(1, 2**63, POOL, dtype=np.uint64)


def pool_values(sets: list[np.ndarray]) -> np.ndarray:
    """rows x POOL min-hash values; rows without shingles give zeros. Kept are 16 bits from
    the middle: a minimum's first bits are zeros in large sets."""
    out = np.zeros((len(sets), POOL), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    begin = np.cumsum([0] + [len(sets[i]) for i in full])[:-1]
    a, b = _multipliers()
    for k in range(POOL):
        h = flat * a[k]
        h += b[k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out[full, k] = (np.minimum.reduceat(h, begin) >> np.uint64(16)).astype(np.uint16)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id, n_shingles, fp1, fp2, sig`` of every row (whole texts)."""

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column(1)):
                sets = shingle_hashes(raw, off, words)
                sigs = pool_values(sets)
                n = np.array([len(s) for s in sets], np.int64)
                fp1 = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64)
                fp2 = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(n),
                     pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)),
                     pa.array([s.astype(WIRE).tobytes() for s in sigs], pa.binary())],
                    ["id", "n_shingles", "fp1", "fp2", "sig"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, _SIG)


def order_permutations(level: int, orders: int, length: int) -> np.ndarray:
    """Positions of the pool that make up each order's key. Orders take the pool in turn,
    so short prefixes of different orders share few values."""
    g = np.random.Generator(np.random.PCG64([level, 31]))
    deck = np.concatenate([g.permutation(POOL) for _ in range(orders * length // POOL + 2)])
    out, at = [], 0
    for _ in range(orders):
        row: list[int] = []
        while len(row) < length:
            if deck[at] not in row:
                row.append(int(deck[at]))
            at += 1
            if at == len(deck):
                deck, at = np.concatenate([g.permutation(POOL) for _ in range(8)]), 0
        out.append(row)
    return np.array(out)


def forest_rows(classes: DataFrame, level: int) -> DataFrame:
    """``ord, key, id, comp``: one row per class and order."""
    orders, _, length = LEVELS[level]
    perm = order_permutations(level, orders, length)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(part.column(2).to_pylist()), WIRE).reshape(len(ids), POOL)
                for o in range(orders):
                    keys = np.ascontiguousarray(sig[:, perm[o]])
                    raw = keys.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), o, np.int16)),
                         pa.Array.from_buffers(pa.binary(), len(ids), [
                             None, pa.py_buffer(np.arange(0, len(raw) + 1, WIRE.itemsize * length, dtype=np.int32)),
                             pa.py_buffer(raw)]),
                         pa.array(ids, pa.int64()), part.column(1)], ["ord", "key", "id", "comp"])

    return classes.select("id", "component", "sig").mapInArrow(run, "ord smallint, key binary, id bigint, comp bigint")


def _runs(cut: np.ndarray):
    """Run number of each row and run lengths, from the flags that cut a row from the last."""
    run = np.concatenate([[0], np.cumsum(cut)])
    return run, np.bincount(run)[run]


def lcp_neighbours(order: np.ndarray, keys: np.ndarray, depth: int, cap: int):
    """Candidates among sorted rows: (i, j, lcp) row numbers, and the rows of regions over ``cap``."""
    n, length = keys.shape
    if n < 2:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    same = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(1)
    lcp = np.where(order[1:] == order[:-1], same, 0)
    run, size = _runs(lcp < depth)
    large = np.flatnonzero(size > cap)
    found, open_rows, region = [], np.ones(n, bool), run
    for d in range(depth, length + 1):
        run, size = _runs(lcp < d)
        small = open_rows & (size <= cap) & (size > 1)
        for step in range(1, cap):
            i = np.flatnonzero(small[:n - step] & (run[:n - step] == run[step:]))
            if not len(i):
                break
            found.append(np.stack([i, i + step, np.full(len(i), d)], 1))
        open_rows &= size > cap
    wide = np.zeros(n, bool)
    wide[large] = True
    for step in (1, 2):
        i = np.flatnonzero(wide[:n - step] & (region[:n - step] == region[step:]))
        low = np.minimum(lcp[i], lcp[np.minimum(i + step - 1, n - 2)])
        found.append(np.stack([i, i + step, low], 1))
    return (np.concatenate(found) if found else np.zeros((0, 3), np.int64)), large


def _neighbour_frame(order, keys, ids, comps, depth, cap, edge: int):
    """Rows (kind, a, b, ord, key, lcp): 0 a candidate pair of two components, 1 a row near a
    partition's end (b: its component), 2 a row of a large region with the region's prefix."""
    pairs, large = lcp_neighbours(order, keys, depth, cap)
    pairs = pairs[comps[pairs[:, 0]] != comps[pairs[:, 1]]]
    a, b = ids[pairs[:, 0]], ids[pairs[:, 1]]
    frames = [pd.DataFrame({"kind": 0, "a": np.minimum(a, b), "b": np.maximum(a, b),
                            "ord": 0, "key": None, "lcp": pairs[:, 2]})]
    if edge:
        ends = np.unique(np.concatenate([np.arange(min(edge, len(ids))),
                                         np.arange(max(0, len(ids) - edge), len(ids))]))
        frames.append(pd.DataFrame({"kind": 1, "a": ids[ends], "b": comps[ends], "ord": order[ends].astype(np.int64),
                                    "key": [keys[i].tobytes() for i in ends], "lcp": 0}))
    frames.append(pd.DataFrame({"kind": 2, "a": ids[large], "b": 0, "ord": order[large].astype(np.int64),
                                "key": [keys[i, :depth].tobytes() for i in large], "lcp": 0}))
    return pd.concat([f for f in frames if len(f)] or [frames[0]])


_NEIGHBOUR = "kind int, a bigint, b bigint, ord int, key binary, lcp int"


def candidates(classes: DataFrame, level: int, scratch: Scratch) -> DataFrame:
    """``kind, a, b, ord, key, lcp`` from the sorted orders of one level."""
    _, depth, length = LEVELS[level]

    def decode(key_list, n):
        return np.frombuffer(b"".join(key_list), WIRE).reshape(n, length)

    def sorted_rows(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        ids = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p in parts])
        order = np.concatenate([p.column(0).to_numpy(zero_copy_only=False) for p in parts])
        keys = decode([k for p in parts for k in p.column(1).to_pylist()], len(ids))
        comps = np.concatenate([p.column(3).to_numpy(zero_copy_only=False) for p in parts])
        out = _neighbour_frame(order, keys, ids, comps, depth, CAP, CAP)
        yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

    def across(key, pdf):
        pdf = pdf.sort_values(["key", "a"], kind="stable")
        ids = pdf["a"].to_numpy()
        return _neighbour_frame(np.full(len(ids), key[0], np.int16), decode(pdf["key"].tolist(), len(ids)),
                                ids, pdf["b"].to_numpy(), depth, CAP, 0)

    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                        ("ord", pa.int32()), ("key", pa.binary()), ("lcp", pa.int32())])
    rows = scratch.save(forest_rows(classes, level).repartitionByRange("ord", "key", "id")
                        .sortWithinPartitions("ord", "key", "id")
                        .mapInArrow(sorted_rows, _NEIGHBOUR), f"neighbours{level}")
    # rows near partition ends: a few per partition, by order. Of a region that is large only
    # across partitions all rows are here, as a part of more than CAP rows is large by itself
    ends = rows.where("kind = 1").groupBy("ord").applyInPandas(across, _NEIGHBOUR)
    return rows.where("kind <> 1").unionByName(ends)


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) with ``100 * intersection >= percent * union`` on the full sets."""

    def run(batches):
        for batch in batches:
            left, right = [], []
            for side, col in ((left, 2), (right, 3)):
                for _, _, raw, off in text_chunks(batch.column(col)):
                    side.extend(shingle_hashes(raw, off, words))
            keep = []
            for x, y in zip(left, right, strict=True):
                both = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ta = texts.select(F.col("id").alias("a"), F.col("body").alias("ta"))
    tb = texts.select(F.col("id").alias("b"), F.col("body").alias("tb"))
    return (pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
            .mapInArrow(run, "a bigint, b bigint"))


def _set_rows(todo: DataFrame, texts: DataFrame, words: int, make, schema: str) -> DataFrame:
    """Rows that ``make`` yields as record batches from an iterator over (id, component, set)."""

    def run(batches):
        def sets():
            for batch in batches:
                ids, comps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for i, _, raw, off in text_chunks(batch.column(2)):
                    for k, found in enumerate(shingle_hashes(raw, off, words), i):
                        yield ids[k], comps[k], found
        yield from make(sets())

    return todo.select("id", "component").join(texts, "id").select("id", "component", "body").mapInArrow(run, schema)


def exact_pairs(todo: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """``a, b``: every pair of ``todo`` (id, component) across components that can be a link.

    A set's shingles are sorted rarest first (by any order that is the same for all sets: the
    magnitude of a hashed count, then the hash). Sets x and y, y not the larger, that share
    ``100 * |x & y| >= percent * |x | y|`` have their first common shingle among the first
    ``|x| - percent|x|/100 + 1`` of x and ``|y| - 2 percent|y|/(100 + percent) + 1`` of y, with
    enough left behind it in both. So a passage that all rows share is not joined on unless it
    is most of a row. A shingle that is in the shorter prefix of no row links nothing and goes; of
    the others, the rows that have it there meet all its rows, but those of its largest component
    the other components' only. Each of a shingle's tasks takes about ``SALT_ROWS`` of its rows."""
    def count(sets):
        total = np.zeros(1 << RANK_BITS, np.int64)
        for _, _, s in sets:
            slot, n = np.unique(s >> np.uint64(64 - RANK_BITS), return_counts=True)
            total[slot] += n
        used = np.flatnonzero(total)
        for at in range(0, len(used), 1 << 16):
            part = used[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["slot", "n"])

    # at most 1 << RANK_BITS rows, whatever the input's size
    counts = (_set_rows(todo, texts, words, count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
              .where("n > 1").select("slot", F.length(F.bin("n")).cast("smallint").alias("rank")).toArrow())
    rank = np.zeros(1 << RANK_BITS, np.uint8)
    rank[counts.column("slot").to_numpy()] = counts.column("rank").to_numpy()

    def prefixes(sets):
        kept, n_kept = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*kept, strict=True)],
                                              ["shingle", "at", "n", "id", "comp", "small"])
        for i, comp, s in sets:
            n = len(s)
            probe = n + percent * n // -100 + 1
            index = n + 2 * percent * n // -(100 + percent) + 1
            first = s[np.lexsort((s, rank[s >> np.uint64(64 - RANK_BITS)]))][:probe]
            at = np.arange(len(first), dtype=np.int32)
            kept.append((first.view(np.int64), at, np.full(len(at), n, np.int32), np.full(len(at), i, np.int64),
                         np.full(len(at), comp, np.int64), at < index))
            n_kept += len(at)
            if n_kept > 1 << 16:
                yield batch()
                kept, n_kept = [], 0
        if kept:
            yield batch()

    rows = scratch.save(_set_rows(todo, texts, words, prefixes,
                                  "shingle bigint, at int, n int, id bigint, comp bigint, small boolean"), "prefixes")
    kinds = (rows.groupBy("shingle", "comp").agg(F.count("*").alias("c"), F.max("small").alias("any"))
             .groupBy("shingle").agg(F.max(F.struct("c", "comp"))["comp"].alias("main"), F.sum("c").alias("rows"),
                                     F.count("*").alias("comps"), F.max("any").alias("any")))
    shared = scratch.save(kinds.where("comps > 1 and any").select(
        "shingle", "main", F.ceil(F.col("rows") / SALT_ROWS).cast("int").alias("salts")), "shared")
    live = scratch.save(rows.join(shared, "shingle").withColumn("main", F.col("comp") == F.col("main")), "live")
    # lane 0: small rows of other components meet all rows; lane 1: those of the main one meet the others.
    # The rows of a shingle are dealt to its salts, its small rows go to each
    x = (live.where("small").withColumn("lane", F.when(F.col("main"), 1).otherwise(0))
         .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("x"))
    y = (live.withColumn("lane", F.explode(F.when(F.col("main"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
         .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).alias("y"))
    return (x.join(y, F.expr(f"""x.shingle = y.shingle and x.lane = y.lane and x.salt = y.salt and x.comp <> y.comp
                and (x.n < y.n or (x.n = y.n and x.id < y.id))
                and {100 + percent} * cast(least(x.n - x.at, y.n - y.at) as bigint) >= {percent} * (cast(x.n as bigint) + y.n)"""))
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``.

    Texts with 100 * |intersection| >= percent * |union| of their distinct ``words``-word
    shingles (A-Z lower-cased) are linked; component_id is the smallest id reachable.
    Null or word-less texts have 0 shingles and link with nothing; fewer words than
    ``words`` make one shingle. Rows with a null id get a null component and kept = true.
    Repeated rows give repeated results; of rows that repeat an id with other texts, one text of
    that id is compared. Texts of any length are taken whole. Empty input gives no rows. Only the id and text
    columns are read, so other columns' names never matter."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lshforest")
    rows = scratch.save(signatures(docs, id_col, text_col, words), "signatures")
    keys = ["n_shingles", "fp1", "fp2"]
    classes = scratch.save(
        rows.where("n_shingles > 0 and id is not null").groupBy(*keys)
        .agg(F.min("id").alias("id"), F.first("sig").alias("sig")), "classes")

    found = candidates(classes.withColumn("component", F.col("id")), 0, scratch)
    pairs = scratch.save(found.where("kind = 0").groupBy("a", "b").agg(F.max("lcp").alias("lcp")), "pairs")
    # whole texts of the documents in any candidate, one row per class
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("body"))
    texts, name = _in_buckets(source, wanted, scratch)
    try:
        best = (pairs.select(F.explode(F.array(F.struct(F.col("a").alias("n"), "lcp", "a", "b"),
                                               F.struct(F.col("b").alias("n"), "lcp", "a", "b"))).alias("s"))
                .groupBy("s.n").agg(F.max(F.struct("s.lcp", "s.a", "s.b")).alias("m"))
                .select("m.a", "m.b").distinct())
        links = scratch.save(confirm(best, texts, words, percent), "links")
        comps = connected_components(links, "a", "b", scratch)
        rest = confirm(_between(pairs, comps), texts, words, percent)
        links = scratch.save(links.unionByName(rest), "links")
        comps = connected_components(links, "a", "b", scratch)
        for level in range(1, len(LEVELS) + 1):
            todo = _unfinished(found, classes, comps, scratch)
            if todo.isEmpty():
                break
            # its rows were wide before, so they have neighbours and are among the texts
            if level < len(LEVELS):
                found = candidates(todo, level, scratch)
                pairs = found.where("kind = 0").select("a", "b").distinct()
            else:
                pairs = scratch.save(exact_pairs(todo, texts, words, percent, scratch), "pairs")
            links = scratch.save(links.unionByName(confirm(pairs, texts, words, percent)), "links")
            comps = connected_components(links, "a", "b", scratch)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry alone: its files are scratch like the others

    named = scratch.save(
        classes.select(*keys, "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
        .select(*keys, F.coalesce("component", "id").alias("component_id")), "named")
    out = (rows.select("id", *keys)
           .join(named, keys, "left")
           .select("id", "n_shingles",
                   F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))
    return out.select("id", "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _in_buckets(source: DataFrame, wanted: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """The rows of ``source`` with an id of ``wanted`` (and few others), one for each id, as a table
    in buckets by id, and the table's name. A bit map of the hashed ids (``BITS``, so a proven bound)
    is broadcast, so other texts stay where they are; the one exchange deals to the buckets, so each
    is one file. Ids that share a bit with a wanted one go along, and no join finds them."""
    spark = source.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"lsh_texts_{uuid.uuid4().hex}"
    bit = F.pmod(F.xxhash64("id"), F.lit(BITS))
    slot, place = F.shiftright(bit, 15).alias("slot"), bit.bitwiseAND(F.lit(32767))
    maps = scratch.save(wanted.select(slot, place.alias("place")).repartition("slot")
                        .groupBy("slot").agg(F.bitmap_construct_agg("place").alias("bits")), "bits")
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = (source.where("id is not null").select("id", "body", slot, place.alias("place"))
            .join(F.broadcast(maps), "slot").where(F.getbit(byte, (F.col("place") % 8).cast("int")) == 1)
            .select("id", "body").repartition(buckets, "id").dropDuplicates(["id"]))
    rows.write.bucketBy(buckets, "id").option("path", scratch.path("texts")).saveAsTable(name, format="parquet")
    return spark.table(name), name


def _unfinished(found: DataFrame, classes: DataFrame, comps: DataFrame, scratch: Scratch) -> DataFrame:
    """The classes (with their components) in large regions that hold several components."""
    wide = found.where("kind = 2").select("ord", "key", F.col("a").alias("id")).distinct()
    named = scratch.save(
        wide.join(comps.withColumnRenamed("node", "id"), "id", "left")
        .select("ord", "key", "id", F.coalesce("component", "id").alias("component")), "wide")
    mixed = scratch.save(named.groupBy("ord", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                         .where("lo <> hi").select("ord", "key"), "mixed")
    ids = scratch.save(named.join(mixed, ["ord", "key"], "left_semi").select("id", "component").distinct(), "todo")
    return scratch.save(classes.join(ids, "id"), "todo")


def _between(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    ca = comps.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = comps.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(ca, "a", "left").join(cb, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", "lcp"))
