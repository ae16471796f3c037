"""Embedding near-duplicates by a subspace join (dealt operator 5).

Unit vectors with cosine >= c lie within squared distance 2(1 - c), the budget. After a seeded
rotation the first 3/8 of the dimensions are the subspace: distances there are never larger than
those of the whole vectors, so a pair over the budget there does not link, and joining the
subspace by range loses no pair. (Blocks with a share of the budget each lose none either, but
then each vector has to travel once a block and once a cell that its ball touches.)

The vectors of a label and dimension are dealt to chunks of bounded size. Chunks stand in a circle:
the task of a chunk holds it and streams the chunks up to half the circle ahead past it, so each two
chunks meet once. A round takes the next distance on the circle, two copies of the vectors at most,
and its shuffle files go with it: disk stays a multiple of the input, whatever the size of a label.
In a task the vectors lie in cells (median splits of the subspace); two cells whose boxes are over the
budget apart are skipped, of the others the pairs within budget in the subspace are found by a
product of matrices in single precision with a margin over its rounding, and verified exactly by the
cosine of the whole vectors in double precision. Tasks return each vector's count of links and a
spanning forest of them, never the pairs, so a cluster of near copies stays linear in the output.
Equal vectors are one class with a count before any of this.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, brief_shuffles
from .components import connected_components

#: Vectors of a chunk from which a label is dealt to several tasks, and to how many for that alone.
CHUNK = 8192
SPREAD = 4
#: Bytes of a chunk's vectors, which a task holds (about).
CHUNK_BYTES = 48 << 20
#: Vectors of a cell at most.
CELL = 512
#: Pairs that are verified together (about).
PAIRS = 1 << 16
SLACK = 1e-9


@lru_cache(8)
def rotation(dim: int) -> np.ndarray:
    g = np.random.Generator(np.random.PCG64([dim, 93]))
    q, r = np.linalg.qr(g.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def subspace(dim: int) -> int:
    return dim if dim <= 16 else -(-3 * dim // 8)


def rounding(dim: int) -> float:
    """More than a sum of ``dim`` products of parts of unit vectors can be off in single precision."""
    return 1e-6 * (dim + 8)


def matrix(col, dim: int) -> np.ndarray:
    """Rows of a column of vectors of one length, as they are (single) or in double precision."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim) if flat.dtype == np.float32 else flat.reshape(-1, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cells(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows and the bounds of cells of at most ``CELL`` of them in it, by median
    splits of the widest coordinate."""
    done, todo = [], [np.arange(len(y))]
    while todo:
        rows = todo.pop()
        if len(rows) <= CELL:
            done.append(rows)
            continue
        own = y[rows]
        half = np.argpartition(own[:, np.argmax(own.max(0) - own.min(0))], len(rows) // 2)
        todo += [rows[half[len(rows) // 2:]], rows[half[:len(rows) // 2]]]
    return np.concatenate(done), np.cumsum([0] + [len(d) for d in done])


class Side:
    """Vectors in cells: ids, counts, vectors as they came, coordinates in the subspace with minus
    half their squared length and 1, bounds and boxes of the cells."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, x: np.ndarray):
        dim = x.shape[1]
        y = np.empty((len(x), subspace(dim)), np.float32)
        for at in range(0, len(x), 1 << 13):  # in double precision a block at a time
            y[at:at + (1 << 13)] = unit(x[at:at + (1 << 13)]) @ rotation(dim)[:, :y.shape[1]]
        order, self.bounds = cells(y)
        self.ids, self.n, self.x = ids[order], n[order], x[order]
        half = np.einsum("ij,ij->i", y, y, dtype=np.float64)[:, None] / -2
        self.left = np.concatenate([y, half, np.ones_like(half)], 1, dtype=np.float32)[order]
        begin = self.bounds[:-1]
        self.low, self.high = (f.reduceat(self.left[:, :-2], begin) for f in (np.minimum, np.maximum))

    def right(self, begin: int, end: int) -> np.ndarray:
        """Columns whose products with rows of ``left`` are minus half the squared distance."""
        own = self.left[begin:end].T.copy()
        own[[-2, -1]] = own[[-1, -2]]
        return own


def close_cells(a: Side, b: Side, k: int, budget: float) -> np.ndarray:
    """Cells of ``a`` whose boxes are within budget of that of cell ``k`` of ``b``."""
    gap = np.maximum(np.maximum(a.low - b.high[k], b.low[k] - a.high), 0)
    return np.flatnonzero((gap * gap).sum(1) <= budget + rounding(gap.shape[1]))


def match(a: Side, b: Side, min_cos: float, budget: float):
    """Row numbers (in ``a``, in ``b``) of the verified pairs of different ids, some at a time; each
    pair of rows once if ``a`` is ``b``."""
    dim = a.x.shape[1]
    limit, whole = -budget / 2 - rounding(a.left.shape[1]), rounding(dim)
    room = np.empty(CELL * CELL, np.float32)
    waiting, count = [], 0

    def verified():
        i, j = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
        step = max(1, (4 << 20) // (8 * dim))
        good = np.zeros(len(i), bool)
        for at in range(0, len(i), step):
            good[at:at + step] = (unit(a.x[i[at:at + step]]) * unit(b.x[j[at:at + step]])).sum(1) >= min_cos
        return i[good], j[good]

    for q in range(len(b.bounds) - 1):
        r, s = b.bounds[q], b.bounds[q + 1]
        column, own = b.right(r, s), None
        for p in close_cells(a, b, q, budget):
            if a is b and p > q:
                break
            t, u = a.bounds[p], a.bounds[p + 1]
            near = room[:(u - t) * (s - r)].reshape(u - t, s - r)
            np.matmul(a.left[t:u], column, out=near)
            hits = np.flatnonzero(near.reshape(-1) >= limit)
            if not len(hits):
                continue
            sure = None
            if len(hits) > near.size >> 6:  # the subspace tells little: whole vectors, those close to the limit exactly
                own = unit(b.x[r:s]).astype(np.float32) if own is None else own
                np.matmul(unit(a.x[t:u]).astype(np.float32), own.T, out=near)
                hits = np.flatnonzero(near.reshape(-1) >= min_cos - whole)
                sure = near.reshape(-1)[hits] >= min_cos + whole
            i, j = np.divmod(hits, s - r)
            i, j = i + t, j + r
            keep = a.ids[i] != b.ids[j]
            if p == q and a is b:
                keep &= i < j
            if sure is not None:
                yield i[keep & sure], j[keep & sure]
                keep &= ~sure
            waiting.append((i[keep], j[keep]))
            count += len(waiting[-1][0])
            if count >= PAIRS:
                yield verified()
                waiting, count = [], 0
    if count:
        yield verified()


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Adds the edges a-b to a flat forest (``root[root] == root``, roots are the smallest nodes)."""
    ra, rb = root[a], root[b]
    new = ra != rb
    if new.any():
        nodes, inverse = np.unique(np.concatenate([ra[new], rb[new]]), return_inverse=True)
        half = len(inverse) // 2
        root[nodes] = nodes[local_roots(len(nodes), inverse[:half], inverse[half:])]
        root[:] = root[root]


class Links:
    """Counts of links and a spanning forest of a chunk and, meanwhile, of vectors that pass it."""

    def __init__(self, chunk: Side):
        self.chunk, self.count, self.root = chunk, np.zeros(len(chunk.ids), np.int64), np.arange(len(chunk.ids))

    def inside(self, min_cos: float, budget: float) -> None:
        if len(self.root) == 1:
            return
        for i, j in match(self.chunk, self.chunk, min_cos, budget):
            np.add.at(self.count, i, self.chunk.n[j])
            np.add.at(self.count, j, self.chunk.n[i])
            unite(self.root, i, j)

    def passing(self, other: Side, min_cos: float, budget: float) -> pa.RecordBatch:
        m = len(self.root)
        count, root = np.zeros(len(other.ids), np.int64), np.concatenate([self.root, np.arange(m, m + len(other.ids))])
        for i, j in match(self.chunk, other, min_cos, budget):
            np.add.at(self.count, i, other.n[j])
            np.add.at(count, j, self.chunk.n[i])
            unite(root, i, j + m)
        self.root = root[:m]
        # a vector that links with the chunk has its root there
        return self.out(other.ids, count, root[m:])

    def out(self, ids: np.ndarray, count: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        rows = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(ids[rows], pa.int64()), pa.array(count[rows], pa.int64()),
                                           pa.array(self.chunk.ids[root[rows]], pa.int64())], ["id", "links", "root"])


def meeting(first: bool, min_cos: float, budget: float):
    """What a task of a round does: rows ``dim, step, id, n, vec`` of a chunk (step 0) and then of the
    chunk that passes it, to ``id, links, root``. In the first round the chunk meets itself, too."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, links, last = [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            step, dim = batch["step"].to_numpy(), batch["dim"][0].as_py()
            if step[0] < last or (step[1:] < step[:-1]).any():
                raise ValueError("a chunk's rows have to come before those that pass it")
            last, mine = step[-1], int(np.searchsorted(step, 0, side="right"))
            part = batch["id"].to_numpy(), batch["n"].to_numpy(), matrix(batch["vec"], dim)
            if mine:
                held.append([np.array(v[:mine]) for v in part])
            if mine < len(step):
                if links is None and held:
                    links = start(held)
                if links:
                    yield links.passing(Side(*(v[mine:] for v in part)), min_cos, budget)
        if links is None and held:
            links = start(held)
        if links:
            yield links.out(links.chunk.ids, links.count, links.root)

    def start(held: list) -> Links:
        parts = [np.concatenate(v) for v in zip(*held)]
        held.clear()
        links = Links(Side(*parts))
        if first:
            links.inside(min_cos, budget)
        return links

    return meet


def deal(classes: DataFrame, chunks: DataFrame, distance: int) -> DataFrame:
    """Rows of a round: ``label, dim, task, step, id, n, vec``; step 0 is the task's own chunk, 1 the one
    ``distance`` ahead on the circle. ``chunks``: the number ``k`` of those of more than one."""
    # at half the circle each two chunks would meet twice: the lower number's task takes it
    met = F.lit(2 * distance) < F.col("k")
    halfway = F.lit(2 * distance) == F.col("k")
    own = F.lit(True) if distance == 1 else met | (halfway & (F.col("c") < distance))
    other = met | (halfway & (F.col("c") >= distance))
    copies = F.array(F.when(own, F.struct(F.col("c").alias("task"), F.lit(0).alias("step"))),
                     F.when(other, F.struct(F.pmod(F.col("c") - distance, F.col("k")).cast("int").alias("task"), F.lit(1).alias("step"))))
    return (classes.join(F.broadcast(chunks), ["label", "dim"], "left" if distance == 1 else "inner")
            .withColumn("k", F.coalesce("k", F.lit(1)))
            .withColumn("c", F.pmod(F.xxhash64("id", "vec"), F.col("k")).cast("int"))
            .select("label", "dim", "id", "n", "vec", F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("to"))
            .select("label", "dim", "to.task", "to.step", "id", "n", "vec"))


def link_vectors(vectors: DataFrame, min_cos: float = 0.93, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row.

    Vectors link when their labels are equal and not null and the cosine in double precision is
    at least ``min_cos``. Vectors that are null, empty, zero or hold null or non-finite parts, and
    rows with a null label, link with nothing; vectors of different lengths never link. Equal
    vectors link with each other; rows that repeat an id count as rows. A null id is never
    linked and has a null component. An empty table gives no rows; other columns are not read."""
    scratch = Scratch(vectors.sparkSession, "subspace")
    budget = 2 * (1 - min_cos) + SLACK
    vec = F.col(vector_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    usable = F.coalesce(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & finite, F.lit(False))
    with brief_shuffles(vectors.sparkSession):
        rows = scratch.save(vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                                           F.when(usable, vec).alias("vec")), "vectors")
        valid = rows.where("vec is not null")
        classes = scratch.save(valid.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
                               .withColumn("dim", F.size("vec")), "classes")
        # each row's class, by two hashes of its vector (0.0 and -0.0 are equal): the vectors stay where they are
        part = rows.schema["vec"].dataType.elementType
        plain = F.transform("vec", lambda x: x + F.lit(0).cast(part))
        hashes = [F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(seed), plain)).alias(f"h{seed}") for seed in (1, 2)]
        members = scratch.save(
            rows.select("vec_id", "label", *hashes).join(classes.select("label", *hashes, "id", "n"), ["label", "h1", "h2"], "left")
            .select("vec_id", "id", "n"), "members")
        scratch.drop(rows)

        width = 4 if part.simpleString() == "float" else 8
        most = F.col("m") * F.col("dim") * width / CHUNK_BYTES
        chunks = scratch.save(
            classes.groupBy("label", "dim").agg(F.count("*").alias("m"))
            .select("label", "dim", F.greatest(F.least(F.ceil(F.col("m") / CHUNK), F.lit(SPREAD)), F.ceil(most)).cast("int").alias("k"))
            .where("k > 1"), "chunks")  # a row for CHUNK vectors at most
        widest = chunks.agg(F.max("k")).first()[0] or 1
        found = []
        for distance in range(1, max(1, widest // 2) + 1):
            key = ["label", "dim", "task"]
            dealt = deal(classes, chunks, distance).repartition(*key).sortWithinPartitions(*key, "step")
            found.append(scratch.save(dealt.groupBy(*key).applyInArrow(
                meeting(distance == 1, min_cos, budget), "id bigint, links bigint, root bigint"), "links"))
        scratch.drop(classes)
        links = found[0]
        for more in found[1:]:
            links = links.union(more)
        components = connected_components(links.select("id", "root").distinct(), "id", "root", scratch)
        counts = links.groupBy("id").agg(F.sum("links").alias("links"))
        nodes = scratch.save(counts.join(components.withColumnRenamed("node", "id"), "id"), "nodes")
    out = members.join(nodes, "id", "left").select(
        "vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("n") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
