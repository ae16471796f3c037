"""Trie of conversation prefixes, rolled up by centroid decomposition (dealt operator 12).

A node is a distinct sequence of first turns, named by the running SHA-256 digest of its turns
(128 bits of it); every conversation is a member of the nodes on its path. Texts are reduced to
digests and lengths first; only those are shuffled.

Sums over subtrees come from a centroid decomposition of the parent-edge forest, without a
round for each depth. Each component has a centroid whose removal leaves parts of at most half
its nodes. The total of the centroid's subtree inside the component is taken by one aggregate
and added to the nodes on the path from the centroid to the component's top; then the parts go
on as components. A node is a centroid once, so its sum is complete after at most log2(n)
rounds, for a chain of any length as for a root with any number of children.

Components of more than ``limit`` nodes are split in rounds of joins: the path of a centroid and
the branch that a node hangs on are looked up in the member table (the path of a conversation
that holds the node). The others, bounded by ``limit``, are finished inside tasks by the
same rule. Sizes that guide the split come from the members: a conversation makes the nodes of
its path from some depth on, so it counts for each node above by subtraction.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Nodes of a component that is finished inside a task.
LIMIT = 1024
#: Ids joined into one row before a node's list of ids is hashed.
IDS_PER_ROW = 4096
_ROOT = hashlib.sha256(b"").digest()[:16]


def turn_digests(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, idx, digest, n_bytes`` of every turn, numbered from 0 within its conversation
    (null turns first; ties by role, then text). Null roles and texts are empty; rows without a
    conversation are left out."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    by = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.withColumn("idx", F.row_number().over(by) - 1).select(
        "conv", "idx", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.octet_length("text").cast("bigint").alias("n_bytes"))


def members(rows: DataFrame) -> DataFrame:
    """``conv, depth, node, parent, n_bytes, last`` from ``conv, part, idx, digest, n_bytes``: a
    row with a null digest opens each conversation (part first), its turns follow in order. A
    task streams through its sorted rows, so a long conversation is not held in memory."""
    schema = pa.schema([("conv", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()),
                        ("n_bytes", pa.int64()), ("last", pa.bool_())])

    def chain(batches):
        held, state, node, depth = None, None, None, 0
        for batch in batches:
            out = []
            for conv, digest, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held is not None:
                    out.append((*held, digest is None))
                if digest is None:
                    state, node, depth = hashlib.sha256(), _ROOT, 0
                    held = (conv, 0, node, None, 0)
                else:
                    state.update(digest)
                    depth += 1
                    parent, node = node, state.copy().digest()[:16]
                    held = (conv, depth, node, parent, n)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held is not None:
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip((*held, True), schema)], schema=schema)

    return (rows.repartition("conv").sortWithinPartitions("conv", "part", "idx").select("conv", "digest", "n_bytes")
            .mapInArrow(chain, "conv bigint, depth int, node binary, parent binary, n_bytes bigint, last boolean"))


def subtree_sizes(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, size``: nodes in each subtree. A conversation that is the smallest member of the
    nodes from depth ``k`` to ``d`` of its path adds those at a node's depth or below."""
    made = nodes.groupBy("conv").agg(F.min("depth").alias("k"), F.max("depth").alias("d"))
    below = F.greatest(F.col("d") - F.greatest("depth", "k") + 1, F.lit(0))
    return paths.select("conv", "depth", "node").join(made, "conv").groupBy("node").agg(F.sum(below).cast("bigint").alias("size"))


def centroid_totals(parent: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums over the subtrees of one tree by centroid decomposition. ``parent`` gives the place
    of each node's parent, ahead of the node itself (the first is the top)."""
    n, width = len(parent), len(values[0])
    added, out = [[0] * width for _ in range(n)], [None] * n
    size = [0] * n
    todo = [list(range(n))]
    while todo:
        part = todo.pop()
        top = part[0]
        for v in part:
            size[v] = 1
        for v in reversed(part):
            if v != top:
                size[parent[v]] += size[v]
        centre = next(v for v in reversed(part) if 2 * size[v] >= len(part))
        branch, hang, above, total = {centre: centre}, {}, [], list(values[centre])
        for v in part:
            if v == centre:
                continue
            at = branch.get(parent[v]) if v != top else None
            if at is None:
                above.append(v)
                continue
            at = branch[v] = v if at == centre else at
            hang.setdefault(at, []).append(v)
            for i, x in enumerate(values[v]):
                total[i] += x
        out[centre] = [a + b for a, b in zip(total, added[centre])]
        v = centre
        while v != top:
            v = parent[v]
            added[v] = [a + b for a, b in zip(added[v], total)]
        todo.extend(hang.values())
        if above:
            todo.append(above)
    return out


def _finish(parts: DataFrame, names: list[str]) -> DataFrame:
    """Subtree sums of components of bounded size, several of them streamed through each task."""
    schema = pa.schema([("node", pa.binary()), *((c, pa.int64()) for c in names)])

    def run(batches):
        comp, rows, width = None, [], len(names)

        def done():
            place = {r[0]: i for i, r in enumerate(rows)}
            sums = centroid_totals([place.get(r[1], 0) for r in rows], [r[2:2 + width] for r in rows])
            return [(r[0], *(s + a for s, a in zip(total, r[2 + width:]))) for r, total in zip(rows, sums)]

        for batch in batches:
            out = []
            for c, *row in zip(*(col.to_pylist() for col in batch.columns)):
                if c != comp and rows:
                    out += done()
                    rows = []
                comp = c
                rows.append(row)
            if out:
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
        if rows:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*done()), schema)], schema=schema)

    return (parts.repartition("comp").sortWithinPartitions("comp", "depth", "node")
            .select("comp", "node", "parent", *names, *(f"add_{c}" for c in names))
            .mapInArrow(run, ", ".join(["node binary", *(f"{c} bigint" for c in names)])))


def subtree_sums(nodes: DataFrame, paths: DataFrame, names: list[str], scratch: Scratch, limit: int = LIMIT) -> DataFrame:
    """``node`` and, for each of ``names``, its sum over the node's subtree. ``nodes`` has
    ``node, parent, conv`` (a member), ``depth, size`` and the values; ``paths`` the member rows
    ``conv, depth, node, parent``. Any number of roots (null parent)."""
    add = [f"add_{c}" for c in names]
    keep = ["node", "parent", "conv", "depth", "size", *names, *add, "comp"]
    paths = paths.select("conv", "depth", "node", "parent")
    # every node's first component is the tree of the root of its own path
    tops = paths.where("depth = 0").select("conv", F.col("node").alias("comp"))
    rows = nodes.join(tops, "conv").withColumns({a: F.lit(0).cast("bigint") for a in add}).select(*keep)
    done, small = [], []
    while True:
        rows = scratch.save(rows, "components")
        whole = scratch.save(rows.groupBy("comp").agg(F.max("size").alias("whole"), F.min("depth").alias("top")).where(
            F.col("whole") > limit), "large")
        small.append(rows.join(whole.select("comp"), "comp", "left_anti"))
        if whole.isEmpty():
            break
        large = rows.join(whole, "comp").select(*keep, "whole", "top")
        centre = scratch.save(large.where(2 * F.col("size") >= F.col("whole")).groupBy("comp", "top").agg(
            F.min_by(F.struct("node", "conv", "depth", "size"), "size").alias("c")), "centres").select(
            "comp", "top", F.col("c.node").alias("c_node"), F.col("c.conv").alias("c_conv"),
            F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size"))
        look = paths.select(F.col("conv").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("node").alias("p_node"),
                            F.col("parent").alias("p_parent"))
        at = large.drop("top", "whole").join(centre, "comp")
        at = at.join(look, (F.col("conv") == F.col("p_conv")) & (F.col("p_depth") == F.col("c_depth") + 1)
                     & (F.col("depth") > F.col("c_depth")) & (F.col("p_parent") == F.col("c_node")), "left")
        at = scratch.save(at.select(*keep, "c_node", F.col("p_node").alias("branch")), "branches")
        inside = (F.col("node") == F.col("c_node")) | F.col("branch").isNotNull()
        total = scratch.save(at.where(inside).groupBy("comp").agg(*(F.sum(c).cast("bigint").alias(f"t_{c}") for c in names)), "totals")
        way = (centre.join(look, F.col("c_conv") == F.col("p_conv"))
               .where((F.col("p_depth") >= F.col("top")) & (F.col("p_depth") < F.col("c_depth")))
               .select(F.col("p_node").alias("w_node"), "c_size"))
        new = at.join(total, "comp").join(way, F.col("node") == F.col("w_node"), "left")
        on_way = F.col("c_size").isNotNull()
        new = new.select("node", "parent", "conv", "depth", (F.col("size") - F.coalesce("c_size", F.lit(0))).alias("size"), *names,
                         *((F.col(a) + F.when(on_way | (F.col("node") == F.col("c_node")), F.col(f"t_{c}")).otherwise(0)).alias(a)
                           for a, c in zip(add, names)),
                         F.coalesce("branch", "comp").alias("comp"), (F.col("node") == F.col("c_node")).alias("centre"))
        new = scratch.save(new, "split")
        done.append(new.where("centre").select("node", *(F.col(a).alias(c) for a, c in zip(add, names))))
        rows = new.where("not centre").select(*keep)
    left = small[0]
    for df in small[1:]:
        left = left.unionByName(df)
    out = _finish(left, names)
    for df in done:
        out = out.unionByName(df)
    return out


def id_list_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` from ``node, conv``: SHA-256 of the ids in ascending order, joined by
    commas. Ids are sorted by range over (node, id), so the list of a node that many
    conversations end at is spread; its rows of ``IDS_PER_ROW`` ids are then hashed in order."""
    def pack(batches):
        def row():
            return node, ids[0], ",".join(map(str, ids))
        node, ids = None, []
        for batch in batches:
            out = []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (n != node or len(ids) == IDS_PER_ROW):
                    out.append(row())
                    ids = []
                node = n
                ids.append(c)
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], ["node", "first", "ids"])
        if ids:
            yield pa.record_batch([pa.array([x]) for x in row()], ["node", "first", "ids"])

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], ["node", "ends_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([x]) for x in (node, state.hexdigest())], ["node", "ends_sha256"])

    packed = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(
        pack, "node binary, first bigint, ids string")
    return packed.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(
        digest, "node binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per distinct prefix: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``rows`` are ``conv, part, idx, digest, n_bytes`` (see :func:`members`; the rows of a
    conversation are sorted by part and idx, the first has a null digest). A conversation without turns is a
    member of the root only. No conversations give no rows."""
    scratch = Scratch(rows.sparkSession, "trie")
    paths = scratch.save(members(rows), "members")
    grouped = scratch.save(paths.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("depth").alias("depth"),
        F.max("parent").alias("parent"), F.max("n_bytes").alias("n_bytes")), "nodes")
    children = grouped.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = scratch.save(
        grouped.join(children, "node", "left").join(subtree_sizes(grouped, paths), "node").select(
            "node", "parent", "conv", "depth", "size", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.col("n_children").isNull().cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")), "sized")
    names = ["n_leaves", "saved_tokens"]
    sums = scratch.save(subtree_sums(nodes, paths, names, scratch, limit), "sums")
    ends = id_list_digests(paths.where("last").select("node", "conv"))
    up = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (nodes.drop(*names, "size").join(sums, "node").join(ends, "node", "left").join(up, "parent", "left").select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def whole_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text") -> DataFrame:
    """Rows for :func:`prefix_trie` of conversations as they are. Repeated rows are turns of
    their own; other columns are not read, so their names cannot clash; no rows give no rows."""
    rows = turn_digests(turns, conv_col, turn_col, role_col, text_col)
    return rows.select("conv", F.lit(1).alias("part"), "idx", "digest", "n_bytes").unionByName(_openings(rows))


def _openings(rows: DataFrame) -> DataFrame:
    """The row that opens each conversation."""
    return rows.select("conv").distinct().select("conv", F.lit(0).alias("part"), F.lit(0).alias("idx"),
                                                 F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("n_bytes"))
