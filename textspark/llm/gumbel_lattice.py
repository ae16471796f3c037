"""SentencePiece encoding by Gumbel top-k without replacement, and decoding (dealt operator 1).

All segmentations of a text are the paths of a lattice of pieces. A path has the sum of its
pieces' log weights, and the lattice's sum over paths makes that a probability. The k paths
with the largest Gumbel-perturbed log probabilities are k distinct samples; they are found
top-down: a node (a begun path) stands for all its completions, its perturbed value is the
largest among them, and it falls to one child while the others get Gumbels of their own mass
cut off at the parent's value. So the node with the largest value of the frontier always leads
to the next sample (a perturbed A-star search with an exact bound), and the value of the best
node that is left over gives the inclusion scores 1 - exp(-exp(log p - threshold)).

The search runs in step for all texts of a chunk, in numpy:

- pieces never go past the start of a white-space unit (checked when a model is loaded), so
  the lattice is a chain of units. Equal units of a chunk are built once, and a task keeps those
  that repeat for its later chunks; their suffix sums (the bound) come from one backward pass;
- a sample walks all units at once, one piece a step; where a node's mass is below
  exp(-CUT) its siblings cannot reach the frontier and are left out (checked, and redone in
  full if they could);
- random numbers are hashes of (seed, row key, sample, unit, place), so a row's samples do not
  depend on its neighbours, partition or order.

Weights: a unigram model's scores; a BPE model, whose scores are minus merge ranks, gets
-log(2 + rank). Characters that are no piece become their UTF-8 byte pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, release_memory
from .texthash import mix, powers, text_chunks

SPACE = 0x2581
CUT = 48.0
#: Bytes of text, or ids, that are worked on at once (a longer text alone).
CHUNK = 1 << 19
FILTER_BITS = 22
#: Characters of repeated units whose lattices are kept from chunk to chunk (some 100 bytes each).
KNOWN = CHUNK


def load_model(path: str, alpha: float = 1.0) -> dict:
    """Pieces, log weights and byte pieces of a SentencePiece model with identity normalisation."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize(" Ａ  x ") != "▁▁Ａ▁▁x▁":
        raise ValueError("the model changes its input beyond white space; only identity normalisation is handled")
    ids, pieces, scores, bytes_of = [], [], [], {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_of[int(text[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids.append(i)
            pieces.append(text)
            scores.append(model.get_score(i))
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("a piece goes past the start of a white-space unit")
    score = np.array(scores)
    if np.all(score == np.round(score)):
        score = -np.log(2 - score)
    table = [b""] * model.get_piece_size()
    for i, p in zip(ids, pieces):
        table[i] = p.replace("▁", " ").encode()
    for b, i in bytes_of.items():
        table[i] = bytes([b])
    if len(bytes_of) != 256:
        raise ValueError("the model has no byte pieces")
    return {"ids": np.array(ids), "pieces": pieces, "weight": alpha * score,
            "byte_ids": np.array([bytes_of[b] for b in range(256)]), "byte_weight": alpha * -float(np.log(2 + len(table))),
            "bytes": table}


def _char_codes(chars: np.ndarray) -> np.ndarray:
    return mix(chars.astype(np.uint64) + np.uint64(0x1234567)) | np.uint64(1)


def _char_prefix(chars: np.ndarray) -> np.ndarray:
    up, _ = powers(len(chars))
    out = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(_char_codes(chars) * up[:len(chars)], out=out[1:])
    return out


class Lexicon:
    """Look-up of pieces by the hash of their characters."""

    def __init__(self, model: dict):
        self.model = model  # kept alive, so that its identity stays its own
        starts = [_char_prefix(np.array([ord(c) for c in p], np.uint32))[1:] for p in model["pieces"]]
        hashes = np.array([p[-1] for p in starts], np.uint64)
        order = np.argsort(hashes)
        self.hash, self.row = hashes[order], order
        if (self.hash[1:] == self.hash[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.length = np.array([len(p) for p in model["pieces"]])
        self.longest = int(self.length.max())
        self.piece_hash = hashes
        self.slot = np.full(1 << FILTER_BITS, -1, np.int32)  # row by the hash's first bits
        self.slot[hashes >> np.uint64(64 - FILTER_BITS)] = np.arange(len(hashes))
        self.begun = np.zeros(1 << FILTER_BITS, bool)  # of all beginnings of pieces
        self.begun[np.concatenate(starts) >> np.uint64(64 - FILTER_BITS)] = True
        self.weight, self.ids = model["weight"], model["ids"]

    def find(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Row of the piece with each hash and that many characters, or -1."""
        row = self.slot[hashes >> np.uint64(64 - FILTER_BITS)]
        same = self.piece_hash[row] == hashes  # row -1 compares with the last piece
        out = np.where((row >= 0) & same & (self.length[row] == length), row, -1)
        rest = np.flatnonzero((row >= 0) & ~same)  # two pieces with one slot
        if len(rest):
            at = np.minimum(np.searchsorted(self.hash, hashes[rest]), len(self.hash) - 1)
            found = self.row[at]
            good = (self.hash[at] == hashes[rest]) & (self.length[found] == length)
            out[rest[good]] = found[good]
        return out


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lengths[0] of them), starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _keyed(*keys, begun=None) -> np.ndarray:
    """Hash of integer keys (arrays broadcast), on from the hash of the keys before them."""
    h = np.array([0x5851F42D4C957F2D], np.uint64) if begun is None else begun
    for k in keys:
        h = mix((np.asarray(k).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ (h * np.uint64(0xD1342543DE82EF95)))
    return h


def _uniform(*keys, begun=None) -> np.ndarray:
    """Open-interval uniforms from hashed integer keys."""
    return ((_keyed(*keys, begun=begun) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


#: Arrays of a lattice: four over its characters, five over its edges.
_PARTS = ("left", "chars", "count", "first", "node", "length", "piece", "log_share", "cum")


def _build(chars, prefix, down, starts, size, lex: Lexicon, model: dict) -> dict:
    """The arrays of ``_PARTS`` for the units that begin at ``starts``."""
    begin = np.cumsum(size) - size
    place = _spread(starts, size)
    n = len(place)
    left = np.repeat(begin + size, size) - np.arange(n)  # characters to the unit's end
    most = int(left.max()) if n else 0
    found, rows = [], np.arange(n)
    for length in range(1, min(lex.longest, most) + 1):  # on from the places where a piece may still begin
        p = place[rows]
        hashes = (prefix[p + length] - prefix[p]) * down[p]
        on = lex.begun[hashes >> np.uint64(64 - FILTER_BITS)]
        rows, hashes = rows[on], hashes[on]
        piece = lex.find(hashes, length)
        good = piece >= 0
        if length == 1 or good.any():
            found += [(length, rows[good], piece[good])]
        rows = rows[left[rows] > length]
    chars = chars[place]
    single = np.zeros(n, bool)
    single[found[0][1] if found else []] = True
    lone = np.flatnonzero(~single)
    c = chars[lone]
    size_of = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF).astype(int)
    # edges by node and length: pieces, and byte pieces (-1) for characters that are none
    count = np.zeros(n, np.int64)
    count[lone] = 1
    for _, at, _ in found:  # a node is there once a length
        count[at] += 1
    first = np.cumsum(count) - count
    node = np.repeat(np.arange(n), count)
    edges = len(node)
    length, piece = np.ones(edges, np.int16), np.full(edges, -1, np.int32)
    weight, put = np.empty(edges), first.copy()
    weight[put[lone]] = model["byte_weight"] * size_of
    put[lone] += 1
    for k, at, x in found:
        edge = put[at]
        length[edge], piece[edge], weight[edge] = k, x, lex.weight[x]
        put[at] += 1
    # suffix sums, all units in step from their ends
    beta = np.zeros(n + 1)
    after = node + length
    after[length == left[node]] = n
    log_share = np.empty(edges)
    by_left = np.argsort(left.astype(np.uint16) if most < 1 << 16 else left, kind="stable")
    bounds = np.searchsorted(left[by_left], np.arange(1, most + 2))
    for r in range(len(bounds) - 1):
        rows = by_left[bounds[r]:bounds[r + 1]]
        if not len(rows):
            continue
        size = count[rows]
        edge, begin = _spread(first[rows], size), np.cumsum(size) - size
        total = weight[edge] + beta[after[edge]]
        top = np.maximum.reduceat(total, begin)
        beta[rows] = np.round(top + np.log(np.add.reduceat(np.exp(total - np.repeat(top, size)), begin)), 12)
        # rounded, so that sums do not show in what order or beside what they were taken
        log_share[edge] = np.round(total - np.repeat(beta[rows], size), 12)
    share = np.exp(log_share)
    cum = share.copy()
    rows = np.flatnonzero(count > 1)
    for k in range(1, int(count.max()) if n else 0):
        rows = rows[count[rows] > k]
        edge = first[rows] + k
        cum[edge] = cum[edge - 1] + share[edge]
    cum[first + count - 1] = 1.0
    kind = np.int32 if edges < 1 << 30 else np.int64  # places of nodes and edges, with those of known units before them
    return {"left": left.astype(kind), "chars": chars, "count": count.astype(kind), "first": first.astype(kind),
            "node": node.astype(kind), "length": length, "piece": piece, "log_share": log_share, "cum": cum}


class Lattice:
    """Distinct units of a chunk: pieces from every character, suffix sums, cumulative shares.

    Units that ``known`` holds (equal in every character) are taken over from there; the
    chunk's others are built and stand behind them."""

    def __init__(self, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lex: Lexicon, model: dict,
                 known: dict | None = None):
        prefix = _char_prefix(chars)
        _, down = powers(len(prefix))
        self.hash = mix((prefix[starts + lengths] - prefix[starts]) * down[starts] + lengths.astype(np.uint64))
        self.hash, first, self.unit, self.seen = np.unique(self.hash, return_index=True, return_inverse=True, return_counts=True)
        starts, self.size = starts[first], lengths[first]
        self.begin = np.full(len(starts), -1)
        if known:
            at = np.minimum(np.searchsorted(known["hash"], self.hash), len(known["hash"]) - 1)
            hit = np.flatnonzero((known["hash"][at] == self.hash) & (known["size"][at] == self.size))
            size = self.size[hit]
            if len(hit):
                same = chars[_spread(starts[hit], size)] == known["chars"][_spread(known["begin"][at[hit]], size)]
                hit = hit[np.logical_and.reduceat(same, np.cumsum(size) - size)]
            self.begin[hit] = known["begin"][at[hit]]
        self.new = np.flatnonzero(self.begin < 0)
        size = self.size[self.new]
        nodes, edges = (len(known["left"]), len(known["node"])) if known else (0, 0)
        self.begin[self.new] = nodes + np.cumsum(size) - size
        made = _build(chars, prefix, down, starts[self.new], size, lex, model)
        made["node"] += nodes
        made["first"] += edges
        for name in _PARTS:
            setattr(self, name, np.concatenate([known[name], made[name]]) if known else made[name])

    def add_repeated(self, known: dict, limit: int | None = None) -> dict:
        """``known`` with the new units that the chunk holds twice or more. Of a chunk that would take it past
        ``limit`` (``KNOWN``) characters, the new units start it afresh; those of one with more alone are left out."""
        limit = KNOWN if limit is None else limit
        unit = self.new[self.seen[self.new] > 1]
        more = int(self.size[unit].sum())
        if known and len(known["left"]) + more > limit:
            known = {}
        if not len(unit) or more > limit:
            return known
        nodes, edges = (len(known["left"]), len(known["node"])) if known else (0, 0)
        size = self.size[unit]
        node = _spread(self.begin[unit], size)
        count = self.count[node]
        edge = _spread(self.first[node], count)
        made = {"left": self.left[node], "chars": self.chars[node], "count": count, "first": edges + np.cumsum(count) - count,
                "node": np.repeat(nodes + np.arange(len(node)), count), "length": self.length[edge], "piece": self.piece[edge],
                "log_share": self.log_share[edge], "cum": self.cum[edge]}
        out = {c: np.concatenate([known[c], made[c].astype(known[c].dtype)]) if known else made[c].astype(getattr(self, c).dtype)
               for c in _PARTS}
        units = {"hash": self.hash[unit], "size": size, "begin": nodes + np.cumsum(size) - size}
        units = {c: np.concatenate([known[c], v]) if known else v for c, v in units.items()}
        order = np.argsort(units["hash"], kind="stable")
        return out | {c: v[order] for c, v in units.items()}

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge drawn at each node."""
        edge = self.first[node].astype(np.intp)
        live = np.flatnonzero(self.cum[edge] < u)
        while len(live):
            edge[live] += 1
            live = live[self.cum[edge[live]] < u[live]]
        return edge


class Paths:
    """One sample of some texts: its edges of the lattice, text by text."""

    def __init__(self, first, edge, lattice):
        self.first, self.edge, self.lattice = first, edge, lattice

    @property
    def length(self):
        return self.lattice.length[self.edge]


def _walk(lat: Lattice, occ_unit, occ_node, occ_doc, occ_place, key, sample, seed):
    """Draw the rest of each occurrence from its node; a step is (occurrences, their edges)."""
    live = np.arange(len(occ_unit))
    node, step, out = occ_node.copy(), 0, []
    begin = lat.begin[occ_unit]
    end = begin + lat.left[begin]
    drawn = _keyed(occ_place, begun=_keyed(seed, key, sample)[occ_doc])  # what all steps of an occurrence share
    live = live[node[live] < end[live]]
    while len(live):
        at = node[live]
        u = _uniform(at - begin[live], begun=drawn[live])
        edge = lat.choose(at, u)
        out.append((live, edge))
        node[live] = at + lat.length[edge]
        live = live[node[live] < end[live]]
        step += 1
    return out


def _assemble(walk, occurrences: int):
    """Edges of a walk in the order of occurrences, and how many each has."""
    count = np.zeros(occurrences, np.int64)
    for live, _ in walk:
        count[live] += 1
    first = np.cumsum(count) - count
    edge = np.empty(count.sum(), np.int64)
    for step, (live, drawn) in enumerate(walk):
        edge[first[live] + step] = drawn
    return count, edge


def _may_lead(value: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Places of all values that can be among the ``n`` largest of their text (``doc`` ascends): a
    text's values are cut into n stretches, and the least of the stretches' largest is a bound."""
    begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(doc)))
    bound = np.full(len(begin), -np.inf)
    many = np.flatnonzero(size >= n)
    if len(many):
        # stretches tile a text; where a text is not cut, its values are one stretch that does not count
        parts = np.ones(len(begin), np.int64)
        parts[many] = n
        first = np.cumsum(parts) - parts
        nth = np.arange(parts.sum()) - np.repeat(first, parts)
        top = np.maximum.reduceat(value, np.repeat(begin, parts) + nth * np.repeat(size, parts) // np.repeat(parts, parts))
        bound[many] = np.minimum.reduceat(top, first)[many]
    return np.flatnonzero(value >= np.repeat(bound, size))


def sample_chunk(chars, doc_chars, key, k, seed, lex, model, cut=CUT, known=None):
    """Rows (doc, rank, nodes...) of the k samples of each text of a chunk.

    Returns the lattice and a list over ranks of dicts: ``doc`` (texts that have a sample of
    this rank), ``paths``, ``logp``, ``value``; and the threshold of every text."""
    docs = len(doc_chars) - 1
    start = chars == SPACE
    start[1:] &= chars[:-1] != SPACE
    begun = doc_chars[:-1][np.diff(doc_chars) > 0]
    start[begun] = True
    unit_start = np.flatnonzero(start)
    unit_len = np.diff(np.append(unit_start, len(chars)))
    lat = Lattice(chars, unit_start, unit_len, lex, model, known)
    doc_unit = np.searchsorted(unit_start, doc_chars)  # texts' first units
    doc_of = np.repeat(np.arange(docs), np.diff(doc_unit))
    place = np.arange(len(unit_start)) - doc_unit[doc_of]

    results = []
    frontier = None
    value = -np.log(-np.log(_uniform(seed, key, 0, np.uint64(2**40), 0)))
    todo = np.arange(docs)
    for rank in range(k):
        if rank == 0:
            walk = _walk(lat, lat.unit, lat.begin[lat.unit], doc_of, place, key, 0, seed)
            count, edge = _assemble(walk, len(unit_start))
            unit_first = np.append(0, np.cumsum(count))
            paths = Paths(unit_first[doc_unit], edge, lat)
            head = np.zeros(docs, np.int64)
            own_unit = np.repeat(np.arange(len(unit_start)), count)
        else:
            # the best node of each text's frontier
            order = np.lexsort((-frontier["value"], frontier["doc"]))
            d = frontier["doc"][order]
            best = order[np.flatnonzero(np.append(True, d[1:] != d[:-1]))] if len(order) else order
            todo = frontier["doc"][best]
            if not len(todo):
                break
            value = np.full(docs, -np.inf)
            value[todo] = frontier["value"][best]
            keep = np.ones(len(frontier["doc"]), bool)
            keep[best] = False
            # the begun path: the parent's pieces up to the branch, and the branch's own piece
            parent, t = frontier["sample"][best], frontier["at"][best]
            branch, branch_unit = frontier["edge"][best], frontier["unit"][best]
            head = t + 1
            he, hu = (np.empty(int(head.sum()), np.int64) for _ in range(2))
            hfirst = np.cumsum(head) - head
            for s in np.unique(parent):
                r = np.flatnonzero(parent == s)
                src = results[s]
                slot = np.searchsorted(src["doc"], todo[r])
                take = _spread(src["paths"].first[slot], t[r])
                put = _spread(hfirst[r], t[r])
                he[put], hu[put] = src["paths"].edge[take], src["unit"][take]
            he[hfirst + t], hu[hfirst + t] = branch, branch_unit
            # the rest of the branch's unit, and the units after it, are drawn anew
            n_units = doc_unit[todo + 1] - branch_unit
            occ = _spread(branch_unit, n_units)
            occ_doc = np.repeat(todo, n_units)
            nodes = lat.begin[lat.unit[occ]].copy()
            nodes[np.cumsum(n_units) - n_units] = lat.node[branch] + lat.length[branch]
            walk = _walk(lat, lat.unit[occ], nodes, occ_doc, place[occ], key, rank, seed)
            count, edge = _assemble(walk, len(occ))
            per_doc = np.add.reduceat(count, np.cumsum(n_units) - n_units)
            size = head + per_doc
            first = np.append(0, np.cumsum(size))
            all_e, own_unit = (np.empty(first[-1], np.int64) for _ in range(2))
            put = _spread(first[:-1], head)
            all_e[put], own_unit[put] = he, hu
            put = _spread(first[:-1] + head, per_doc)
            all_e[put], own_unit[put] = edge, np.repeat(occ, count)
            paths = Paths(first, all_e, lat)
            frontier = {c: v[keep] for c, v in frontier.items()}
        # log probabilities along the paths
        logp = lat.log_share[paths.edge]
        run = np.append(0.0, np.cumsum(logp))
        texts = todo if rank else np.arange(docs)
        doc_pos = np.repeat(np.arange(len(texts)), np.diff(paths.first))
        before = np.round(run[:-1] - run[paths.first[:-1]][doc_pos], 9)
        results.append({"doc": texts, "paths": paths, "unit": own_unit, "value": value[texts],
                        "logp": np.round(run[paths.first[1:]] - run[paths.first[:-1]], 9)})
        # siblings of the new part of each path join the frontier
        at = np.arange(len(paths.edge)) - paths.first[:-1][doc_pos]
        drawn = _keyed(seed, key, rank)
        new = np.flatnonzero((before >= -cut) & (at >= (head[doc_pos] if rank else 0)))
        node = lat.node[paths.edge[new]]
        edge, i_new = _spread(lat.first[node], lat.count[node]), np.repeat(np.arange(len(new)), lat.count[node])
        other = edge != paths.edge[new][i_new]
        edge, i_new = edge[other], i_new[other]
        i = new[i_new]
        m, d = before[i] + lat.log_share[edge], texts[doc_pos[i]]
        u = _uniform(lat.length[edge], begun=_keyed(np.uint64(2**41) + at[new].astype(np.uint64), begun=drawn[texts[doc_pos[new]]])[i_new])
        g = m - np.log(np.exp(m - value[d]) - np.log(u))
        best = _may_lead(g, d, k - rank)
        i, d = i[best], d[best]
        add = {"value": g[best], "doc": d, "sample": np.full(len(d), rank), "at": at[i], "edge": edge[best], "unit": own_unit[i]}
        frontier = add if frontier is None else {c: np.concatenate([frontier[c], add[c]]) for c in add}
        order = np.lexsort((-frontier["value"], frontier["doc"]))
        d = frontier["doc"][order]
        begin = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, int)
        nth = np.arange(len(d)) - np.repeat(begin, np.diff(np.append(begin, len(d))))
        frontier = {c: v[order[nth < k - rank]] for c, v in frontier.items()}
        # a sibling left out has at most this value: log mass -cut plus the largest Gumbel of 53 bits
        dropped = np.unique(texts[doc_pos[before < -cut]]) if cut < np.inf else np.zeros(0, int)
        if len(dropped):
            held = np.bincount(frontier["doc"], minlength=docs)[dropped]
            low = np.full(docs, np.inf)
            np.minimum.at(low, frontier["doc"], frontier["value"])
            if ((held < k - rank) | (low[dropped] < 37.5 - cut)).any():
                return sample_chunk(chars, doc_chars, key, k, seed, lex, model, np.inf, known)
    threshold = np.full(docs, -np.inf)
    if frontier is not None and len(frontier["doc"]):
        np.maximum.at(threshold, frontier["doc"], frontier["value"])
    return lat, results, threshold


def piece_ids(lat: Lattice, paths: Paths, lex: Lexicon, model: dict):
    """Flat ids of all paths and where each path's ids begin (byte pieces written out)."""
    row = lat.piece[paths.edge]
    byte = np.flatnonzero(row < 0)
    if not len(byte):
        return lex.ids[row], paths.first
    c = lat.chars[lat.node[paths.edge[byte]]].astype(np.int64)
    size = np.ones(len(row), np.int64)
    size[byte] = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    begin = np.append(0, np.cumsum(size))
    out = np.empty(begin[-1], np.int64)
    plain = np.flatnonzero(row >= 0)
    out[begin[plain]] = lex.ids[row[plain]]
    n = size[byte]
    for extra in range(4):
        rows = np.flatnonzero(n > extra)
        shift = 6 * (n[rows] - 1 - extra)
        value = c[rows] >> shift
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n[rows]]
        value = value | lead if extra == 0 else (value & 0x3F) | 0x80
        out[begin[byte[rows]] + extra] = model["byte_ids"][value]
    return out, begin[paths.first]


_lexicons: dict[int, Lexicon] = {}


def sample_encodings(docs: DataFrame, model_path: str, k: int = 2, seed: int = 1, alpha: float = 1.0,
                     id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                     decoded: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Up to ``k`` rows for each row of ``docs``: ``id``, the columns of ``keep``, ``sample`` (0 the
    largest perturbed value), ``ids``, ``log_prob``, ``perturbed``, ``inclusion`` and its logarithm
    ``log_inclusion`` (finite also where the share underflows).

    Samples of a row are distinct; a text with fewer than ``k`` segmentations gives them all,
    with inclusion 1. Null and empty texts have one, without pieces. The key of a row is its
    id, so rows that repeat id and text get the same samples; a null id counts as 0. Whole
    texts of any length are used. An empty table gives no rows. ``decoded`` names one more column,
    the ids decoded as by :func:`decode_ids`, in the task that drew them. A ``chunk`` of
    fewer bytes takes less memory and more time and changes no row. ``keep`` must not repeat the
    names above; columns not named are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path, alpha))
    kept = [(c, docs.schema[c].dataType.simpleString()) for c in keep]

    def run(batches):
        model = shared.value
        lex = _lexicons.get(id(model))
        if lex is None:
            _lexicons.clear()            # the tables of a job that is over
            lex = _lexicons[id(model)] = Lexicon(model)
        known = {}
        pieces = pa.array(model["bytes"], pa.binary())
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column(1), chunk):
                rows = batch.slice(i, j - i)
                keys = rows.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                head = (raw & 0xC0) != 0x80
                at = np.append(0, np.cumsum(head))[off]
                chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
                full = np.diff(off) > 0
                chars = np.insert(chars, at[:-1][full], SPACE)
                at = at + np.append(0, np.cumsum(full))
                chars[chars == 0x20] = SPACE
                lat, results, threshold = sample_chunk(chars, at, keys, k, seed, lex, model, known=known)
                for rank, r in enumerate(results):
                    ids, first = piece_ids(lat, r["paths"], lex, model)
                    with np.errstate(over="ignore"):
                        gap = r["logp"] - threshold[r["doc"]]
                        inclusion = -np.expm1(-np.exp(gap))
                        # the share itself is too small for a float in long texts; log(1 - exp(-exp(x))) is x there
                        log_inclusion = np.where(gap < -30, gap, np.log(np.maximum(inclusion, 1e-300)))
                    pick = pa.array(r["doc"])
                    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pick), *[rows.column(2 + c).take(pick) for c in range(len(kept))],
                         pa.array(np.full(len(pick), rank, np.int32)),
                         lists, pa.array(r["logp"]), pa.array(r["value"]), pa.array(inclusion),
                         pa.array(log_inclusion), *([_decode(lists, pieces)] if decoded else [])], names)
                known = lat.add_repeated(known, chunk)
                del lat, results
        release_memory()

    names = ["id", *keep, "sample", "ids", "log_prob", "perturbed", "inclusion", "log_inclusion", *([decoded] if decoded else [])]
    schema = ", ".join(["id bigint", *[f"{c} {t}" for c, t in kept], "sample int", "ids array<int>",
                        "log_prob double", "perturbed double", "inclusion double", "log_inclusion double",
                        *([f"`{decoded}` string"] if decoded else [])])
    return docs.select(F.col(id_col).cast("bigint").alias("id"), text_col, *keep).mapInArrow(run, schema)


def _decode(column: pa.Array, pieces: pa.Array) -> pa.Array:
    """Texts of a column of id lists; ``pieces`` are the bytes of each id."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, flat, parts = column.offsets.to_numpy(), column.values, [pa.array([], pa.string())]
    for i, j in byte_chunks(offsets, CHUNK):
        ids = flat.slice(offsets[i], offsets[j] - offsets[i])
        try:
            taken = pieces.take(ids)  # its bytes lie one after another
        except pa.ArrowIndexError as e:
            raise ValueError("an id is outside the vocabulary") from e
        ends = np.frombuffer(taken.buffers()[1], np.int32)[offsets[i:j + 1] - offsets[i]] if len(ids) else np.zeros(j - i + 1, np.int32)
        raw = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.tobytes()), taken.buffers()[2] if len(ids) else pa.py_buffer(b"")])
        try:
            text = raw.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())
        text = pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text)
        parts.append(pc.if_else(column.slice(i, j - i).is_null(), pa.scalar(None, pa.string()), text))
    return pa.concat_arrays(parts)


def decode_ids(model_path: str):
    """Column function: the text of an array of ids. Null gives null; ids without text (such as
    begin marks) give nothing; bytes that are no UTF-8 become U+FFFD; an id outside the
    vocabulary fails."""
    table = load_model(model_path)["bytes"]

    def run(column: pa.Array) -> pa.Array:
        return _decode(column, pa.array(table, pa.binary()))

    return F.arrow_udf(run, "string")
