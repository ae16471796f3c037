"""Generation over whole tables of prompts.

The next token has a probability for every id of the vocabulary: the observed successors of
the last token, and all other ids, which share one smoothed probability each. That tail is
kept as a number and a mass, never as rows: it ties below every observed successor, so a
top-k larger than the successors keeps all of it, and a draw that falls into it picks the
r-th id that is no successor.

A request is completed in one go: the successors of each context, ranked, go to the tasks as
arrays if they are at most ``KERNEL_BYTES`` (checked; entries have a fixed width), and a task
takes the requests of an Arrow batch through their budgets together. A larger model stays partitioned: each token is a
round in which requests and successor lists of the same context meet in a cogroup, a context
that many requests are at in several groups. Both use the same chooser, so they give the
same tokens. Draws are hashes of (seed, prompt, step): no state, no dependence on
partitions, retries or row ids.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import reliable_checkpoint
from .encode import _spread, id_lists
from .lm import NgramModel

UNSEEN = -1
#: A model of at most this size goes to every task; an entry is an int token and a long count.
KERNEL_BYTES = 64 << 20
ENTRY_BYTES = 12
#: Requests at one context that a group of a round takes.
GROUP_REQUESTS = 10_000
#: Cumulative shares that a task keeps (8 bytes each).
CACHE_ENTRIES = 4_000_000


def candidates(model: NgramModel) -> DataFrame:
    """(context, token, logp, n_tokens): the observed successors of each context, and under
    ``context = -1`` the unigrams for back-off. ``n_tokens`` is 1; a last row of each context, with a
    null token, stands for the ``n_tokens`` ids that were not observed, with the ``logp`` of each."""
    a, V = model.alpha, model.vocab_size
    succ = model.next_token_probs().select("context", "token", F.log("prob").alias("logp"), "n_tokens")
    n = F.lit(float(model.n_tokens)) + a * V
    seen = model.unigrams.select(F.count(F.lit(1)).alias("s")).select((F.lit(V) - F.col("s")).alias("n_tokens"))
    uni = model.unigrams.select(F.lit(UNSEEN).alias("context"), "token", F.log((F.col("n_w") + a) / n).alias("logp"),
                                F.lit(1).cast("bigint").alias("n_tokens"))
    rest = seen.where("n_tokens > 0").select(F.lit(UNSEEN).alias("context"), F.lit(None).cast("int").alias("token"),
                                             F.log(F.lit(a) / n).alias("logp"), F.col("n_tokens").cast("bigint"))
    return succ.unionByName(uni).unionByName(rest)


def crop_context(ids, n: int = 2):
    """What an n-gram model looks at, the last n - 1 tokens (all of a shorter prompt)."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(ids, F.greatest(F.size(ids) - (n - 2), F.lit(1)), F.lit(max(n - 1, 0)))


def ranked_successors(model: NgramModel) -> DataFrame:
    """(context, tokens, counts): the successors of each context, most frequent first (ties by id);
    the unigrams under ``context = -1``. A list is as long as the vocabulary at most."""
    rows = model.pairs.select("context", "token", "n").unionByName(
        model.unigrams.select(F.lit(UNSEEN).alias("context"), "token", F.col("n_w").alias("n")))
    ranked = rows.groupBy("context").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("n")).alias("m"), F.col("token").cast("int").alias("token")))).alias("r"))
    return ranked.select(F.col("context").cast("int").alias("context"), F.transform("r", lambda x: x["token"]).alias("tokens"),
                         F.transform("r", lambda x: -x["m"]).alias("counts"))


class Chooser:
    """Picks next tokens from successor lists; keeps the shares of the settings it has met."""

    def __init__(self, vocab_size: int, alpha: float):
        self.size, self.alpha, self.kept, self.entries = vocab_size, alpha, {}, 0

    def shares(self, name, tokens: np.ndarray, counts: np.ndarray, temperature: float, top_k: int):
        """Ids that stay in id order, their cumulative weights, weight of one tail id, all observed ids sorted."""
        top_k = top_k if 0 < top_k <= len(tokens) else 0                                  # all larger ones keep everything
        key = (name, temperature, top_k)
        found = self.kept.get(key)
        if found is None:
            stay = len(tokens)
            if 0 < top_k < stay:
                stay = int(np.searchsorted(-counts, -counts[top_k - 1], side="right"))    # ties with the k-th stay
            tail = len(tokens) if not top_k else None                                     # the tail ties as rank s + 1
            top = float(counts[0]) + self.alpha if len(counts) else self.alpha
            order = np.argsort(tokens[:stay], kind="stable")
            weight = np.exp(np.log((counts[:stay][order] + self.alpha) / top) / temperature)
            each = float(np.exp(np.log(self.alpha / top) / temperature)) if tail is not None and self.alpha > 0 else 0.0
            if self.entries > CACHE_ENTRIES:
                self.kept.clear()
                self.entries = 0
            found = (tokens[:stay][order].tolist(), np.cumsum(weight).tolist(), each, np.sort(tokens) if each else None)
            self.kept[key] = found
            self.entries += 2 * stay + 1
        return found

    def choose(self, name, tokens, counts, temperature: float, top_k: int, u: float) -> int:
        """G4 or, at temperature 0, G5. ``u`` in [0, 1) runs over the successors by id, then over
        the other ids."""
        if temperature == 0:
            return int(tokens[0]) if len(tokens) else 0
        ids, upto, each, observed = self.shares(name, tokens, counts, temperature, top_k)
        mass = upto[-1] if upto else 0.0
        rest = self.size - len(tokens) if each else 0
        at = u * (mass + each * rest)
        if at < mass or not rest:
            return ids[min(bisect_right(upto, at), len(ids) - 1)]
        return nth_other(observed, min(int((at - mass) / each), rest - 1))


class Draws:
    """:meth:`Chooser.choose` for many requests at once. The shares that were met lie one after the other, and all
    requests search the bounds of theirs together; a draw among the other ids is looked up on its own."""

    def __init__(self, chooser: Chooser, lists: dict):
        self.chooser, self.lists = chooser, lists
        self.empty = (np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.longest = max((len(t) for t, _ in lists.values()), default=0)
        self.known = np.zeros(max(lists, default=0) + 2, bool)
        self.known[[c for c in lists if c >= 0]] = True
        self.clear()

    def clear(self):
        self.seen, self.parts, self.entries = {}, [([0], [np.inf])], 1
        self.bounds, self.others = [], []                      # (first, end, mass, each, rest) and observed ids of a share

    def contexts(self, tokens: np.ndarray) -> np.ndarray:
        """The tokens, ``UNSEEN`` for those that are no context."""
        inside = np.minimum(np.maximum(tokens, 0), len(self.known) - 1)
        return np.where((tokens == inside) & self.known[inside], tokens, UNSEEN)

    def _share(self, context: int, temperature: float, top_k: int) -> int:
        key = (context, temperature, top_k)
        at = self.seen.get(key)
        if at is None:
            tokens, counts = self.lists.get(context, self.empty)
            if temperature == 0:
                ids, upto, each, observed = [int(tokens[0]) if len(tokens) else 0], [1.0], 0.0, None
            else:
                ids, upto, each, observed = self.chooser.shares(context, tokens, counts, temperature, top_k)
            rest = self.chooser.size - len(tokens) if each else 0
            if not ids and not rest:
                raise IndexError("no token to choose from")
            at = self.seen[key] = len(self.bounds)
            self.bounds.append((self.entries, self.entries + len(ids), upto[-1] if upto else 0.0, each, rest))
            self.others.append(observed)
            self.parts.append((ids, upto))
            self.entries += len(ids)
        return at

    def choose(self, context: np.ndarray, setting: np.ndarray, settings: list[tuple[float, int]], u: np.ndarray) -> np.ndarray:
        if self.entries > CACHE_ENTRIES:
            self.clear()
        asked, back = np.unique((setting.astype(np.int64) << 32) | (context.astype(np.int64) + 1), return_inverse=True)
        share = np.array([self._share((x & 0xFFFFFFFF) - 1, *settings[x >> 32]) for x in asked.tolist()], np.int64)[back]
        if len(self.parts) > 1 or self.bounds is not self.made:
            self._pack()
        first, end = self.first[share], self.end[share]
        mass, each, rest = self.mass[share], self.each[share], self.rest[share]
        at = u * (mass + each * rest)
        low, high = first.copy(), end.copy()
        for _ in range(int((end - first).max(initial=0)).bit_length()):
            mid = (low + high) >> 1
            right = (low < high) & (self.upto[np.minimum(mid, end - 1)] <= at)   # bisect_right
            low, high = np.where(right, mid + 1, low), np.where(right, high, mid)
        out = self.ids[np.minimum(low, end - 1)]
        for i in np.flatnonzero((at >= mass) & (rest > 0)):
            out[i] = nth_other(self.others[share[i]], min(int((at[i] - mass[i]) / each[i]), int(rest[i]) - 1))
        return out

    #: The list of bounds that the arrays were made of.
    made = None

    def _pack(self):
        """Arrays of all shares, those met since the last time at the end."""
        self.ids = np.concatenate([np.asarray(i, np.int32) for i, _ in self.parts])
        self.upto = np.concatenate([np.asarray(x, np.float64) for _, x in self.parts])
        self.parts, self.made = [(self.ids, self.upto)], self.bounds
        first, end, mass, each, rest = zip(*self.bounds)
        self.first, self.end, self.rest = (np.array(x, np.int64) for x in (first, end, rest))
        self.mass, self.each = np.array(mass, np.float64), np.array(each, np.float64)


def nth_other(observed: np.ndarray, r: int) -> int:
    """The r-th id (from 0) that is not among the sorted ``observed``."""
    return r + int(np.searchsorted(observed - np.arange(len(observed)), r, side="right"))


def prompt_key(seed, ids):
    """Names the draws of a request by its seed and the tokens of its prompt."""
    return F.md5(F.concat_ws(":", F.coalesce(seed.cast("string"), F.lit("-")), F.array_join(ids.cast("array<string>"), ",")).cast("binary"))


def uniform(key: str, step: int) -> float:
    """52 bits of a digest, in [0, 1)."""
    return int(hashlib.md5(f"{key}:{step}".encode()).hexdigest()[:13], 16) / (1 << 52)


def uniforms(keys: list[bytes], step: int) -> np.ndarray:
    """:func:`uniform` of many keys, each with its colon."""
    digests = b"".join([hashlib.md5(k + b"%d" % step).digest() for k in keys])
    return (np.frombuffer(digests, ">u8")[::2] >> 12).astype(np.float64) / (1 << 52)


def complete(draws: Draws, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """The ids and the numbers of new tokens of a batch of requests (pid, ids, budget, temperature, top_k, key,
    stop_ids), which go on together, a token at a time."""
    prompt, bounds = id_lists(batch.column(1))
    prompt, size = prompt.to_numpy(zero_copy_only=False), np.diff(bounds)
    budget, temperature, top_k = (batch.column(k) for k in (2, 3, 4))
    budget = pc.fill_null(budget, 0).to_numpy(zero_copy_only=False)
    live = np.flatnonzero(budget > 0)
    codes: dict[tuple[float, int], int] = {}
    # a top-k beyond the longest list keeps everything: one setting, whatever its number
    kept = [0 if k is not None and k > draws.longest else k for k in top_k.to_pylist()]
    setting = np.array([codes.setdefault(x, len(codes)) for x in zip(temperature.to_pylist(), kept)], np.int64)
    settings = list(codes)
    warm = np.array([bool(t) for t, _ in settings], bool)[setting]
    keys = [f"{k}:".encode() for k in batch.column(5).to_pylist()]
    stops = [set(x) for x in batch.column(6).to_pylist()]
    stopped = np.array([bool(x) for x in stops], bool)
    newest = np.full(len(size), UNSEEN, np.int64)
    newest[size > 0] = prompt[bounds[1:][size > 0] - 1]
    made, steps = np.zeros(len(size), np.int64), []
    while len(live):
        u = np.zeros(len(live))
        drawn = warm[live]
        u[drawn] = uniforms([keys[i] for i in live[drawn].tolist()], len(steps))
        tokens = draws.choose(draws.contexts(newest[live]), setting[live], settings, u)
        steps.append((live, tokens))
        newest[live] = tokens
        made[live] += 1
        going = made[live] < budget[live]
        may = np.flatnonzero(going & stopped[live])
        going[may] = [t not in stops[i] for t, i in zip(tokens[may].tolist(), live[may].tolist())]
        live = live[going]
    ends = np.append(0, np.cumsum(size + made))
    out = np.empty(ends[-1], np.int32)
    out[_spread(ends[:-1], size)] = prompt
    for step, (rows, tokens) in enumerate(steps):
        out[ends[rows] + size[rows] + step] = tokens
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out)), pa.array(made, pa.int32())


def generate(model: NgramModel, prompts: DataFrame, max_steps: int | None = None,
             kernel_bytes: int = KERNEL_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prompts (pid, ids, max_new_tokens, temperature, top_k, seed, stop_ids)
    -> (pid, ids, new_tokens) and the columns of ``keep``. A row stops after its newest token is a stop id (the token is
    kept, G8) or when its budget is used; ``max_steps`` bounds all budgets. A prompt without
    tokens goes on from the unigrams."""
    budget = F.col("max_new_tokens").cast("int")
    state = prompts.select(
        "pid", F.col("ids").cast("array<int>").alias("ids"),
        (F.least(budget, F.lit(max_steps)) if max_steps is not None else budget).alias("budget"),
        F.col("temperature").cast("double").alias("temperature"), F.col("top_k").cast("int").alias("top_k"),
        prompt_key(F.col("seed"), F.col("ids")).alias("key"),
        F.coalesce(F.col("stop_ids").cast("array<int>"), F.array().cast("array<int>")).alias("stop_ids"),
        *(F.col(c).alias(f"keep_{c}") for c in keep))
    entries = model.pairs.count() + model.unigrams.count()
    if entries * ENTRY_BYTES <= kernel_bytes:
        out = _generate_in_tasks(model, state)
    else:
        out = _generate_in_rounds(model, state)
    return out.select("pid", "ids", "new_tokens", *(F.col(f"keep_{c}").alias(c) for c in keep))


def _generate_in_tasks(model: NgramModel, state: DataFrame) -> DataFrame:
    kept = state.columns[7:]
    spark = state.sparkSession
    table = ranked_successors(model).toArrow()                       # at most KERNEL_BYTES, checked
    lists = {c: (t.values.to_numpy(), n.values.to_numpy()) for c, t, n in zip(
        table["context"].to_pylist(), table["tokens"], table["counts"])}
    shared = spark.sparkContext.broadcast(lists)
    size, alpha = model.vocab_size, model.alpha

    def run(batches):
        draws = Draws(Chooser(size, alpha), shared.value)
        for batch in batches:
            ids, made = complete(draws, batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, made, *batch.columns[7:]], ["pid", "ids", "new_tokens", *kept])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # requests differ in budget, so they are dealt evenly over the tasks
    kind = {c: f"{c} {state.schema[c].dataType.simpleString()}" for c in ("pid", *kept)}
    kinds = ", ".join([kind["pid"], "ids array<int>", "new_tokens int", *(kind[c] for c in kept)])
    return state.repartition(parts, F.xxhash64("key", "pid")).mapInArrow(run, kinds)


def _generate_in_rounds(model: NgramModel, state: DataFrame) -> DataFrame:
    ranked = reliable_checkpoint(ranked_successors(model))
    known = ranked.select(F.col("context").alias("known"))
    size, alpha = model.vocab_size, model.alpha
    live = reliable_checkpoint(state.withColumn("new_tokens", F.lit(0)))
    cols = live.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in live.schema.fields)
    done = []
    while True:
        done.append(live.where("budget is null or new_tokens >= budget").select("pid", "ids", "new_tokens", *state.columns[7:]))
        live = live.where("new_tokens < budget")
        if live.isEmpty():
            break
        last = F.get("ids", F.size("ids") - 1)
        at = live.join(known, last == F.col("known"), "left").withColumn("at", F.coalesce("known", F.lit(UNSEEN))).drop("known")
        groups = at.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / GROUP_REQUESTS).cast("int").alias("groups"))
        groups = reliable_checkpoint(groups)
        asked = at.join(groups, "at").withColumn("salt", F.pmod(F.xxhash64("pid", "key"), F.col("groups")).cast("int")).drop("groups")
        offered = ranked.join(groups, F.col("context") == F.col("at")).select(
            "at", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), "tokens", "counts")

        def choose(requests: pa.Table, successors: pa.Table) -> pa.Table:
            chooser = Chooser(size, alpha)
            if successors.num_rows:
                lists = successors["tokens"][0].values.to_numpy(), successors["counts"][0].values.to_numpy()
            else:
                lists = np.zeros(0, np.int32), np.zeros(0, np.int64)
            data = {c: requests[c].to_pylist() for c in cols}
            for i, ids in enumerate(data["ids"]):
                t = data["temperature"][i]
                n = data["new_tokens"][i]
                token = chooser.choose(0, *lists, t, data["top_k"][i], uniform(data["key"][i], n) if t else 0.0)
                data["ids"][i] = [*ids, token]
                data["new_tokens"][i] = n + 1
                if token in data["stop_ids"][i]:
                    data["budget"][i] = n + 1
            return pa.table({c: pa.array(data[c], requests.schema.field(c).type) for c in cols})

        live = reliable_checkpoint(asked.groupBy("at", "salt").cogroup(offered.groupBy("at", "salt")).applyInArrow(choose, kinds))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def filtered_distribution(cands: DataFrame, temperature: float, top_k: int) -> DataFrame:
    """G1-G3 for every context at fixed settings: (context, token, prob, n_tokens). The row with a
    null token gives the probability of each of ``n_tokens`` other ids; it stays where k is
    larger than the observed successors, since all of them tie."""
    by_ctx = Window.partitionBy("context")
    if temperature == 0:  # greedy: all mass on the best token
        return greedy_next(cands).withColumns({"prob": F.lit(1.0), "n_tokens": F.lit(1).cast("bigint")})
    c = cands.withColumn("_l", F.col("logp") / F.lit(float(temperature)))
    if top_k and top_k > 0:
        c = c.withColumn("_r", F.rank().over(by_ctx.orderBy(F.col("_l").desc()))).where(F.col("_r") <= top_k)
    c = c.withColumn("_e", F.exp(F.col("_l") - F.max("_l").over(by_ctx)))
    return c.select("context", "token", (F.col("_e") / F.sum(F.col("_e") * F.col("n_tokens")).over(by_ctx)).alias("prob"), "n_tokens")


def greedy_next(cands: DataFrame) -> DataFrame:
    """Argmax per context, ties to the smallest id."""
    w = Window.partitionBy("context").orderBy(F.col("logp").desc(), F.asc_nulls_last("token"))
    return cands.withColumn("_g", F.row_number().over(w)).where("_g = 1").select("context", "token")


def reject_empty(encoded_prompts: DataFrame, ids_col="ids") -> DataFrame:
    """Prompts that produce no tokens get an error instead of a result."""
    return encoded_prompts.withColumn(
        "error", F.when(F.size(ids_col) == 0, F.lit(K.MSG_EMPTY_TOKENS)))


def prompt_file_prep(lines: DataFrame, ord_col="ord", line_col="line") -> DataFrame:
    """Skip blank lines, stop at the first quit/exit, unescape "\\n".
    The stop line is found with a scalar subquery (min ordinal)."""
    stripped = F.lower(F.trim(F.regexp_replace(F.col(line_col), r"(?U)^\s+|\s+$", "")))
    stop = lines.where(stripped.isin(*K.STOP_WORDS)).select(F.min(ord_col)).scalar()
    keep = lines.where((F.col(ord_col) < stop) | stop.isNull())
    keep = keep.where(F.regexp_replace(F.col(line_col), r"(?U)\s+", "") != "")
    return keep.select(ord_col, F.replace(F.col(line_col), F.lit("\\n"), F.lit("\n")).alias("prompt"))
