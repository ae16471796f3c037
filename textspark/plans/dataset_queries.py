"""Registered queries: split, windows, batches, counts.

Tokens are word tokens (vocabulary fitted on all documents); the stream is the
documents' tokens in ``doc_id`` order, context 128, stride 64, batch 32.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import dataset as W
from ..operators import encode as E
from ..sources.tables import documents
from .pretok_queries import DUCK_WORDS
from .token_queries import WORD_VOCAB_SQL
from .registry import register

CTX, STRIDE, BATCH, EPOCHS = K.CONTEXT_LENGTH, K.STRIDE, K.BATCH_SIZE, 10


def word_encoded(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return E.WordTokenizer.train(docs).encode(docs)


TOK_SQL = f"""with {WORD_VOCAB_SQL},
tok as (select doc_id, pos, coalesce(wv.id, 1)::int as id from (
  select doc_id, generate_subscripts(c, 1) as pos, unnest(c) as token
  from (select doc_id, {DUCK_WORDS} as c from documents)) x left join wv using (token)),
st as (select doc_id, pos, id, (row_number() over (order by doc_id, pos) - 1)::bigint as p from tok),
nt as (select count(*)::bigint as n from st),
dl as (select d.doc_id, coalesce(list(t.id order by t.pos) filter (where t.id is not null), []::int[]) as ids
       from documents d left join tok t using (doc_id) group by d.doc_id)"""


@register("w1_contiguous_split", """
with d as (select doc_id, text, length(text) as len,
             coalesce(sum(length(text)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as off
           from documents),
c as (select floor(sum(length(text)) * (1 - 0.1::double))::bigint as cut from documents)
select doc_id, split, text from (
  select doc_id, 0 as split, text from d, c where off + len <= cut
  union all select doc_id, 0, substr(text, 1, (cut - off)::bigint) from d, c where off <= cut and cut < off + len
  union all select doc_id, 1, substr(text, (cut - off + 1)::bigint) from d, c where off <= cut and cut < off + len
  union all select doc_id, 1, text from d, c where off > cut) where length(text) > 0""")
def w1_contiguous_split(spark, sf_dir):
    return W.contiguous_split(documents(spark, sf_dir), K.VAL_RATIO)


@register("w2_sliding_windows", TOK_SQL + f""",
kw as (select p, id, unnest(range(greatest(0, ceil((p - {CTX}) / {STRIDE})::bigint),
                                  least(floor(p / {STRIDE})::bigint, (select floor((n - {CTX} - 1) / {STRIDE})::bigint from nt)) + 1)) as k
       from st)
select k::bigint as k, (k * {STRIDE})::bigint as start, w[1:{CTX}] as x, w[2:{CTX + 1}] as y
from (select k, list(id order by p) as w from kw group by k)""")
def w2_sliding_windows(spark, sf_dir):
    return W.packed_windows(word_encoded(spark, sf_dir), CTX, STRIDE)


@register("w2b_document_windows", TOK_SQL + f"""
select doc_id, start::bigint as start, ids[start + 1:start + {CTX}] as x, ids[start + 2:start + {CTX + 1}] as y
from (select doc_id, ids, unnest(range(0, len(ids) - {CTX}, {STRIDE})) as start from dl where len(ids) > {CTX})""")
def w2b_document_windows(spark, sf_dir):
    return W.per_document_windows(word_encoded(spark, sf_dir), CTX, STRIDE).select(
        "doc_id", F.col("start").cast("bigint"), "x", "y")


@register("w3_shifted_targets", TOK_SQL + f"""
select count(*)::bigint as n_windows, count(*)::bigint as n_shift_ok from (
  select k from (select p, unnest(range(greatest(0, ceil((p - {CTX}) / {STRIDE})::bigint),
      least(floor(p / {STRIDE})::bigint, (select floor((n - {CTX} - 1) / {STRIDE})::bigint from nt)) + 1)) as k from st)
  group by k)""")
def w3_shifted_targets(spark, sf_dir):
    w = W.packed_windows(word_encoded(spark, sf_dir), CTX, STRIDE)
    ok = F.slice("x", 2, CTX - 1) == F.slice("y", 1, CTX - 1)
    return w.agg(F.count(F.lit(1)).cast("bigint").alias("n_windows"),
                 F.sum(ok.cast("int")).cast("bigint").alias("n_shift_ok"))


@register("w4_short_documents", TOK_SQL + f"""
select doc_id, len(ids)::int as n_tokens from dl where len(ids) < {CTX + 1}""")
def w4_short_documents(spark, sf_dir):
    return W.short_documents(word_encoded(spark, sf_dir), CTX)


@register("w5_batches", TOK_SQL + f""",
win as (select unnest(range(0, (select floor((n - {CTX} - 1) / {STRIDE})::bigint + 1 from nt))) as k)
select (k // {BATCH})::bigint as batch_id, count(*)::bigint as n_windows, min(k)::bigint as first_k
from win where k // {BATCH} < (select count(*) from win) // {BATCH} group by 1""")
def w5_batches(spark, sf_dir):
    w = W.packed_windows(word_encoded(spark, sf_dir), CTX, STRIDE)
    b = W.ordered_batches(w, BATCH, drop_last=True)
    return b.groupBy("batch_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_windows"),
                                     F.min("k").cast("bigint").alias("first_k"))


def _w5_training_sql(seed: int, epoch: int) -> str:
    # the half-width depends on the number of windows: keys of every width that the table can have
    keys = " union all ".join(
        f"select {half} as half, " + ", ".join(f"{c}::bigint as c{i}, {d}::bigint as d{i}" for i, (c, d) in enumerate(
            W.feistel_keys(1 << (2 * half), seed, epoch)[1])) for half in range(2, 16))
    value = "select k, cur >> half as l0, cur & ((1::bigint << half) - 1) as r0, * exclude (k, cur) from todo"
    for i in range(4):
        value = (f"select * exclude (l{i}, r{i}), r{i} as l{i + 1}, xor(l{i}, (((r{i} + c{i}) * xor(r{i}, d{i})) >> (half // 2)) & ((1::bigint << half) - 1)) as r{i + 1} "
                 f"from ({value})")
    return TOK_SQL.replace("with ", "with recursive ", 1) + f""",
sz as (select floor((n - {CTX} - 1) / {STRIDE})::bigint + 1 as m from nt),
ky as (select m, k.* from sz, ({keys}) k where half = greatest(2, (length(bin(greatest(m - 1, 1))) + 1) // 2)),
walk as (select k, k as cur, 0 as step, ky.* from ky, (select unnest(range(0, (select m from sz))) as k)
  union all
  select k, (l4 << half) | r4 as cur, step + 1, m, half, c0, d0, c1, d1, c2, d2, c3, d3
  from ({value.replace('from todo', 'from walk where step = 0 or cur >= m')})),
done as (select k, cur from walk where step > 0 and cur < m)
select k, cur // {BATCH} as batch_id, (cur % {BATCH})::int as place from done
where cur // {BATCH} < (select m from sz) // {BATCH}"""


@register("w5_training_batches", _w5_training_sql(7, 3))
def w5_training_batches(spark, sf_dir):
    """Batch and place of every window in epoch 3 of seed 7; the last short batch is dropped."""
    w = W.packed_windows(word_encoded(spark, sf_dir), CTX, STRIDE)
    return W.shuffled_batches(w, 7, 3, BATCH).select("k", "batch_id", "place")


@register("w6_chars_per_token", TOK_SQL + """
select round((select sum(length(text)) from documents) / (select count(*) from st), 6) as chars_per_token""")
def w6_chars_per_token(spark, sf_dir):
    r = W.chars_per_token(word_encoded(spark, sf_dir))
    return r.select(F.round("chars_per_token", 6).alias("chars_per_token"))


@register("w7_sample_count", TOK_SQL + f"""
select n as n_tokens, (floor((n - {CTX} - 1) / {STRIDE}) + 1)::bigint as samples,
       floor((floor((n - {CTX} - 1) / {STRIDE}) + 1) / {BATCH})::bigint as batches,
       (floor((floor((n - {CTX} - 1) / {STRIDE}) + 1) / {BATCH}) * {EPOCHS})::bigint as steps from nt""")
def w7_sample_count(spark, sf_dir):
    enc = word_encoded(spark, sf_dir)
    n = enc.agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"))
    samples, batches, steps = W.sample_counts(F.col("n_tokens"), CTX, STRIDE, BATCH, EPOCHS)
    return n.select("n_tokens", samples.alias("samples"), batches.alias("batches"), steps.alias("steps"))
