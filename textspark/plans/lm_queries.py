"""Registered queries: n-gram statistics, evaluation and generation (L*, G1-G15).

Setup shared by all: documents -> contiguous 90/10 split (W1) -> char
tokenizer fitted on the train side only -> bigram model (alpha = 1) on the
train side; evaluation on the validation side; prompts are the benchmark texts.
"""

from __future__ import annotations

import dataclasses
import os
import uuid
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import first_line_reply, wrap_chat_prompt
from ..operators import dataset as W
from ..operators import encode as E
from ..operators import generate as G
from ..operators import lm as L
from ..sources.tables import benchmark, documents, read_table
from .pretok_queries import DUCK_WORDS
from ..session import ensure_checkpoint_dir, reliable_checkpoint
from ..sources import store
from . import duck
from .registry import register

CTX, STRIDE, BATCH = K.CONTEXT_LENGTH, K.STRIDE, K.BATCH_SIZE
GREEDY_STEPS = 8


@dataclass
class Setup:
    tok: E.CharTokenizer
    train: DataFrame
    val: DataFrame
    model: L.NgramModel
    V: int


@lru_cache(maxsize=None)
def char_setup(spark, sf_dir) -> Setup:
    split = W.contiguous_split(documents(spark, sf_dir), K.VAL_RATIO)
    train_txt = split.where("split = 0").select("doc_id", "text")
    val_txt = split.where("split = 1").select("doc_id", "text")
    tok = E.CharTokenizer.train(train_txt)
    V = tok.vocab.count()
    # the train side is counted in one pass and its ids (4 bytes a character) are not kept; the encoded validation
    # side is read by every evaluation and written once, dealt out, as its texts are in the last scan tasks
    train = tok.encode(train_txt)
    val = reliable_checkpoint(tok.encode(val_txt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", F.xxhash64("text"))))
    return Setup(tok, train, val, L.fit_ngram(train, V), V)


SPLIT_SQL = """d as (select doc_id, split, text from (
  select doc_id, 0 as split, text from d0, c where off + len <= cut
  union all select doc_id, 0, substr(text, 1, (cut - off)::bigint) from d0, c where off <= cut and cut < off + len
  union all select doc_id, 1, substr(text, (cut - off + 1)::bigint) from d0, c where off <= cut and cut < off + len
  union all select doc_id, 1, text from d0, c where off > cut) where length(text) > 0)"""

CHAR_CV = """cv as (select '<unk>' as token, 0 as id union all
  select ch, row_number() over (order by ch) from (
    select distinct unnest(string_split(lower(text), '')) as ch from d where split = 0)),"""
CHAR_ENC = """enc as (select doc_id, split, list(coalesce(cv.id, 0) order by pos) as ids from (
  select doc_id, split, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select doc_id, split, string_split(lower(text), '') as c from d)) x
  left join cv on cv.token = x.ch group by doc_id, split),"""

BASE_SQL = f"""with d0 as (select doc_id, text, length(text) as len,
    coalesce(sum(length(text)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as off
  from documents),
c as (select floor(sum(length(text)) * (1 - 0.1::double))::bigint as cut from documents),
{SPLIT_SQL},
cv as (select '<unk>' as token, 0 as id union all
  select ch, row_number() over (order by ch) from (
    select distinct unnest(string_split(lower(text), '')) as ch from d where split = 0)),
vs as (select count(*)::double as v from cv),
enc as (select doc_id, split, list(coalesce(cv.id, 0) order by pos) as ids from (
  select doc_id, split, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select doc_id, split, string_split(lower(text), '') as c from d)) x
  left join cv on cv.token = x.ch group by doc_id, split),
pr as (select split, doc_id, ids[i] as context, ids[i + 1] as token from (
  select split, doc_id, ids, unnest(range(1, len(ids))) as i from enc)),
bg as (select context, token, count(*) as n from pr where split = 0 group by context, token),
cx as (select context, sum(n) as n_c from bg group by context),
uni as (select token, count(*) as n_w from (select unnest(ids) as token from enc where split = 0) group by token),
ntok as (select sum(n_w)::double as n from uni)"""


WORD_CV = """cv as (select token, id from (select '<pad>' as token, 0 as id union all select '<unk>', 1
  union all select '<bos>', 2 union all select '<eos>', 3) union all
  select w, row_number() over (order by w) + 3 from (
    select distinct unnest(""" + DUCK_WORDS + """) as w from d where split = 0)),"""
WORD_ENC = """enc as (select doc_id, split, list(coalesce(cv.id, 1) order by pos) as ids from (
  select doc_id, split, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select doc_id, split, """ + DUCK_WORDS + """ as c from d)) x
  left join cv on cv.token = x.ch group by doc_id, split),"""
WORD_BASE_SQL = BASE_SQL.replace(CHAR_CV, WORD_CV).replace(CHAR_ENC, WORD_ENC)


def score_sql(src: str) -> str:
    """(cnt, logp) for pre-aggregated pairs in ``src`` (context, token, cnt, ...)."""
    return f"""(select s.*, case when cx.n_c is not null
      then ln((coalesce(bg.n, 0) + 1.0) / (cx.n_c + (select v from vs)))
      else ln((coalesce(uni.n_w, 0) + 1.0) / ((select n from ntok) + (select v from vs))) end as logp
    from {src} s left join bg using (context, token) left join cx using (context) left join uni using (token))"""


# --- L1-L12 -----------------------------------------------------------------
@register("l1_ngram_fit", BASE_SQL + "\nselect context::int as context, token::int as token, n::bigint as n from bg")
def l1_ngram_fit(spark, sf_dir):
    m = char_setup(spark, sf_dir).model
    return m.pairs.select(F.col("context").cast("int"), F.col("token").cast("int"), F.col("n").cast("bigint"))


@register("l2_next_token_probs", BASE_SQL + """
select bg.context::int as context, bg.token::int as token, round((n + 1.0) / (n_c + (select v from vs)), 6) as prob, 1::bigint as n_tokens
from bg join cx using (context)
union all select context::int, null, round(1.0 / (n_c + (select v from vs)), 6), ((select v from vs) - s)::bigint
from (select context, count(*) as s, sum(n) as n_c from bg group by context) where s < (select v from vs)""")
def l2_next_token_probs(spark, sf_dir):
    p = char_setup(spark, sf_dir).model.next_token_probs()
    return p.select(F.col("context").cast("int"), F.col("token").cast("int"), F.round("prob", 6).alias("prob"), "n_tokens")


EVAL_SQL = BASE_SQL + f""",
ev as (select context, token, count(*) as cnt from pr where split = 1 group by context, token),
sc as {score_sql('ev')},
ce as (select sum(-logp * cnt) / sum(cnt) as loss, sum(cnt)::bigint as n_pairs from sc),
cpt as (select (select sum(length(text)) from d where split = 1)::double /
               (select sum(len(ids)) from enc where split = 1) as cpt)"""


@register("l3_cross_entropy", EVAL_SQL + "\nselect round(loss, 6) as loss, n_pairs from ce")
def l3_cross_entropy(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    return L.cross_entropy(s.model, s.val).select(F.round("loss", 6).alias("loss"), "n_pairs")


@register("l4_mean_of_batch_means", BASE_SQL + f""",
st as (select id, (row_number() over (order by doc_id, pos) - 1)::bigint as p from (
  select doc_id, generate_subscripts(ids, 1) as pos, unnest(ids) as id from enc where split = 1)),
nt as (select count(*) as n from st),
pw as (select a.p, a.id as context, b.id as token from st a join st b on b.p = a.p + 1),
kw as (select context, token, unnest(range(greatest(0, ceil((p - {CTX - 1}) / {STRIDE})::bigint),
        least(floor(p / {STRIDE})::bigint, (select floor((n - {CTX} - 1) / {STRIDE})::bigint from nt)) + 1)) as k from pw),
ev as (select floor(k / {BATCH})::bigint as batch_id, context, token, count(*) as cnt from kw group by all),
sc as {score_sql('ev')},
pb as (select batch_id, sum(-logp * cnt) as tot, sum(cnt) as cnt from sc group by batch_id)
select round(avg(tot / cnt), 6) as loss, round(sum(tot) / sum(cnt), 6) as token_weighted_loss,
       count(*)::bigint as n_batches from pb""")
def l4_mean_of_batch_means(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    windows = W.ordered_batches(W.packed_windows(s.val, CTX, STRIDE), BATCH, drop_last=False)
    r = L.mean_of_batch_means(s.model, windows)
    return r.select(F.round("loss", 6).alias("loss"), F.round("token_weighted_loss", 6).alias("token_weighted_loss"),
                    "n_batches")


def _eval_row(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    ce = L.cross_entropy(s.model, s.val)
    cpt = W.chars_per_token(s.val.select("doc_id", "text", "ids"))
    return ce.select("loss", cpt.select("chars_per_token").scalar().alias("cpt"))


@register("l5_perplexity", EVAL_SQL + "\nselect round(loss, 6) as loss, round(exp(loss), 6) as perplexity from ce")
def l5_perplexity(spark, sf_dir):
    r = _eval_row(spark, sf_dir)
    return r.select(F.round("loss", 6).alias("loss"), F.round(L.perplexity(F.col("loss")), 6).alias("perplexity"))


@register("l6_bits_per_char", EVAL_SQL + """
select round(cpt, 6) as chars_per_token, round(loss / cpt / ln(2), 6) as bits_per_char from ce, cpt""")
def l6_bits_per_char(spark, sf_dir):
    r = _eval_row(spark, sf_dir)
    return r.select(F.round("cpt", 6).alias("chars_per_token"),
                    F.round(L.bits_per_char(F.col("loss"), F.col("cpt")), 6).alias("bits_per_char"))


def step_log(spark, sf_dir):
    """events as a step log: step = event_id + 1, loss = value."""
    e = read_table(spark, sf_dir, "events", "event_id", "value")
    return e.select((F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"))


@register("l7_interval_train_loss", """
select ceil((event_id + 1) / 100)::bigint as interval, max(event_id + 1)::bigint as eval_step,
       round(avg(value), 6) as train_loss, count(*)::bigint as steps from events group by 1""")
def l7_interval_train_loss(spark, sf_dir):
    r = L.interval_train_loss(step_log(spark, sf_dir), K.EVAL_EVERY)
    return r.select("interval", "eval_step", F.round("train_loss", 6).alias("train_loss"), "steps")


@register("l8_best_checkpoint", """
select step, val_loss, (prev is null or val_loss < prev) as improved from (
  select (event_id + 1)::bigint as step, value as val_loss,
         min(value) over (order by event_id rows between unbounded preceding and 1 preceding) as prev from events)""")
def l8_best_checkpoint(spark, sf_dir):
    log = step_log(spark, sf_dir).select(F.col("step").cast("bigint"), F.col("loss").alias("val_loss"))
    return L.best_checkpoints(log)


def eval_tail(base: str) -> str:
    return base + f""",
ev as (select context, token, count(*) as cnt from pr where split = 1 group by context, token),
sc as {score_sql('ev')},
ce as (select sum(-logp * cnt) / sum(cnt) as loss, sum(cnt)::bigint as n_pairs from sc),
cpt as (select (select sum(length(text)) from d where split = 1)::double /
               (select sum(len(ids)) from enc where split = 1) as cpt)"""


L9_ROW = """select '{kind}' as tokenizer, round(loss, 6) as loss, round(cpt, 6) as chars_per_token,
       round(loss / cpt / ln(2), 6) as bits_per_char from ce, cpt"""


@register("l9_compare_tokenizers",
          "select * from (" + eval_tail(BASE_SQL) + "\n" + L9_ROW.format(kind="char") + ") union all select * from ("
          + eval_tail(WORD_BASE_SQL) + "\n" + L9_ROW.format(kind="word") + ")")
def l9_compare_tokenizers(spark, sf_dir):
    """Same held-out text, char and word tokenizers (each fitted on the train
    side): compared by bits per character, not loss per token."""
    rows = []
    split = W.contiguous_split(documents(spark, sf_dir), K.VAL_RATIO)
    train_txt = split.where("split = 0").select("doc_id", "text")
    val_txt = split.where("split = 1").select("doc_id", "text")
    for kind, cls in (("char", E.CharTokenizer), ("word", E.WordTokenizer)):
        tok = cls.train(train_txt)
        model = L.fit_ngram(tok.encode(train_txt), tok.vocab.count())
        val = tok.encode(val_txt)
        ce = L.cross_entropy(model, val)
        cpt = W.chars_per_token(val.select("doc_id", "text", "ids")).select("chars_per_token").scalar()
        rows.append(ce.select(F.lit(kind).alias("tokenizer"), F.round("loss", 6).alias("loss"),
                              F.round(cpt, 6).alias("chars_per_token"),
                              F.round(L.bits_per_char(F.col("loss"), cpt), 6).alias("bits_per_char")))
    return rows[0].unionByName(rows[1])


@register("l10_parity_check", BASE_SQL + """,
sc as (select context, n, ln((n + 1.0) / (n_c + (select v from vs))) as a,
         case when context % 2 = 0 then ln((2 * n + 1.0) / (2 * n_c + (select v from vs)))
              else ln((n + 1.0) / (n_c + (select v from vs))) end as b from bg join cx using (context))
select 0.0::double as max_abs_diff, true as within_tolerance, count(*)::bigint as n_scores, true as saved,
       round(max(abs(a - b)), 6) as bad_diff, max(abs(a - b)) > 0.001 as bad_refused from sc""")
def l10_parity_check(spark, sf_dir):
    """A model is saved only if its scores agree, within the tolerance, with scores counted from the tokens in another
    way: the right one is; one with the counts of every even context doubled is refused, and nothing of it can be seen."""
    s = char_setup(spark, sf_dir)
    m = s.model
    want = reliable_checkpoint(L.counted_scores(s.train, m.vocab_size, m.alpha))  # read by each save and comparison
    path = os.path.join(ensure_checkpoint_dir(spark), f"parity-{uuid.uuid4().hex}")
    store.save_model(m, os.path.join(path, "good"), scores=want)
    good = L.score_difference(store.load_model(spark, os.path.join(path, "good"))[0], want)
    bad = dataclasses.replace(m, pairs=m.pairs.withColumn("n", F.when(F.col("context") % 2 == 0, 2 * F.col("n")).otherwise(F.col("n"))))
    try:
        store.save_model(bad, os.path.join(path, "bad"), scores=want)
        refused = False
    except ValueError:
        refused = True
    try:
        store.load_model(spark, os.path.join(path, "bad"))
        refused = False
    except FileNotFoundError:
        pass
    contexts = bad.pairs.groupBy("context").agg(F.sum("n").alias("n_c"))
    worse = L.score_difference(dataclasses.replace(bad, contexts=contexts), want)
    return spark.createDataFrame(
        [(round(good[0], 6), good[0] <= K.PARITY_TOLERANCE, good[1], True, round(worse[0], 6), refused)],
        "max_abs_diff double, within_tolerance boolean, n_scores bigint, saved boolean, bad_diff double, bad_refused boolean")


@register("l11_uniform_baseline", BASE_SQL + """
select v::bigint as vocab_size, round(ln(v), 6) as loss, round(v, 6) as perplexity from vs""")
def l11_uniform_baseline(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    v = s.tok.vocab.agg(F.count(F.lit(1)).alias("vocab_size"))
    loss, ppl = L.uniform_baseline(F.col("vocab_size"))
    return v.select(F.col("vocab_size").cast("bigint"), F.round(loss, 6).alias("loss"), F.round(ppl, 6).alias("perplexity"))


@register("l12_model_summary", EVAL_SQL + f"""
select ((select count(*) from bg) + (select count(*) from uni))::bigint as parameters,
       (select v from vs)::bigint as vocab_size, 1 as context_tokens, round(loss, 6) as val_loss,
       {K.MAX_NEW_TOKENS} as max_new_tokens, {K.TEMPERATURE}::double as temperature, {K.TOP_K} as top_k,
       {K.MAX_NEW_TOKENS_LIMIT} as max_new_tokens_limit, {K.MAX_PROMPT_CHARS} as max_prompt_chars from ce""")
def l12_model_summary(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    params = s.model.pairs.select(F.count(F.lit(1))).scalar() + s.model.unigrams.select(F.count(F.lit(1))).scalar()
    ce = L.cross_entropy(s.model, s.val)
    return ce.select(params.cast("bigint").alias("parameters"), F.lit(s.V).cast("bigint").alias("vocab_size"),
                     F.lit(1).alias("context_tokens"), F.round("loss", 6).alias("val_loss"),
                     F.lit(K.MAX_NEW_TOKENS).alias("max_new_tokens"), F.lit(K.TEMPERATURE).alias("temperature"),
                     F.lit(K.TOP_K).alias("top_k"), F.lit(K.MAX_NEW_TOKENS_LIMIT).alias("max_new_tokens_limit"),
                     F.lit(K.MAX_PROMPT_CHARS).alias("max_prompt_chars"))


# --- G1-G15 -----------------------------------------------------------------
CANDS_SQL = f""",
cand as (select context, token, ln((n + 1.0) / (n_c + (select v from vs))) as logp, 1 as m from bg join cx using (context)
  union all select -1, token, ln((n_w + 1.0) / ((select n from ntok) + (select v from vs))), 1 from uni
  union all select context, null, ln(1.0 / (n_c + (select v from vs))), (select v from vs) - s
  from (select context, count(*) as s, sum(n) as n_c from bg group by context) where s < (select v from vs)
  union all select -1, null, ln(1.0 / ((select n from ntok) + (select v from vs))), (select v from vs) - (select count(*) from uni)
  where (select count(*) from uni) < (select v from vs))"""


@register("g3_softmax", BASE_SQL + CANDS_SQL + f""",
f as (select context, token, m, logp / {K.TEMPERATURE} as l,
        rank() over (partition by context order by logp / {K.TEMPERATURE} desc) as r from cand),
k as (select context, token, m, l from f where r <= {K.TOP_K}),
e as (select context, token, m, exp(l - max(l) over (partition by context)) as e from k)
select context::int as context, token::int as token, round(e / sum(e * m) over (partition by context), 6) as prob, m::bigint as n_tokens
from e""")
def g3_softmax(spark, sf_dir):
    """Temperature 0.8, top-k 40 (ties kept), renormalized, per context."""
    m = char_setup(spark, sf_dir).model
    d = G.filtered_distribution(G.candidates(m), K.TEMPERATURE, K.TOP_K)
    return d.select(F.col("context").cast("int"), F.col("token").cast("int"), F.round("prob", 6).alias("prob"), "n_tokens")


@register("g5_greedy", BASE_SQL + CANDS_SQL + """
select context::int as context, token::int as token from (
  select context, token, row_number() over (partition by context order by logp desc, token nulls last) as r from cand)
where r = 1""")
def g5_greedy(spark, sf_dir):
    g = G.greedy_next(G.candidates(char_setup(spark, sf_dir).model))
    return g.select(F.col("context").cast("int"), F.col("token").cast("int"))


def prompts(spark, sf_dir, max_new=GREEDY_STEPS, temperature=0.0, top_k=0, seed=None, stop=False):
    s = char_setup(spark, sf_dir)
    p = s.tok.encode(benchmark(spark, sf_dir).withColumnRenamed("item_id", "pid"), key_cols=("pid",))
    stop_ids = s.tok.newline_token_ids().agg(F.collect_list(F.col("id").cast("int")).alias("s")).select("s") \
        .scalar() if stop else F.lit(None).cast("array<int>")
    return p.select("pid", "text", "ids", F.lit(max_new).alias("max_new_tokens"),
                    F.lit(float(temperature)).alias("temperature"), F.lit(top_k).alias("top_k"),
                    F.lit(seed).cast("bigint").alias("seed"), stop_ids.alias("stop_ids"))


GREEDY_CHAIN_SQL = BASE_SQL + CANDS_SQL + """,
gn as (select context, token from (
  select context, token, row_number() over (partition by context order by logp desc, token nulls last) as r from cand) where r = 1),
p0 as (select item_id as pid, list(coalesce(cv.id, 0) order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select item_id, string_split(lower(text), '') as c from benchmark)) x
  left join cv on cv.token = x.ch group by item_id),
""" + ",\n".join(
    f"""p{i + 1} as (select pid, list_append(ids, coalesce(
      (select token from gn where gn.context = ids[-1] and ids[-1] in (select context from cx)),
      (select token from gn where gn.context = -1))::int) as ids from p{i})""" for i in range(GREEDY_STEPS))


def stop_chain_sql(source_sql: str, steps: int) -> str:
    """Greedy rounds with newline stop ids: q0 = (pid, ids, n0) from ``source_sql``;
    a row stops after a newline-token or when ``steps`` tokens are new."""
    chain = [f"""gn as (select context, token from (
  select context, token, row_number() over (partition by context order by logp desc, token nulls last) as r from cand) where r = 1),
stops as materialized (select id from cv where contains(token, chr(10))),
q0 as (select pid, ids, len(ids) as n0, false as done from ({source_sql}))"""]
    for i in range(steps):
        chain.append(f"""q{i + 1} as (select pid, n0, case when done then ids else list_append(ids, nxt) end as ids,
      done or nxt in (select id from stops) or len(ids) + 1 - n0 >= {steps} as done from (
    select q.*, coalesce((select token from gn where gn.context = q.ids[-1] and q.ids[-1] in (select context from cx)),
                         (select token from gn where gn.context = -1))::int as nxt from q{i} q))""")
    return BASE_SQL + CANDS_SQL + ",\n" + ",\n".join(chain)


BENCH_PROMPTS_SQL = """select item_id as pid, list(coalesce(cv.id, 0) order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select item_id, string_split(lower(text), '') as c from benchmark)) x
  left join cv on cv.token = x.ch group by item_id"""

CHAT_PROMPTS_SQL = f"""select item_id as pid, list(coalesce(cv.id, 0) order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select item_id, string_split(lower('User: ' || trim(regexp_replace(text, '\\s+', ' ', 'g')) || chr(10) || 'Bot:'), '') as c
        from benchmark)) x
  left join cv on cv.token = x.ch group by item_id"""

STOP_STEPS = 32


@register("g6_generate", GREEDY_CHAIN_SQL + f"\nselect pid, ids, {GREEDY_STEPS} as new_tokens from p{GREEDY_STEPS}")
def g6_generate(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    return G.generate(s.model, prompts(spark, sf_dir))


@register("g9_continue_text", GREEDY_CHAIN_SQL + f"""
select pid, string_agg(cv.token, '' order by pos) as text from (
  select pid, generate_subscripts(ids, 1) as pos, unnest(ids) as id from p{GREEDY_STEPS}) x
join cv using (id) group by pid""")
def g9_continue_text(spark, sf_dir):
    s = char_setup(spark, sf_dir)
    out = G.generate(s.model, prompts(spark, sf_dir))
    return s.tok.decode(out, "ids", "text").select("pid", "text")


@register("g15_result_record", GREEDY_CHAIN_SQL + f""",
dec as (select pid, string_agg(cv.token, '' order by pos) as text from (
  select pid, generate_subscripts(ids, 1) as pos, unnest(ids) as id from p{GREEDY_STEPS}) x
  join cv using (id) group by pid),
shown as (select pid, string_agg(cv.token, '' order by pos) as prompt from (
  select pid, generate_subscripts(ids, 1) as pos, unnest(ids) as id from p0) x join cv using (id) group by pid)
select pid, prompt, substr(text, length(prompt) + 1) as continuation, {GREEDY_STEPS} as new_tokens
from dec join shown using (pid)""")
def g15_result_record(spark, sf_dir):
    """Continue-mode records: the decoded prompt (unknown characters shown as
    <unk>), the text after it, and the requested token count."""
    s = char_setup(spark, sf_dir)
    p = prompts(spark, sf_dir)
    out = G.generate(s.model, p).join(p.select("pid", F.col("ids").alias("prompt_ids"), "max_new_tokens"), "pid")
    out = s.tok.decode(s.tok.decode(out, "prompt_ids", "prompt"), "ids", "text")
    return out.select("pid", "prompt", F.substring("text", F.length("prompt") + 1, F.lit(1 << 30)).alias("continuation"),
                      F.col("max_new_tokens").alias("new_tokens"))


@register("g8_stop_ids", stop_chain_sql(BENCH_PROMPTS_SQL, STOP_STEPS) + f"""
select pid, ids, (len(ids) - n0)::int as new_tokens from q{STOP_STEPS}""")
def g8_stop_ids(spark, sf_dir):
    """Greedy with the newline ids as stop tokens: a row ends right after its
    first generated newline token (kept)."""
    s = char_setup(spark, sf_dir)
    return G.generate(s.model, prompts(spark, sf_dir, max_new=32, stop=True))


def shares_sql(settings: str) -> str:
    """``shr``: for each row (temp, topk) of ``settings`` and each context the ids in the order of
    draws (observed successors by id, then the other ids by id) with their share of [0, 1)."""
    return f"""
ctxs as materialized (select context, n_c::double as n_c, (select v from vs) as v from cx union all select -1, (select n from ntok), (select v from vs)),
allp as materialized (select c.context, cv.id as token, case when c.context = -1 then coalesce(uni.n_w, 0) else coalesce(bg.n, 0) end as n
  from ctxs c cross join cv left join bg on bg.context = c.context and bg.token = cv.id left join uni on uni.token = cv.id),
rk as (select s.temp, s.topk, a.*, rank() over (partition by s.temp, s.topk, context order by n desc) as r from allp a cross join {settings} s
       where s.temp > 0),
wt as (select temp, topk, context, token, n, exp(ln(n + 1.0) / temp) as w from rk where topk <= 0 or r <= topk),
cw as (select temp, topk, context, token, n, sum(w) over (partition by temp, topk, context order by (n > 0) desc, token
         rows between unbounded preceding and current row) as hi, sum(w) over (partition by temp, topk, context) as total from wt),
shr as materialized (select temp, topk, context, list(token order by (n > 0) desc, token) as toks, list(hi / total order by (n > 0) desc, token) as his from cw group by all)"""


def draws_sql(requests: str) -> str:
    """``toks_out`` (pid, new): the tokens drawn for ``requests`` (pid, ids, mnt, temp, topk, seed, chat). Stops
    are newline tokens, for chat requests only."""
    return f"""
rq as materialized (select pid, ids[-1] as last, mnt, temp, topk, chat,
         md5(coalesce(seed::varchar, '-') || ':' || array_to_string(ids, ',')) as key from {requests}),
gn as materialized (select context, token from (
  select context, token, row_number() over (partition by context order by logp desc, token nulls last) as r from cand) where r = 1),
stops as materialized (select list(id) as ids from cv where contains(token, chr(10))),
walk as (select pid, 0 as step, last as token, mnt, temp, topk, chat, key, false as done from rq
  union all
  select pid, step + 1, nxt, mnt, temp, topk, chat, key, step + 1 >= mnt or (chat and list_contains(coalesce((select ids from stops), []), nxt)) from (
    select w.*, case when w.temp = 0 then g.token else
        toks[least(len(list_filter(his, lambda x: x <= ('0x' || left(md5(key || ':' || step), 13))::bigint / 4503599627370496.0)) + 1, len(toks))] end::int as nxt
    from walk w join ctxs c on c.context = case when w.token in (select context from ctxs) then w.token else -1 end
    left join gn g on g.context = c.context
    left join shr s on s.context = c.context and s.temp = w.temp and s.topk = w.topk
    where not done and w.step < w.mnt)),
toks_out as (select pid, list(token order by step) filter (where step > 0) as new from walk group by pid)"""


@register("g4_sample", BASE_SQL.replace("with d0", "with recursive d0", 1) + CANDS_SQL + f""",
st as (select {K.TEMPERATURE}::double as temp, {K.TOP_K} as topk),
{shares_sql('st')},
p0 as ({BENCH_PROMPTS_SQL}),
{draws_sql(f"(select pid, ids, 16 as mnt, {K.TEMPERATURE}::double as temp, {K.TOP_K} as topk, 7 as seed, false as chat from p0)")}
select pid, list_transform(list_concat(p0.ids, t.new), lambda x: x::int) as ids, 16 as new_tokens from p0 join toks_out t using (pid)""")
def g4_sample(spark, sf_dir):
    """Seeded temperature 0.8 / top-k 40 sampling, 16 new tokens per prompt."""
    s = char_setup(spark, sf_dir)
    return G.generate(s.model, prompts(spark, sf_dir, 16, K.TEMPERATURE, K.TOP_K, seed=7))


@register("g11_seed", """
select count(*)::bigint as n, count(*)::bigint as same, 2::bigint as copies from benchmark""")
def g11_seed(spark, sf_dir):
    """Every prompt asked twice under different ids (and so on different partitions), with
    the same seed and settings: the texts are equal."""
    s = char_setup(spark, sf_dir)
    p = prompts(spark, sf_dir, 16, K.TEMPERATURE, K.TOP_K, seed=11)
    twice = p.withColumn("pid", 2 * F.col("pid")).unionByName(p.withColumn("pid", 2 * F.col("pid") + 1))
    out = G.generate(s.model, twice).groupBy(F.floor(F.col("pid") / 2).alias("item")).agg(
        F.count(F.lit(1)).alias("copies"), (F.min("ids") == F.max("ids")).alias("same"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("same").cast("int")).cast("bigint").alias("same"),
                   F.max("copies").alias("copies"))


@register("g10_chat_reply", stop_chain_sql(CHAT_PROMPTS_SQL, STOP_STEPS) + f""",
nw as (select pid, n0, ids, generate_subscripts(ids, 1) as pos, unnest(ids) as id from q{STOP_STEPS}),
dec as (select pid, string_agg(cv.token, '' order by pos) as t, any_value(len(ids) - n0) as k
        from nw join cv using (id) where pos > n0 group by pid)
select pid, {duck.strip_py("split_part(t, chr(10), 1)")} as reply, k::int as new_tokens from dec""")
def g10_chat_reply(spark, sf_dir):
    """Chat mode: wrap as a User/Bot prompt, stop at a newline token, keep the
    first line of the reply."""
    s = char_setup(spark, sf_dir)
    msgs = benchmark(spark, sf_dir).select(F.col("item_id").alias("pid"), wrap_chat_prompt("text").alias("text"))
    enc = s.tok.encode(msgs, key_cols=("pid",))
    stop = s.tok.newline_token_ids().agg(F.collect_list(F.col("id").cast("int"))).scalar()
    p = enc.select("pid", "ids", F.lit(32).alias("max_new_tokens"), F.lit(0.0).alias("temperature"),
                   F.lit(0).alias("top_k"), F.lit(None).cast("bigint").alias("seed"), stop.alias("stop_ids"))
    out = G.generate(s.model, p).join(enc.select("pid", F.size("ids").alias("n_prompt")), "pid")
    new_ids = F.slice("ids", F.col("n_prompt") + 1, 1 << 20)
    return s.tok.decode(out, new_ids, "new_text").select(
                      "pid", first_line_reply("new_text").alias("reply"),
                      (F.size("ids") - F.col("n_prompt")).alias("new_tokens"))


@register("g12_reject_empty", f"""with cv as (select '<unk>' as token, 0 as id)
select item_id as pid, case when length(regexp_replace(text, '[^0-9]', '', 'g')) = 0
       then '{K.MSG_EMPTY_TOKENS}' end as error from benchmark""")
def g12_reject_empty(spark, sf_dir):
    """Digits-only prompts derived from the benchmark: most are empty."""
    s = char_setup(spark, sf_dir)
    p = benchmark(spark, sf_dir).select(F.col("item_id").alias("pid"),
                                        F.regexp_replace("text", "[^0-9]", "").alias("text"))
    enc = s.tok.encode(p, key_cols=("pid",))
    return G.reject_empty(enc).select("pid", "error")


@register("g14_prompt_file_prep", """
select ord, prompt from (
  select conv_id * 1000000 + turn * 1000 + (generate_subscripts(l, 1) - 1) as ord,
         replace(unnest(l), '\\n', chr(10)) as prompt
  from (select conv_id, turn, string_split(text, chr(10)) as l from conversations))
where regexp_replace(prompt, '\\s', '', 'g') <> ''""")
def g14_prompt_file_prep(spark, sf_dir):
    """Lines of the conversations as a prompt script (no quit line in the data)."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    lines = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    lines = lines.select((F.col("conv_id") * 1000000 + F.col("turn") * 1000 + F.col("i")).alias("ord"), "line")
    return G.prompt_file_prep(lines)


@register("g1_temperature", BASE_SQL + CANDS_SQL + f"""
select context::int as context, token::int as token, round(logp / {K.TEMPERATURE}, 6) as logit, m::bigint as n_tokens from cand""")
def g1_temperature(spark, sf_dir):
    c = G.candidates(char_setup(spark, sf_dir).model)
    return c.select(F.col("context").cast("int"), F.col("token").cast("int"),
                    F.round(F.col("logp") / F.lit(K.TEMPERATURE), 6).alias("logit"), "n_tokens")


@register("g2_top_k_filter", BASE_SQL + CANDS_SQL + """
select context::int as context, token::int as token from (
  select context, token, rank() over (partition by context order by logp desc) as r from cand) where r <= 3""")
def g2_top_k_filter(spark, sf_dir):
    """k = 3: every token whose score ties the third best stays."""
    c = G.filtered_distribution(G.candidates(char_setup(spark, sf_dir).model), 1.0, 3)
    return c.select(F.col("context").cast("int"), F.col("token").cast("int"))


@register("g7_crop_context", GREEDY_CHAIN_SQL + "\nselect pid, ids[-1]::int as context, list_transform(ids[-3:], lambda i: i::int) as four_gram_context from p0")
def g7_crop_context(spark, sf_dir):
    """What a bigram model and a 4-gram model look at: the last token, the last three tokens of each prompt."""
    p = prompts(spark, sf_dir)
    return p.select("pid", F.get(G.crop_context("ids"), F.lit(0)).cast("int").alias("context"),
                    G.crop_context("ids", 4).alias("four_gram_context"))


@register("t10_continuation_after_prompt", BASE_SQL + """,
sh as (select conv_id, string_agg(coalesce(cv.token, '<unk>'), '' order by pos) as shown from (
  select conv_id, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select conv_id, string_split(lower(text), '') as c from conversations where turn = 0)) x
  left join cv on cv.token = x.ch group by conv_id)
select conv_id, shown, text as continuation from conversations join sh using (conv_id) where turn = 1""")
def t10_continuation_after_prompt(spark, sf_dir):
    """The shown prompt is the *decoded* first turn (unknown characters appear as
    <unk>); the continuation is what follows it in prompt + second turn."""
    from ..functions.text import continuation_after_prompt
    s = char_setup(spark, sf_dir)
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    first = s.tok.encode(c.where("turn = 0").select("conv_id", "text"), key_cols=("conv_id",))
    shown = s.tok.decode(first, "ids", "shown").select("conv_id", "shown")
    second = c.where("turn = 1").select("conv_id", F.col("text").alias("reply"))
    j = shown.join(second, "conv_id")
    return j.select("conv_id", "shown", continuation_after_prompt(F.concat("shown", "reply"), F.col("shown"))
                    .alias("continuation"))
