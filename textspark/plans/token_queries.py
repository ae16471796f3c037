"""Registered queries: vocabularies, BPE training and encoding/decoding (V*, E*).

Oracle SQL for BPE is a generated chain of CTEs, one merge per step, so the
checked merge count stays small (16); larger counts are covered by the
batched-vs-sequential differential test.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import bpe as B
from ..operators import encode as E
from ..operators import pretok
from ..operators import vocab as V
from ..sources.tables import benchmark, documents
from .pretok_queries import DUCK_CHUNKS, DUCK_WORDS
from .registry import register

ORACLE_MERGES = 16
SPECIALS_SQL = " union all ".join(f"select '{t}' as token, {i} as id" for i, t in enumerate(K.SPECIAL_TOKENS))


def bpe_chain_sql(k: int) -> str:
    """CTEs s0..s_k (wrapped chunk types) and b0..b_{k-1} (the merge of each step)."""
    ctes = [f"""ch as materialized (select chunk, count(*)::bigint as freq
      from (select unnest({DUCK_CHUNKS}) as chunk from documents) group by chunk)""",
            """s0 as materialized (select chunk, freq,
      chr(2) || array_to_string(string_split(chunk, ''), chr(3) || chr(2)) || chr(3) as w from ch)"""]
    for i in range(k):
        ctes.append(f"""b{i} as materialized (select a, b, sum(freq)::bigint as n from (
      select freq, syms[j] as a, syms[j + 1] as b from (
        select freq, syms, unnest(range(1, len(syms))) as j from (
          select freq, string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) as syms from s{i})))
      group by a, b order by n desc, a, b limit 1)""")
        ctes.append(f"""s{i + 1} as materialized (select chunk, freq, coalesce(replace(w,
      (select chr(2) || a || chr(3) || chr(2) || b || chr(3) from b{i}),
      (select chr(2) || a || b || chr(3) from b{i})), w) as w from s{i})""")
    merges = " union all ".join(f"select {i} as rank, a, b, n from b{i}" for i in range(k)) or \
        "select 0 as rank, '' as a, '' as b, 0::bigint as n where false"
    ctes.append(f"mg as ({merges})")
    ctes.append("""base as (select distinct unnest(string_split(chunk, '')) as token from ch)""")
    ctes.append(f"""voc as (select token, id::bigint as id from ({SPECIALS_SQL}) union all
      select token, (row_number() over (order by token) + 3)::bigint as id from (
        select token from base union select a || b from mg))""")
    return "with " + ",\n".join(ctes)


@lru_cache(maxsize=None)
def _chain(k: int) -> str:
    return bpe_chain_sql(k)


# --- vocabularies -----------------------------------------------------------
@register("v1_char_vocab", """
select '<unk>' as token, 0::bigint as id
union all
select ch as token, row_number() over (order by ch)::bigint as id
from (select distinct unnest(string_split(lower(text), '')) as ch from documents where length(text) > 0)""")
def v1_char_vocab(spark, sf_dir):
    v = V.char_vocab(documents(spark, sf_dir))
    return v.select("token", F.col("id").cast("bigint"))


@register("v2_word_vocab", f"""
select token, id::bigint as id from ({SPECIALS_SQL})
union all
select w as token, (row_number() over (order by w) + 3)::bigint as id
from (select distinct unnest({DUCK_WORDS}) as w from documents)""")
def v2_word_vocab(spark, sf_dir):
    return V.word_vocab(documents(spark, sf_dir)).select("token", F.col("id").cast("bigint"))


@register("v3_base_symbols", f"""
select distinct unnest(string_split(c, '')) as token
from (select unnest({DUCK_CHUNKS}) as c from documents)""")
def v3_base_symbols(spark, sf_dir):
    return V.base_symbols(pretok.chunk_frequencies(documents(spark, sf_dir)))


@register("v4_pair_counts", _chain(0) + """
select a, b, sum(freq)::bigint as n from (
  select freq, syms[j] as a, syms[j + 1] as b from (
    select freq, syms, unnest(range(1, len(syms))) as j from (
      select freq, string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) as syms from s0)))
group by a, b""")
def v4_pair_counts(spark, sf_dir):
    return B.pair_counts(B.chunk_types(pretok.chunk_frequencies(documents(spark, sf_dir))))


@register("v5_best_pair", _chain(1) + "\nselect a, b, n from b0")
def v5_best_pair(spark, sf_dir):
    return B.best_pairs(B.pair_counts(B.chunk_types(pretok.chunk_frequencies(documents(spark, sf_dir)))))


@register("v6_merge_pair", _chain(1) + """
select chunk, string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) as symbols from s1""")
def v6_merge_pair(spark, sf_dir):
    types = B.chunk_types(pretok.chunk_frequencies(documents(spark, sf_dir)))
    best = B.best_pairs(B.pair_counts(types)).first()
    return types.select("chunk", B.symbols_of(B.apply_merge(F.col("w"), best["a"], best["b"])).alias("symbols"))


@lru_cache(maxsize=None)
def _trained(spark, sf_dir, k):
    return E.BpeTokenizer.train(documents(spark, sf_dir), k)


def trained_bpe(spark, sf_dir, k=ORACLE_MERGES):
    return _trained(spark, sf_dir, k)


@register("v7_bpe_train", _chain(ORACLE_MERGES) + "\nselect rank, a, b, n from mg")
def v7_bpe_train(spark, sf_dir):
    tok = trained_bpe(spark, sf_dir)
    return tok.merges.select(F.col("rank").cast("int"), "a", "b", "n")


@register("v7_bpe_train_full")
def v7_bpe_train_full(spark, sf_dir):
    """All 4,000 merges of the default setting."""
    model = B.train_bpe(pretok.chunk_frequencies(documents(spark, sf_dir)), K.NUM_MERGES)
    return model.merges.select(F.col("rank").cast("int"), "a", "b", "n")


@register("v8_bpe_vocab", _chain(ORACLE_MERGES) + "\nselect token, id from voc")
def v8_bpe_vocab(spark, sf_dir):
    return trained_bpe(spark, sf_dir).vocab.select("token", F.col("id").cast("bigint"))


@register("v9_vocab_size", _chain(ORACLE_MERGES) + """
select (select count(*) from voc)::bigint as vocab_size, (select count(*) from mg)::bigint as merges,
       (select a || b from mg where rank = 0) as first_merge""")
def v9_vocab_size(spark, sf_dir):
    tok = trained_bpe(spark, sf_dir)
    size = tok.vocab.select(F.count(F.lit(1))).scalar()
    return tok.merges.agg(
        size.cast("bigint").alias("vocab_size"),
        F.count(F.lit(1)).cast("bigint").alias("merges"),
        F.min_by(F.concat("a", "b"), "rank").alias("first_merge"))


# --- encoding ---------------------------------------------------------------
CHAR_VOCAB_SQL = """cv as (select '<unk>' as token, 0 as id union all
  select ch, row_number() over (order by ch) from (
    select distinct unnest(string_split(lower(text), '')) as ch from documents where length(text) > 0))"""


@register("e1_char_encode", f"""with {CHAR_VOCAB_SQL}
select item_id, list(coalesce(cv.id, 0)::int order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as ch
  from (select item_id, string_split(lower(text), '') as c from benchmark)) x
left join cv on cv.token = x.ch group by item_id""")
def e1_char_encode(spark, sf_dir):
    tok = E.CharTokenizer.train(documents(spark, sf_dir))
    return tok.encode(benchmark(spark, sf_dir), key_cols=("item_id",)).select("item_id", "ids")


WORD_VOCAB_SQL = f"""wv as (select token, id from ({SPECIALS_SQL}) union all
  select w, row_number() over (order by w) + 3 from (select distinct unnest({DUCK_WORDS}) as w from documents))"""


@register("e2_word_encode", f"""with {WORD_VOCAB_SQL}
select item_id, list(coalesce(wv.id, 1)::int order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as token
  from (select item_id, {DUCK_WORDS.replace('text', 'text')} as c from benchmark)) x
left join wv using (token) group by item_id""")
def e2_word_encode(spark, sf_dir):
    tok = E.WordTokenizer.train(documents(spark, sf_dir))
    return tok.encode(benchmark(spark, sf_dir), key_cols=("item_id",)).select("item_id", "ids")


E3_SQL = _chain(ORACLE_MERGES) + f""",
occ as (select doc_id, generate_subscripts(c, 1) as pos, unnest(c) as chunk from (
  select doc_id, {DUCK_CHUNKS} as c from documents)),
sy as (select chunk, generate_subscripts(s, 1) as sp, unnest(s) as token from (
  select chunk, string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) as s from s{ORACLE_MERGES}))
select doc_id, list(voc.id::int order by pos, sp) as ids
from occ join sy using (chunk) join voc using (token) group by doc_id"""


@register("e3_bpe_encode", E3_SQL)
def e3_bpe_encode(spark, sf_dir):
    """Only an empty text has no ids; a filter on the ids would have every text encoded twice."""
    tok = trained_bpe(spark, sf_dir)
    return tok.encode(documents(spark, sf_dir).where(F.length("text") > 0)).select("doc_id", "ids")


@register("e4_decode_concat", """
select doc_id, text as decoded from documents where length(text) > 0""")
def e4_decode_concat(spark, sf_dir):
    """BPE decode of the BPE encoding: every character is known, so the text comes back."""
    tok = trained_bpe(spark, sf_dir)
    enc = tok.encode(documents(spark, sf_dir).where(F.length("text") > 0))
    return tok.decode(enc, "ids", "decoded").select("doc_id", "decoded")


def _word_decode_sql(ids_src: str) -> str:
    glue = ", ".join("'" + t.replace("'", "''") + "'" for t in K.NO_SPACE_BEFORE)
    return f"""select item_id, string_agg(case when pos = 1 or token in ({glue}) then token else ' ' || token end, ''
       order by pos) as decoded
from (select item_id, generate_subscripts(ids, 1) as pos, unnest(ids) as id from {ids_src}) x
join wv using (id) group by item_id"""


E2_IDS = f"""(select item_id, list(coalesce(wv.id, 1) order by pos) as ids from (
  select item_id, generate_subscripts(c, 1) as pos, unnest(c) as token
  from (select item_id, {DUCK_WORDS} as c from benchmark)) x left join wv using (token) group by item_id)"""


@register("e5_decode_words", f"with {WORD_VOCAB_SQL}\n" + _word_decode_sql(E2_IDS))
def e5_decode_words(spark, sf_dir):
    tok = E.WordTokenizer.train(documents(spark, sf_dir))
    enc = tok.encode(benchmark(spark, sf_dir), key_cols=("item_id",)).where(F.size("ids") > 0)
    return tok.decode(enc, "ids", "decoded", ("item_id",)).select("item_id", "decoded")


EN_CHAR_VOCAB_SQL = """cv as (select '<unk>' as token, 0 as id union all
  select ch, row_number() over (order by ch) from (
    select distinct unnest(string_split(lower(text), '')) as ch from documents where lang = 'en' and length(text) > 0))"""


@register("e7_unk_lookup", f"""with {EN_CHAR_VOCAB_SQL}
select lang, round(avg(case when cv.id is null then 1.0 else 0.0 end), 6) as unk_rate, count(*)::bigint as n_tokens
from (select lang, unnest(string_split(lower(text), '')) as ch from documents where length(text) > 0) x
left join cv on cv.token = x.ch group by lang""")
def e7_unk_lookup(spark, sf_dir):
    """Char vocabulary fitted on English documents only, applied to every
    document: accented characters of the other languages become ``<unk>``."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    tok = E.CharTokenizer.train(docs.where(F.col("lang") == "en"))
    enc = tok.encode(docs)
    per = enc.select("lang", F.explode("ids").alias("id"))
    return per.groupBy("lang").agg(
        F.round(F.avg((F.col("id") == tok.unk_id).cast("double")), 6).alias("unk_rate"),
        F.count(F.lit(1)).cast("bigint").alias("n_tokens"))


@register("e8_exact_round_trip", """
select count(*)::bigint as n_docs, 0::bigint as failures from documents""")
def e8_exact_round_trip(spark, sf_dir):
    tok = trained_bpe(spark, sf_dir)
    enc = tok.encode(documents(spark, sf_dir))
    dec = tok.decode(enc, "ids", "back").select((F.col("back") == F.col("text")).alias("ok"))
    return dec.agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"),
                   F.sum((~F.col("ok")).cast("int")).cast("bigint").alias("failures"))


@register("e9_token_round_trip", f"""with {WORD_VOCAB_SQL}
select count(*)::bigint as n_items, 0::bigint as failures from benchmark""")
def e9_token_round_trip(spark, sf_dir):
    # vocabulary covers the benchmark text, so no <unk> breaks the token round trip
    fit = documents(spark, sf_dir, "text").unionByName(benchmark(spark, sf_dir, "text"))
    tok = E.WordTokenizer.train(fit)
    enc = tok.encode(benchmark(spark, sf_dir), key_cols=("item_id",))
    dec = tok.decode(enc.select("item_id", "ids"), "ids", "text", ("item_id",))
    again = tok.encode(dec.select("item_id", "text", F.col("ids").alias("ids0")), key_cols=("item_id",))
    return again.agg(F.count(F.lit(1)).cast("bigint").alias("n_items"),
                     F.sum((F.col("ids") != F.col("ids0")).cast("int")).cast("bigint").alias("failures"))


@register("e10_newline_token_ids", _chain(ORACLE_MERGES) + """
select id from voc where contains(token, chr(10))""")
def e10_newline_token_ids(spark, sf_dir):
    return trained_bpe(spark, sf_dir).newline_token_ids().select(F.col("id").cast("bigint"))
