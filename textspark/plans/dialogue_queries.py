"""Registered queries: text cleaning and conversation operators (T*, S2-S3, D*).

The provided ``conversations`` table is already clean, so raw DailyDialog-like
input is *derived* from it: punctuation gets a space before it and "er" is
split as a spaced, capitalised contraction ("e ' R"), which gives T3/T4 work.
``documents`` (with 73 exact copies) serve as dialogues for de-duplication:
each line of a document is a turn.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators import dialogue as D
from ..sources.tables import benchmark, conversations, documents
from . import duck
from .registry import register


def respace(col):
    return F.regexp_replace(F.regexp_replace(col, r"([.,?!;:])", " $1"), "er", "e ' R")


DUCK_RESPACE = "regexp_replace(regexp_replace(text, '([.,?!;:])', ' \\1', 'g'), 'er', 'e '' R', 'g')"
DUCK_RAW_TURNS = f"(select conv_id, turn, {DUCK_RESPACE} as text from conversations)"


def raw_turns(spark, sf_dir):
    """Every turn, whatever its role: the layout goes by index parity alone."""
    c = conversations(spark, sf_dir, "conv_id", "turn", "text")
    return c.select("conv_id", "turn", respace(F.col("text")).alias("text"))


# --- T1-T11 -----------------------------------------------------------------
@register("t1_replace_chars", f"select doc_id, {duck.replace_chars('text')} as out from documents")
def t1_replace_chars(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.replace_chars("text").alias("out"))


@register("t2_collapse_whitespace",
          f"select conv_id, turn, {duck.collapse_ws('text')} as out from {DUCK_RAW_TURNS}")
def t2_collapse_whitespace(spark, sf_dir):
    return raw_turns(spark, sf_dir).select("conv_id", "turn", T.collapse_whitespace("text").alias("out"))


@register("t3_rejoin_contractions",
          f"select conv_id, turn, {duck.rejoin_contractions('text')} as out from {DUCK_RAW_TURNS}")
def t3_rejoin_contractions(spark, sf_dir):
    return raw_turns(spark, sf_dir).select("conv_id", "turn", T.rejoin_contractions("text").alias("out"))


@register("t4_fix_punctuation", f"select doc_id, {duck.fix_punct('text')} as out from documents")
def t4_fix_punctuation(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.fix_punctuation("text").alias("out"))


@register("t5_clean_utterance", f"select conv_id, turn, {duck.clean('text')} as out from {DUCK_RAW_TURNS}")
def t5_clean_utterance(spark, sf_dir):
    return raw_turns(spark, sf_dir).select("conv_id", "turn", T.clean_utterance("text").alias("out"))


@register("t6_lowercase", "select doc_id, lower(text) as out from documents")
def t6_lowercase(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.lowercase("text").alias("out"))


@register("t7_wrap_chat_prompt", f"""
select item_id, {duck.lit(K.CHAT_USER_PREFIX + ' ')} || {duck.collapse_ws('text')} || chr(10) || {duck.lit(K.CHAT_BOT_PREFIX)} as out
from benchmark""")
def t7_wrap_chat_prompt(spark, sf_dir):
    return benchmark(spark, sf_dir).select("item_id", T.wrap_chat_prompt("text").alias("out"))


@register("t8_unescape_newlines", """
select conv_id, turn, replace(replace(text, chr(10), '\\n'), '\\n', chr(10)) as out from conversations""")
def t8_unescape_newlines(spark, sf_dir):
    escaped = F.replace(F.col("text"), F.lit("\n"), F.lit("\\n"))
    return conversations(spark, sf_dir).select("conv_id", "turn", T.unescape_newlines(escaped).alias("out"))


@register("t9_first_line_reply", f"""
select conv_id, turn, {duck.strip_py("split_part(text, chr(10), 1)")} as out from conversations""")
def t9_first_line_reply(spark, sf_dir):
    return conversations(spark, sf_dir).select("conv_id", "turn", T.first_line_reply("text").alias("out"))


@register("t11_recent_chats", """
select conv_id,
       substr(regexp_replace(regexp_replace(first_prompt, '[\\s\\x{FEFF}]+', ' ', 'g'), '^ | $', '', 'g'), 1, 40) as title,
       right(last_text, 1000) as tail
from (select conv_id, arg_min(text, turn) filter (where role = 'user') as first_prompt,
             arg_max(text, turn) as last_text
      from conversations group by conv_id)
order by conv_id desc limit 50""")
def t11_recent_chats(spark, sf_dir):
    c = conversations(spark, sf_dir, "conv_id", "turn", "role", "text")
    per = c.groupBy("conv_id").agg(
        F.min_by(F.when(F.col("role") == "user", F.col("text")),
                 F.when(F.col("role") == "user", F.col("turn"))).alias("first_prompt"),
        F.max_by("text", "turn").alias("last_text"))
    return (per.select("conv_id", T.chat_title("first_prompt").alias("title"),
                       T.context_tail("last_text").alias("tail"))
            .orderBy(F.col("conv_id").desc()).limit(50))


# --- S2 / S3 ----------------------------------------------------------------
def raw_dialogue_lines(spark, sf_dir):
    """One raw line per conversation: turns joined with the turn separator."""
    t = raw_turns(spark, sf_dir).select("conv_id", "turn", F.regexp_replace("text", "\n", " ").alias("text"))
    return t.groupBy("conv_id").agg(
        F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))),
                                          lambda s: s["text"]), f" {K.TURN_SEPARATOR} "),
                 F.lit(f" {K.TURN_SEPARATOR}")).alias("line"))


DUCK_RAW_LINES = f"""(select conv_id, string_agg(replace(text, chr(10), ' '), ' {K.TURN_SEPARATOR} ' order by turn)
       || ' {K.TURN_SEPARATOR}' as line from {DUCK_RAW_TURNS} group by conv_id)"""

DUCK_PARSED = f"""(select conv_id, list_filter(list_transform(string_split(line, '{K.TURN_SEPARATOR}'),
       lambda t: {duck.clean('t')}), lambda t: t <> '') as turns from {DUCK_RAW_LINES})"""


@register("s2_parse_dialogue_lines", f"""
select line_no, idx, turn from (
  select conv_id as line_no, (generate_subscripts(turns, 1) - 1)::bigint as idx, unnest(turns) as turn
  from {DUCK_PARSED} where len(turns) >= 2)""")
def s2_parse_dialogue_lines(spark, sf_dir):
    lines = raw_dialogue_lines(spark, sf_dir).withColumnRenamed("conv_id", "line_no")
    parsed = D.parse_dialogue_lines(lines)
    return D.turn_rows(parsed, ("line_no",)).select(
        "line_no", F.col("idx").cast("bigint"), F.col("text").alias("turn"))


@register("s3_union_splits", f"""
select (case when length(line) < 500 then 0 when length(line) < 1500 then 1 else 2 end)::bigint as split_ord,
       count(*)::bigint as conversations, sum(len(turns))::bigint as turns
from (select p.turns, r.line from {DUCK_PARSED} p join {DUCK_RAW_LINES} r using (conv_id))
where len(turns) >= 2 group by 1""")
def s3_union_splits(spark, sf_dir):
    lines = raw_dialogue_lines(spark, sf_dir).withColumnRenamed("conv_id", "line_no")
    # three "files": short, medium and long lines (a partition of every row)
    n = F.length("line")
    parts = [lines.where(n < 500), lines.where((n >= 500) & (n < 1500)), lines.where(n >= 1500)]
    unioned = D.union_splits(*parts)
    parsed = D.parse_dialogue_lines(unioned)
    return parsed.groupBy(F.col("split_ord").cast("bigint").alias("split_ord")).agg(
        F.count(F.lit(1)).alias("conversations"), F.sum(F.size("turns")).cast("bigint").alias("turns"))


# --- D1-D6 ------------------------------------------------------------------
def kept_turns(spark, sf_dir):
    return D.drop_blank_turns(D.clean_turns(raw_turns(spark, sf_dir)))


DUCK_KEPT = f"(select conv_id, turn, text from (select conv_id, turn, {duck.clean('text')} as text from {DUCK_RAW_TURNS}) where text <> '')"
DUCK_KEPT2 = f"(select * from {DUCK_KEPT} where conv_id in (select conv_id from {DUCK_KEPT} group by conv_id having count(*) >= 2))"
DUCK_LINES = f"""(select conv_id, (row_number() over (partition by conv_id order by turn) - 1)::bigint as idx,
  case when (row_number() over (partition by conv_id order by turn) - 1) % 2 = 0
       then '{K.CHAT_USER_PREFIX}' else '{K.CHAT_BOT_PREFIX}' end || ' ' || text as line from {DUCK_KEPT2})"""


@register("d1_drop_blank_turns", f"select conv_id, turn, text from {DUCK_KEPT}")
def d1_drop_blank_turns(spark, sf_dir):
    return kept_turns(spark, sf_dir)


@register("d2_min_turns_filter", f"select conv_id, count(*)::bigint as n_turns from {DUCK_KEPT2} group by conv_id")
def d2_min_turns_filter(spark, sf_dir):
    t = D.min_turns_filter(kept_turns(spark, sf_dir))
    return t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def dialogue_lines(spark, sf_dir):
    return D.format_dialogue(D.min_turns_filter(kept_turns(spark, sf_dir)))


@register("d3_format_dialogue", f"select conv_id, idx, line from {DUCK_LINES}")
def d3_format_dialogue(spark, sf_dir):
    return dialogue_lines(spark, sf_dir)


@register("d4_dedup_exact_first",
          "select min(doc_id) as doc_id, count(*)::bigint as copies from documents group by text")
def d4_dedup_exact_first(spark, sf_dir):
    return D.dedup_texts(documents(spark, sf_dir))


# documents as dialogues: every line of a document is a turn
LB = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
DUCK_DOC_TURNS = f"""(select doc_id, turn, text from (
  select doc_id, (generate_subscripts(l, 1) - 1) as turn, {duck.clean('unnest(l)')} as text from (
    select doc_id, string_split_regex(regexp_replace(text, '(?:{LB})$', ''), '{LB}') as l from documents))
  where text <> '')"""
DUCK_DOC_BLOCKS = f"""(select doc_id, string_agg(case when idx % 2 = 0 then '{K.CHAT_USER_PREFIX}' else '{K.CHAT_BOT_PREFIX}' end
      || ' ' || text, chr(10) order by idx) as block, count(*) as n
  from (select doc_id, text, row_number() over (partition by doc_id order by turn) - 1 as idx from {DUCK_DOC_TURNS})
  group by doc_id having count(*) >= 2)"""


def document_dialogue_lines(spark, sf_dir):
    docs = documents(spark, sf_dir)
    turns = docs.select("doc_id", F.posexplode(T.split_lines("text")).alias("turn", "text"))
    kept = D.min_turns_filter(D.drop_blank_turns(D.clean_turns(turns)), "doc_id")
    return D.format_dialogue(kept, "doc_id", "turn")


@register("d4_dedup_dialogues", f"""
select min(doc_id) as doc_id, count(*)::bigint as copies from {DUCK_DOC_BLOCKS} group by block""")
def d4_dedup_dialogues(spark, sf_dir):
    lines = document_dialogue_lines(spark, sf_dir)
    _, kept = D.dedup_conversations(lines, ["doc_id"], "doc_id")
    return kept.select("doc_id", F.col("copies").cast("bigint"))


@register("d5_assemble_corpus", f"""
with l as {DUCK_LINES},
b as (select conv_id, string_agg(line, chr(10) order by idx) as block from l group by conv_id),
kl as (select * from l where conv_id in (select min(conv_id) from b group by block))
select conv_id, conv_id as conv_ord, idx, line from kl
union all
select distinct conv_id, conv_id, -1::bigint, '' from kl where conv_id > (select min(conv_id) from kl)""")
def d5_assemble_corpus(spark, sf_dir):
    lines = dialogue_lines(spark, sf_dir).withColumn("conv_ord", F.col("conv_id"))
    kept_lines, _ = D.dedup_conversations(lines, ["conv_ord"])
    return D.corpus_lines(kept_lines, "conv_ord")


@register("d6_corpus_summary", f"""
select count(*)::bigint as conversations, (sum(copies) - count(*))::bigint as duplicates,
       (sum(chars) + 2 * (count(*) - 1) + 1)::bigint as characters,
       (sum(n - 1) + 2 * (count(*) - 1) + 1)::bigint as lines
from (select block, count(*) as copies, any_value(length(block)) as chars, any_value(n) as n
      from {DUCK_DOC_BLOCKS} group by block)""")
def d6_corpus_summary(spark, sf_dir):
    lines = document_dialogue_lines(spark, sf_dir)
    kept_lines, kept = D.dedup_conversations(lines, ["doc_id"], "doc_id")
    return D.corpus_summary(kept_lines, kept, "doc_id")
