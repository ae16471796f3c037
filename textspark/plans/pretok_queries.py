"""Registered queries: corpus load and pre-tokenization."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import char_split
from ..operators import pretok
from ..sources import corpus
from ..sources.tables import documents
from .registry import register

# DuckDB (RE2) has no lookahead: a \x01 sentinel before the last whitespace
# character of every run that is followed by a non-space emulates `\s+(?!\S)`.
DUCK_CHUNKS = r"""regexp_extract_all(
  regexp_replace(text, '([\s])([^\s])', chr(1) || '\1\2', 'g'),
  ' ?[\p{L}\p{N}_]+| ?[^\p{L}\p{N}_\s\x01]+|[\s]+')"""

DUCK_WORDS = r"""regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')"""


@register("s1_load_corpus", """
select count(*)::bigint as n_docs, sum(length(text))::bigint as n_chars,
       min(doc_id)::bigint as first_doc, max(doc_id)::bigint as last_doc
from documents
""")
def s1_load_corpus(spark, sf_dir):
    return corpus.corpus_stats(corpus.load_documents(spark, sf_dir))


@register("p1_bpe_chunks", f"""
select doc_id, (generate_subscripts(c, 1) - 1)::bigint as pos, unnest(c) as chunk
from (select doc_id, {DUCK_CHUNKS} as c from documents)
""")
def p1_bpe_chunks(spark, sf_dir):
    return pretok.chunk_occurrences(documents(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


@register("p2_word_split", f"""
select word, count(*)::bigint as freq
from (select unnest({DUCK_WORDS}) as word from documents) group by word
""")
def p2_word_split(spark, sf_dir):
    return pretok.word_frequencies(documents(spark, sf_dir))


@register("p3_char_split", """
select ch, count(*)::bigint as freq
from (select unnest(string_split(text, '')) as ch from documents where length(text) > 0)
group by ch
""")
def p3_char_split(spark, sf_dir):
    return pretok.piece_frequencies(documents(spark, sf_dir), char_split("text"), "ch")


@register("p4_chunk_frequencies", f"""
select chunk, count(*)::bigint as freq
from (select unnest({DUCK_CHUNKS}) as chunk from documents) group by chunk
""")
def p4_chunk_frequencies(spark, sf_dir):
    return pretok.chunk_frequencies(documents(spark, sf_dir))


TOP_CHUNKS_SQL = f"""
select chunk, count(*)::bigint as freq
from (select unnest({DUCK_CHUNKS}) as chunk from documents) group by chunk
order by freq desc, chunk limit 100
"""


@register("p4_top_chunks", TOP_CHUNKS_SQL)
def p4_top_chunks(spark, sf_dir):
    return pretok.top_chunks(pretok.chunk_frequencies(documents(spark, sf_dir)), 100)
