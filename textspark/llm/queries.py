"""Registered queries of the training-data operators (``opN_<name>``) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import WORD, Scratch, let, small_batches, table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_lsh_forest(spark, sf_dir):
    from .lsh_forest import near_duplicates
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, words=4).withColumnRenamed("id", "doc_id")


@query
def op6_bpe_count(spark, sf_dir):
    import public_tokenizers
    from .bpe_count import token_counts
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_stratified_shards(spark, sf_dir):
    from .stratified_shards import stratified_shards
    return stratified_shards(table(spark, sf_dir, "documents", "doc_id", "text", "source"), shards=40)


@query
def op9_warc_cas(spark, sf_dir):
    from .warc_cas import field, page_number, payload_digest, read_archive, write_archive
    path = Scratch(spark, "warc").path("archive")
    write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_archive(spark, path).select(
        page_number("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        payload_digest(F.col("payload")).alias("payload_digest"),
        field("WARC-Type").alias("record_type"), page_number("WARC-Refers-To").alias("refers_to"))


# The digest's 160 bits: five hex digits are four characters.
ORACLE["op9_warc_cas"] = """
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
d as (select page_id, payload_bytes, html, array_to_string(list_transform(range(0, 8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(h, 5 * i + 1, 5))::int >> b) & 31) + 1)::int, 1)), '')), '') as payload_digest from p),
m as (select *, max(page_id) over (partition by html) as head from d)
select page_id, payload_bytes, payload_digest, case when page_id = head then 'response' else 'revisit' end as record_type,
       case when page_id <> head then head end as refers_to from m"""


#: The rules of the contract (fixed values).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


@query
def op2_url_rules(spark, sf_dir):
    from .url_rules import judge_urls
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)


def _url_rules_sql():
    """Own rules alone: ``pages`` holds no links that could give a page the decision of another."""
    fits = " ".join(
        f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{tail}') then '{verdict} {name}/{tail}'"
        for verdict, (name, _, tail) in sorted(((v, r.partition("/")) for v, r in URL_RULES), key=lambda r: -len("".join(r[1]))))
    return f"""
with r as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
u as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
f as (select *, case {fits} end as fit from u)
select page_id, host, path, split_part(fit, ' ', 2) as rule, coalesce(split_part(fit, ' ', 1), 'allow') as verdict,
       null::varchar as alias_verdict from f"""


ORACLE["op2_url_rules"] = _url_rules_sql()


@query
def op3_divergence(spark, sf_dir):
    from .divergence import judge_documents
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return judge_documents(docs).select("doc_id", "judgement.*")


@query
def op8_entropy_balance(spark, sf_dir):
    from .entropy_balance import mix_sources
    return mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query
def op5_subspace_join(spark, sf_dir):
    from .subspace_join import link_vectors
    return link_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query
def op4_subword_clf(spark, sf_dir):
    from .subword_clf import classify
    return classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                    table(spark, sf_dir, "labels", "doc_id", "quality"))


@query
def op1_gumbel_lattice(spark, sf_dir):
    import public_tokenizers
    from .gumbel_lattice import sample_encodings
    small_batches(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn(
        "plain_crc32", F.crc32(F.translate(F.coalesce("text", F.lit("")), "▁", " ").cast("binary")))
    samples = sample_encodings(docs, path, k=2, keep=("plain_crc32",), decoded="decoded")
    return samples.select(
        F.col("id").alias("doc_id"), "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "perturbed", "inclusion", "log_inclusion",
        (F.crc32(F.col("decoded").cast("binary")) == F.col("plain_crc32")).alias("round_trip"))


@query
def op11_periodic_runs(spark, sf_dir):
    from .periodic_runs import best_run, find_runs
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = find_runs(repeat_tails(docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.withColumn("best", best_run(F.col("runs")))
    return rows.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def repeat_tails(docs):
    """The contract's texts: with h = crc32 of the decimal id, one in ten (h % 10 = 0) repeats its
    words from a = g % n on with period 1 + (n - a) // (3 + g % 8), g = h // 10. The words of
    such a text are joined by one space; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        tail = F.transform(F.sequence(F.lit(0).cast("bigint"), n - a - 1), lambda i: words[(a + F.pmod(i, p)).cast("int")])
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " "))

    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), let(
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), repeated)).otherwise(F.col("text")))


@query
def op13_passage_join(spark, sf_dir):
    from .decontaminate import find_passages
    rows = find_passages(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_FOLDED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE["op13_passage_join"] = f"""
with d as (select doc_id, coalesce({_FOLDED}, []) as w from documents),
b as (select item_id, w, least(len(w), 10) as l from (select item_id, {_FOLDED} as w from benchmark) where len(w) > 0),
bw as (select item_id, l, array_to_string(w[i:i + l - 1], ' ') as win
       from (select item_id, w, l, unnest(range(1, len(w) - l + 2)) as i from b)),
dw as (select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as win
       from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, (select distinct l from bw))),
m as (select distinct doc_id, i, l, item_id from dw join bw using (l, win)),
hit as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + l)) as p from m) group by doc_id),
its as (select doc_id, count(*)::bigint as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
        from (select distinct doc_id, item_id::varchar as item from m) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join its using (doc_id)"""


@query
def op12_prefix_trie(spark, sf_dir):
    from .prefix_trie import prefix_trie
    return prefix_trie(rebuilt_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def rebuilt_conversations(turns):
    """The contract's conversations: the first h turns of conversation c - c % 5 (h = crc32 of the
    decimal c, mod 9; so at most 8), then c's own turns after its first h."""
    from .prefix_trie import _openings, turn_digests
    rows = Scratch(turns.sparkSession, "rebuilt").save(turn_digests(turns, "conv_id", "turn", "role", "text"), "turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    opened = _openings(rows)
    shared = (rows.where((F.pmod("conv", F.lit(5)) == 0) & (F.col("idx") < 8))
              .withColumn("conv", F.explode(F.sequence("conv", F.col("conv") + 4))).where(F.col("idx") < h)
              .join(opened.select("conv"), "conv", "left_semi"))
    own = rows.where(F.col("idx") >= h)
    return (opened.unionByName(shared.withColumn("part", F.lit(1)), allowMissingColumns=False)
            .unionByName(own.withColumn("part", F.lit(2))))


def _crc32_sql(text):
    """Unsigned CRC-32 of an ASCII string, bit by bit (DuckDB has no function for it)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: list_concat([ord(ch)::ubigint], [256, 256, 256, 256, 256, 256, 256, 256]::ubigint[])))"
    return (f"xor(list_reduce(list_prepend(4294967295::ubigint, {steps}), lambda a, e: case when e < 256 then xor(a, e) "
            "else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295::ubigint)")


ORACLE["op12_prefix_trie"] = f"""
with t as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as i
  from conversations where conv_id is not null),
h as (select c, ({_crc32_sql('c::varchar')} % 9)::int as h from (select distinct c from t)),
rb as (select h.c, 0 as part, t.i, md5(strlen(r) || ':' || r || x) as d, strlen(x) as nb from h join t on t.c = h.c - h.c % 5 and t.i < h.h
  union all select h.c, 1, t.i, md5(strlen(r) || ':' || r || x), strlen(x) from h join t on t.c = h.c and t.i >= h.h),
seq as (select h.c, coalesce(list(d order by part, i) filter (where d is not null), []) as k,
    coalesce(list(nb order by part, i) filter (where d is not null), []) as b from h left join rb using (c) group by h.c),
mem as (select c, d, k[1:d] as key, case d when 0 then 0 else b[d] end as nb from (select *, unnest(range(0, len(k) + 1)) as d from seq)),
node as (select key, d, min(c) as conv, count(*) as n, max(nb) as nb from mem group by key, d),
kid as (select key[1:d - 1] as key, count(*) as nc from node where d > 0 group by 1),
own as (select node.*, coalesce(nc, 0) as nc, (n - 1) * nb as s from node left join kid using (key)),
sub as (select key[1:j] as key, sum(s)::bigint as saved, sum((nc = 0)::int)::bigint as leaves
        from (select *, unnest(range(0, d + 1)) as j from own) group by 1),
ends as (select k as key, sha256(string_agg(c::varchar, ',' order by c)) as e from seq group by k)
select own.conv as conv_id, own.d as depth, up.conv as parent_conv_id, own.n as n_convs, own.nc as n_children, leaves as n_leaves,
       saved as saved_tokens, coalesce(e, sha256('')) as ends_sha256
from own join sub using (key) left join ends using (key) left join node up on own.d > 0 and up.key = own.key[1:own.d - 1]"""
