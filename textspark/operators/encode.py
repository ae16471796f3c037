"""Tokenizers over DataFrames: encode / decode.

Each tokenizer holds its vocabulary as a ``(token, id)`` DataFrame. Encoding and decoding are
narrow steps: a text is cut into chunks beside the scan, the distinct chunks of an Arrow batch
are encoded (BPE: all of them go through the merges together; else by the task's table of encoded
chunks), and the ids are put together by array operations; nothing is shuffled. For that the
vocabulary goes to the tasks, if it has at most ``VOCAB_BYTES`` (checked once for a tokenizer).

A larger vocabulary stays a table. Rows are then dealt to blocks of about ``BLOCK_BYTES`` of text by
a hash of the row; the distinct chunks of each block are joined with the vocabulary, and the block's
small table of encoded chunks meets its rows in a cogroup. So a chunk is shuffled once for each block
that has it, not once for each occurrence. Decoding joins by id; rows are named by a digest of
their ids, so a row that is repeated often is gathered once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, IntegerType, StructField, StructType, VariantType

from ..functions import constants as K
from ..functions.text import bpe_chunks, char_split, word_split
from . import bpe as B
from . import pretok, vocab as V
from .pretok import SLICE_VALUES, row_slices

DIGEST = "_content_digest"
BLOCK = "_text_block"
#: A vocabulary of at most this size (its strings, and ``ENTRY_BYTES`` for each token) goes to the tasks.
VOCAB_BYTES = 16 << 20
ENTRY_BYTES = 100
#: Bytes of text in a block of rows that share a table of encoded chunks.
BLOCK_BYTES = 8 << 20
#: Encoded chunks that a task keeps.
CACHE_CHUNKS = 200_000


def _digest(value) -> Column:
    return F.substring(F.unhex(F.sha2(value.cast("string").cast("binary"), 256)), 1, 16)


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _gather(occ: DataFrame, value: str, out: str) -> DataFrame:
    """``(pos, value)`` rows of each content back in order, one array per content."""
    return (occ.groupBy(DIGEST).agg(F.array_sort(F.collect_set(F.struct("pos", value))).alias("s"))
            .select(DIGEST, F.transform("s", lambda s: s[value]).alias(out)))


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places first[i], first[i] + 1, ... (count[i] of them) of every i, one after the other."""
    upto = np.cumsum(count)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(first - (upto - count), count)


def id_lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column, and the bounds of its rows in them (null: empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.append(0, np.cumsum(size))


def sliced(run, lengths, kind: str):
    """``run`` as a column function that works on a few rows of a batch at once, so that a task holds a
    batch of its input and a slice of its output."""
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            if not len(column):
                yield run(column)
            for part in row_slices(column, lengths(column)):
                yield run(part)

    return F.arrow_udf(each, kind)


def encode_column(shared, symbols, unknown):
    """Column function: the ids of each array of chunks. ``shared`` broadcasts (ids by token,
    rank by pair); ``symbols(chunk, ranks)`` cuts a chunk; ``unknown`` is the id of a symbol that
    is in no vocabulary (None: an error)."""
    known: dict[str, list[int]] = {}

    def run(column: pa.Array) -> pa.Array:
        ids, ranks = shared.value
        chunks, bounds = id_lists(column)
        coded = chunks.dictionary_encode()
        each = []
        for chunk in coded.dictionary.to_pylist():
            found = known.get(chunk)
            if found is None:
                found = [ids.get(s, unknown) for s in symbols(chunk, ranks)]
                if unknown is None and None in found:
                    raise ValueError(f"token outside the vocabulary in {chunk!r}")
                if len(known) >= CACHE_CHUNKS:
                    known.clear()
                known[chunk] = found
            each.append(found)
        return place_ids(each, coded.indices.to_numpy(zero_copy_only=False), bounds)

    return sliced(run, pc.list_value_length, "array<int>")


def encode_bpe_column(shared, classes, unknown: int):
    """Column function: the BPE ids of each text (null: none). The texts of a slice are cut at once and their distinct
    chunks go through the merges together."""
    tables: dict[int, B.MergeTable] = {}

    def run(column: pa.Array) -> pa.Array:
        ids, ranks = shared.value
        table = tables.get(id(ids))
        if table is None:
            tables.clear()
            table = tables[id(ids)] = B.MergeTable(ids, ranks, unknown)
        chunks, bounds = pretok.cut_chunks(column, classes.value)
        coded = chunks.dictionary_encode()
        return place_flat(*table.encode(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), bounds)

    return sliced(run, pc.binary_length, "array<int>")


def place_ids(each: list[list[int]], codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The ids of rows of chunks: ``each`` has the ids of the distinct chunks, ``codes`` names the chunk of each
    place, ``bounds`` are the rows' bounds in them."""
    size = np.array([len(x) for x in each], np.int64)
    return place_flat(np.fromiter((i for x in each for i in x), np.int32, int(size.sum())), size, codes, bounds)


def place_flat(flat: np.ndarray, size: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """:func:`place_ids` where the ids of the distinct chunks are one after the other, ``size`` of each chunk."""
    ends = np.append(0, np.cumsum(size[codes]))
    out = flat[_spread((np.cumsum(size) - size)[codes], size[codes])]
    return pa.ListArray.from_arrays(pa.array(ends[bounds], pa.int32()), pa.array(out, pa.int32()))


def encode_chars_column(shared, unknown: int):
    """Column function: the ids of a text's characters (null: none), by a table over code points."""
    tables: dict[int, np.ndarray] = {}

    def run(column: pa.Array) -> pa.Array:
        ids = shared.value[0]
        table = tables.get(id(ids))
        if table is None:
            tables.clear()
            table = tables[id(ids)] = np.full(0x110000, unknown, np.int32)
            for token, i in ids.items():
                if len(token) == 1:
                    table[ord(token)] = i
        size = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
        text = "".join(column.drop_null().to_pylist())
        codes = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(codes))

    return sliced(run, pc.utf8_length, "array<int>")


def decode_column(shared, join):
    """Column function: the text of each array of ids. ``shared`` broadcasts (place of each id,
    tokens); ``join(tokens, codes, bounds)`` puts the rows together."""
    def run(column: pa.Array) -> pa.Array:
        place, tokens = shared.value
        values, bounds = id_lists(column)
        ids = values.to_numpy(zero_copy_only=False)
        bad = (ids < 0) | (ids >= len(place))
        bad[~bad] = place[ids[~bad]] < 0
        if bad.any():
            raise ValueError(f"unknown token id {int(ids[bad][0])}")
        return join(tokens, place[ids], bounds)

    return sliced(run, pc.list_value_length, "string")


def join_plain(tokens: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    rows = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), tokens.take(pa.array(codes)))
    return pc.binary_join(rows, "").cast(pa.string())


class Tokenizer:
    """Interface: ``encode(df, text_col) -> df + ids`` and
    ``decode(df, ids_col) -> df + text``; ``vocab`` is a (token, id) table."""

    kind = "base"
    unk_token = K.UNK_TOKEN
    merge_rows = ()
    vocab_bytes = VOCAB_BYTES

    def __init__(self, vocab: DataFrame):
        self.vocab = vocab

    @property
    def unk_id(self) -> int:
        return 0 if self.kind == "char" else 1

    def pieces(self, text_col) -> Column:
        """The chunks of a text, in order."""
        raise NotImplementedError

    def symbols(self, chunks: DataFrame) -> DataFrame:
        """``chunk, symbols`` of distinct chunks; each symbol is looked up."""
        raise NotImplementedError

    #: (chunk, ranks) -> symbols, the same rule inside a task.
    cut = staticmethod(lambda chunk, ranks: [chunk])
    #: How decoded tokens are put together inside a task.
    join_in_task = staticmethod(join_plain)
    task_unknown = property(lambda self: self.unk_id)

    def unknown(self) -> Column:
        """The id of a symbol outside the vocabulary."""
        return F.lit(self.unk_id)

    def _tables(self):
        """Broadcast lookup tables of a vocabulary of bounded size, else None."""
        if not hasattr(self, "_shared"):
            size = self.vocab.agg(F.sum(F.octet_length("token") + ENTRY_BYTES)).first()[0] or 0
            self._shared = None
            if size <= self.vocab_bytes:
                rows = [(r["token"], int(r["id"])) for r in self.vocab.select("token", "id").collect()]
                sc = self.vocab.sparkSession.sparkContext
                place = np.full(max((i for _, i in rows), default=-1) + 1, -1, np.int64)
                place[[i for _, i in rows]] = np.arange(len(rows))
                ranks = {(a, b): r for r, a, b, *_ in self.merge_rows}
                self._shared = (sc.broadcast((dict(rows), ranks)), sc.broadcast((place, pa.array([t for t, _ in rows], pa.string()))))
        return self._shared

    def encode(self, df: DataFrame, text_col="text", key_cols=(), out="ids") -> DataFrame:
        """``df`` with the ids of each text; a null or empty text has none. ``key_cols``
        is not needed any more: rows that share a key are encoded each on its own."""
        tables = self._tables()
        if tables is None:
            return self._encode_by_join(df, text_col, out)
        return df.withColumn(out, self._encode_in_task(tables[0], text_col))

    def _encode_in_task(self, shared, text_col) -> Column:
        return encode_column(shared, self.cut, self.task_unknown)(self.pieces(text_col))

    def encoded_chunks(self, chunks: DataFrame) -> DataFrame:
        """``chunk, ids`` of the distinct chunks."""
        syms = self.symbols(chunks.select("chunk").distinct())
        occ = syms.select("chunk", F.posexplode("symbols").alias("pos", "token"))
        named = occ.join(self.vocab.select("token", F.col("id").cast("int").alias("id")), "token", "left")
        return (named.select("chunk", "pos", F.coalesce("id", self.unknown()).alias("id"))
                .groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("s"))
                .select("chunk", F.transform("s", lambda s: s["id"]).alias("ids")))

    def block_table(self, words: DataFrame) -> DataFrame:
        """``words`` (block, chunk) with the ids of each chunk."""
        return words.join(self.encoded_chunks(words), "chunk")

    def _encode_by_join(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        size = df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        n = max(1, math.ceil(size / BLOCK_BYTES))
        # all plain columns decide the block, so copies of a text are dealt out unless the whole rows are equal
        plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
        dealt = df.withColumn(BLOCK, F.pmod(F.xxhash64(*plain), F.lit(n)).cast("int")).repartition(n, BLOCK)
        # a hash aggregate within the block's partition: no chunk moves before the distinct ones are known
        words = dealt.select(BLOCK, F.explode(F.array_distinct(self.pieces(text_col))).alias("chunk")).distinct()
        table = self.block_table(words).select(F.col(BLOCK).alias("_b"), "chunk", "ids")
        rows = dealt.withColumn("_pieces", self.pieces(text_col))
        names = [c for c in df.columns if c != out]
        schema = StructType([*[f for f in df.schema if f.name != out], StructField(out, ArrayType(IntegerType()))])

        def fill(left: pa.Table, right: pa.Table) -> pa.Table:
            chunks, bounds = id_lists(left["_pieces"])
            coded = right["chunk"].combine_chunks()
            codes = pc.index_in(chunks, value_set=coded).to_numpy(zero_copy_only=False)
            ids = place_ids(right["ids"].to_pylist(), codes, bounds)
            return pa.table([*[left[c] for c in names], ids], [*names, out])

        done = rows.groupBy(BLOCK).cogroup(table.groupBy("_b")).applyInArrow(fill, schema)
        return done.select(*[f"`{c}`" for c in df.columns], *([] if out in df.columns else [out]))

    def join_tokens(self, toks) -> Column:
        """tokens array -> text (plain concatenation)."""
        return F.array_join(toks, "")

    def decode(self, df: DataFrame, ids_col="ids", out="decoded", key_cols=()) -> DataFrame:
        """``df`` with the text of each id array (no ids: empty). An unknown id is an
        error, like a missing dict key."""
        ids = _as_col(ids_col)
        tables = self._tables()
        if tables is None:
            return self._decode_by_join(df, ids, out)
        return df.withColumn(out, decode_column(tables[1], self.join_in_task)(ids.cast("array<int>")))

    def _decode_by_join(self, df: DataFrame, ids: Column, out: str) -> DataFrame:
        keyed = df.withColumn(DIGEST, _digest(ids))
        occ = keyed.select(DIGEST, F.posexplode(ids).alias("pos", "id"))
        named = occ.join(self.vocab.select(F.col("id").cast("int").alias("id"), "token"), "id", "left").select(
            DIGEST, "pos", F.coalesce("token", F.raise_error(F.concat(
                F.lit("unknown token id "), F.col("id").cast("string")))).alias("token"))
        toks = _gather(named, "token", "_tokens")
        return (keyed.join(toks, DIGEST, "left")
                .withColumn(out, F.coalesce(self.join_tokens(F.col("_tokens")), F.lit("")))
                .drop(DIGEST, "_tokens"))

    def vocab_size(self) -> DataFrame:
        return V.vocab_size(self.vocab)

    def newline_token_ids(self) -> DataFrame:
        """Ids whose text contains a line break."""
        return self.vocab.where(F.col("token").contains("\n")).select("id")


class CharTokenizer(Tokenizer):
    kind = "char"

    @classmethod
    def train(cls, docs: DataFrame, text_col="text") -> "CharTokenizer":
        return cls(V.char_vocab(docs, text_col))

    def pieces(self, text_col):
        """BPE chunks cover the text, so far fewer rows than characters are joined."""
        return bpe_chunks(F.lower(F.col(text_col)))

    def _encode_in_task(self, shared, text_col) -> Column:
        return encode_chars_column(shared, self.unk_id)(F.lower(_as_col(text_col)))

    def symbols(self, chunks: DataFrame) -> DataFrame:
        return chunks.select("chunk", char_split("chunk").alias("symbols"))


def join_words(tokens: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """E5 in a task: the table of tokens is followed by the tokens with a space ahead."""
    spaced = pc.binary_join_element_wise(" ", tokens, "")
    glued = pc.is_in(tokens, pa.array(K.NO_SPACE_BEFORE)).to_numpy(zero_copy_only=False)
    plain = glued[codes] if len(codes) else np.zeros(0, bool)
    first = bounds[:-1][np.diff(bounds) > 0]
    plain[first] = True
    both = pa.concat_arrays([tokens, spaced])
    return join_plain(both, np.where(plain, codes, codes + len(tokens)), bounds)


class WordTokenizer(Tokenizer):
    kind = "word"
    join_in_task = staticmethod(join_words)

    @classmethod
    def train(cls, docs: DataFrame, text_col="text") -> "WordTokenizer":
        return cls(V.word_vocab(docs, text_col))

    def pieces(self, text_col):
        return word_split(text_col)

    def symbols(self, chunks: DataFrame) -> DataFrame:
        return chunks.select("chunk", F.array("chunk").alias("symbols"))

    def block_table(self, words):
        """A chunk is a token: one join."""
        ids = self.vocab.select(F.col("token").alias("chunk"), F.col("id").cast("int").alias("id"))
        return words.join(ids, "chunk", "left").select(BLOCK, "chunk", F.array(F.coalesce("id", self.unknown())).alias("ids"))

    def join_tokens(self, toks):
        """E5: a space before every token except the first and the fixed
        closing punctuation set."""
        glue = F.array(*[F.lit(t) for t in K.NO_SPACE_BEFORE])
        return F.array_join(F.transform(toks, lambda t, i: F.when(
            (i == 0) | F.array_contains(glue, t), t).otherwise(F.concat(F.lit(" "), t))), "")


class BpeTokenizer(Tokenizer):
    """Chunk-level BPE. ``merge_rows`` is the (small) ordered merge list, ``types`` the
    trained chunk table. Chunks go through the lowest-rank loop, which is right for any
    merge table, learned here or imported."""

    kind = "bpe"
    cut = staticmethod(B.lowest_rank_symbols)

    def __init__(self, vocab: DataFrame, merges: DataFrame, merge_rows, types: DataFrame | None = None,
                 base: DataFrame | None = None):
        super().__init__(vocab)
        self.merges = merges
        self.merge_rows = sorted(merge_rows)
        self.types = types
        self.base = base

    @classmethod
    def train(cls, docs: DataFrame, num_merges: int = K.NUM_MERGES, text_col="text", **kw) -> "BpeTokenizer":
        freqs = pretok.chunk_frequencies(docs, text_col)
        model = B.train_bpe(freqs, num_merges, **kw)
        vocab = V.bpe_vocab(model.base, model.merges)
        tok = cls(vocab, model.merges, model.merge_rows, model.types, base=model.base)
        tok.rounds = model.rounds
        return tok

    def with_merges(self, k: int) -> "BpeTokenizer":
        """The tokenizer after only the first ``k`` merges (V10 sweeps)."""
        rows = [r for r in self.merge_rows if r[0] < k]
        merges = self.merges.where(F.col("rank") < k)
        return BpeTokenizer(V.bpe_vocab(self.base, merges), merges, rows, None, base=self.base)

    def pieces(self, text_col):
        return bpe_chunks(text_col)

    def _encode_in_task(self, shared, text_col) -> Column:
        spark = self.vocab.sparkSession
        classes = spark.sparkContext.broadcast(pretok.char_classes(spark))
        return encode_bpe_column(shared, classes, self.unk_id)(_as_col(text_col))

    def symbols(self, chunks: DataFrame) -> DataFrame:
        """The lowest-rank loop on the distinct chunk."""
        ranks = {(a, b): r for r, a, b, *_ in self.merge_rows}

        @F.pandas_udf("array<string>")
        def loop(column: pd.Series) -> pd.Series:
            return column.map(lambda c: None if c is None else B.lowest_rank_symbols(c, ranks))

        return chunks.select("chunk", loop("chunk").alias("symbols"))


def reuse_or_train(saved: "BpeTokenizer", docs: DataFrame, num_merges: int, text_col="text") -> tuple["BpeTokenizer", bool]:
    """The saved tokenizer if it has as many merges as asked for and gives every text back
    as it was; else one trained anew. And whether the saved one is reused."""
    if len(saved.merge_rows) == num_merges:
        back = saved.decode(saved.encode(docs.select(text_col), text_col), "ids", "_back")
        lost = back.where(F.coalesce(F.col(text_col), F.lit("")) != F.col("_back"))
        if lost.limit(1).count() == 0:                         # all tasks at once, each up to its first such text
            return saved, True
    return BpeTokenizer.train(docs, num_merges, text_col), False


# --- E6: byte-level BPE ---------------------------------------------------------
END_OF_TEXT = "<|endoftext|>"


def byte_chunks(text_col):
    """Chunks as byte strings: every UTF-8 byte becomes one ISO-8859-1 character,
    so any text has a 256-symbol alphabet and nothing is unknown."""
    return F.transform(bpe_chunks(text_col), lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"))


def _byte_symbols(chunk: str, ranks: dict) -> list[str]:
    return [chunk] if chunk == END_OF_TEXT else B.lowest_rank_symbols(chunk, ranks)


def join_bytes(tokens: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Bytes (as ISO-8859-1 characters) back to text; malformed UTF-8 becomes U+FFFD."""
    rows = join_plain(tokens, codes, bounds).to_pylist()
    return pa.array([r.encode("iso-8859-1").decode("utf-8", "replace") for r in rows], pa.string())


class ByteBpeTokenizer(BpeTokenizer):
    """Byte-level BPE: ids 0..255 are the bytes, merge ``r`` is id 256 + r, and
    the end-of-text marker is the last id and always one token."""

    kind = "byte_bpe"
    cut = staticmethod(_byte_symbols)
    join_in_task = staticmethod(join_bytes)
    task_unknown = None

    @classmethod
    def train(cls, docs: DataFrame, num_merges: int, text_col="text", **kw) -> "ByteBpeTokenizer":
        pieces = F.filter(F.split(F.col(text_col), r"<\|endoftext\|>"), lambda p: F.length(p) > 0)
        parts = docs.select(F.explode(pieces).alias("part"))
        freqs = pretok.piece_frequencies(parts, byte_chunks("part"), "chunk")
        model = B.train_bpe(freqs, num_merges, **kw)
        tok = cls.from_merges(model.merges, model.merge_rows, model.types)
        tok.rounds = model.rounds
        return tok

    @classmethod
    def from_merges(cls, merges: DataFrame, merge_rows, types: DataFrame | None = None) -> "ByteBpeTokenizer":
        """The tokenizer of a supplied ``rank, a, b`` table over byte strings."""
        rows = [(chr(b), b) for b in range(256)]
        rows += [(a + b, 256 + r) for r, a, b, *_ in merge_rows]
        rows.append((END_OF_TEXT, 256 + len(merge_rows)))
        return cls(merges.sparkSession.createDataFrame(rows, "token string, id int"), merges, merge_rows, types)

    @property
    def eot_id(self) -> int:
        return 256 + len(self.merge_rows)

    def unknown(self):
        return F.raise_error(F.lit("token outside the vocabulary")).cast("int")

    _encode_in_task = Tokenizer._encode_in_task

    def pieces(self, text_col):
        """No chunk of a part can hold the marker, so the marker itself may stand as a chunk."""
        parts = F.split(F.col(text_col), r"<\|endoftext\|>")
        return F.flatten(F.transform(parts, lambda p, i: F.concat(
            F.when(i > 0, F.array(F.lit(END_OF_TEXT))).otherwise(F.array().cast("array<string>")), byte_chunks(p))))

    def symbols(self, chunks: DataFrame) -> DataFrame:
        marker = F.col("chunk") == END_OF_TEXT
        return super().symbols(chunks).select(
            "chunk", F.when(marker, F.array(F.lit(END_OF_TEXT))).otherwise(F.col("symbols")).alias("symbols"))

    def join_tokens(self, toks):
        """Bytes back to text; malformed UTF-8 becomes U+FFFD."""
        return F.make_valid_utf8(F.encode(F.array_join(toks, ""), "ISO-8859-1").cast("string"))
