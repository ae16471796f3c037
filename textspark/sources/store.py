"""Sinks and persistence.

Everything is a directory of Parquet (or text) written by executors in
parallel; nothing is assembled on the driver.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K


# --- S4 ---------------------------------------------------------------------
def write_corpus(lines: DataFrame, path: str, order_cols, line_col="line", partitions: int | None = None,
                 overwrite: bool = False) -> None:
    """Write rows in corpus order, one line each followed by "\\n": range
    partitions by the order key, sorted inside, so part files concatenate in
    order (no single-writer coalesce)."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    out = lines.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).select(line_col)
    out.write.mode("overwrite" if overwrite else "errorifexists").option("lineSep", "\n").text(path)


# --- S7 ---------------------------------------------------------------------
def destination(explicit: str | None, base: str, corpus_path: str | None) -> str:
    """explicit dir > base/<corpus stem> > base."""
    if explicit:
        return explicit
    if corpus_path:
        stem = re.sub(r"\.[^./]*$", "", os.path.basename(corpus_path.rstrip("/")))
        return os.path.join(base, stem)
    return base


def write_mode(overwrite: bool) -> str:
    """Refuse to replace existing output unless asked."""
    return "overwrite" if overwrite else "errorifexists"


# --- S5 ---------------------------------------------------------------------
def save_tokenizer(tok, path: str, overwrite: bool = False) -> None:
    mode = write_mode(overwrite)
    tok.vocab.write.mode(mode).parquet(os.path.join(path, "vocab"))
    spark = tok.vocab.sparkSession
    meta = spark.createDataFrame([(tok.kind,)], "kind string")
    meta.write.mode(mode).parquet(os.path.join(path, "meta"))
    if tok.kind in ("bpe", "byte_bpe"):
        tok.merges.select("rank", "a", "b").write.mode(mode).parquet(os.path.join(path, "merges"))


def load_tokenizer(spark: SparkSession, path: str):
    from ..operators import encode as E
    kind = spark.read.parquet(os.path.join(path, "meta")).first()["kind"]
    vocab = spark.read.parquet(os.path.join(path, "vocab"))
    if kind == "char":
        return E.CharTokenizer(vocab)
    if kind == "word":
        return E.WordTokenizer(vocab)
    merges = spark.read.parquet(os.path.join(path, "merges"))
    rows = [(r["rank"], r["a"], r["b"], 0) for r in merges.orderBy("rank").collect()]  # O(num_merges)
    if kind == "byte_bpe":
        return E.ByteBpeTokenizer(vocab, merges, rows)
    base = vocab.where(F.col("id") >= len(K.SPECIAL_TOKENS)).where(F.length("token") == 1).select("token")
    return E.BpeTokenizer(vocab, merges, rows, None, base=base)


def tokenizer_from_json(spark: SparkSession, json_text: DataFrame):
    """Import a JSON tokenizer file ``{"stoi": {...}, "merges": [[a, b], ...]}``
    (merges optional) read as one ``value`` column: the map is exploded and
    the merge list gets its rank back from its position."""
    from ..operators import encode as E
    schema = "stoi map<string,int>, merges array<array<string>>, type string"
    parsed = json_text.select(F.from_json("value", schema).alias("j"))
    vocab = parsed.select(F.explode("j.stoi").alias("token", "id"))
    merges = parsed.select(F.posexplode("j.merges").alias("rank", "pair")).select(
        F.col("rank").cast("int"), F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b"))
    kind = parsed.select("j.type").first()["type"]
    if kind in ("char", "word"):
        return (E.CharTokenizer if kind == "char" else E.WordTokenizer)(vocab)
    if kind is None and merges.limit(1).count() == 0:
        return E.WordTokenizer(vocab) if vocab.where(F.col("token") == K.PAD_TOKEN).limit(1).count() \
            else E.CharTokenizer(vocab)
    rows = [(r["rank"], r["a"], r["b"], 0) for r in merges.collect()]
    return (E.ByteBpeTokenizer if kind == "byte_bpe" else E.BpeTokenizer)(vocab, merges, rows, None)


def tokenizer_to_json(tok) -> DataFrame:
    """Export as one JSON line (vocab as a map, merges in rank order)."""
    stoi = tok.vocab.agg(F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("stoi"))
    kind = F.lit(tok.kind).alias("type")
    if tok.kind not in ("bpe", "byte_bpe"):
        return stoi.select(F.to_json(F.struct("stoi", kind)).alias("value"))
    m = tok.merges.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "a", "b"))),
                                   lambda s: F.array(s["a"], s["b"])).alias("merges"))
    return stoi.select(F.to_json(F.struct("stoi", m.select("merges").scalar().alias("merges"), kind)).alias("value"))


# --- S6 ---------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _committed(spark: SparkSession, path: str) -> str | None:
    """The version that the last finished save has committed: the marker ``commit-<number>`` of the highest number names its folder."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    marks = [(int(n.split("-")[1]), n) for n in names if n.startswith("commit-")]
    return f"version-{max(marks)[0]}" if marks else None


def save_model(model, path: str, epoch: int | None = None, val_loss: float | None = None,
               overwrite: bool = False, scores: DataFrame | None = None, tokenizer=None) -> None:
    """All parts (and the tokenizer, if given) go to a folder of their own that no reader looks
    at; one empty marker file, written last, makes them the model. A save that is killed before,
    or refused because the written model's scores differ from ``scores`` by more than the
    tolerance, leaves what was there (or nothing) as it was."""
    spark = model.pairs.sparkSession
    fs, _ = _fs(spark, path)
    before = _committed(spark, path)
    if before and not overwrite:
        raise FileExistsError(f"a model is stored under {path}")
    number = int(before.split("-")[1]) + 1 if before else 1
    folder = os.path.join(path, f"version-{number}")
    model.pairs.write.mode("overwrite").parquet(os.path.join(folder, "pairs"))
    model.unigrams.write.mode("overwrite").parquet(os.path.join(folder, "unigrams"))
    meta = spark.createDataFrame(
        [(json.dumps({"vocab_size": model.vocab_size, "n_tokens": model.n_tokens, "alpha": model.alpha,
                      "tokenizer": tokenizer is not None}), epoch, val_loss)], "config string, epoch int, val_loss double")
    meta.write.mode("overwrite").parquet(os.path.join(folder, "meta"))
    if tokenizer is not None:
        save_tokenizer(tokenizer, os.path.join(folder, "tokenizer"), overwrite=True)
    if scores is not None:
        from ..operators.lm import score_difference
        gap, _ = score_difference(_read_model(spark, folder)[0], scores)
        if gap > K.PARITY_TOLERANCE:
            raise ValueError(f"scores differ by {gap}: the model is not saved")
    if not fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"commit-{number}"))):
        raise FileExistsError(f"another save to {path} has been committed meanwhile")


def load_model(spark: SparkSession, path: str):
    """The model that was committed last; missing metadata fields get defaults."""
    version = _committed(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished model under {path}")
    return _read_model(spark, os.path.join(path, version))


def load_model_tokenizer(spark: SparkSession, path: str):
    """The tokenizer that was saved with the model, null if none was."""
    version = _committed(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished model under {path}")
    folder = os.path.join(path, version)
    cfg = json.loads(spark.read.parquet(os.path.join(folder, "meta")).first()["config"] or "{}")
    return load_tokenizer(spark, os.path.join(folder, "tokenizer")) if cfg.get("tokenizer") else None


def _read_model(spark: SparkSession, path: str):
    from ..operators.lm import NgramModel
    meta = spark.read.parquet(os.path.join(path, "meta")).select(
        "config", F.coalesce("epoch", F.lit(0)).alias("epoch"),
        F.coalesce("val_loss", F.lit(float("inf"))).alias("val_loss")).first()
    cfg = json.loads(meta["config"] or "{}")
    pairs = spark.read.parquet(os.path.join(path, "pairs"))
    unigrams = spark.read.parquet(os.path.join(path, "unigrams"))
    contexts = pairs.groupBy("context").agg(F.sum("n").alias("n_c"))
    model = NgramModel(pairs, contexts, unigrams, int(cfg.get("vocab_size", 0)), int(cfg.get("n_tokens", 0)),
                       float(cfg.get("alpha", 1.0)))
    return model, {"epoch": meta["epoch"], "val_loss": meta["val_loss"]}
