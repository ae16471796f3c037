"""Generation requests arriving over time.

Request payload files are read as a stream; validation (G13) is stateless and
runs in-stream; ``foreachBatch`` completes the valid requests of each micro-batch, each with
its whole budget in one go, and writes the result records (G15), with rejected
requests and their messages alongside. A chat request is wrapped as a User/Bot prompt and
stops at a line break; its record has the message, the reply's first line and the
number of tokens made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_line_reply, wrap_chat_prompt
from ..operators import generate as G
from ..operators.requests import validate_requests


def request_stream(spark: SparkSession, source: str) -> DataFrame:
    raw = spark.readStream.schema("request_id bigint, payload string").parquet(source)
    return validate_requests(raw)


def serve(requests: DataFrame, tokenizer, model, checkpoint_location: str, out_path: str) -> None:
    stops = F.array(*[F.lit(int(r[0])) for r in tokenizer.newline_token_ids().select("id").collect()])

    def handle(batch: DataFrame, epoch_id: int) -> None:
        from pyspark import StorageLevel
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # read by every branch below
        rejected = batch.where(F.col("error").isNotNull()).select(
            "request_id", F.lit(None).cast("string").alias("prompt"), F.lit(None).cast("string").alias("continuation"),
            F.lit(None).cast("int").alias("new_tokens"), "error")
        valid = batch.where(F.col("error").isNull()).withColumnRenamed("request_id", "pid")
        asked = F.when(F.col("chat"), wrap_chat_prompt("prompt")).otherwise(F.col("prompt"))
        enc = tokenizer.encode(valid.withColumn("text", asked))
        enc = G.reject_empty(enc)
        empty = enc.where(F.col("error").isNotNull()).select(
            F.col("pid").alias("request_id"), F.lit(None).cast("string").alias("prompt"),
            F.lit(None).cast("string").alias("continuation"), F.lit(None).cast("int").alias("new_tokens"), "error")
        ok = enc.where(F.col("error").isNull()).select(
            "pid", "ids", "max_new_tokens", "temperature", "top_k", "seed", "chat", "prompt",
            F.when(F.col("chat"), stops).alias("stop_ids"))
        out = G.generate(model, ok, keep=("max_new_tokens", "chat", "prompt"))
        n_prompt = F.size("ids") - F.col("new_tokens")
        prompt_ids, new_ids = F.slice("ids", F.lit(1), n_prompt), F.slice("ids", n_prompt + 1, F.col("new_tokens"))
        out = tokenizer.decode(tokenizer.decode(tokenizer.decode(out, prompt_ids, "shown"), "ids", "text"), new_ids, "new_text")
        rest = F.substring("text", F.length("shown") + 1, F.lit(1 << 30))
        done = out.select(
            F.col("pid").alias("request_id"), F.when(F.col("chat"), F.col("prompt")).otherwise(F.col("shown")).alias("prompt"),
            F.when(F.col("chat"), first_line_reply("new_text")).otherwise(rest).alias("continuation"),
            F.when(F.col("chat"), F.col("new_tokens")).otherwise(F.col("max_new_tokens")).cast("int").alias("new_tokens"),
            F.lit(None).cast("string").alias("error"))
        # one folder for each micro-batch: a batch that runs again replaces its own rows
        done.unionByName(rejected).unionByName(empty).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")
        batch.unpersist()

    q = (requests.writeStream.option("checkpointLocation", checkpoint_location)
         .foreachBatch(handle).trigger(availableNow=True).start())
    q.awaitTermination()
