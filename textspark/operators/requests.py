"""Validate generation requests in bulk.

Input: ``payload`` JSON strings. Each field is read through a VARIANT so the
JSON type is known (a number and a numeric string follow different rules):
missing / null / "" -> default; numbers accepted as strings; integers
truncate JSON floats; booleans count as numbers; first failure wins. Output:
settings columns plus ``error`` (null when valid).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.patterns import S

INT_TEXT = r"^[\s]*[+-]?[0-9]+[\s]*$"


def _field(v, key):
    return F.try_variant_get(v, f"$.{key}", "variant")


def _kind(x):
    return F.when(x.isNull(), F.lit("MISSING")).otherwise(F.schema_of_variant(x))


def _number(key, default, is_int, low, high):
    """(value, error) columns for one numeric setting, from the columns ``_x_``, ``_k_`` and ``_s_`` of the key."""
    x, kind, as_str = (F.col(f"_{c}_{key}") for c in "xks")
    missing = kind.isin("MISSING", "NULL", "VOID") | ((kind == "STRING") & (as_str == ""))
    if is_int:
        # numbers beyond bigint are still numbers, only out of range: held as the nearest
        # bigint, which no setting allows
        def whole(d):
            return F.when(d >= 9.2e18, F.lit((1 << 63) - 1)).when(d <= -9.2e18, F.lit(-(1 << 63))).otherwise(
                d.try_cast("bigint"))                          # JSON floats truncate like int()
        digits = F.trim(as_str)
        from_str = F.when(as_str.rlike(INT_TEXT), F.coalesce(digits.try_cast("bigint"), whole(digits.try_cast("double"))))
        value = (F.when(kind == "STRING", from_str)
                 .when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("bigint"))
                 .when(kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"),
                       whole(F.try_variant_get(x, "$", "double"))))
    else:
        from_str = F.regexp_replace(as_str, rf"(?U)^[{S}]+|[{S}]+$", "").try_cast("double")
        value = (F.when(kind == "STRING", from_str)
                 .when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("double"))
                 .when(kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"),
                       F.try_variant_get(x, "$", "double")))
    low_s = str(low)
    high_s = str(high)
    err = (F.when(missing, F.lit(None))
           .when(value.isNull(), F.lit(f"{key} must be a number."))
           .when(F.isnan(value.cast("double")) | (value < low) | (value > high),
                 F.lit(f"{key} must be between {low_s} and {high_s}.")))
    return F.when(missing, F.lit(default)).otherwise(value), err


FIELDS = ["prompt", "max_new_tokens", "temperature", "top_k", "seed", "chat"]


def validate_requests(payloads: DataFrame, payload_col="payload") -> DataFrame:
    """In steps, so that a payload is parsed once and a field is read once: each step refers to the columns
    of the last one (in one step, every use of a setting would parse its payload again)."""
    df = payloads.withColumn("_v", F.try_parse_json(F.col(payload_col)))
    v = F.col("_v")
    df = df.withColumns({"_obj": v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT"), **{f"_x_{f}": _field(v, f) for f in FIELDS}})
    df = df.withColumns({f"_k_{f}": _kind(F.col(f"_x_{f}")) for f in FIELDS}
                        | {f"_s_{f}": F.try_variant_get(F.col(f"_x_{f}"), "$", "string") for f in FIELDS[:-1]})
    is_obj, pk = F.col("_obj"), F.col("_k_prompt")
    df = df.withColumn("_prompt", F.when(pk.isin("MISSING", "NULL", "VOID"), F.lit("")).otherwise(F.col("_s_prompt")))
    prompt = F.col("_prompt")
    prompt_blank = F.regexp_replace(prompt, rf"(?U)[{S}]+", "") == ""
    prompt_err = (F.when(~pk.isin("MISSING", "NULL", "VOID", "STRING"), F.lit(K.MSG_EMPTY_PROMPT))
                  .when(prompt_blank, F.lit(K.MSG_EMPTY_PROMPT))
                  .when(F.length(prompt) > K.MAX_PROMPT_CHARS, F.lit(K.MSG_LONG_PROMPT)))
    mnt, mnt_err = _number("max_new_tokens", K.MAX_NEW_TOKENS, True, 1, K.MAX_NEW_TOKENS_LIMIT)
    tmp, tmp_err = _number("temperature", K.TEMPERATURE, False, *K.TEMPERATURE_RANGE)
    tk, tk_err = _number("top_k", K.TOP_K, True, *K.TOP_K_RANGE)
    sd, sd_err = _number("seed", None, True, *K.SEED_RANGE)
    ck = F.col("_k_chat")
    chat = F.when(ck.isin("MISSING"), F.lit(False)).when(ck == "BOOLEAN", F.try_variant_get(F.col("_x_chat"), "$", "boolean"))
    chat_err = F.when(ck != "BOOLEAN", F.when(ck != "MISSING", F.lit(K.MSG_CHAT_BOOL)))
    error = F.coalesce(F.when(~is_obj, F.lit(K.MSG_NOT_OBJECT)), prompt_err, mnt_err, tmp_err, tk_err, sd_err,
                       chat_err)
    keys = [c_ for c_ in payloads.columns if c_ != payload_col]
    out = df.select(*keys, is_obj.alias("_obj"), prompt.alias("prompt"), mnt.cast("int").alias("max_new_tokens"),
                          tmp.cast("double").alias("temperature"), tk.cast("int").alias("top_k"),
                          sd.cast("bigint").alias("seed"), chat.alias("chat"), error.alias("error"))
    return out.select(*keys, *[F.when(F.col("error").isNull(), F.col(s)).alias(s) for s in FIELDS], "error")
