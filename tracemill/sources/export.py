"""Three training formats from typed messages, as columns of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "You reason carefully and briefly: plain statements, nothing repeated, every technical detail kept."


def normalised(msgs: Column) -> Column:
    """Roles human and gpt become user and assistant, a missing one is empty."""
    role = lambda m: F.coalesce(m["role"], F.lit(""))
    name = lambda m: F.when(role(m) == "human", F.lit("user")).when(role(m) == "gpt", F.lit("assistant")).otherwise(role(m))
    return F.transform(F.coalesce(msgs, F.array().cast("array<struct<role:string,content:string>>")), lambda m: F.struct(name(m).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))


def with_system(msgs: Column, system: str = SYSTEM) -> Column:
    """A system message first, unless there is one anywhere."""
    own = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    return F.when(F.exists(msgs, lambda m: m["role"] == "system"), msgs).otherwise(F.concat(own, msgs))


def trace_id(position: Column, canonical: Column) -> Column:
    return F.concat(F.format_string("t%06d_", position), F.substring(F.sha1(canonical.cast("binary")), 1, 10))


def axolotl(msgs: Column, score: Column, id_: Column, error: Column, signal: Column | None = None) -> Column:
    """{id, messages, metadata {quality_score, error_class, signal if there is one}}"""
    extra = F.struct(F.round(score, 4).alias("quality_score"), error.alias("error_class"), *([signal.alias("signal")] if signal is not None else []))
    return F.to_json(F.struct(id_.alias("id"), with_system(normalised(msgs)).alias("messages"), extra.alias("metadata")))


def sharegpt(msgs: Column) -> Column:
    """{conversations: [{from, value}]}"""
    name = lambda m: F.when(m["role"] == "user", F.lit("human")).when(m["role"] == "assistant", F.lit("gpt")).otherwise(m["role"])
    return F.to_json(F.struct(F.transform(with_system(normalised(msgs)), lambda m: F.struct(name(m).alias("from"), m["content"].alias("value"))).alias("conversations")))


def unsloth(msgs: Column, score: Column, id_: Column, error: Column, signal: Column | None = None) -> Column:
    """{id, messages, score, error_class, signal if there is one}"""
    return F.to_json(F.struct(id_.alias("id"), with_system(normalised(msgs)).alias("messages"), F.round(score, 4).alias("score"), error.alias("error_class"), *([signal.alias("signal")] if signal is not None else [])))


def write_lines(lines: DataFrame, path: str, order: str) -> None:
    """One text column as a directory of part files whose names follow the order."""
    value = next(c for c in lines.columns if c != order)
    lines.orderBy(order).select(F.col(value).alias("value")).write.mode("overwrite").text(path)
