"""Reasoning spans in typed messages: array<struct<role, content>>, all in the JVM.

Heterogeneous JSON goes through tracemill.sources.traces, which finds the same spans and more kinds of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import interleave, strip

TAGS = ("analyze", "reasoning", "scratchpad", "think", "thinking", "thought")
TAGGED = rf"(?is)<({'|'.join(TAGS)})>(.*?)</\1>"
ASSISTANTS, ASKERS = ("assistant", "model"), ("system", "user", "human")


def messages(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: key, messages. A conversation is one row by nature; groups are as large as it is."""
    packed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))))
    return turns.groupBy(key).agg(packed.alias("m")).select(key, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def visible(text: Column) -> Column:
    """Text without its reasoning."""
    return strip(F.regexp_replace(text, F.lit(TAGGED), F.lit("")))


def problem(msgs: Column, before: Column) -> Column:
    """What system and user said before a message (0-based), blank ones left out."""
    said = F.transform(F.filter(F.slice(msgs, F.lit(1), before), lambda m: m["role"].isin(*ASKERS)), lambda m: strip(F.coalesce(m["content"], F.lit(""))))
    return F.array_join(F.filter(said, lambda s: s != ""), "\n\n")


def spans(traces: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per span: key, msg_idx, span_idx (within its message), source, text, outer, problem, answer."""
    turns = traces.select(key, "messages", F.posexplode("messages").alias("msg_idx", "m")).where(F.col("m.role").isin(*ASSISTANTS) & F.contains(F.col("m.content"), F.lit("<")))
    take = lambda group: F.regexp_extract_all("m.content", F.lit(TAGGED), F.lit(group))
    each = turns.withColumn("found", F.arrays_zip(take(0).alias("outer"), take(1).alias("tag"), take(2).alias("text"))).where(F.size("found") > 0)
    each = each.select(key, "msg_idx", problem(F.col("messages"), F.col("msg_idx")).alias("problem"), visible(F.col("m.content")).alias("answer"), F.posexplode("found").alias("span_idx", "s"))
    return each.select(key, "msg_idx", "span_idx", F.concat(F.lit("tag:"), F.lower("s.tag")).alias("source"), F.col("s.text").alias("text"), F.col("s.outer").alias("outer"), "problem", "answer")


def write_back(text: Column, replacements: Column) -> Column:
    """Text with the n-th span's inside replaced by replacements[n]; tags keep their case, the rest stays."""
    tags = F.regexp_extract_all(text, F.lit(TAGGED), F.lit(1))
    between = F.zip_with(tags, replacements, lambda t, new: F.concat(F.lit("<"), t, F.lit(">"), new, F.lit("</"), t, F.lit(">")))
    return F.when(text.rlike(TAGGED), interleave(F.split(text, TAGGED, -1), between)).otherwise(text)
