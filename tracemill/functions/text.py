"""Text measures as column expressions; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def estimate_tokens(text: Column) -> Column:
    """Rough token count: CJK ideographs count one each, of the rest four characters one (at least one); empty is 0."""
    rest = F.length(F.regexp_replace(text, r"[\x{4E00}-\x{9FFF}]", ""))
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(F.length(text) - rest + F.greatest(F.lit(1), F.floor(rest / 4))).cast("bigint")


def entropy(text: Column) -> Column:
    """Shannon entropy in bits a character, summed in order of the characters; empty is 0."""
    size = F.length(text)
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    symbols = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))))
    return F.aggregate(symbols, F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c)))


def interleave(parts: Column, between: Column) -> Column:
    """parts[0] between[0] parts[1] ...: what split and regexp_extract_all took apart, put together again."""
    return F.array_join(F.zip_with(parts, between, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def saved_percent(before: Column, after: Column) -> Column:
    return F.when(before == 0, F.lit(0.0)).otherwise(100.0 * (1 - after / F.nullif(before, F.lit(0))))
