"""Six quality scores of a trace, their composite, and its error class; reported, never used to filter.

Inputs are columns: the typed messages and the trace's JSON text (whose escapes and keys the patterns see).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHTS = {name: parts / 20 for name, parts in {"coherence": 3, "length": 3, "reasoning_depth": 4, "refusal": 3, "structure": 4, "tool_calls": 3}.items()}
_DEPTH_TAGS = ("<analyze>", "<reasoning>", "<scratchpad>", "<thinking>", "<thought>")
_CALL_TAGS = ("<function_calls>", "<invoke>", "<tool_call>")


def _spaced(pattern: str) -> str:
    """A pattern in which each space stands for any white space."""
    return pattern.replace(" ", r"\s+")


REFUSAL = _spaced("(?i)(?:not (?:allowed|able) to|unable to|i (?:do not|don't) know|i'?m sorry|i can'?t? (?:assist|do|help))")
#: First match wins. A * after a space means that it may be missing.
ERRORS: dict[str, str] = {
    name: "(?:" + _spaced("|".join(phrases)).replace(r"\s+*", r"\s*") + ")"
    for name, phrases in {
        "tool_failure": ("traceback", r"error *: *\w+", "command not found", "exit code [1-9]", "tool (?:timeout|error|failed)"),
        "syntax_error": ("unmatched (?:brace|paren|bracket)", "invalid syntax", "unexpected token", "parseerror", "syntaxerror"),
        "safety_refusal": ("against my guidelines", "i (?:cannot|must) decline", "i'?m (?:unable|not able)", "i can'?t (?:do|assist|help)"),
        "timeout_stall": ("connection reset", "no response", "stalled", "hung", "deadline exceeded", "timed out", "timeout"),
        "reasoning_error": ("actually,? (?:that is|that's) (?:incorrect|wrong)", "i was (?:incorrect|wrong)", "let me reconsider", "that was wrong", "i made an? (?:error|mistake)"),
    }.items()
}


def _content(m: Column) -> Column:
    return F.coalesce(m["content"], F.lit(""))


def _answers(msgs: Column) -> Column:
    return F.transform(F.filter(msgs, lambda m: m["role"].isin("assistant", "gpt")), _content)


def reasoning_depth(msgs: Column, json_text: Column) -> Column:
    lowered = F.lower(json_text)
    tags = sum((F.contains(lowered, F.lit(t)).cast("int") for t in _DEPTH_TAGS), F.lit(0))
    long = F.size(F.filter(msgs, lambda m: F.length(_content(m)) > 100))
    return 0.4 * F.least(tags / 2, F.lit(1.0)) + 0.6 * F.least(long / 4, F.lit(1.0))


def structure(msgs: Column) -> Column:
    sides = F.exists(msgs, lambda m: F.coalesce(m["role"].isin("human", "user"), F.lit(False))) & F.exists(msgs, lambda m: F.coalesce(m["role"].isin("gpt", "assistant"), F.lit(False)))
    return F.when(sides, 0.5 + 0.5 * F.least(F.size(msgs) / 4, F.lit(1.0))).otherwise(F.lit(0.0))


def tool_calls(json_text: Column) -> Column:
    lowered = F.lower(json_text)
    return F.when(F.contains(lowered, F.lit(_CALL_TAGS[0])) | F.contains(lowered, F.lit(_CALL_TAGS[1])) | F.contains(lowered, F.lit(_CALL_TAGS[2])), F.lit(1.0)).otherwise(F.lit(0.5))


def coherence(msgs: Column) -> Column:
    said = _answers(msgs)
    return F.when(F.size(msgs) < 2, F.lit(0.5)).when(F.size(said) == 0, F.lit(0.4)).otherwise(F.size(F.array_distinct(said)) / F.greatest(F.size(said), F.lit(1)))


def length(json_text: Column) -> Column:
    return F.when(F.length(json_text) < 256, F.lit(0.2)).when(F.length(json_text) > 100_000, F.lit(0.5)).otherwise(F.lit(1.0))


def refusal(msgs: Column) -> Column:
    said = F.array_join(_answers(msgs), "\n")
    return F.when(said == "", F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), 1.0 - 0.25 * F.regexp_count(said, F.lit(REFUSAL))))


def scores(msgs: Column, json_text: Column) -> dict[str, Column]:
    return {
        "reasoning_depth": reasoning_depth(msgs, json_text), "structure": structure(msgs), "tool_calls": tool_calls(json_text),
        "coherence": coherence(msgs), "length": length(json_text), "refusal": refusal(msgs),
    }


def composite() -> Column:
    """Of columns named like the scores."""
    return sum((F.col(name) * weight for name, weight in WEIGHTS.items()), F.lit(0.0))


def error_class(json_text: Column) -> Column:
    out = F.lit("none")
    for name, pattern in reversed(ERRORS.items()):
        out = F.when(json_text.rlike(r"(?i)\b" + pattern), F.lit(name)).otherwise(out)
    return out
