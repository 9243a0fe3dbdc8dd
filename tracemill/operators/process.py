"""What becomes of a reasoning span: noop, rules, compress, invert, or both of these."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import estimate_tokens, strip
from tracemill.operators import prompts, rules
from tracemill.operators.chat import ChatBackend, call

MODES = ("noop", "rules", "compress", "invert", "both")


def resolve_mode(mode: str | None, legacy: str | None = None) -> str:
    """The mode of new or old options; llm is the old name of compress."""
    name = (mode or legacy or "rules").lower()
    name = "compress" if name == "llm" else name
    if name not in MODES:
        raise ValueError(f"unknown mode: {name!r}")
    return name


def _or(text: Column, otherwise: str) -> Column:
    stripped = strip(F.coalesce(text, F.lit("")))
    return F.when(stripped == "", F.lit(otherwise)).otherwise(stripped)


def compress_user(problem: Column, answer: Column, text: Column) -> Column:
    return F.concat(F.lit("PROBLEM:\n"), _or(problem, "(no problem given)"), F.lit("\n\nANSWER:\n"), _or(answer, "(no answer given)"), F.lit("\n\nREASONING:\n"), text)


def invert_user(problem: Column, answer: Column, text: Column) -> Column:
    return F.concat(F.lit("Problem:\n"), _or(problem, "(no problem given)"), F.lit("\n\nModel's final answer:\n"), _or(answer, "(no answer given)"), F.lit("\n\nReasoning Bubbles:\n"), text, F.lit("\n\nReconstruct the full reasoning."))


def _stage(spans: DataFrame, mode: str, level: str, make: Callable[[], ChatBackend] | None, seqs: int, retries: int) -> DataFrame:
    text = F.col("processed")
    if mode == "noop":
        return spans
    if mode == "rules":
        return spans.withColumn("processed", rules.compress(text, level))
    if make is None:
        raise ValueError(f"mode {mode} needs a chat backend")
    user = (compress_user if mode == "compress" else invert_user)(F.col("problem"), F.col("answer"), text)
    system = prompts.compress_prompt(level) if mode == "compress" else prompts.invert_prompt()
    done = call(spans.withColumns({"system": F.lit(system), "user": user}), make, seqs, retries, f"chat-{mode}")
    reply = F.col("chat_reply")
    return done.withColumn("processed", F.when(F.length(strip(F.coalesce(reply, F.lit("")))) > 0, reply).otherwise(text)).drop("system", "user", "chat_reply", "chat_error")


def process(spans: DataFrame, mode: str = "rules", level: str = "lite", make: Callable[[], ChatBackend] | None = None, seqs: int = 1, retries: int = 2) -> DataFrame:
    """spans (text, problem, answer ...) with processed, original_tokens, processed_tokens. A failed or blank reply leaves the text."""
    mode = resolve_mode(mode)
    out = spans.withColumn("processed", F.col("text"))
    for stage in ("compress", "invert") if mode == "both" else (mode,):
        out = _stage(out, stage, level, make, seqs, retries)
    blank = F.length(strip(F.col("text"))) == 0
    after = estimate_tokens(F.col("processed"))
    if mode in ("rules", "noop"):
        after = F.when(blank, F.lit(0).cast("bigint")).otherwise(after)
    return out.withColumns({"original_tokens": estimate_tokens(F.col("text")), "processed_tokens": after})


def get_compressor(mode: str, level: str = "lite", make: Callable[[], ChatBackend] | None = None, seqs: int = 1) -> Callable[[DataFrame], DataFrame]:
    """The older interface: a function from a table with text to that table with processed and token counts, without rails."""
    if mode not in ("rules", "llm", "noop"):
        raise ValueError(f"unknown compressor: {mode!r}")

    def run(texts: DataFrame) -> DataFrame:
        bare = texts.withColumns({c: F.lit("") for c in ("problem", "answer") if c not in texts.columns})
        out = process(bare, mode, level, make, seqs)
        return out.drop(*[c for c in ("problem", "answer") if c not in texts.columns])

    return run
