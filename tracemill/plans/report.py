"""Rollups and the two Markdown reports."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import saved_percent


@dataclass
class RunStats:
    avg_signal: float = 0.0
    mean_score: float = 0.0
    traces_in: int = 0
    original_tokens: int = 0
    redactions: int = 0
    compressed_tokens: int = 0
    spans: int = 0
    traces_out: int = 0
    errors: dict[str, int] = field(default_factory=dict)

    @property
    def saved(self) -> float:
        return 100.0 * (1 - self.compressed_tokens / self.original_tokens) if self.original_tokens else 0.0

    def line(self) -> str:
        return "STATS_JSON=" + json.dumps(asdict(self) | {"saved_pct": round(self.saved, 4)}, sort_keys=True)

    def lines(self, qaqc: bool = False) -> list[str]:
        rows = [("traces in", self.traces_in), ("traces out", self.traces_out), ("reasoning spans", self.spans), ("tokens before", f"{self.original_tokens:,}"), ("tokens after", f"{self.compressed_tokens:,}"), ("tokens saved", f"{self.saved:.1f}%"), ("redactions", self.redactions)]
        return [f"  {name:<16}: {value}" for name, value in [*rows, *([("avg signal", f"{self.avg_signal:.3f}")] if qaqc else [])]]


def trace_rollup(traces: DataFrame, spans: DataFrame, key: str = "trace_idx") -> DataFrame:
    """key, spans, tokens_before, tokens_after of every trace, also of those without a span."""
    sums = spans.groupBy(key).agg(F.count(F.lit(1)).alias("spans"), F.sum("original_tokens").alias("tokens_before"), F.sum("processed_tokens").alias("tokens_after"))
    return traces.select(key).join(sums, key, "left").select(key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("spans", "tokens_before", "tokens_after")])


def run_rollup(report: DataFrame) -> DataFrame:
    """One row: sums, and the mean signal of the rows that have one (0 if none has)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    graded = F.avg(F.when(F.col("signal") >= 0, F.col("signal")))
    return report.agg(F.count(F.lit(1)).alias("traces_in"), *map(total, ("spans", "tokens_before", "tokens_after", "redactions")), F.coalesce(graded, F.lit(0.0)).alias("avg_signal"))


def error_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("error_class").agg(F.count(F.lit(1)).alias("n"))


def report_lines(report: DataFrame) -> DataFrame:
    """trace_idx, line: one table row for every trace that came in, dropped ones too."""
    signal = F.when(F.col("signal") < 0, F.lit("—")).otherwise(F.format_string("%.3f", "signal"))
    line = F.format_string("| %d | %d | %d | %d | %.1f | %s |", "trace_idx", "spans", "tokens_before", "tokens_after", saved_percent(F.col("tokens_before"), F.col("tokens_after")), signal)
    return report.select("trace_idx", line.alias("line"))


_COLUMNS = "trace,spans,tokens_before,tokens_after,saved %,signal".split(",")
REPORT_HEAD = ["# Processing report", "", f"| {' | '.join(_COLUMNS)} |", "|" + "---|" * len(_COLUMNS)]


def card(stats: RunStats, repo_id: str = "") -> str:
    errors: Iterable[str] = [f"- `{name}`: {n}" for name, n in sorted(stats.errors.items())] or ["- none"]
    signal = f"{stats.avg_signal:.3f}" if stats.avg_signal > 0 else "_not run_"
    table = [
        ("Traces read", stats.traces_in), ("Traces kept", stats.traces_out), ("Spans processed", stats.spans), ("Reasoning tokens before", f"{stats.original_tokens:,}"),
        ("Reasoning tokens after", f"{stats.compressed_tokens:,}"), ("Tokens saved", f"{stats.saved:.1f}%"), ("Redactions", stats.redactions), ("Mean QAQC signal", signal),
    ]
    return "\n".join(
        [
            "# Curated reasoning traces", "", *([f"Repository: `{repo_id}`", ""] if repo_id else []),
            "Reasoning was rewritten; questions, answers, tool calls and code are as they were, but for redactions.", "",
            "## Steps", "", "read, find spans with their problem and answer, process, grade, redact, stamp the signal, drop near duplicates, score, classify, export.", "",
            "## Figures", "", "| figure | value |", "|---|---|", *[f"| {a} | {b} |" for a, b in table], "",
            "## Quality", "", f"Mean composite score: {stats.mean_score:.3f} (reasoning depth and structure weigh 0.20 each; tool calls, coherence, length and refusal 0.15 each). Reported, never a filter.", "",
            "## Errors", "", *errors, "",
            "## Files", "", "`data.jsonl` (messages with metadata), `sharegpt.jsonl`, `unsloth.jsonl`, `prompts/`.", "",
        ]
    )
