"""The curation run: JSONL traces in; three formats, a card and a report out."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators import dedup, process, prompts, qaqc, quality, redact
from tracemill.operators.chat import ChatBackend
from tracemill.plans import report as reports
from tracemill.plans.report import RunStats
from tracemill.session import ship, small_batches, stable
from tracemill.sources import export
from tracemill.sources import traces as T


@dataclass(frozen=True)
class Options:
    mode: str = "rules"
    level: str = "lite"
    anonymize_level: str = "strict"
    max_similarity: float = 0.92
    qaqc: bool = False
    qaqc_mirrors: int = 1
    seqs: int = 1
    retries: int = 2
    make_chat: Callable[[], ChatBackend] | None = None


def written_back(traces: DataFrame, results: DataFrame) -> DataFrame:
    """traces with the processed texts of their spans (trace_idx, span_idx, path, kind, processed) in place."""
    ship(traces.sparkSession)
    changes = results.groupBy("trace_idx").agg(F.sort_array(F.collect_list(F.struct("span_idx", "path", "kind", "processed"))).alias("changes"))  # bounded by one trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for batch in batches:
            out = []
            for raw, edits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out.append(T.dumps(T.patch(json.loads(raw), [(e["path"], e["kind"], e["processed"]) for e in edits])) if edits else raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["trace_idx", "raw"])

    return traces.join(changes, "trace_idx", "left").select("trace_idx", "raw", "changes").mapInArrow(run, "trace_idx bigint, raw string")


def redacted(traces: DataFrame, level: str) -> tuple[DataFrame, DataFrame]:
    """(traces with every string redacted; trace_idx, redactions of those with any). Strings are redacted as a table of leaves."""
    found = stable(redact.redact(T.leaves(traces), "value", level).where("n_redactions > 0").select("trace_idx", "path", F.col("redacted").alias("value"), "n_redactions"), "redacted-leaves")
    counts = found.groupBy("trace_idx").agg(F.sum("n_redactions").alias("redactions"))
    return T.patch_leaves(traces, found.drop("n_redactions")), counts


def scored(kept: DataFrame) -> DataFrame:
    """kept traces (trace_idx, raw, canonical, messages, signal) with position, id, the six scores, composite, error_class."""
    out = T.with_index(kept, ["trace_idx"], "position")
    out = out.withColumns(quality.scores(F.col("messages"), F.col("raw"))).withColumns({"error_class": quality.error_class(F.col("raw")), "id": export.trace_id(F.col("position"), F.col("canonical"))})
    return out.withColumn("composite", quality.composite())


@dataclass
class Curated:
    stats: RunStats
    report: DataFrame
    scored: DataFrame


def curate(traces: DataFrame, options: Options) -> Curated:
    """All steps but files, on trace_idx, raw. Traces go to Python a few MB at a time, so a worker's memory doesn't grow with the input."""
    with small_batches(traces.sparkSession):
        return _curate(traces, options)


def _curate(traces: DataFrame, options: Options) -> Curated:
    mode = process.resolve_mode(options.mode)
    found = T.spans(traces)
    results = stable(process.process(found, mode, options.level, options.make_chat, options.seqs, options.retries), "processed")
    signals = None
    if options.qaqc:
        if options.make_chat is None:
            raise ValueError("qaqc needs a chat backend")
        signals = qaqc.row_signal(stable(qaqc.validate(results, mode, options.make_chat, options.qaqc_mirrors, options.seqs, options.retries), "grades"))
    clean, counts = redacted(written_back(traces, results), options.anonymize_level)
    rollup = reports.trace_rollup(traces, results).join(counts, "trace_idx", "left")
    rollup = rollup.join(signals, "trace_idx", "left") if signals is not None else rollup.withColumn("signal", F.lit(None).cast("double"))
    rollup = stable(rollup.withColumns({"redactions": F.coalesce("redactions", F.lit(0)).cast("bigint"), "signal": F.coalesce("signal", F.lit(-1.0))}), "report")
    done = stable(T.finished(clean.join(rollup.select("trace_idx", "signal"), "trace_idx")), "finished")
    keep = dedup.keep_first(done.select("trace_idx", dedup.signature(F.col("messages")).alias("text")), options.max_similarity, "text", "trace_idx")
    rows = stable(scored(done.join(keep, "trace_idx", "left_semi")), "scored")
    one = reports.run_rollup(rollup).first()
    kept = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("composite"), F.lit(0.0)).alias("score")).first()
    errors = {r["error_class"]: r["n"] for r in reports.error_histogram(rows).collect()}  # six classes
    stats = RunStats(one["avg_signal"], kept["score"], one["traces_in"], one["tokens_before"], one["redactions"], one["tokens_after"], one["spans"], kept["n"], errors)
    return Curated(stats, rollup, rows)


def run(spark: SparkSession, output_dir: str, *, input_dir: str | None = None, input_file: str | None = None, options: Options | None = None) -> RunStats:
    """Read, curate and write; the JSONL outputs are directories of ordered part files."""
    options = options or Options()
    process.resolve_mode(options.mode)
    traces, _rejects = T.load(spark, *[p for p in (input_file, input_dir) if p])
    out = Path(output_dir)
    (out / "prompts").mkdir(parents=True, exist_ok=True)
    for name, text in prompts.files().items():
        (out / "prompts" / name).write_text(text, encoding="utf-8")
    result = curate(traces, options)
    rows, c = result.scored, F.col
    for name, line in (("data", export.axolotl(c("messages"), c("composite"), c("id"), c("error_class"), c("signal"))), ("sharegpt", export.sharegpt(c("messages"))), ("unsloth", export.unsloth(c("messages"), c("composite"), c("id"), c("error_class"), c("signal")))):
        export.write_lines(rows.select("position", line.alias("line")), os.path.join(output_dir, f"{name}.jsonl"), "position")
    (out / "dataset_card.md").write_text(reports.card(result.stats), encoding="utf-8")
    with (out / "compression_report.md").open("w", encoding="utf-8") as file:
        file.write("\n".join(reports.REPORT_HEAD) + "\n")
        for row in reports.report_lines(result.report).orderBy("trace_idx").toLocalIterator():  # a partition at a time
            file.write(row["line"] + "\n")
    return result.stats


def push_to_hub(output_dir: str, repo_id: str, private: bool = True, api=None) -> None:
    """Upload the output folder as a dataset; off unless asked for. api: any object with create_repo and upload_folder."""
    if not repo_id:
        raise ValueError("a repository id is needed")
    if api is None:
        try:
            import huggingface_hub
        except ImportError as e:
            raise SystemExit("huggingface_hub is not installed") from e
        api = huggingface_hub.HfApi()
    kind = {"repo_type": "dataset"}
    api.create_repo(repo_id, exist_ok=True, private=private, **kind)
    api.upload_folder(repo_id=repo_id, folder_path=output_dir, **kind)
