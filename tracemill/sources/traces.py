"""Traces as JSON: reading, walking, finding spans, patching.

A trace is one JSON object of any shape, kept as text. What Catalyst can't express, because the shape is only known row by row,
is done here in Arrow batches, one parse a row: reasoning spans of every kind, writing them back, redacting every string, and
the flat columns (messages, JSON text) on which all other operators are plain expressions.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators.spans import ASKERS, ASSISTANTS, TAGS
from tracemill.session import ship, stable

TAGGED = re.compile(rf"(?is)<({'|'.join(TAGS)})>(.*?)</\1>")
BLOCK_FIELDS, MESSAGE_FIELDS = "reasoning thought analysis".split(), "reasoning thinking analysis thought".split()
SPAN = "struct<span_idx:int,source:string,path:string,kind:string,tag:string,text:string,problem:string,answer:string>"
MESSAGES = "array<struct<role:string,content:string>>"


def dumps(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False)


def canonical(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


# reading


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """source, path, block, line_no, raw of all lines that aren't blank. A directory gives its *.jsonl files, at any depth."""
    out: DataFrame | None = None
    for n, path in enumerate(paths):
        reader = spark.read.option("recursiveFileLookup", True)
        if not path.endswith(".jsonl"):
            reader = reader.option("pathGlobFilter", "*.jsonl")
        rows = reader.text(path).select(F.lit(n).alias("source"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("raw"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no input given")
    return out.where("raw <> ''")


def _kind(line: str) -> str | None:
    """Why a line is no trace; None if it is one."""
    try:
        return None if isinstance(json.loads(line), dict) else "not an object"
    except ValueError:
        return "malformed"


def checked(lines: DataFrame) -> DataFrame:
    """lines with reject: null, or why the line is no trace."""
    ship(lines.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("raw")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([_kind(v.as_py()) for v in batch.column(at)], pa.string())], [*batch.schema.names, "reject"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    return lines.mapInArrow(run, schema + ", reject string")


def load(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """(traces: trace_idx, raw; rejects: path, raw, reject). Files first as given, then by path, then by place; no row is merged."""
    lines = stable(checked(scan(spark, *paths)), "trace-lines")
    traces = with_index(lines.where("reject IS NULL"), ["source", "path", "block", "line_no"]).select("trace_idx", "raw")
    if traces.isEmpty():
        raise SystemExit("no traces loaded")
    return traces, lines.where("reject IS NOT NULL").select("path", "raw", "reject")


def with_index(df: DataFrame, order: list[str], name: str = "trace_idx") -> DataFrame:
    """df with gapless positions in an order: sorted once, counted by partition, numbered from the partitions' offsets."""
    ordered = stable(df.orderBy(*order).withColumn("__tm_at", F.monotonically_increasing_id()), "indexed")  # partition in the high bits
    part, place = F.shiftright("__tm_at", 33), F.col("__tm_at").bitwiseAND((1 << 33) - 1)
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    if not offsets:
        return ordered.drop("__tm_at").withColumn(name, F.lit(0).cast("bigint")).limit(0)
    table = df.sparkSession.createDataFrame(offsets, "__tm_part bigint, __tm_first bigint")
    return ordered.withColumn("__tm_part", part).join(F.broadcast(table), "__tm_part").withColumn(name, F.col("__tm_first") + place).drop("__tm_part", "__tm_first", "__tm_at")


# one trace


def walk(node: Any, path: tuple = ()) -> Iterator[tuple[tuple, Any]]:
    """All nodes before their children, in document order."""
    yield path, node
    children = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ()
    for key, child in children:
        yield from walk(child, (*path, key))


def assign(root: Any, path: tuple | list, value: Any) -> None:
    for key in path[:-1]:
        root = root[key]
    root[path[-1]] = value


def messages(trace: dict) -> list:
    for key in ("messages", "conversations"):
        if isinstance(trace.get(key), list):
            return trace[key]
    return []


def content(message: dict) -> str:
    body = message.get("content")
    if isinstance(body, list):
        part = lambda block: block.get("text", "") if isinstance(block, dict) else block
        return "\n".join(str(part(block)) for block in body)
    return body if isinstance(body, str) else ""


def _texts(body: list) -> Iterator[Any]:
    """What the text blocks hold."""
    for block in body:
        if isinstance(block, dict) and block.get("type") == "text":
            yield block.get("text", "")


def _said(message: Any) -> str | None:
    """An asker's words before a span, or None."""
    if not isinstance(message, dict) or message.get("role") not in ASKERS:
        return None
    body = message.get("content")
    if isinstance(body, list):
        body = " ".join(map(str, _texts(body)))
    return body.strip() or None if isinstance(body, str) else None


def _visible(text: str) -> str:
    return TAGGED.sub("", text).strip()


def _answer(message: dict) -> str:
    body = message.get("content")
    if isinstance(body, str):
        return _visible(body)
    if isinstance(body, list):
        shown = [_visible(words) for words in _texts(body) if isinstance(words, str)]
        return "\n\n".join(s for s in shown if s).strip()
    return ""


def _tagged(path: tuple, text: str) -> Iterator[dict]:
    for match in TAGGED.finditer(text):
        yield {"source": "tag:" + match[1].lower(), "path": path, "kind": "tag", "tag": match[1], "text": match[2]}


def _fields(path: tuple, holder: dict, names: list[str]) -> Iterator[dict]:
    for name in names:
        if isinstance(holder.get(name), str) and holder[name].strip():
            yield {"source": "field:" + name, "path": (*path, name), "kind": "field", "tag": None, "text": holder[name]}


def _of_message(path: tuple, message: dict) -> Iterator[dict]:
    body = message.get("content")
    if isinstance(body, str) and TAGGED.search(body):
        yield from _tagged((*path, "content"), body)
        return  # fields of such a message are left alone
    for n, block in enumerate(body if isinstance(body, list) else ()):
        if isinstance(block, dict):
            here = (*path, "content", n)
            inner = block.get("thinking")
            if isinstance(inner, str) and block.get("type") == "thinking":
                yield {"source": "block:thinking", "path": (*here, "thinking"), "kind": "field", "tag": None, "text": inner}
            yield from _fields(here, block, BLOCK_FIELDS)
    yield from _fields(path, message, MESSAGE_FIELDS)


def find_spans(trace: Any) -> list[dict]:
    """The reasoning spans, in order, each with path, kind and rails; anywhere in the trace if no message has one."""
    found: list[dict] = []
    turns = trace.get("messages", ()) if isinstance(trace, dict) else ()
    said: list[str] = []
    for n, message in enumerate(turns if isinstance(turns, list) else ()):
        if isinstance(message, dict) and message.get("role") in ASSISTANTS:
            rails = {"problem": "\n\n".join(said), "answer": _answer(message)}
            found += [span | rails for span in _of_message(("messages", n), message)]
        if (words := _said(message)) is not None:
            said.append(words)
    if not found:
        for path, node in walk(trace):
            if isinstance(node, str) and "<" in node:
                found += [span | {"problem": "", "answer": ""} for span in _tagged(path, node)]
    return [span | {"span_idx": i, "path": dumps(list(span["path"]))} for i, span in enumerate(found)]


def patch(trace: Any, changes: list[tuple[str, str, str]]) -> Any:
    """The trace with its spans' texts replaced: (path, kind, new text) in span order. Tagged text is rebuilt by position."""
    tagged: dict[str, list[str]] = {}
    for path, kind, new in changes:
        if kind == "tag":
            tagged.setdefault(path, []).append(new)
        else:
            assign(trace, json.loads(path), new)
    for path, news in tagged.items():
        keys, fresh = json.loads(path), iter(news)
        node: Any = trace
        for key in keys:
            node = node[key]
        text = TAGGED.sub(lambda m: f"<{m[1]}>{next(fresh, m[2])}</{m[1]}>", node)  # noqa: B023
        if not keys:
            return text
        assign(trace, keys, text)
    return trace


def map_strings(node: Any, change: Callable[[str], str]) -> Any:
    """Every string value changed, keys left alone."""
    if isinstance(node, str):
        return change(node)
    if isinstance(node, dict):
        return {k: map_strings(v, change) for k, v in node.items()}
    return [map_strings(v, change) for v in node] if isinstance(node, list) else node


def signal_of(trace: dict) -> Any:
    extra = trace.get("metadata")
    return extra["signal"] if isinstance(extra, dict) and "signal" in extra else trace.get("signal")


def stamp(trace: dict, signal: float) -> None:
    if not isinstance(trace.get("metadata"), dict):
        trace["metadata"] = {}
    trace["metadata"]["signal"] = trace["signal"] = round(signal, 4)


def trace_id(trace: dict, position: int) -> str:
    return f"t{position:06d}_{hashlib.sha1(canonical(trace).encode()).hexdigest()[:10]}"


# tables of traces


def leaves(traces: DataFrame, key: str = "trace_idx", raw: str = "raw") -> DataFrame:
    """key, path, value of every string in every trace."""
    ship(traces.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, dumps(list(p)), v) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for p, v in walk(json.loads(text)) if isinstance(v, str)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.string()) for i in (1, 2))], ["key", "path", "value"])

    return traces.select(F.col(key).cast("bigint"), raw).mapInArrow(run, "key bigint, path string, value string").withColumnRenamed("key", key)


def patch_leaves(traces: DataFrame, changes: DataFrame, key: str = "trace_idx", raw: str = "raw") -> DataFrame:
    """key, raw with the changed leaves (key, path, value) assigned; traces without changes stay as they are."""
    packed = changes.groupBy(key).agg(F.collect_list(F.struct("path", "value")).alias("changes"))  # bounded by one trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, edits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                trace = json.loads(text) if edits else None
                for edit in edits or ():
                    if path := json.loads(edit["path"]):
                        assign(trace, path, edit["value"])
                    else:
                        trace = edit["value"]
                out.append(dumps(trace) if edits else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, raw])

    return traces.join(packed, key, "left").select(F.col(key).cast("bigint"), raw, "changes").mapInArrow(run, f"`{key}` bigint, `{raw}` string")


def spans(traces: DataFrame) -> DataFrame:
    """trace_idx and the fields of each span."""
    ship(traces.sparkSession)
    names = ("span_idx", "source", "path", "kind", "tag", "text", "problem", "answer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, s) for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for s in find_spans(json.loads(raw))]
            columns = [pa.array([r[1][n] for r in rows], pa.int32() if n == "span_idx" else pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *columns], ["trace_idx", *names])

    return traces.select("trace_idx", "raw").mapInArrow(run, "trace_idx bigint, " + SPAN[7:-1].replace(":", " "))


def finished(traces: DataFrame) -> DataFrame:
    """trace_idx, signal, raw with the signal stamped, sorted (canonical JSON), messages: what all later operators need."""
    ship(traces.sparkSession)
    entry = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ordered, turns = [], [], []
            for raw, signal in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                trace = json.loads(raw)
                stamp(trace, signal)
                texts.append(dumps(trace))
                ordered.append(canonical(trace))
                turns.append([{"role": None if m.get("role") is None else str(m["role"]), "content": content(m)} for m in messages(trace) if isinstance(m, dict)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(texts, pa.string()), pa.array(ordered, pa.string()), pa.array(turns, entry)], ["trace_idx", "signal", "raw", "canonical", "messages"])

    return traces.select("trace_idx", "raw", "signal").mapInArrow(run, f"trace_idx bigint, signal double, raw string, canonical string, messages {MESSAGES}")
