import json

import pytest
from pyspark.sql import functions as F

from tracemill import cli
from tracemill.operators import chat, process, prompts, qaqc, spans
from tracemill.plans import pipeline, report
from tracemill.sources import export
from tracemill.sources import traces as T


def turn(speaker, words, **more):
    return dict(role=speaker, content=words, **more)


def block(kind, **more):
    return dict(type=kind, **more)


def talk(*turns):
    return dict(messages=list(turns))


def test_tagged_spans_with_rails():
    trace = talk(turn("system", " be good "), turn("user", [block("text", text="why"), block("image")]), turn("assistant", "<Thinking>a</Thinking> x <reasoning>b</reasoning>", reasoning="ignored"))
    a, b = T.find_spans(trace)
    assert (a["source"], a["text"], b["source"], b["text"]) == ("tag:thinking", "a", "tag:reasoning", "b")
    assert a["problem"] == "be good\n\nwhy" and a["answer"] == "x"
    T.patch(trace, [(a["path"], "tag", "A"), (b["path"], "tag", "B")])
    assert trace["messages"][2]["content"] == "<Thinking>A</Thinking> x <reasoning>B</reasoning>"


def test_blocks_and_fields():
    trace = talk(turn("model", [block("thinking", thinking="t"), block("text", text="<think>q</think> shown", analysis="an", thought=" ")], reasoning="r"))
    assert [(s["source"], s["text"]) for s in T.find_spans(trace)] == [("block:thinking", "t"), ("field:analysis", "an"), ("field:reasoning", "r")]
    assert T.find_spans(trace)[0]["answer"] == "shown"
    plain = talk(turn("assistant", "answer", reasoning="why"))
    assert [s["source"] for s in T.find_spans(plain)] == ["field:reasoning"]


def test_fallback_walk_anywhere():
    trace = {"conversations": [{"from": "gpt", "value": "<thought>deep</thought>"}], "meta": {"x": ["<think>n</think>"]}}
    assert [s["text"] for s in T.find_spans(trace)] == ["deep", "n"]
    assert T.find_spans(talk(turn("gpt", "<think attr=1>n</think>"))) == []


def test_equal_spans_are_rebuilt_by_place():
    text = "<think>x</think><think>x</think>"
    trace = talk(turn("assistant", text))
    path = T.find_spans(trace)[0]["path"]
    assert T.patch(trace, [(path, "tag", "x"), (path, "tag", "y")])["messages"][0]["content"] == "<think>x</think><think>y</think>"


def test_navigation():
    assert T.messages({"messages": {}, "conversations": [1]}) == [1] and T.messages({}) == []
    assert T.content({"content": [{"text": "a"}, {"type": "image"}, 3]}) == "a\n\n3" and T.content({"content": 4}) == ""
    assert T.signal_of({"metadata": {"signal": 0.2}, "signal": 1}) == 0.2 and T.signal_of({"metadata": [], "signal": 1}) == 1
    trace = {"metadata": "odd"}
    T.stamp(trace, 0.123456)
    assert trace == {"metadata": {"signal": 0.1235}, "signal": 0.1235}
    assert T.trace_id({"b": 1, "a": "é"}, 1234567).startswith("t1234567_")


def test_scan_rejects_and_order(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "one.jsonl").write_text('{"n": 0}\n\n  \n{"n": 1} x\n[1]\n{"n": 1, "n": 2}\n', encoding="utf-8")
    (tmp_path / "d" / "b.jsonl").write_text('{"n": 4}\n', encoding="utf-8")
    (tmp_path / "d" / "a.jsonl").write_text('{"n": 3}\n', encoding="utf-8")
    (tmp_path / "d" / "sub" / "c.jsonl").write_text('{"n": NaN}\n', encoding="utf-8")
    (tmp_path / "d" / "no.txt").write_text('{"n": 9}\n', encoding="utf-8")
    traces, rejects = T.load(spark, str(tmp_path / "one.jsonl"), str(tmp_path / "d"))
    rows = [(r.trace_idx, json.loads(r.raw)["n"]) for r in traces.orderBy("trace_idx").collect()]
    assert rows[:4] == [(0, 0), (1, 2), (2, 3), (3, 4)] and len(rows) == 5
    assert sorted(r.reject for r in rejects.collect()) == ["malformed", "not an object"]
    (tmp_path / "empty.jsonl").write_text("\n")
    with pytest.raises(SystemExit):
        T.load(spark, str(tmp_path / "empty.jsonl"))


def test_typed_spans(spark):
    rows = [(1, [("user", "q"), ("assistant", "<THINK>t</THINK> a")])]
    df = spark.createDataFrame(rows, "conv_id long, messages array<struct<role:string,content:string>>")
    (s,) = spans.spans(df).collect()
    assert (s.msg_idx, s.source, s.text, s.problem, s.answer) == (1, "tag:think", "t", "q", "a")


class Stub:
    def __init__(self, reply=None, fail=0, error=None):
        self.reply, self.fail, self.error, self.seen = reply, fail, error, []

    def chat(self, system, user):
        self.seen.append((system, user))
        if self.fail:
            self.fail -= 1
            raise chat.Transient("later")
        if self.error:
            raise RuntimeError(self.error)
        return self.reply if self.reply is not None else user.upper()


def test_chat_order_retry_and_failure():
    items = [("s", f"u{i}") for i in range(20)]
    assert [a for a, _ in chat.batch_chat(Stub(), items, 4)] == [u.upper() for _, u in items]
    assert chat.batch_chat(Stub(), []) == []
    waits = []
    assert chat.with_retry(Stub("ok", fail=2), "s", "u", 2, waits.append) == "ok" and waits == [1, 2]
    with pytest.raises(chat.Transient):
        chat.with_retry(Stub("ok", fail=3), "s", "u", 2, waits.append)
    assert chat.batch_chat(Stub(error="boom"), items[:1]) == [(None, "boom")]


def span_frame(spark, texts):
    return spark.createDataFrame([(0, i, t, "p", "") for i, t in enumerate(texts)], "trace_idx long, span_idx int, text string, problem string, answer string")


def test_process_modes(spark):
    frame = span_frame(spark, ["Basically, it is fine", "  "])
    rules = process.process(frame, "rules").orderBy("span_idx").collect()
    assert rules[0].processed == "it is fine" and (rules[1].original_tokens, rules[1].processed_tokens) == (1, 0)
    assert [r.processed for r in process.process(frame, "noop").orderBy("span_idx").collect()] == ["Basically, it is fine", "  "]
    out = process.process(frame, "compress", make=lambda: Stub("short"), seqs=2).orderBy("span_idx").collect()
    assert [r.processed for r in out] == ["short", "short"] and out[0].answer == ""
    blank = process.process(frame, "compress", make=lambda: Stub(" "), seqs=2).orderBy("span_idx").collect()
    assert blank[0].processed == "Basically, it is fine"
    both = process.process(span_frame(spark, ["x"]), "both", make=lambda: Stub(), seqs=1).first()
    assert both.processed.startswith("PROBLEM:") and "REASONING BUBBLES:\nPROBLEM:" in both.processed.upper()
    assert process.resolve_mode(None, "llm") == "compress" and process.resolve_mode(None) == "rules"
    with pytest.raises(ValueError):
        process.resolve_mode("odd")
    with pytest.raises(ValueError):
        process.process(frame, "invert")


def test_older_interface(spark):
    texts = spark.createDataFrame([("It is really fine",)], "text string")
    assert process.get_compressor("rules")(texts).first().processed == "It is fine"
    out = process.get_compressor("llm", make=lambda: Stub("short"))(texts)
    assert out.first().processed == "short" and "problem" not in out.columns
    with pytest.raises(ValueError):
        process.get_compressor("odd")


GRADES = [
    (json.dumps({"safety": 0.7, "content_fidelity": -0.2, "logical_fidelity": 1.4, "signal": 2.0}), (1.0, 1.0, 0.0, 0.7), ""),
    (f"x {json.dumps({'safety': 0.4, 'content_fidelity': 0.8, 'logical_fidelity': 0.9})} y", (0.4, 0.9, 0.8, 0.4), ""),
    ("not json", (0.0,) * 4, "parse_error"),
    ('{"broken": ', (0.0,) * 4, "parse_error"),
    ('{"logical_fidelity":"0.5","content_fidelity":true,"safety":[1],"signal":null,"notes":" n "}', (0.0, 0.5, 1.0, 0.0), "n"),
]


@pytest.mark.parametrize(("raw", "numbers", "notes"), GRADES)
def test_parse_grade(spark, raw, numbers, notes):
    g = spark.createDataFrame([(raw,)], "r string").select(qaqc.parse_grade(F.col("r")).alias("g")).first().g
    assert (g.signal, g.logical_fidelity, g.content_fidelity, g.safety) == pytest.approx(numbers) and g.notes == notes


class Judge:
    """Each call of this process grades lower."""

    def chat(self, system, user):
        if "explode" in user:
            raise RuntimeError("gone")
        return json.dumps(dict.fromkeys(("safety", "signal"), 0.5) | dict.fromkeys(("content_fidelity", "logical_fidelity"), 1))


def test_validate_takes_the_worst_and_notes_errors(spark):
    frame = span_frame(spark, ["fine", "explode"]).withColumn("processed", F.col("text"))
    a, b = qaqc.validate(frame, "rules", Judge, mirrors=3, seqs=2).orderBy("span_idx").collect()
    assert a.per_judge == [0.5, 0.5, 0.5] and a.signal == 0.5 and b.signal == 0.0 and b.notes == "call_error: gone"
    graded = spark.createDataFrame([(1, j, (s, s, s, s, "")) for j, s in ((1, 0.9), (2, 0.5), (3, 0.7))], "k int, judge_no int, grade struct<signal:double,logical_fidelity:double,content_fidelity:double,safety:double,notes:string>")
    w = qaqc.worst(graded, ["k"]).first()
    assert w.signal == 0.5 and w.per_judge == [0.9, 0.5, 0.7]
    with pytest.raises(ValueError):
        qaqc.validate(frame, "rules", Judge, mirrors=0)
    assert qaqc.judge_mode("both") == "invert" and qaqc.judge_mode("noop") == "compress"


def test_exports(spark):
    df = spark.createDataFrame([([("human", "q"), ("gpt", "a"), (None, None)], 0.123456, None)], "m array<struct<role:string,content:string>>, s double, g double")
    c = F.col
    row = df.select(export.axolotl(c("m"), c("s"), F.lit("t1"), F.lit("none"), c("g")).alias("a"), export.sharegpt(c("m")).alias("s"), export.unsloth(c("m"), c("s"), F.lit("t1"), F.lit("none"), F.lit(-1.0)).alias("u")).first()
    a, s, u = map(json.loads, row)
    assert a["metadata"] == {"quality_score": 0.1235, "error_class": "none"} and [m["role"] for m in a["messages"]] == ["system", "user", "assistant", ""]
    assert [m["from"] for m in s["conversations"]] == ["system", "human", "gpt", ""] and list(s) == ["conversations"]
    assert u["score"] == 0.1235 and u["signal"] == -1.0


ASKED = turn("user", "why? mail bob@example.org")
REPLY = turn("assistant", "<thinking>Okay, so basically it is just slow because of the missing index on the table</thinking>\nAdd an index on the table.")
SAMPLE = [talk(ASKED, REPLY) | {"session_id": name} for name in "ab"] + [{"conversations": [turn("human", "hi"), turn("gpt", "hello")]}]


def run(spark, tmp_path, **options):
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, SAMPLE)) + "\nbroken\n", encoding="utf-8")
    stats = pipeline.run(spark, str(tmp_path / "out"), input_file=str(tmp_path / "in.jsonl"), options=pipeline.Options(**options))
    read = lambda name: [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out" / f"{name}.jsonl")).collect()]
    return stats, read, (tmp_path / "out" / "compression_report.md").read_text(encoding="utf-8"), (tmp_path / "out" / "dataset_card.md").read_text(encoding="utf-8")


def test_run_rules(spark, tmp_path):
    stats, read, table, card = run(spark, tmp_path)
    assert (stats.traces_in, stats.traces_out, stats.spans, stats.redactions, stats.avg_signal) == (3, 2, 2, 2, 0.0)
    data = read("data")
    assert data[0]["messages"][1]["content"] == "why? mail <EMAIL>" and data[0]["metadata"]["signal"] == -1.0
    assert data[0]["messages"][2]["content"] == "<thinking>so it is slow because of the missing index on the table</thinking>\nAdd an index on the table."
    assert len(read("sharegpt")) == len(read("unsloth")) == 2 and "_not run_" in card
    assert table.count("\n") == 7 and "| 2 | 0 | 0 | 0 | 0.0 | — |" in table
    assert {p.name for p in (tmp_path / "out" / "prompts").iterdir()} == set(prompts.files())
    assert stats.line().startswith("STATS_JSON={")


def test_run_noop_keeps_tokens_and_grades(spark, tmp_path):
    stats, read, table, card = run(spark, tmp_path, mode="noop", qaqc=True, qaqc_mirrors=2, make_chat=Judge)
    assert stats.original_tokens == stats.compressed_tokens > 0 and stats.avg_signal == 0.5
    assert read("data")[0]["metadata"]["signal"] == 0.5 and "| 0.500 |" in table and "0.500" in card


def test_card_and_cli(capsys):
    assert "- none" in report.card(report.RunStats()) and "`x/y`" in report.card(report.RunStats(), "x/y")
    assert cli.main(["run"]) == 2 and cli.main(["prompt", "invert"]) == 0
    assert prompts.invert_prompt() in capsys.readouterr().out
    with pytest.raises(ValueError):
        prompts.compress_prompt("odd")
    calls = []
    api = type("Api", (), {"create_repo": lambda s, *a, **k: calls.append(a), "upload_folder": lambda s, **k: calls.append(k)})()
    pipeline.push_to_hub("out", "x/y", api=api)
    assert calls[0] == ("x/y",) and calls[1]["folder_path"] == "out"


def test_stream_dedup_across_batches(spark, tmp_path):
    from tracemill.streaming import DedupSink, read_traces, row_local

    schema = "doc_id long, text string"
    sink = DedupSink(str(tmp_path / "kept"), 0.9)
    sink(spark.createDataFrame([(5, "a b c d e f"), (6, "a b c d e f")], schema), 0)
    later = spark.createDataFrame([(1, "a b c d e f"), (2, "other words than these are here")], schema)
    sink(later, 1)
    sink(later, 1)  # written again after a failure
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "kept")).collect()) == [2, 5]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x.jsonl").write_text('{"a": "just x@y.org"}\n')
    out = row_local(read_traces(spark, str(tmp_path / "s")), "raw").writeStream.format("memory").queryName("rows").trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.table("rows").first().n_redactions >= 0
