import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracemill.functions.text import entropy, estimate_tokens
from tracemill import queries
from tracemill.operators import rules


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "level", "expected"),
    [
        ("Okay, let me see. Clearly, this cache is really a stale one in memory.", "lite", ". this cache is a stale one in memory."),
        ("We verify that it works in order to ship it, with respect to the plan, due to the fact that time is short.", "lite", "We check it works to ship it, re the plan, because time is short."),
        ("a\n\nb", "lite", "a b"),
        ("a\nb", "lite", "a\nb"),
        ('say "see /etc/x" now', "lite", 'say "see /etc/x" now'),
        ("The fault lies in the cable", "full", "The fault lies in cable"),
        ("cached so it is fast", "full", "cached -> it is fast"),
        ("look ```x = just 1``` and `very` at /usr/really/x", "lite", "look ```x = just 1``` and `very` at /usr/really/x"),
        ("It failed 'just because' of v1.2.3", "lite", "It failed 'just because' of v1.2.3"),
        ("   ", "lite", "   "),
        ("", "lite", ""),
        ("nul \0P0\0 just", "lite", "nul \0P0\0 just"),
        ("well\nOkay, go. Right - on", "lite", "go. on"),
        (None, "lite", None),
    ],
)
def test_compress(spark, text, level, expected):
    assert one(spark, text, lambda t: rules.compress(t, level)) == expected


def test_unknown_level():
    with pytest.raises(ValueError):
        rules.compress(F.lit("x"), "mid")


def test_table_counts(spark):
    df = spark.createDataFrame([("I think it is really just fine, you know",), ("  ",)], "text string")
    a, b = rules.compress_table(df).collect()
    assert a.compressed == "it is fine, you know" and a.compressed_tokens < a.original_tokens and 0 < a.ratio < 1
    assert (b.original_tokens, b.compressed_tokens, b.ratio) == (0, 0, 1.0)


@pytest.mark.parametrize(("text", "n"), [("", 0), ("  ", 1), ("abc", 1), ("abcdefgh", 2), ("日本", 3)])
def test_tokens(spark, text, n):
    assert one(spark, text, estimate_tokens) == n


@pytest.mark.parametrize(("text", "bits"), [("", 0.0), ("aaaa", 0.0), ("abcdefghijklmnop", 4.0), ("abab", 1.0)])
def test_entropy(spark, text, bits):
    assert one(spark, text, entropy) == pytest.approx(bits, abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab `'\"/.\n1~<>tool_cal\\C:é", max_size=60), min_size=20, max_size=60))
def test_restore_undoes_protect(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", rules.protect(F.col("t")))
    assert df.where(rules.restore(F.col("p.txt"), F.col("p.originals")) != F.col("t")).count() == 0


def plain(text, level):
    """compress in plain Python."""
    if text is None or not text.strip() or "\0" in text:
        return text
    flags = lambda p: (p[4:], re.NOFLAG) if p.startswith("(?U)") else (p, re.ASCII)
    sub = lambda p, new, t: re.sub(flags(p)[0], new, t, flags=flags(p)[1])
    kept = []

    def put(m):
        kept.append(m[0])
        return f"\0P{len(kept) - 1}\0"

    for pattern in rules.PROTECTED:
        text = sub(pattern, put, text)
    text = sub(rf"(?im)(?:^|(?<=[!.?]\s))(?:{'|'.join(rules.OPENERS)})[-\s,!.:]+", "", text)
    for words in (rules.PLEASANTRIES, rules.HEDGES, rules.FILLER):
        text = sub(rules.phrases(words), "", text)
    for phrase, short in rules.REPLACEMENTS:
        text = sub(rf"(?i)\b{phrase}\b", short, text)
    if level == "full":
        text = sub(r"(?i)(?<=\S )(?:the|an?)\b\s+", "", text)
        text = sub(r"(?i)\bso(?: that)?\b\s+", "-> ", text)
    for pattern, new in [(r"[\t ]+", " "), (r"[\t ]*(\n)[\t ]*", r"\1"), (r"(\n\n)\n+", r"\1"), (r"(?U)\s+([!,.:;?])", r"\1"), (r"(?U)\s{2,}", " ")]:
        text = sub(pattern, new, text)
    text = text.strip()
    for i in reversed(range(len(kept))):
        text = text.replace(f"\0P{i}\0", kept[i])
    return text


FAR = "The value of a word is in the list. " * 12
TURNS = [
    "Okay, so basically I think the cache is just stale, in order to run. Well, it is so that `just so` stays.", FAR + "Perhaps it is really just the case that 'just this' in /usr/just/x is kept.", "a\n\n\n\nb  ,\tc",
    FAR + "\nYeah, see https://x.y/just?q=very and ```so = just 1``` so it is very fast", "", "  ", None, FAR + "<output>just\nso</output> due to the fact that 1.2.3 is \"really\" 日本語 é",
]


@pytest.mark.parametrize("level", rules.LEVELS)
def test_queries_compress_whole_texts(spark, data, tmp_path, level):
    run = queries.QUERIES[f"rules_{level}_text"]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(TURNS)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert {r.turn: r.compressed for r in run(spark, str(tmp_path)).collect()} == {i: plain(t, level) for i, t in enumerate(TURNS)}
    rows = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{data}/conversations.parquet").collect()}
    assert any(len(t or "") > 200 for t in rows.values())
    assert {(r.conv_id, r.turn): r.compressed for r in run(spark, data).collect()} == {k: plain(t, level) for k, t in rows.items()}
