"""Redaction of personal data and secrets: ordered patterns, then tokens of high entropy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import entropy, interleave

LEVELS = ("standard", "strict")
#: Applied in this order, each to what the last one left.
PATTERNS: dict[str, str] = {
    "EMAIL": r"[-%+._0-9A-Za-z]+@[-.0-9A-Za-z]+\.[A-Za-z]{2,}",
    "API_KEY": r"sk-(?:test|live|ant)?[-_]?[-_0-9A-Za-z]{20,}",
    "AWS_KEY": r"AKIA[A-Z0-9]{16}",
    "GH_TOKEN": r"ghp_[0-9A-Za-z]{36,}",
    "SSN": r"\b\d{3}-\d\d-\d{4}\b",
    "CARD": r"\b\d(?:[- ]?\d){12,18}[- ]?\b",
    "HOME": r"/(?:Users|home)/[-.0-9A-Z_a-z]+",
    "IP": r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
    "PRIVATE_KEY": r"(?s)-{5}BEGIN [ A-Z]+ KEY-{5}.*?-{5}END [ A-Z]+ KEY-{5}",
}
#: Stretches without which a pattern can't match (one of each group must be there); texts without them are left alone at once.
NEEDS: dict[str, tuple[tuple[str, ...], ...]] = {
    "EMAIL": (("@",),),
    "API_KEY": (("sk-",),),
    "AWS_KEY": (("AKIA",),),
    "GH_TOKEN": (("ghp_",),),
    "HOME": (("/Users/", "/home/"),),
    "PRIVATE_KEY": (("-----BEGIN ",), ("-----END ",)),
}
TOKEN = r"[-0-9A-Z_a-z]{24,}"
#: The same matches in time linear in the text: a run is tried from its beginning, or from where the last match ended, and from
#: nowhere else, since no later start can match where that one doesn't.
_LINEAR = PATTERNS | {"EMAIL": r"(?:\G|(?<![-%+._0-9A-Za-z]))[-%+._0-9A-Za-z]++@[-.0-9A-Za-z]+\.[A-Za-z]{2,}"}
_LINEAR_TOKEN = r"(?<![-0-9A-Z_a-z])[-0-9A-Z_a-z]{24,}+"
BITS = 4.0


def suspicious(token: Column) -> Column:
    """A token that looks random: high entropy, and not an identifier of words joined by underscores.

    Entropy is at most the logarithm of the number of symbols, so tokens of few symbols are known without it.
    """
    many = F.size(F.array_distinct(F.split(token, ""))) >= int(2**BITS)
    return ~(F.contains(token, F.lit("_")) & ~token.rlike("[0-9]")) & many & (entropy(token) >= BITS)


def _with(value: Column, made) -> Column:
    """made(value), where value is computed once however often made reads it."""
    return F.transform(F.array(value), made)[0]


def _step(state: Column, name: str) -> Column:
    """The state (text, counts) after one pattern. Matches are only counted where the text has changed."""
    pattern = F.lit(_LINEAR[name])

    def one(s: Column) -> Column:
        text, new = s["text"], F.regexp_replace(s["text"], pattern, F.lit(f"<{name}>"))
        for group in NEEDS.get(name, ()):
            there = F.lit(False)
            for part in group:
                there = there | F.contains(text, F.lit(part))
            new = F.when(there, new).otherwise(text)
        count = lambda t: F.when(t != text, F.regexp_count(text, pattern)).otherwise(0).cast("bigint")
        return _with(new, lambda t: F.struct(t.alias("text"), F.concat(s["counts"], F.array(count(t))).alias("counts")))

    return _with(state, one)


def _token_step(state: Column) -> Column:
    def one(s: Column) -> Column:
        text = s["text"]
        found = F.when(text.rlike(_LINEAR_TOKEN), F.transform(tokens(text), lambda t: F.struct(t.alias("t"), suspicious(t).alias("random"))))

        def masked(marked: Column) -> Column:
            hits = F.when(marked.isNull(), F.lit(0)).otherwise(F.size(F.filter(marked, lambda x: x["random"]))).cast("bigint")
            new = interleave(F.split(text, _LINEAR_TOKEN, -1), F.transform(marked, lambda x: F.when(x["random"], F.lit("<TOKEN>")).otherwise(x["t"])))
            return _with(hits, lambda n: F.struct(F.when(n > 0, new).otherwise(text).alias("text"), F.concat(s["counts"], F.array(n)).alias("counts")))

        return _with(found, masked)

    return _with(state, one)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_LINEAR_TOKEN), F.lit(0))


def redact(df: DataFrame, text: str = "text", level: str = "strict", counts: bool = False) -> DataFrame:
    """df with redacted and n_redactions (and n_<pattern> each); null text gives null and 0.

    One expression that takes the text from pattern to pattern and reads each state once, so that a filter on the counts, which
    the optimiser moves below the projection, repeats it as a whole and no more.
    """
    if level not in LEVELS:
        raise ValueError(f"no such level of redaction: {level!r}")
    state, names = F.struct(F.col(text).alias("text"), F.array().cast("array<bigint>").alias("counts")), [f"n_{name.lower()}" for name in PATTERNS]
    for name in PATTERNS:
        state = _step(state, name)
    if level == "strict":
        names.append("n_token")
        state = _token_step(state)
    out = df.withColumn("__tm_state", state)
    columns = {"redacted": F.col("__tm_state.text"), **({n: F.col("__tm_state.counts")[i] for i, n in enumerate(names)} if counts else {})}
    return out.withColumns({**columns, "n_redactions": F.aggregate("__tm_state.counts", F.lit(0).cast("bigint"), lambda a, n: a + n)}).drop("__tm_state")
