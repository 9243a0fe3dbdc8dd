"""Rule-based shortening of reasoning text, as one column expression.

Protected stretches (code, tool blocks, addresses, paths, quotes, numbers) are set aside behind placeholders, phrases are
removed or shortened, white space is folded, and the stretches come back in descending order, so that one which holds another's
placeholder is restored whole. Text with a NUL character is returned as it is, since placeholders are built from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import estimate_tokens, interleave, strip

LEVELS = ("lite", "full")


def _block(tag: str) -> str:
    return rf"(?s)<{tag}>.*?</{tag}>"


#: In this order; later ones see the placeholders of earlier ones.
PROTECTED: list[str] = [
    *[rf"(?s){fence}.*?{fence}" for fence in ("`" * 3, "~" * 3)],
    r"`[^\n`]+`",
    *map(_block, "tool_call function_calls tool_result output".split()),
    r"(?U)https?://\S+",
    r"(?U)/[-./\w]+",
    r"(?U)[A-Za-z]:\\[-.\\\w]+",
    *[rf"{q}[^\n{q}]{{0,200}}{q}" for q in ('"', "'")],
    r"(?U)\b\d+(?:[.]\d+)*\b",
]
FILLER = "actually|basically|clearly|essentially|fundamentally|honestly|indeed|just|kind of|literally|obviously|quite|rather|really|simply|somewhat|sort of|very".split("|")
HEDGES = "i believe|i guess|i suppose|i think|i'd say|i'm not sure but|if i recall correctly|it appears|it seems|it would seem|maybe|perhaps|possibly|probably".split("|")
PLEASANTRIES = (
    "alright|alright so|awesome|first of all|first off|great|happy to help|i am going to|i want to|i will start by|i'll go ahead and|i'll start by|i'm going to|let me see|let me start by|"
    "let me think|let's see|next i'll|next let me|no problem|now i|now let me|now let's|of course|ok so|okay so|perfect|sure thing|to begin with"
).split("|")
OPENERS = "hmm ok okay right sure well yeah yep".split()
#: short form -> phrases; a phrase never contains an earlier one, so the order is free but for those kept apart below.
_SHORT: dict[str, tuple[str, ...]] = {
    "to": ("in order to",),
    "because": ("due to the fact that",),
    "due to": ("as a result of",),
    "now": ("at this moment", "at this point in time"),
    "if": ("in the event that",),
    "use": ("make use of",),
    "consider": ("give consideration to", "take into account"),
    "can": ("has the ability to", "is able to"),
    "though": ("in spite of the fact that", "notwithstanding"),
    "re": ("with regard to", "with respect to"),
    "for": ("in terms of",),
    "many": ("a large number of",),
    "few": ("a small number of",),
    "most": ("the vast majority of",),
    "fix": ("implement a solution for",),
    "check": ("verify that",),
    "check if": ("determine whether",),
}
REPLACEMENTS: list[tuple[str, str]] = [(phrase, short) for short, phrases in _SHORT.items() for phrase in phrases]


def phrases(words: list[str]) -> str:
    """One regex for a list: longest first, with a comma and the white space after it."""
    return rf"(?i)\b(?:{'|'.join(sorted(words, key=lambda w: (-len(w), w)))})\b[\t ]*,?\s*"


def _placeholder(number: Column) -> Column:
    return F.concat(F.lit("\0P"), number.cast("string"), F.lit("\0"))


def protect(text: Column) -> Column:
    """struct(txt, originals)."""

    def step(state: Column, pattern: str) -> Column:
        txt, kept = state["txt"], state["originals"]
        found = F.regexp_extract_all(txt, F.lit(pattern), F.lit(0))
        marks = F.transform(found, lambda _, i: _placeholder(F.size(kept) + i))
        return F.when(F.size(found) == 0, state).otherwise(F.struct(interleave(F.split(txt, pattern, -1), marks).alias("txt"), F.concat(kept, found).alias("originals")))

    # a fold over the patterns keeps each state in a lambda variable, evaluated once
    start = F.struct(text.alias("txt"), F.array().cast("array<string>").alias("originals"))
    pick = lambda state, n: reduce(lambda other, i: F.when(n == i, step(state, PROTECTED[i])).otherwise(other), range(len(PROTECTED)), state)
    return F.aggregate(F.array(*[F.lit(i) for i in range(len(PROTECTED))]), start, pick)


def restore(text: Column, originals: Column) -> Column:
    numbered = F.reverse(F.transform(originals, lambda s, i: F.struct(_placeholder(i).alias("mark"), s.alias("text"))))
    return F.aggregate(numbered, text, lambda out, s: F.replace(out, s["mark"], s["text"]))


def shorten(text: Column, level: str = "lite") -> Column:
    """The phrase rules and the folding of white space, without protection."""
    opener = rf"(?dim)(?:^|(?<=[!.?]\s))(?:{'|'.join(OPENERS)})[-\s,!.:]+"  # the flags make ^ the place after a line feed
    chain = [(opener, ""), *[(phrases(w), "") for w in (PLEASANTRIES, HEDGES, FILLER)], *[(rf"(?i)\b{p}\b", s) for p, s in REPLACEMENTS]]
    if level == "full":
        chain += [(r"(?i)(?<=\S )(?:the|an?)\b\s+", ""), (r"(?i)\bso(?: that)?\b\s+", "-> ")]
    return fold_space(reduce(lambda t, rule: F.regexp_replace(t, F.lit(rule[0]), F.lit(rule[1])), chain, text))


def fold_space(text: Column) -> Column:
    steps = [(r"[\t ]+", " "), (r"[\t ]*(\n)[\t ]*", "$1"), (r"(\n\n)\n+", "$1"), (r"(?U)\s+([!,.:;?])", "$1"), (r"(?U)\s{2,}", " ")]
    return strip(reduce(lambda t, s: F.regexp_replace(t, F.lit(s[0]), F.lit(s[1])), steps, text))


def compress(text: Column, level: str = "lite") -> Column:
    """Null stays null; blank text and text with NUL stay as they are."""
    if level not in LEVELS:
        raise ValueError(f"no such level: {level!r}")
    state = F.transform(F.array(protect(text)), lambda s: restore(shorten(s["txt"], level), s["originals"]))
    return F.when((F.length(strip(text)) == 0) | F.contains(text, F.lit("\0")), text).otherwise(state[0])


def compress_table(df: DataFrame, text: str = "text", level: str = "lite") -> DataFrame:
    """df with compressed, original_tokens, compressed_tokens, ratio."""
    out = df.withColumn("compressed", compress(F.col(text), level))
    blank = F.length(strip(F.col(text))) == 0
    out = out.withColumns({"original_tokens": F.when(blank, F.lit(0)).otherwise(estimate_tokens(F.col(text))).cast("bigint"), "compressed_tokens": F.when(blank, F.lit(0)).otherwise(estimate_tokens(F.col("compressed"))).cast("bigint")})
    return out.withColumn("ratio", F.when(F.col("original_tokens") == 0, F.lit(1.0)).otherwise(F.col("compressed_tokens") / F.nullif(F.col("original_tokens"), F.lit(0))))
