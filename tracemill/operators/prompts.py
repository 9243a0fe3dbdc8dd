"""System prompts of the chat stages, in our own words."""

from __future__ import annotations

_COMMON = (
    "You get a PROBLEM, its final ANSWER and the REASONING that led there. Write the reasoning anew. Keep the order of steps, all numbers, names, code, "
    "formulas and decisions, dead ends included. Don't solve the problem again, don't change the conclusion, add no remark of your own; give the new reasoning only."
)
_LITE = _COMMON + " Drop filler, politeness, hedging and repetition, but write grammatical sentences. About half the tokens should do."
_FULL = _COMMON + " Write telegraphic notes: no articles, no filler, symbols and arrows where they are clear. Drop about seven tokens of ten."
_INVERT = (
    "You get a problem, the final answer and compressed reasoning. Write it out as the full chain of thought that it abbreviates: every step spelled out, in order, "
    "with no method, fact or assumption that the notes don't imply, and ending in the given answer. Give the reasoning only."
)
_VALIDATE = (
    "You grade how faithful PROCESSED reasoning is to the ORIGINAL. Answer with one JSON object and nothing else: logical_fidelity, content_fidelity and safety, each from 0 to 1, "
    "signal (the least of the three unless you have a reason), and notes (one short sentence)."
)


def compress_prompt(level: str = "lite") -> str:
    try:
        return {"lite": _LITE, "full": _FULL}[level]
    except KeyError:
        raise ValueError(f"unknown level: {level!r}") from None


system_prompt = compress_prompt


def invert_prompt() -> str:
    return _INVERT


def validate_prompt() -> str:
    return _VALIDATE


def files() -> dict[str, str]:
    """File names under prompts/, old names included."""
    lite, full = compress_prompt("lite"), compress_prompt("full")
    return {"compress_lite.md": lite, "compress_full.md": full, "invert.md": _INVERT, "validate.md": _VALIDATE, "caveman_lite.md": lite, "caveman_full.md": full}
