"""Scalar functions: Column in, Column out."""

from tracemill.functions.text import entropy, estimate_tokens, interleave, saved_percent, strip

__all__ = ["entropy", "estimate_tokens", "interleave", "saved_percent", "strip"]
