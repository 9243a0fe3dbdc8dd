"""Operators on traces: spans, rules, redaction, deduplication, scores, grades, chat."""
