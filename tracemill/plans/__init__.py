"""Whole runs: the curation pipeline, its reports and its command line."""
