"""tracemill: curation of reasoning traces and training text on Spark."""

__version__ = "0.1.0"
