"""Sources and sinks: JSONL traces in, three training formats and two reports out."""
