"""Chat calls in bulk: a pluggable backend, retries, bounded concurrency, results by key.

Calls are paid for, so they are made in mapInPandas (which Catalyst never repeats within a plan) and the result is written to
the shared folder before anything reads it twice.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import ship, stable


class Transient(Exception):
    """A failure worth another attempt."""


class ChatBackend(Protocol):
    """Anything that answers one exchange; it raises Transient where another attempt may help."""

    def chat(self, system: str, user: str, /) -> str: ...


def _turn(speaker: str, words: str) -> dict[str, str]:
    return {"role": speaker, "content": words}


@dataclass(frozen=True)
class ChatConfig:
    model: str = field(default_factory=lambda: os.environ.get("TRACEMILL_MODEL", "default"))
    endpoint: str = field(default_factory=lambda: os.environ.get("TRACEMILL_ENDPOINT", "http://localhost:8000/v1"))
    key: str = field(default_factory=lambda: os.environ.get("TRACEMILL_API_KEY", ""), repr=False)
    max_tokens: int = 4096
    temperature: float = 0.0
    timeout: float = field(default_factory=lambda: float(os.environ.get("TRACEMILL_TIMEOUT", "180")))
    retries: int = field(default_factory=lambda: int(os.environ.get("TRACEMILL_RETRIES", "2")))


class HttpBackend:
    """Any server with the usual chat-completions interface."""

    def __init__(self, config: ChatConfig):
        self.config = config

    def chat(self, system, user):
        c = self.config
        body = {"model": c.model, "max_tokens": c.max_tokens, "temperature": c.temperature, "messages": [_turn("system", system), _turn("user", user)]}
        request = urllib.request.Request(c.endpoint.rstrip("/") + "/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {c.key}"})
        try:
            with urllib.request.urlopen(request, timeout=c.timeout) as response:
                return (json.load(response)["choices"][0]["message"]["content"] or "").strip()
        except urllib.error.HTTPError:
            raise
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            raise Transient(str(e)) from e


def with_retry(backend: ChatBackend, system: str, user: str, retries: int, wait: Callable[[float], None] = time.sleep) -> str:
    for attempt in range(retries + 1):
        try:
            return backend.chat(system, user)
        except Transient:
            if attempt == retries:
                raise
            wait(min(2**attempt, 30))
    raise AssertionError


def batch_chat(backend: ChatBackend, items: list[tuple[str, str]], workers: int = 8, retries: int = 2) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each item, in order; at most `workers` calls at a time."""

    def one(item: tuple[str, str]) -> tuple[str | None, str | None]:
        try:
            return with_retry(backend, *item, retries), None
        except Exception as e:  # one failed call must not cost the others
            return None, str(e) or type(e).__name__

    if workers <= 1 or len(items) < 2:
        return [one(i) for i in items]
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, items))


def call(prompts: DataFrame, make: Callable[[], ChatBackend], seqs: int = 8, retries: int = 2, name: str = "chat") -> DataFrame:
    """prompts (system, user and any other columns) with chat_reply and chat_error. seqs bounds the calls of the whole job at a time."""
    spark = prompts.sparkSession
    ship(spark)
    tasks = max(1, min(seqs, spark.sparkContext.defaultParallelism))
    workers = max(1, seqs // tasks)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for part in parts:
            for at in range(0, len(part), 256):
                some = part.iloc[at : at + 256]
                done = batch_chat(backend, list(zip(some["system"], some["user"], strict=True)), workers, retries)
                yield some.assign(chat_reply=[a for a, _ in done], chat_error=[e for _, e in done])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields) + ", chat_reply string, chat_error string"
    return stable(prompts.repartition(tasks, F.xxhash64("user")).mapInPandas(run, schema), name)
