"""Packing token streams into fixed windows by order-preserving dynamic programming.

The documents of a partition, in order, are one stream of ids (a document's ids, then the end id). A window holds up to 2048
of them and is padded to 2048 unless its length is a power of two. Cuts cost 0 after a document, SENTENCE after a sentence and
INSIDE elsewhere; the padding costs its length. best(j) = cut(j) + min over i of best(i) + padding(j - i): since
best(i) + i doesn't depend on j, the best i of the last 2048 positions is the head of a monotone queue, and windows of a power
of two add one look-up each. Numpy takes the candidates of half a window at a time. Candidate cuts are document and sentence ends, the positions a full window after these, and, in
stretches without any, every full window on. The stream is solved in blocks of about a million ids; what lies after the best
cut within the last window of a block goes into the next, so memory is bounded and only a partition's last window need be short.

Nothing is shuffled: partitions are packed where they are read, and a sequence's id is its partition's number and its own.

Ids are those of the file's own tokenizer: its added tokens, such as the end-of-text mark, count wherever a text holds them.

Defined results: null text counts as empty and gives the end id alone; null ids and repeated rows are packed like any other;
every id of every whole document lies in exactly one piece; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tracemill.llm import bpe
from tracemill.session import ship

WINDOW = 2048
END = 1
SENTENCE, INSIDE = 2, 12
BLOCK = 1_000_000
_NEVER = 1 << 60
_POWERS = [1 << k for k in range(WINDOW.bit_length())]


class LibraryEncoder(bpe.Encoder):
    """Chunks are told apart as they are there, but a library encodes them, all that are new in a slice in one call.

    As the tokenizer of the file has it, its added tokens are found in the text first and are ids of their own.
    """

    def __init__(self, path: str):
        dict.__init__(self)
        with open(path, encoding="utf-8") as file:
            added = json.load(file).get("added_tokens", [])
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"an added token of {path} is not matched as it stands")
        self.added = {t["content"]: t["id"] for t in added}
        self.ranks = {token: i for token, i in bpe.load_ranks(path).items() if i not in self.added.values()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        core = tiktoken.Encoding("ranks", pat_str=bpe.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self._encode = core._core_bpe.encode_ordinary if hasattr(core, "_core_bpe") else core.encode_ordinary
        self.spaced = np.zeros(max(self.ranks.values()) + 1, bool)
        for token, i in self.ranks.items():
            self.spaced[i] = token[:1] == b" "

    def chunk(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def packed(self, text: str) -> bytes:
        if not self.added:
            return self.chunk(text)
        parts = self.split(text)  # text and added tokens by turns
        return b"".join([self.added[part].to_bytes(4, "little") if i % 2 else self.chunk(part) for i, part in enumerate(parts)])

    def odd(self, column: pa.Array) -> np.ndarray:
        marked = [pc.match_substring(column, token).to_numpy(zero_copy_only=False) for token in self.added]
        return np.union1d(super().odd(column), np.flatnonzero(np.logical_or.reduce(marked))) if marked else super().odd(column)

    def table(self, chunks: pa.Array) -> tuple[bytes, list[int]]:
        if not len(chunks):
            return b"", []
        ids = np.array(self._encode(" " + bpe._joined(chunks)), np.uint32)
        begins = np.flatnonzero(self.spaced[ids])  # a chunk has no space but the one before it, which its first token begins with
        return ids.tobytes(), (4 * np.diff(begins, append=len(ids))).tolist()


_coders: dict[str, tuple[LibraryEncoder, np.ndarray, np.ndarray]] = {}


def coder(path: str) -> tuple[LibraryEncoder, np.ndarray, np.ndarray]:
    """This process's encoder; which ids end a sentence; which begin with white space or are the end id."""
    if path not in _coders:
        library = LibraryEncoder(path)
        ends, opens = np.zeros((2, 1 + max([END, *library.ranks.values(), *library.added.values()])), bool)
        for token, i in library.ranks.items():
            ends[i] = token.rstrip(b"\"')\xbb").endswith((b".", b"!", b"?")) or b"\n" in token
            opens[i] = token[:1].isspace()
        _coders[path] = library, ends, opens
    return _coders[path]


def cuts(ends: np.ndarray, sentences: np.ndarray, length: int, last: bool, window: int = WINDOW, sentence: int = SENTENCE, inside: int = INSIDE) -> list[int]:
    """The best cuts of a stream: ends and sentences are sorted positions in (0, length]; with last, the stream ends at length.

    reach(j) = best(j) + j is min over i of reach(i), i in the window before j, + window + cut(j), or with a power p, reach(j - p)
    + p + cut(j). Candidates are taken half a window at a time. The monotone queue holds those before the half window that no
    later one undercuts; its head for each j is found by bisection. Candidates of one half window reach each other too: their
    least reach so far and the powers within are applied until nothing changes.
    """
    mark = np.zeros(length + 1, bool)
    strong = np.zeros(length + 1, bool)
    strong[ends] = strong[sentences] = True
    at = np.flatnonzero(strong)
    edges = np.concatenate([[0], at, [length]])
    for a in np.flatnonzero(np.diff(edges) > window).tolist():
        mark[edges[a] + window : edges[a + 1] : window] = True
    full = edges[:-1] + window
    mark[full[full <= length]] = mark[at] = mark[0] = True
    if last:
        mark[length] = True
    at = np.flatnonzero(mark)
    n = len(at)
    cost = np.where(strong[at], sentence, inside).astype(np.int64)
    cost[np.isin(at, ends)] = 0
    cost[0] = 0
    if last:
        cost[-1] = 0
    index = np.full(length + 1, n, np.int64)  # n: no candidate
    index[at] = np.arange(n)
    powers = np.array([p for p in _POWERS if p <= window])[:, None]
    from_ = np.where(at >= powers, index[np.maximum(at - powers, 0)], n)
    reach, back = np.full(n + 1, _NEVER), np.zeros(n, np.int64)
    reach[0] = 0
    queue = np.zeros(1, np.int64)  # candidates with rising reach
    half = window // 2
    borders = np.searchsorted(at, np.arange(0, length + half, half), "right").tolist()
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        if a == b:
            continue
        source, price = from_[:, a:b], cost[a:b]
        heads = np.searchsorted(at[queue], at[a:b] - window)
        earlier = np.append(reach[queue], _NEVER)[heads]
        low = earlier
        while True:
            exact = (reach[source] + powers).min(0)
            now = np.minimum(low + window, exact) + price
            if np.array_equal(now, reach[a:b]):
                break
            reach[a:b] = now
            low = np.minimum(earlier, np.minimum.accumulate(np.append(_NEVER, now[:-1])))
        value = low + window
        fits = exact <= value
        by_power = source[(reach[source] + powers).argmin(0), np.arange(b - a)]
        so_far = np.maximum.accumulate(np.where(np.append(True, now[1:] < np.minimum.accumulate(now)[:-1]), np.arange(a, b), a))  # place of the least so far
        inner = np.append(a, so_far[:-1])
        by_queue = np.append(queue, 0)[heads]
        back[a:b] = np.where(fits, by_power, np.where(low < earlier, inner, by_queue))
        queue = np.concatenate([queue[np.searchsorted(at[queue], at[b - 1] + 1 - window) :], np.arange(a, b)])
        held = reach[queue]
        queue = queue[np.append(held[:-1] < np.minimum.accumulate(held[::-1])[::-1][1:], True)]
    if last:
        j = n - 1
    else:  # any cut of the last window may end the block; the ids after it are not lost, so they count as saved padding
        first = int(np.searchsorted(at, length - window, "right"))
        first = max(first, 1)
        tail = (reach[first:n] - 2 * at[first:n])[::-1]
        j = n - 1 - int(tail.argmin())
    out = []
    while j:
        out.append(int(at[j]))
        j = int(back[j])
    return out[::-1]


class Packer:
    """Takes documents, gives pieces (doc_id, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, ends: np.ndarray, opens: np.ndarray, first: int = 0, block: int = BLOCK):
        self.ends, self.opens, self.sequence, self.block = ends, opens, first, block
        self.docs: list[tuple[int | None, bytes, int, int]] = []  # id, packed ids from start on, start, all tokens
        self.held = 0

    def add(self, doc: int | None, packed: bytes) -> Iterator[tuple]:
        whole = packed + END.to_bytes(4, "little")
        self.docs.append((doc, whole, 0, len(whole) // 4))
        self.held += len(whole) // 4
        if self.held >= self.block:
            yield from self._solve(False)

    def close(self) -> Iterator[tuple]:
        if self.docs:
            yield from self._solve(True)

    def _solve(self, last: bool) -> Iterator[tuple]:
        docs, total = self.docs, self.held
        ends = np.cumsum([len(d[1]) // 4 for d in docs])
        ids = np.frombuffer(b"".join([d[1] for d in docs]), "<u4")
        closing = np.flatnonzero(self.ends[ids[:-1]] & self.opens[ids[1:]]) + 1
        begin, doc, inside = 0, 0, 0
        for cut in cuts(ends, closing, total, last):
            offset = 0
            while begin < cut:
                name, body, start, tokens = docs[doc]
                take = min(cut - begin, len(body) // 4 - inside)
                yield name, start + inside, take, body[4 * inside : 4 * (inside + take)], tokens, self.sequence, offset
                begin, offset, inside = begin + take, offset + take, inside + take
                if 4 * inside == len(body):
                    doc, inside = doc + 1, 0
            self.sequence += 1
        self.docs = docs[doc:]
        if inside:
            name, body, start, tokens = self.docs[0]
            self.docs[0] = name, body[4 * inside :], start + inside, tokens
        self.held = total - begin


def pack(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids if wanted."""
    ship(docs.sparkSession)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc, start, length, body, tokens, sequence, offset = zip(*rows, strict=True)
        columns = [pa.array(x, pa.int64()) for x in (doc, start, length, list(map(zlib.crc32, body)), tokens, sequence, offset)]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), pa.array(np.frombuffer(b"".join(body), "<i4"))))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ends, opens = coder(path)
        packer = Packer(ends, opens, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []
        for part in (x for whole in batches for x in bpe.slices(whole, 1)):
            flat, starts = encoder.many(part.column(1))
            for i, doc in enumerate(part.column(0).to_pylist()):
                rows.extend(packer.add(doc, flat[starts[i] : starts[i + 1]].tobytes()))
                if len(rows) > 2000:
                    yield batch(rows)
                    rows = []
        rows.extend(packer.close())
        if rows:
            yield batch(rows)

    schema = ", ".join(f"{n} bigint" for n in names[:7]) + ", ids array<int>" * with_ids
    return docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)
