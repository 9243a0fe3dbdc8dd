"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A tokenization is the one that the merges give if and only if each token arises from its own bytes and each pair of
neighbours stays a pair when its bytes are merged alone. So a non-deterministic transducer whose states are (last token, trie
node of the bytes since) accepts exactly the right tokenizations. It is determinised while it runs: a state is the set of live
pairs with the tokens that each still owes, what all of them owe is emitted at once, and a transition is built when first taken.
A pair dies within one token's length, which bounds the lookahead. Text is cut before each space that precedes a non-space (a
boundary of the pattern in any context), and what such a chunk encodes to is remembered; both memories are bounded and start
anew when full, which changes no result. Texts are taken about SLICE bytes at a time: their chunks are told apart first, each
different one is looked up or run through the transducer once, and the ids of the texts are gathered from these.

Decoding. Ids become bytes by table and pass an incremental UTF-8 machine that holds back an unfinished character.

Defined results: null text is empty (no ids, the digest of no bytes); every whole text is encoded, however long; other columns
pass through untouched (`encode` refuses a name that exists already); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import ship

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pattern has it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_DOUBLED_RE2 = f" (?:[{_SPACE}]|\\z)"
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: The same where a text is ASCII.
_ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"""
#: What one process remembers in a generation: pieces (about 200 bytes each; two generations are held) and
#: transitions (about 500 bytes each, with their states).
PIECES = 400_000
TRANSITIONS = 600_000
#: Bytes of text that are encoded together.
SLICE = 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from a rank file or from the json file of a byte-level model."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such a file
    table = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return {bytes(table[c] for c in token): i for token, i in vocabulary.items() if all(c in table for c in token)}


class Vocabulary:
    """Ranks, the last merge of each token, and a trie over the tokens that merges can reach."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(len(self.bytes_of))), list(range(len(self.bytes_of)))
        self.reachable = [len(b) == 1 for b in self.bytes_of]
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):  # a token's parts have lower ranks, so they are known
            if len(token) < 2:
                continue
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k], i), ranks.get(token[k:], i)
                if a < i and b < i and self.reachable[a] and self.reachable[b] and self.adjacent(a, b):
                    self.left[i], self.right[i], self.merged[a, b], self.reachable[i] = a, b, i, True
                    break
        self.child: dict[int, int] = {}
        self.token_at, self.inner = [-1], [True]
        for token, i in ranks.items():
            if not self.reachable[i]:
                continue
            node = 0
            for byte in token:
                self.inner[node] = True
                step = node << 8 | byte
                if (following := self.child.get(step)) is None:
                    following = self.child[step] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = following
            self.token_at[node] = i

    def adjacent(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both ends with just these two.

        Undo the later of the two last merges, again and again, and see whether the tokens that then meet would have been merged
        across the border before it.
        """
        merged, left, right = self.merged, self.left, self.right
        before = len(left) + 1
        while True:
            if merged.get((a, b), before) < before:
                return False
            inner_a, inner_b = right[a], left[b]
            if inner_a == a and inner_b == b:
                return True
            if inner_b == b or inner_a != a and a > b:
                before, a = a, inner_a
            else:
                before, b = b + 1, inner_b


class Transducer:
    """States are made as they are reached, and numbered in steps of 256: hops has the transition of state + byte."""

    def __init__(self, vocabulary: Vocabulary, transitions: int = TRANSITIONS):
        self.vocabulary, self.limit = vocabulary, transitions
        self._pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((-1, 0, ()),)
        self.entries, self.final = [start], [()]
        self.hops: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._number = {start: 0}
        if len(self._pairs) > self.limit:
            self._pairs.clear()

    def _build(self, at: int) -> tuple[int, tuple[int, ...]]:
        v = self.vocabulary
        child, token_at, inner, pairs = v.child, v.token_at, v.inner, self._pairs
        byte, entries, done = at & 255, [], None
        for last, node, owed in self.entries[at >> 8]:
            following = child.get(node << 8 | byte)
            if following is None:
                continue
            if done is None and (token := token_at[following]) >= 0:
                if last < 0:
                    done = (token,)
                else:
                    pair = last << 24 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = v.adjacent(last, token)
                    if fits:
                        done = (*owed, token)
            if inner[following]:
                entries.append((last, following, owed))
        if entries:
            entries.append((done[-1], 0, done))
            common = 0
            for column in zip(*[e[2] for e in entries], strict=False):  # what all of them owe
                if column.count(column[0]) < len(column):
                    break
                common += 1
            key = tuple([(last, node, owed[common:]) for last, node, owed in entries]) if common else tuple(entries)
        else:
            common = len(done)
            key = ((done[-1], 0, ()),)
        number = self._number.get(key)
        if number is None:
            number = self._number[key] = len(self.entries) << 8
            self.entries.append(key)
            self.final.append(done[common:])
        hop = self.hops[at] = (number, done[:common])
        return hop

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece. A piece that is a token is that token, as in the usual libraries."""
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.hops) > self.limit:
            self._reset()
        out: list[int] = []
        get, state = self.hops.get, 0
        for byte in piece:
            hop = get(state | byte)
            if hop is None:
                hop = self._build(state | byte)
            state, emitted = hop
            if emitted:
                out += emitted
        out += self.final[state >> 8]
        return out


def _joined(column: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column), " ")[0].as_py()


class Encoder(dict):
    """Whole texts to packed little-endian unsigned 32-bit ids.

    The dict remembers what a piece gives, in two generations: what the old one has and is asked for again moves to the new one.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        super().__init__()
        self.transducer = Transducer(Vocabulary(ranks))
        self.pieces = regex.compile(pattern).findall
        self.ascii_pieces = re.compile(_ASCII_PATTERN).findall if pattern == PATTERN else self.pieces
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = array("I", self.transducer.encode(piece.encode())).tobytes()
            if len(piece) > 64:
                return packed
        self[piece] = packed
        return packed

    def chunk(self, text: str) -> bytes:
        """The ids of a stretch of text that begins and ends at borders of pieces."""
        return b"".join(map(self.__getitem__, self.ascii_pieces(text) if text.isascii() else self.pieces(text)))

    def packed(self, text: str) -> bytes:
        self.turn()
        return self.chunk(text)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u4")

    def turn(self) -> None:
        if len(self) > PIECES:
            self.old = dict(self)
            self.clear()

    def table(self, chunks: pa.Array) -> tuple[bytes, list[int]]:
        """The packed ids of different chunks, each after its space, one after another, and how many bytes each has."""
        self.turn()
        chunk = self.chunk
        found = [self[" " + c] if c.isalpha() and (c.isascii() or _PLAIN(c)) else chunk(" " + c) for c in _joined(chunks).split(" ")] if len(chunks) else []
        return b"".join(found), list(map(len, found))

    def odd(self, column: pa.Array) -> np.ndarray:
        """Places of the texts that aren't to be cut at every space."""
        return np.flatnonzero(pc.match_substring_regex(column, _DOUBLED_RE2).to_numpy(zero_copy_only=False))

    def many(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and where each begins; one more place, the end, follows."""
        column = pc.fill_null(column, "")
        whole = {}
        if len(odd := self.odd(column)):
            whole = {i: self.packed(column[i].as_py()) for i in odd.tolist()}
            mask = np.zeros(len(column), bool)
            mask[odd] = True
            column = pc.if_else(pa.array(mask), "", column)
        cut = pc.split_pattern(column, " ")
        starts = cut.offsets.to_numpy().astype(np.int64)
        chunks = cut.values.slice(int(starts[0]), int(starts[-1] - starts[0]))
        starts -= starts[0]
        coded = chunks.dictionary_encode()
        # the first chunk of a text has no space before it, so each gets an entry of its own
        firsts = chunks.take(pa.array(starts[:-1])).to_pylist()
        entries, sizes = self.table(coded.dictionary)
        others = [whole[i] if i in whole else self.chunk(first) for i, first in enumerate(firsts)]
        entries = b"".join([entries, *others])
        ends = np.cumsum(np.array([0, *sizes, *map(len, others)], np.int64)) // 4
        which = coded.indices.to_numpy().astype(np.int64)
        which[starts[:-1]] = len(coded.dictionary) + np.arange(len(firsts))
        lengths = np.diff(ends)[which]
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(entries, "<u4")))
        return lists.take(pa.array(which)).values.to_numpy(), np.append(0, np.cumsum(lengths))[starts]


class Utf8Machine:
    """Incremental UTF-8: bytes in, whole characters out; the state is the unfinished character at the end."""

    #: By lead byte, the bytes that a character has.
    NEEDS = bytes(1 if b < 0xC2 or b > 0xF4 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256))

    def __init__(self) -> None:
        self.pending = b""

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        cut = len(data)
        for back in range(1, min(4, cut + 1)):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                if self.NEEDS[lead] > back:
                    cut -= back
                break
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.pending = self.pending.decode("utf-8", "replace"), b""
        return rest


class StreamingDecoder:
    def __init__(self, bytes_of: list[bytes], block: int = 65_536):
        self.table, self.block = pa.array(bytes_of, pa.binary()), block

    def stream(self, ids: np.ndarray) -> Iterator[tuple[bytes, str]]:
        """Blocks of the decoded bytes, with the text that is certain by then."""
        machine = Utf8Machine()
        for at in range(0, len(ids), self.block):
            _, ends, data = self.table.take(pa.array(ids[at : at + self.block])).buffers()
            data = data.to_pybytes()[: np.frombuffer(ends, np.int32)[min(self.block, len(ids) - at)]] if data else b""
            yield data, machine.feed(data)
        if machine.pending:
            yield b"", machine.close()

    def text(self, ids: Iterable[int]) -> str:
        return "".join(t for _, t in self.stream(np.asarray(ids, "<u4")))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(load_ranks(path))
    return _encoders[path]


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts (column number text) have about so many bytes; a longer text is a part by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """df with the ids of its text as array<int>."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists")
    ship(df.sparkSession)
    names = [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                flat, starts = coder.many(part.column(part.num_columns - 1))
                ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` array<int>"
    return df.select("*", F.col(f"`{text}`").alias("__tm_text")).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """df with the text of its ids; null ids give null."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists")
    ship(df.sparkSession)
    names = [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamingDecoder(encoder(path).transducer.vocabulary.bytes_of)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                done = [None if v.as_py() is None else decoder.text(v.values.to_numpy(zero_copy_only=False)) for v in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(done, pa.string())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` string"
    return df.select("*", F.col(f"`{ids}`").alias("__tm_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and whether the decoded text is the text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        decoder = StreamingDecoder(coder.transducer.vocabulary.bytes_of)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            encoded, decoded, same = [], [], []
            flat, starts = coder.many(batch.column(1))
            for i, value in enumerate(batch.column(1)):
                value, ids = value.as_py() or "", flat[starts[i] : starts[i + 1]]
                encoded.append(hashlib.sha256(ids).hexdigest())
                digest, at, equal = hashlib.sha256(), 0, True
                for data, certain in decoder.stream(ids):
                    digest.update(data)
                    equal = equal and value.startswith(certain, at)
                    at += len(certain)
                decoded.append(digest.hexdigest())
                same.append(equal and at == len(value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts), pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"],
            )

    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, same boolean")
