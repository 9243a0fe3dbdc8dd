"""Secret scans through a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived that every match satisfies. Documents are indexed in segments
(one Arrow batch each): a posting list is the set of a segment's documents that hold a trigram, letters of A-Z folded. Lists are
made for the trigrams that queries name, when they are first needed; a query intersects and unites them, and the documents that
remain are verified by the regex itself over the whole text. A rule without mandatory trigrams scans every document.

Defined results: null text is empty and has no secret; positions are code points, the end exclusive; every whole text is
scanned; a private key is the stretch from its BEGIN to its END line; other columns pass through `redact` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from re import _constants as sre
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import ship

Query = tuple | bool  # True: any document; ("tri", bytes), ("and", (...)), ("or", (...))
_MOST = 24  # strings in a set, characters of a class


def _all(parts: list) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list) -> Query:
    if not parts or any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _trigrams(text: str) -> Query:
    data = text.encode()
    return _all([("tri", data[i : i + 3]) for i in range(len(data) - 2)])


class _Info:
    """What is known of a regex's matches: the exact strings, or sets of prefixes and suffixes, and a query that holds."""

    def __init__(self, exact: set[str] | None, prefix: set[str], suffix: set[str], query: Query):
        self.exact, self.prefix, self.suffix, self.query = exact, prefix, suffix, query

    @classmethod
    def of(cls, strings: set[str]) -> _Info:
        return cls(strings, strings, strings, True)

    def settled(self) -> Query:
        if self.exact is not None:
            return _any([_trigrams(s) for s in self.exact])
        return _all([self.query, _any([_trigrams(s) for s in self.prefix]), _any([_trigrams(s) for s in self.suffix])])


ANY = _Info(None, {""}, {""}, True)


def _then(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= _MOST:
        return _Info.of({x + y for x in a.exact for y in b.exact})
    parts = [a.query, b.query]
    left, right = a.exact if a.exact is not None else a.suffix, b.exact if b.exact is not None else b.prefix
    if len(left) * len(right) <= _MOST * 8:  # across the border
        parts.append(_any([_trigrams(x[-2:] + y[:2]) for x in left for y in right]))
    parts += [_any([_trigrams(s) for s in left]), _any([_trigrams(s) for s in right])]
    prefix = {x + y for x in a.exact for y in b.prefix} if a.exact is not None and len(a.exact) * len(b.prefix) <= _MOST else a.prefix
    suffix = {x + y for x in a.suffix for y in b.exact} if b.exact is not None and len(a.suffix) * len(b.exact) <= _MOST else b.suffix
    return _Info(None, prefix, suffix, _all(parts))


def _or(parts: list[_Info]) -> _Info:
    if all(p.exact is not None for p in parts) and len(union := set().union(*[p.exact for p in parts])) <= _MOST:
        return _Info.of(union)
    prefix, suffix = set().union(*[p.prefix for p in parts]), set().union(*[p.suffix for p in parts])
    return _Info(None, prefix if len(prefix) <= _MOST else {""}, suffix if len(suffix) <= _MOST else {""}, _any([p.settled() for p in parts]))


def _characters(items: list) -> set[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            out.add(_fold(chr(value)))
        elif kind is sre.RANGE and value[1] - value[0] < 64:
            out |= {_fold(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= _MOST // 2 else None


def _sequence(items) -> _Info:
    out = _Info.of({""})
    for kind, value in items:
        if kind is sre.LITERAL:
            part = _Info.of({_fold(chr(value))})
        elif kind is sre.IN:
            part = _Info.of(found) if (found := _characters(value)) else ANY
        elif kind is sre.SUBPATTERN:
            part = _sequence(value[3])
        elif kind is sre.BRANCH:
            part = _or([_sequence(x) for x in value[1]])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            body = _sequence(inner)
            if least == 0 and most == 1:
                part = _or([body, _Info.of({""})])
            elif least == 0:
                part = ANY
            else:
                part = body
                for _ in range(min(least, 8) - 1):
                    part = _then(part, body)
                if most != least or least > 8:
                    part = _Info(None, part.prefix, part.suffix, part.settled())
        elif kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            part = _Info.of({""})
        else:
            part = ANY
        out = _then(out, part)
    return out


def trigram_query(pattern: str) -> Query:
    """A query that holds for every text with a match, over text with A-Z folded. True: no trigram is mandatory."""
    return _sequence(parser.parse(pattern)).settled()


def query_trigrams(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(query_trigrams, query[1]))


class Segment:
    """Trigram index of some documents."""

    def __init__(self, folded: list[bytes]):
        self.size = len(folded)
        self.blob = b"\n\n\n".join(folded)  # no query's trigram crosses it unless it is of line feeds only
        self.starts, at = [], 0
        for data in folded:
            self.starts.append(at)
            at += len(data) + 3
        self.postings: dict[bytes, frozenset[int]] = {}

    def posting(self, trigram: bytes) -> frozenset[int]:
        if trigram not in self.postings:
            found, find, starts, at = [], self.blob.find, self.starts, 0
            while (at := find(trigram, at)) >= 0:
                doc = bisect_right(starts, at) - 1
                found.append(doc)
                if doc + 1 == self.size:
                    break
                at = starts[doc + 1]
            self.postings[trigram] = frozenset(found)
        return self.postings[trigram]

    def candidates(self, query: Query) -> frozenset[int] | range:
        if query is True:
            return range(self.size)
        kind, value = query
        if kind == "tri":
            return self.posting(value)
        if kind == "or":
            return frozenset().union(*map(self.candidates, value))
        out: frozenset[int] | None = None
        for part in value:
            found = self.candidates(part)
            out = frozenset(found) if out is None else out.intersection(found)
            if not out:
                break
        return out


class Rule:
    def __init__(self, kind: str, pattern: str, base: bool = False, keep: Callable[[re.Match], bool] | None = None, end: Callable[[re.Match], int] = re.Match.end):
        self.kind, self.base, self.keep, self.end = kind, base, keep, end
        self.regex = re.compile(pattern, re.ASCII)
        self.query = trigram_query(pattern)
        self.bytes_regex = re.compile(pattern.encode(), re.ASCII)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [(m.start(), self.end(m)) for m in self.regex.finditer(text) if self.keep is None or self.keep(m)]


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_LABEL = r"(?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----"
_MARK = re.compile(rf"-----(?:BEGIN [A-Z0-9 ]+-----|(END) {_LABEL})", re.ASCII)
#: The end of a line, also as strings in source code write it.
_EOL = r"""(?:[ \t"',;+]*(?:\r\n?|\n|\\r|\\n))"""
#: Long words in the header's own line; then fields such as Proc-Type, and lines of base64 only.
_BODY = re.compile(
    rf"""(?:[ \t]*[A-Za-z0-9+/]{{20,}}={{0,2}}(?:[ \t]+(?=[A-Za-z]*[0-9+/=])[A-Za-z0-9+/=]+)*)?"""
    rf"""(?:{_EOL}+[ \t>"'#*]*[A-Z][A-Za-z-]+:[ \t][^\r\n\\]*)*"""
    rf"""(?:{_EOL}+[ \t>"'#*]*[A-Za-z0-9+/=]+(?={_EOL}|[ \t"',;]*\Z))*""",
    re.ASCII,
)


def key_end(header: re.Match) -> int:
    """Where a private key ends: with its END line, or with the lines of base64 if there is none before the next BEGIN."""
    mark = _MARK.search(header.string, header.end())
    return mark.end() if mark and mark[1] else _BODY.match(header.string, header.end()).end()


def rules() -> list[Rule]:
    return [
        Rule("assign", ASSIGN, True, lambda m: len(m[2]) >= 6),
        Rule("access", r"AKIA[A-Z0-9]+", True, lambda m: m.end() - m.start() >= 20),
        Rule("hex", r"[0-9a-f]{24,}", True),  # the runs of 24 and more among those of [0-9a-f]+
        Rule("github", r"gh[oprsu]_[0-9A-Za-z]{36,}"),
        Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
        Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
        Rule("openai", r"\bsk-[A-Za-z0-9_-]{20,}"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
        Rule("private_key", f"-----BEGIN {_LABEL}", end=key_end),
    ]


_rules: list[Rule] = []


def own_rules() -> list[Rule]:
    if not _rules:
        _rules.extend(rules())
    return _rules


def scan(texts: list[str], which: list[Rule] | None = None) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (start, rule number, end), sorted."""
    which = which or own_rules()
    data = [t.encode() for t in texts]
    segment = Segment([d.lower() for d in data])  # bytes: A-Z only
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, rule in enumerate(which):
        for doc in segment.candidates(rule.query):
            if rule.query is True and rule.bytes_regex.search(data[doc]) is None:
                continue
            out[doc].extend((start, number, end) for start, end in rule.spans(texts[doc]))
    for spans in out:
        spans.sort()
    return out


def _pieces(column: pa.Array, rows: int = 1000, size: int = 8_000_000) -> Iterator[list[str]]:
    part: list[str] = []
    held = 0
    for value in column:
        text = value.as_py() or ""
        part.append(text)
        held += len(text)
        if len(part) >= rows or held > size:
            yield part
            part, held = [], 0
    if part:
        yield part


def findings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, found (array of kind, start, end)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [r.kind for r in own_rules()]
        base = sum(r.base for r in own_rules())
        for batch in batches:
            counts, hashes, joined, found = [[], [], []], [], [], []
            for part in _pieces(batch.column(1)):
                for spans in scan(part):
                    for n in range(3):
                        counts[n].append(sum(s[1] == n for s in spans))
                    named = [f"{kinds[k]}:{a}:{b}" for a, k, b in spans]
                    hashes.append(hashlib.sha256(",".join([x for x, s in zip(named, spans, strict=True) if s[1] < base]).encode()).hexdigest())
                    joined.append(",".join(named))
                    found.append([{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(joined, pa.string()), pa.array(found, kind)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"],
            )

    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, found array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all columns, with each secret in the text replaced by <KIND>; overlapping spans are replaced together."""
    ship(docs.sparkSession)
    names = docs.columns
    place = [n.lower() for n in names].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f"<{r.kind.upper()}>" for r in own_rules()]
        for batch in batches:
            column, done, at = batch.column(place), [], 0
            for part in _pieces(column):
                for value, spans in zip(part, scan(part), strict=True):
                    if spans:
                        pieces, end = [], 0
                        for start, kind, stop in spans:
                            if start >= end:
                                pieces += [value[end:start], kinds[kind]]
                            end = max(end, stop)
                        value = "".join([*pieces, value[end:]])
                    done.append(value if column[at].is_valid else None)
                    at += 1
            columns = list(batch.columns)
            columns[place] = pa.array(done, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The index as a table: segment, trigram, doc_ids; for the trigrams that the rules' queries name."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sorted(set().union(*[query_trigrams(r.query) for r in own_rules()]))
        for batch in batches:
            at = 0
            for part in _pieces(batch.column(1)):
                segment = Segment([t.encode().lower() for t in part])
                ids = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                rows = [(t, [ids[i] for i in sorted(found)]) for t in wanted if (found := segment.posting(t))]
                yield pa.RecordBatch.from_arrays([pa.array([str(ids[0])] * len(rows), pa.string()), pa.array([t for t, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.list_(pa.int64()))], ["segment", "trigram", "doc_ids"])

    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "segment string, trigram binary, doc_ids array<bigint>")
