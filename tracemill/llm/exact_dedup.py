"""Exact deduplication on a cuckoo-filter index of live digests.

Texts are equal when identical after each run of ASCII white space becomes one space. A document's key is the SHA-256 of
that normal form. An index shard holds a cuckoo filter (two candidate buckets of four 16-bit fingerprints) over the keys
stored in buckets beside it: a filter miss is certainly new, a hit is verified against the full 256-bit keys of the bucket.
Deleting a live digest takes its fingerprint out again; when an insertion finds no place, the filter doubles and is rebuilt
from the stored keys.

Distribution: every map task first folds its own rows through a local index, so that a group of copies sends one row per
task however large it is; the partial keys are then shuffled by digest to the index shards. Joining the keys back to the
documents salts groups that hold over 1/200 of all rows (at most 200 of them exist).

Defined results: null text counts as empty. Null doc_id comes after all others; a group of only null ids has keep_id null.
Of rows that agree in doc_id and text exactly one is kept. Other columns never matter. An empty table gives an empty result.
"""

from __future__ import annotations

import random
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.operators.joins import salted_left_join, without
from tracemill.session import parallelism, ship, stable

SPACES = r"[\x20\x09-\x0D]+"
SLOTS = 4
KEYS = "digest binary, keep_id bigint, live bigint, at_keep bigint"
_FLUSH = 500_000
#: Keys to an index shard, which is held in memory (about 250 bytes a key).
_SHARD = 1_000_000
#: Keys that are worth a shard of their own: fewer make no task and no file.
_LEAST = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class CuckooFilter:
    """Approximate set of keys with deletion. Keys are uniform byte strings of 12 bytes or more."""

    def __init__(self, buckets: int = 1024):
        self.mask = buckets - 1
        if buckets < 1 or buckets & self.mask:
            raise ValueError("buckets must be a power of two")
        self.slots = array("H", bytes(2 * SLOTS * buckets))
        self._random = random.Random(7)

    def place(self, key: bytes) -> tuple[int, int]:
        """Fingerprint and home bucket."""
        return (int.from_bytes(key[:2], "little") or 1), int.from_bytes(key[2:10], "little") & self.mask

    def other(self, fingerprint: int, bucket: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self.mask

    def _find(self, fingerprint: int, bucket: int) -> int:
        at = bucket * SLOTS
        for i in range(at, at + SLOTS):
            if self.slots[i] == fingerprint:
                return i
        return -1

    def __contains__(self, key: bytes) -> bool:
        fingerprint, bucket = self.place(key)
        return self._find(fingerprint, bucket) >= 0 or self._find(fingerprint, self.other(fingerprint, bucket)) >= 0

    def add(self, key: bytes, kicks: int = 500) -> bool:
        """False on overflow; the filter then has lost a fingerprint and must be rebuilt from the stored keys."""
        fingerprint, bucket = self.place(key)
        for b in (bucket, self.other(fingerprint, bucket)):
            if (i := self._find(0, b)) >= 0:
                self.slots[i] = fingerprint
                return True
        for _ in range(kicks):
            i = bucket * SLOTS + self._random.randrange(SLOTS)
            fingerprint, self.slots[i] = self.slots[i], fingerprint
            bucket = self.other(fingerprint, bucket)
            if (i := self._find(0, bucket)) >= 0:
                self.slots[i] = fingerprint
                return True
        return False

    def remove(self, key: bytes) -> bool:
        """Only for keys that were added."""
        fingerprint, bucket = self.place(key)
        for b in (bucket, self.other(fingerprint, bucket)):
            if (i := self._find(fingerprint, b)) >= 0:
                self.slots[i] = 0
                return True
        return False


class CuckooIndex:
    """Live digests with their smallest document: filter in front, keys stored by home bucket behind it."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.stored: list[list[list]] = [[] for _ in range(buckets)]
        self.size = 0
        self.resizes = self.false_hits = 0

    def get(self, key: bytes) -> list | None:
        """The entry [digest, keep_id, live, at_keep], or None."""
        if key not in self.filter:
            return None
        for entry in self.stored[self.filter.place(key)[1]]:
            if entry[0] == key:
                return entry
        self.false_hits += 1
        return None

    def insert(self, key: bytes, doc: int | None, live: int = 1, at_keep: int = 1) -> bool:
        """True if the digest is new."""
        if (entry := self.get(key)) is not None:
            entry[2] += live
            if doc == entry[1]:
                entry[3] += at_keep
            elif entry[1] is None or doc is not None and doc < entry[1]:
                entry[1], entry[3] = doc, at_keep
            return False
        self.stored[self.filter.place(key)[1]].append([key, doc, live, at_keep])
        self.size += 1
        if not self.filter.add(key):
            self._grow()
        return True

    def delete(self, key: bytes, live: int = 1) -> bool:
        """Take away live references; True if the digest was live."""
        if (entry := self.get(key)) is None:
            return False
        entry[2] -= live
        if entry[2] <= 0:
            self.stored[self.filter.place(key)[1]].remove(entry)
            self.filter.remove(key)
            self.size -= 1
        return True

    def _grow(self) -> None:
        entries, buckets = list(self.entries()), len(self.stored)
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            if all(self.filter.add(entry[0]) for entry in entries):
                break
        self.stored = [[] for _ in range(buckets)]
        for entry in entries:
            self.stored[self.filter.place(entry[0])[1]].append(entry)

    def entries(self) -> Iterator[list]:
        for bucket in self.stored:
            yield from bucket

    def batches(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for entry in self.entries():
            out.append(entry)
            if len(out) == rows:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = (("digest", pa.binary()), ("keep_id", pa.int64()), ("live", pa.int64()), ("at_keep", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


def _fold_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for doc, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            index.insert(key, doc)
        if index.size > _FLUSH:  # a combiner may send what it has at any time
            yield from index.batches()
            index = CuckooIndex()
    yield from index.batches()


def _fold_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0 (stored or new keys) are inserted, then those of kind 1 delete; they come in this order."""
    index = CuckooIndex()
    for batch in batches:
        for key, doc, live, at_keep, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind:
                index.delete(key, live)
            else:
                index.insert(key, doc, live, at_keep)
    yield from index.batches()


def index_shards(partial: DataFrame, deleted: DataFrame | None = None, keys: int | None = None) -> DataFrame:
    """Merge partial keys, then delete; each shard of the digest space is one cuckoo index. keys: how many there may be, if known."""
    rows = partial.select("digest", "keep_id", "live", "at_keep", F.lit(0).alias("kind"))
    if deleted is not None:
        rows = rows.unionByName(deleted.select("digest", "keep_id", "live", "at_keep", F.lit(1).alias("kind")))
    shards = parallelism(partial.sparkSession)
    if keys is not None:
        shards = max(min(shards, keys // _LEAST + 1), keys // _SHARD + 1)
    rows = rows.repartition(shards, "digest")
    return (rows.sortWithinPartitions("kind") if deleted is not None else rows).mapInArrow(_fold_keys, KEYS)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(docs[doc_id].cast("bigint").alias("doc_id"), digest(docs[text]).alias("digest"))


def partial_keys(rows: DataFrame) -> DataFrame:
    ship(rows.sparkSession)
    return rows.select("doc_id", "digest").mapInArrow(_fold_documents, KEYS)


def insert(index: DataFrame | None, docs: DataFrame, **names: str) -> DataFrame:
    """The index (digest, keep_id, live, at_keep) after the documents came in."""
    new = partial_keys(digests(docs, **names))
    return index_shards(new if index is None else index.unionByName(new))


def delete(index: DataFrame, docs: DataFrame, **names: str) -> DataFrame:
    """The index after the documents went; a digest without live documents is no longer known."""
    return index_shards(index, partial_keys(digests(docs, **names)))


def assign(rows: DataFrame) -> DataFrame:
    """(doc_id, digest) -> doc_id, digest, keep_id, group_size, kept; one row per row. rows must be cheap to read again."""
    keys = stable(index_shards(partial_keys(rows), keys=rows.count()), "dedup-keys")
    total = keys.agg(F.sum("live"), F.max("at_keep")).first()
    n, repeated = total[0] or 0, (total[1] or 0) > 1
    named = keys.select("digest", "keep_id", F.col("live").alias("group_size"), "at_keep", F.col("live").alias("weight"))
    joined = salted_left_join(rows, named, "digest", "weight", n).select("doc_id", "digest", "keep_id", "group_size", "at_keep", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))
    if not repeated:
        return joined.drop("at_keep")
    plain = joined.where(~(F.col("kept") & (F.col("at_keep") > 1))).drop("at_keep")
    again = keys.where("at_keep > 1").select(F.col("keep_id").alias("doc_id"), "digest", "keep_id", F.col("live").alias("group_size"), F.explode(F.sequence(F.lit(1).cast("bigint"), "at_keep")).alias("nth"))
    return plain.unionByName(again.select("doc_id", "digest", "keep_id", "group_size", (F.col("nth") == 1).alias("kept")))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stable(digests(docs, text, doc_id), "dedup-digests")  # 40 bytes a document; the text is read once
    out = assign(rows)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, all columns, without copies: of equal texts the row with the smallest id stays.

    Only copies are named in the join, by id and digest, so that it isn't skewed by a large group.
    """
    rows = stable(digests(docs, text, doc_id), "dedup-digests")
    verdict = assign(rows).where("group_size > 1").select("doc_id", F.col("digest").alias("mark"), "kept")  # read once
    return without(docs, doc_id, digest(F.col(f"`{text}`")), verdict)
