"""Keep-first near-duplicate removal by exact Jaccard similarity of 5-word shingle sets.

In order, a row goes if it is as similar as max_similarity to any row kept before it. Rows with one shingle set are decided by
the first of them: its fate is that of all. A set can reach the threshold with another one only if few of its shingles are its
own: those are counted on the shingles of the lowest hashes, a share of all that is the same everywhere, so a count is never too
high. Sets with too many of their own are left out (they stay); only the others' shingles move, in full.

Of these sets, pairs that can reach the threshold share a shingle in the rare-first prefix of both, so rows are listed by prefix
shingle. Each listed row has a sketch: whether the number of its shingles in each of 512 classes of hashes is odd. Two sets differ
in as many shingles as their sketches in bits, at least; pairs whose sketches differ too much are never held against the sets. In a round each list names its first rows as pivots, and all its rows are tested against these. A row that is a pivot of
all its lists has met every earlier candidate: it stays as soon as none of its earlier partners may, and the partners of a row
that stays go. Pivots are eight times as many from round to round, so the number of rounds is a logarithm of the longest list;
rows that went take no further part.

Shingles are compared as 64-bit hashes, whole sets by 128 bits. Empty sets are similar to nothing. A threshold of 1.0 still
drops equal sets; one of 0 or less leaves the first row alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.text import strip
from tracemill.operators.joins import narrowed, salted_left_join, spread_join
from tracemill.session import ship, small_batches, stable

try:
    from xxhash import xxh3_64_intdigest as _hash
except ModuleNotFoundError:  # slower

    def _hash(word: str) -> int:
        return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")


SHINGLE = 5
#: Pivots of a list in the first round.
PIVOTS = 64
#: 64-bit numbers of a sketch.
_SKETCH = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: str.split() takes these for white space, the regex (?U)\s doesn't.
_NO_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
TOOL_BLOCK = r"(?is)<(output|tool_result|tool_call|function_calls)>.*?</\1>"


def signature(msgs: Column) -> Column:
    """role:text lines of typed messages, tool blocks left out."""
    fold = lambda m: strip(F.regexp_replace(F.regexp_replace(F.coalesce(m["content"], F.lit("")), F.lit(TOOL_BLOCK), F.lit("")), r"(?U)\s+", " "))
    lines = F.transform(msgs, lambda m: F.struct(F.coalesce(m["role"], F.lit("?")).alias("r"), fold(m).alias("t")))
    return F.array_join(F.transform(F.filter(lines, lambda x: x["t"] != ""), lambda x: F.concat_ws(":", x["r"], x["t"])), "\n")


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word windows; of all words when there are fewer."""
    words = [w for w in _SPACE.split(text) if w] if text and _NO_SPACE.search(text) else (text or "").split()
    size = min(k, len(words))
    if not size:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(_hash, words), np.uint64, len(words))
    count = len(words) - size + 1
    rolled = np.full(count, size, np.uint64)
    for i in range(size):
        rolled = (rolled ^ hashes[i : i + count]) * _MIX
        rolled ^= rolled >> np.uint64(29)
    out = np.sort(rolled.view(np.int64))
    return out[np.append(True, out[1:] != out[:-1])]


def _mapped(rows: DataFrame, text: str, idx: str, make: Callable[[list[np.ndarray]], list[pa.Array]], schema: str, name: str) -> DataFrame:
    """idx and what make gives for the shingle sets of a few MB of texts."""
    ship(rows.sparkSession)
    names = ["idx", *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *make([shingles(v.as_py()) for v in batch.column(1)])], names)

    with small_batches(rows.sparkSession):
        return stable(rows.select(F.col(idx).alias("idx"), F.col(text).alias("text")).mapInArrow(run, f"idx {rows.schema[idx].dataType.simpleString()}, {schema}"), name)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *sets]), pa.int64()))


def _sizes(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([len(s) for s in sets], pa.int32())


def _sketches(sets: list[np.ndarray]) -> pa.Array:
    odd = np.array([np.bincount(s & (64 * _SKETCH - 1), minlength=64 * _SKETCH) & 1 for s in sets], np.uint8).reshape(-1, 64 * _SKETCH)
    numbers = np.packbits(odd, axis=1).view(np.int64)
    return pa.StructArray.from_arrays([pa.array(numbers[:, i]) for i in range(_SKETCH)], [f"b{i}" for i in range(_SKETCH)])


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)))


def room(n: Column, t: float) -> Column:
    """So many shingles of a set of n may be missing in one that is as similar as t."""
    return n - F.ceil(F.lit(t) * n - 1e-9).cast("int")


def digests(rows: DataFrame, text: str, idx: str, share: float = 0.0) -> DataFrame:
    """idx, n, c, d (a hash of the shingle set, in two numbers), part: the share of shingles of the lowest hashes."""
    low = np.int64(int(-(1 << 63) + min(share, 1.0) * ((1 << 64) - 2048)))

    def make(sets: list[np.ndarray]) -> list[pa.Array]:
        both = np.frombuffer(b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
        return [_sizes(sets), pa.array(both[:, 0]), pa.array(both[:, 1]), _lists([s[: np.searchsorted(s, low)] for s in sets])]

    return _mapped(rows, text, idx, make, "n int, c bigint, d bigint, part array<bigint>", "dedup-digests")


def firsts(made: DataFrame) -> DataFrame:
    """idx (the least), n, c, d, m (how many rows) of each set that isn't empty."""
    return stable(made.where("n > 0").groupBy("c", "d").agg(F.min("idx").alias("idx"), F.first("n").alias("n"), F.count(F.lit(1)).alias("m")), "dedup-firsts")


def suspects(made: DataFrame, first: DataFrame, t: float) -> DataFrame:
    """idx of the sets that aren't known to be alone: of their part, not more shingles are theirs only than may be missing."""
    seen = made.where("n > 0").select("c", F.explode("part").alias("h")).groupBy("h").agg(F.min("c").alias("c"), F.max("c").alias("z"))
    own = seen.where("c = z").groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    return stable(first.join(own, "c", "left").where(F.coalesce("own", F.lit(0)) <= room(F.col("n"), t)).select("idx"), "dedup-suspects")


def candidates(rows: DataFrame, t: float, text: str, idx: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(digests of all rows, firsts, sets: idx, n, s, bits (the sketch) of the firsts that may be as similar as t to another)."""
    made = digests(rows, text, idx, max(0.1, 2.2 * (1 - t)))
    first = firsts(made)
    chosen = narrowed(rows.select(F.col(idx).alias("idx"), F.col(text).alias("text")), suspects(made, first, t), "idx")
    return made, first, _mapped(chosen, "text", "idx", lambda sets: [_sizes(sets), _lists(sets), _sketches(sets)], f"n int, s array<bigint>, bits struct<{','.join(f'b{i}:bigint' for i in range(_SKETCH))}>", "dedup-sets")


def prefixes(sets: DataFrame, t: float) -> DataFrame:
    """h, idx, n: the rare-first prefix of each set (idx, n, s), shingles that no other set has left out."""
    each = sets.select("idx", "n", F.explode("s").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").withColumn("weight", F.col("c"))
    total = sets.agg(F.sum("n")).first()[0] or 0
    mine = salted_left_join(each, shared, "h", "weight", total).where("c is not null").groupBy("idx", "n").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("l"))
    left = room(F.col("n"), t) + 1 - (F.col("n") - F.size("l"))
    return mine.withColumn("room", left).where("room > 0").select("idx", "n", F.explode(F.slice("l", F.lit(1), F.col("room"))).alias("x")).select(F.col("x.h").alias("h"), "idx", "n")


def classes(rows: DataFrame, text: str = "text", idx: str = "doc_id") -> DataFrame:
    """idx, class_id, class_size of the rows that have shingles. Rows of one shingle set are a class, named by its least row."""
    made = digests(rows, text, idx).where("n > 0").select("idx", F.struct("c", "d").alias("cls"))
    named = firsts_named(made)
    return salted_left_join(made, named, "cls", "weight", made.count()).select(F.col("idx").alias(idx), "class_id", "class_size")


def firsts_named(made: DataFrame) -> DataFrame:
    """cls, class_id, class_size, weight of each class."""
    return stable(made.groupBy("cls").agg(F.min("idx").alias("class_id"), F.count(F.lit(1)).alias("class_size")).withColumn("weight", F.col("class_size")), "class-firsts")


def sized(lists: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Lists (h, idx, n) of two rows or more, with their size and the rows' sketches."""
    lists = stable(lists.select("h", "idx", "n"), name)
    sizes = lists.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumn("weight", F.col("size"))
    listed = salted_left_join(lists, sizes, "h", "weight", lists.count()).where("size is not null")
    return stable(listed.join(sets.select("idx", "bits"), "idx"), name)


def alike(n: str, m: str, bits: str, others: str, t: float) -> Column:
    """Whether sets of so many shingles and such sketches can be as similar as t."""
    differ = reduce(add, [F.bit_count(F.col(f"{bits}.b{i}").bitwiseXOR(F.col(f"{others}.b{i}"))) for i in range(_SKETCH)])
    return (F.least(n, m) >= F.lit(t) * F.greatest(n, m) - 1e-9) & (differ <= F.lit((1 - t) / (1 + t)) * (F.col(n) + F.col(m)) + 1e-6)


def tested(met: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """a, b and the jaccard of these pairs, which must be cheap to read again. Only sets that occur in a pair are moved."""
    sets = narrowed(sets.select("idx", "s"), met.select(F.col(a).alias("idx")).union(met.select(b)).distinct(), "idx")
    side = lambda c: sets.select(F.col("idx").alias(c), F.col("s").alias(f"s_{c}"))
    return met.join(side(a), a).join(side(b), b).select(a, b, jaccard(F.col(f"s_{a}"), F.col(f"s_{b}")).alias("jaccard"))


def pairs(rows: DataFrame, t: float, text: str = "text", idx: str = "doc_id") -> DataFrame:
    """a, b (a < b), jaccard of all pairs of the classes' least rows that reach t."""
    _, _, sets = candidates(rows, t, text, idx)
    lists = sized(prefixes(sets, t), sets, "pairs-lists")
    named = lambda c: lists.withColumnsRenamed({"idx": c, "n": f"n_{c}", "bits": f"bits_{c}"})
    found = stable(spread_join(named("a"), named("b"), "h", "a").where((F.col("a") < F.col("b")) & alike("n_a", "n_b", "bits_a", "bits_b", t)).select("a", "b").distinct(), "pairs-found")
    return tested(found, sets, "a", "b").where(F.col("jaccard") >= t)


def keep_first(rows: DataFrame, max_similarity: float = 0.92, text: str = "text", idx: str = "doc_id") -> DataFrame:
    """idx of the kept rows. idx must be unique; it gives the order."""
    if max_similarity <= 0:
        return rows.agg(F.min(idx).alias(idx)).where(F.col(idx).isNotNull())
    made, first, sets = candidates(rows, max_similarity, text, idx)
    empty = made.where("n = 0").select("idx")
    dropped: list[DataFrame] = []
    lists, most = sized(prefixes(sets, max_similarity), sets, "dedup-lists"), PIVOTS
    while not lists.isEmpty():
        nth = F.row_number().over(Window.partitionBy("h").orderBy("idx"))  # only the first few: grouped limits are taken before the shuffle
        pivots = stable(lists.withColumn("nth", nth).where(F.col("nth") <= most).select("h", F.col("idx").alias("k"), F.col("n").alias("n_k"), F.col("bits").alias("bits_k"), "size"), "dedup-pivots")
        led = pivots.groupBy(F.col("k").alias("idx")).agg(F.count(F.lit(1)).alias("led"))
        ready = stable(lists.groupBy("idx").agg(F.count(F.lit(1)).alias("all")).join(led, "idx").where("led = all").select("idx"), "dedup-ready")
        met = stable(spread_join(lists, pivots, "h", "idx").where((F.col("k") < F.col("idx")) & alike("n", "n_k", "bits", "bits_k", max_similarity)).select("idx", "k").distinct(), "dedup-met")
        partners = stable(tested(met, sets, "idx", "k").where(F.col("jaccard") >= max_similarity).select("idx", "k"), "dedup-partners")
        decided: DataFrame | None = None
        while True:
            stays = stable(ready.join(partners.select("idx").distinct(), "idx", "left_anti"), "dedup-stays")
            if stays.isEmpty():
                break
            gone = stable(partners.join(stays.select(F.col("idx").alias("k")), "k").select("idx").distinct(), "dedup-gone")
            dropped.append(gone)
            done = stays.union(gone)
            decided = done if decided is None else decided.union(done)
            partners = stable(partners.join(done, "idx", "left_anti").join(done.select(F.col("idx").alias("k")), "k", "left_anti").select("idx", "k"), "dedup-partners")
            ready = stable(ready.join(done, "idx", "left_anti"), "dedup-ready")
        lists = sized(lists.join(decided, "idx", "left_anti"), sets, "dedup-lists")
        most *= 8
    kept = first.select("idx")
    for gone in dropped:
        kept = kept.join(gone, "idx", "left_anti")
    return kept.union(empty).select(F.col("idx").alias(idx))
