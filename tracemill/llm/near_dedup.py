"""Near duplicates: signature coordinates in an inverted index, confirmed on full shingle sets.

A document's set are its distinct 5-word shingles. Documents with one set form a class, and only classes are compared. A class
has a signature of 48 MinHash coordinates and is posted under each coordinate-value pair. Two classes are candidates if 20 or
more coordinates collide; at the similarity sought, 0.7, a pair falls short of that with probability 2e-5, above it sooner
still. Lists of one are skipped. Of its other lists a class keeps the prefix of all but the 19 longest, in one global order
(rare first): pairs with 20 collisions meet in such a prefix, while lists of passages that many documents share are skipped
and only probed through the signatures when a pair's collisions are counted.

Members that share lists are first brought together in neighbourhoods; one that is small enough for a task (bounded in members
and shingles) is settled there by the same join on its own lists: members meet in the prefixes, their collisions are counted,
the likeliest pairs are confirmed first and none within a component. Other candidates of a list are not all paired: in each round every list names pivots, members are tested against them (collisions
counted, then the exact sets), links are contracted into components, and lists within one component are done. A pivot leaves
its lists when all members have met it, and the number of pivots grows from round to round, so in the end each pair of a list
has met or is known to be connected. No list is cut, capped or collected.

Shingles are 64-bit hashes of word hashes, and a class is known by a 64-bit hash of its set together with its size: two
different texts are taken for one another with a probability of the order 1e-18 a pair.

Defined results: without words or text the set is empty, linked with nothing and kept; with fewer than five words the whole
sequence is the one shingle; null ids come after all others; repeated rows are in one class, and `drop_near` keeps one row of
those that agree in id and text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracemill.operators.joins import salted_left_join, without
from tracemill.session import parallelism, ship, stable

SHINGLE = 5
COORDINATES, MATCHES = 48, 20
SIMILAR = 70
_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)
#: Members of a block whose sets are moved together.
_BLOCK = 32
#: A neighbourhood of at most so many members and shingles (32 MB) is settled in one task.
_PART, _PART_SHINGLES = 8_000, 4_000_000
#: Members of a list to one salt.
_SALTED = 5_000
#: Bytes of texts or sets that move between the JVM and Python at once.
_MOVED = 4 << 20
#: Up to so many wanted sets, their names (24 bytes each) are broadcast.
_FEW = 50_000


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(SHINGLE, n)
    count = n - size + 1
    rolled = np.full(count, np.uint64(size), np.uint64)
    for i in range(size):
        rolled = (rolled ^ hashes[i : i + count]) * _MIX
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def signature(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    """The least of each coordinate's 32-bit hashes."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), block):
        hashes = shingles[at : at + block, None] * _FACTORS
        np.minimum(out, ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).min(0), out=out)
    return out.astype(np.uint32)


def node_of(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, signatures = [], [], []
        for text in batch.column(batch.num_columns - 1):
            shingles = shingle_set(text.as_py() or "")
            sizes.append(len(shingles))
            nodes.append(node_of(shingles) if len(shingles) else None)
            signatures.append(signature(shingles).tobytes() if len(shingles) else None)
        columns = [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signatures, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n_shingles", "node", "sig"])


def _keys(signatures: np.ndarray) -> np.ndarray:
    """The coordinate-value pairs of each signature, one number each."""
    keys = (signatures.astype(np.uint64) + (np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1)) * _MIX) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(32))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows with texts or sets go to Python a few MB at a time; what is run inside has this setting."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(_MOVED))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            keys = _keys(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(part.column(0).to_numpy(), COORDINATES))], ["key", "node"])


def sketch(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, mark (hash of the text), n_shingles, node (its class), sig."""
    ship(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.xxhash64(docs[text]).alias("mark"), docs[text].alias("text"))
    return rows.mapInArrow(_sketched, "doc_id bigint, mark bigint, n_shingles bigint, node bigint, sig binary")


def prefix_lists(classes: DataFrame) -> DataFrame:
    """key, node, size: the lists in which pairs with enough collisions meet. size: the members that the list had."""
    postings = classes.select("node", "sig").mapInArrow(_posted, "key bigint, node bigint")
    shared = stable(postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "neardup-shared")
    sized = salted_left_join(postings, shared.withColumn("weight", F.col("size")), "key", "weight", COORDINATES * classes.count())
    mine = sized.where("size is not null").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("lists"))  # at most COORDINATES
    mine = mine.where(F.size("lists") >= MATCHES).select("node", F.explode(F.slice("lists", F.lit(1), F.size("lists") - (MATCHES - 1))).alias("l"))
    return mine.select("l.key", "node", "l.size")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"shingles": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds.get(n, pa.int64())) for i, n in enumerate(names)], names)


def full_sets(docs: DataFrame, members: DataFrame, text: str, doc_id: str) -> DataFrame:
    """node, sig, shingles of the members (doc_id, node, sig): a second pass over the texts, which only works on theirs.

    Members are recognised by a bitmap of their ids of at most 32 MB, then by an exact join.
    """
    spark = docs.sparkSession
    n = members.count()
    bits = 1 << min(28, max(20, (16 * n).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    spot = place(F.col("doc_id"))
    rows = members.groupBy(F.bitmap_bucket_number(spot + 1).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot + 1)).alias("m")).collect()
    bitmap = bytearray(bits // 8)
    for row in rows:
        at = (row["b"] - 1) * 4096
        bitmap[at : at + 4096] = row["m"]
    share = spark.sparkContext.broadcast(bytes(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(share.value, np.uint8)
        names = ["doc_id", "node", "shingles"]
        for batch in batches:
            spots = batch.column(2).to_numpy()
            rows, held = [], 0
            for i in np.flatnonzero((table[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).tolist():
                shingles = shingle_set(batch.column(1)[i].as_py() or "")
                if not len(shingles):
                    continue
                rows.append((batch.column(0)[i].as_py(), node_of(shingles), shingles.tobytes()))
                held += shingles.nbytes
                if held > _MOVED:
                    yield _batch(rows, names)
                    rows, held = [], 0
            yield _batch(rows, names)

    texts = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text")).withColumn("spot", place(F.col("doc_id")))
    found = texts.mapInArrow(run, "doc_id bigint, node bigint, shingles binary")
    # compared so that the ids are no join key: the sets then lie by node, as the last step wants them
    equal = F.coalesce(F.col("doc_id").bitwiseXOR(F.col("first_id")) == 0, F.col("doc_id").isNull() & F.col("first_id").isNull())
    joined = found.join(members.select("node", F.col("doc_id").alias("first_id"), "sig"), "node").where(equal)
    return joined.groupBy("node").agg(F.first("sig").alias("sig"), F.first("shingles").alias("shingles"))  # repeated rows


def _spread(members: DataFrame, per_key: DataFrame) -> DataFrame:
    """members join per_key on key, where both know the key's size: a long list's members are spread over salts."""
    split = (F.col("size") / _SALTED).cast("int")
    spread = per_key.withColumn("salt", F.explode(F.sequence(F.lit(0), split))).drop("size")
    return members.withColumn("salt", F.pmod(F.xxhash64("node"), split + 1).cast("int")).join(spread, ["key", "salt"]).drop("salt")


def neighbourhoods(lists: DataFrame, steps: int = 6) -> DataFrame:
    """node, home: members that share lists, directly or over a few others, get one home, the least node seen."""
    home = lists.select("key", "node", "size", F.col("node").alias("home"))
    for _ in range(steps):
        least = home.groupBy("key").agg(F.first("size").alias("size"), F.min("home").alias("least"))
        seen = _spread(home.select("key", "node", "size"), least).groupBy("node").agg(F.min("least").alias("home"))
        home = stable(lists.select("key", "node", "size").join(seen, "node"), "neardup-homes")
    return home.groupBy("node").agg(F.min("home").alias("home"))


def _local_links(nodes: list[int], signatures: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected, by the inverted join on the members' own lists.

    Each member takes the earlier ones of its prefix lists (all but the MATCHES - 1 longest of the lists it shares, rare first),
    counts collisions with them, tests the likeliest first and none that is in its component by then.
    """
    n, sizes = len(nodes), np.array([len(x) for x in sets])
    _, of, counts = np.unique(_keys(signatures), return_inverse=True, return_counts=True)
    of = of.reshape(n, COORDINATES)
    length = counts[of]
    order = np.lexsort((of, length), axis=1)
    of, length = np.take_along_axis(of, order, 1), np.take_along_axis(length, order, 1)
    place = np.arange(COORDINATES)
    prefix = (length > 1) & (place < COORDINATES - (MATCHES - 1)) & ((length > 1).sum(1) >= MATCHES)[:, None]
    member, column = np.nonzero(prefix)
    keys = of[member, column]
    posted = member[np.argsort(keys, kind="stable")]  # each list's members, rising
    begin = np.cumsum(np.append(0, np.bincount(keys, minlength=len(counts))))
    end = begin[:-1].copy()  # of what a list holds so far
    label = np.arange(n)
    for i in range(n):
        mine = of[i][prefix[i]]
        met = np.zeros(i, bool)
        for a, b in zip(begin[mine].tolist(), end[mine].tolist(), strict=True):
            met[posted[a:b]] = True
        end[mine] += 1
        other = np.flatnonzero(met & (100 * np.minimum(sizes[:i], sizes[i]) >= SIMILAR * np.maximum(sizes[:i], sizes[i])))
        if not len(other):
            continue
        same = (signatures[other] == signatures[i]).sum(1)
        ranked = np.argsort(-same, kind="stable")[: int((same >= MATCHES).sum())]
        likely = other[ranked]
        while len(likely):
            j = int(likely[0])
            if similar(sets[i], sets[j]):
                label[label == label[j]] = i
                yield nodes[j], nodes[i]
                likely = likely[label[likely] != i]
            else:
                likely = likely[1:]


def _linked_at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (home, node, sig, shingles) of small neighbourhoods, one after another; links within each."""
    home, nodes, signatures, sets = None, [], [], []

    def done() -> list[tuple[int, int]]:
        return list(_local_links(nodes, np.stack(signatures), sets)) if len(nodes) > 1 else []

    for batch in batches:
        out: list[tuple[int, int]] = []
        for h, node, sig, shingles in zip(*(batch.column(i) for i in range(4)), strict=True):
            if (h := h.as_py()) != home:
                out += done()
                home, nodes, signatures, sets = h, [], [], []
            nodes.append(node.as_py())
            signatures.append(np.frombuffer(sig.as_py(), np.uint32))
            sets.append(np.frombuffer(shingles.as_py(), np.uint64))
        yield _batch(out, ["a", "b"])
    yield _batch(done(), ["a", "b"])


def at_home(lists: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tested: node, part, block; links). Pairs of one part are settled: a part is a neighbourhood small enough for one task
    (_PART members, _PART_SHINGLES shingles), each member of a larger one is a part by itself and left to the rounds.

    A home is some node's id, and that node may itself live in a larger neighbourhood: a small one's part is a hash of its home,
    which no node's id equals but by accident (5e-20 a pair)."""
    homes = stable(neighbourhoods(lists).join(sets.select("node", F.octet_length("shingles").alias("bytes")), "node"), "neardup-neighbourhoods")
    sizes = homes.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).withColumn("weight", F.col("n"))
    sized = salted_left_join(homes.select("node", "home"), sizes, "home", "weight", homes.count())
    small = (F.col("n") <= _PART) & (F.col("bytes") <= 8 * _PART_SHINGLES)
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / _BLOCK)))
    tested = stable(sized.select("node", "home", F.when(small, F.xxhash64(F.lit("home"), "home")).otherwise(F.col("node")).alias("part"), small.alias("small"), "n", block.alias("block")), "neardup-parts")
    rows = tested.where("small and n > 1").select("node", "home").join(sets, "node").select("home", "node", "sig", "shingles")
    rows = rows.repartition(parallelism(lists.sparkSession), "home").sortWithinPartitions("home")
    with _small_batches(lists.sparkSession):
        links = stable(rows.mapInArrow(_linked_at_home, "a bigint, b bigint"), "neardup-links")
    return tested.select("node", "part", "block"), links


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two blocks come together: first the members with signature and set, then the pairs to test."""
    at, held = None, {}
    for batch in batches:
        first, second, kind, a, b = (batch.column(i).to_pylist() for i in range(5))
        sig, shingles = batch.column(5), batch.column(6)
        out: list[tuple[int, int]] = []
        for i in range(batch.num_rows):
            if (first[i], second[i]) != at:
                at, held = (first[i], second[i]), {}
            if kind[i] == 0:
                held[a[i]] = np.frombuffer(sig[i].as_py(), np.uint32), np.frombuffer(shingles[i].as_py(), np.uint64)
                continue
            (sig_a, set_a), (sig_b, set_b) = held[a[i]], held[b[i]]
            if int((sig_a == sig_b).sum()) >= MATCHES and similar(set_a, set_b):
                out.append((a[i], b[i]))
        yield _batch(out, ["a", "b"])


def _links(lists: DataFrame, pivots: DataFrame, block_of: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members (key, node, n, part, label, size) and pivots (key, pivot, pivot_n, pivot_part, pivot_label, size) of one list."""
    near = (100 * F.least("n", "pivot_n") >= SIMILAR * F.greatest("n", "pivot_n")) & (F.col("label") != F.col("pivot_label")) & (F.col("part") != F.col("pivot_part"))
    pairs = _spread(lists, pivots).where(near)  # a long list's pivots are repeated
    pairs = pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    where = lambda who: block_of.select(F.col("node").alias(who), F.col("block").alias(f"block_{who}"))
    pairs = stable(pairs.join(where("a"), "a").join(where("b"), "b"), "neardup-pairs")
    side = lambda who: pairs.select("block_a", "block_b", F.col(who).alias("node"))
    moved = side("a").union(side("b")).distinct()
    n = moved.count()
    if n <= _FEW:  # 24 bytes each: then only the sets that are wanted move
        moved = F.broadcast(moved)
    moved = sets.join(moved, "node").select("block_a", "block_b", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(None).cast("bigint").alias("b"), "sig", "shingles")
    tested = pairs.select("block_a", "block_b", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("sig"), F.lit(None).cast("binary").alias("shingles"))
    both = moved.union(tested).repartition(parallelism(pairs.sparkSession), "block_a", "block_b").sortWithinPartitions("block_a", "block_b", "kind")
    with _small_batches(pairs.sparkSession):
        return stable(both.mapInArrow(_confirmed, "a bigint, b bigint"), "neardup-links")


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node reachable) of the nodes with an edge (a, b): least neighbours, then pointer jumping.

    Nodes of many edges and labels of many nodes are spread over salts.
    """
    both = stable(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "neardup-edges")
    ends = both.count()
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    labels = stable(first.select("node", F.least("node", "m").alias("label"), "degree"), "neardup-labels")
    nodes = labels.count()
    while True:
        seen = salted_left_join(both, labels.select(F.col("node").alias("b"), "label", "degree"), "b", "degree", ends).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        hooked = labels.join(seen, "node").select("node", "degree", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        hooked = stable(hooked, "neardup-hooked")
        held = hooked.groupBy("label").agg(F.count(F.lit(1)).alias("weight"))
        step = held.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label")
        jumped = salted_left_join(hooked, step, "label", "weight", nodes).select("node", "degree", "was", F.least("label", "next").alias("label"))
        following = stable(jumped, "neardup-labels")
        if following.where("label <> was").isEmpty():
            return following.select("node", "label")
        labels = following.select("node", "label", "degree")


def link(classes: DataFrame, lists: DataFrame, sets: DataFrame) -> DataFrame | None:
    """node, label of all classes that are linked with another; None if none are."""
    parts, found = at_home(lists, sets)
    labels = None if found.isEmpty() else components(found)
    block_of = parts.select("node", "block")
    names = ["key", "node", "n", "part", "size"]
    rest = lists.join(classes.select("node", F.col("n_shingles").alias("n")), "node").join(parts.select("node", "part"), "node").select(names)
    most = 1
    while True:
        rest = rest.select(names)
        rest = rest.withColumn("label", F.col("node")) if labels is None else rest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = rest.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("now")).where("l < h and p < q").select("key", "now")
        rest = stable(rest.join(open_, "key").select("key", "node", "n", "part", "label", F.col("now").alias("size")), "neardup-lists")
        if rest.isEmpty():
            return labels
        nth = F.row_number().over(Window.partitionBy("key").orderBy("node"))  # only the first few: grouped limits are taken before the shuffle
        pivots = rest.withColumn("nth", nth).where(F.col("nth") <= most).select("key", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("part").alias("pivot_part"), F.col("label").alias("pivot_label"), "size")
        pivots = stable(pivots, "neardup-pivots")
        found = _links(rest, pivots, block_of, sets)
        rest = rest.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
        if not found.isEmpty():
            if labels is None:
                labels = components(found)
            else:
                name = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_l"))  # noqa: B023, E731
                edges = found.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("a_l", "a").alias("a"), F.coalesce("b_l", "b").alias("b"), F.col("a").alias("x"), F.col("b").alias("y"))
                edges = stable(edges, "neardup-edges")
                moved = components(edges.where("a <> b").select("a", "b")).select(F.col("node").alias("label"), F.col("label").alias("to"))
                known = labels.union(edges.select("x", "a")).union(edges.select("y", "b")).distinct()
                labels = stable(known.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "neardup-labels")
        most *= 8


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, mark, n_shingles, component_id, kept."""
    with _small_batches(docs.sparkSession):
        rows = stable(sketch(docs, text, doc_id), "neardup-sketch")  # about 220 bytes a document
    classes = stable(rows.where("n_shingles > 0").groupBy("node", "n_shingles").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig")), "neardup-classes")
    lists = stable(prefix_lists(classes), "neardup-prefixes")
    alone = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n < 2").select("key")
    lists = lists.join(alone, "key", "left_anti")
    members = lists.select("node").distinct().join(classes, "node").select(F.col("first_id").alias("doc_id"), "node", "sig")
    members = stable(members, "neardup-members")
    with _small_batches(docs.sparkSession):
        sets = stable(full_sets(docs, members, text, doc_id), "neardup-sets")
    labels = link(classes, lists, sets)
    named = classes.select("node", "first_id", "copies")
    named = named.withColumn("label", F.col("node")) if labels is None else named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = stable(named.join(least, "label").select("node", "copies", "component_id"), "neardup-components")
    out = salted_left_join(rows.select("doc_id", "mark", "n_shingles", "node"), of_class, "node", "copies", rows.count())
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "mark", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, all columns, one of each component: that with the smallest id."""
    verdict = groups(docs, text, doc_id).where("n_shingles > 0").select("doc_id", "mark", "kept")  # read once
    return without(docs, doc_id, F.xxhash64(F.col(f"`{text}`")), verdict)


ORACLE = r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, hash(k) AS k FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS k FROM w)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * shared >= 70 * (x.n + y.n - shared)),
    l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
    SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id, w.doc_id = min(r.y) AS kept
    FROM w JOIN r ON r.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n"""
