import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import EDGE, frame, near_copies, prose
from tracemill import session
from tracemill.llm import exact_dedup, near_dedup, sharding


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=300), st.sampled_from([1, 2, 64]))
def test_cuckoo_index_is_exact(steps, buckets):
    index, truth = exact_dedup.CuckooIndex(buckets), Counter()
    for add, n in steps:
        key = hashlib.sha256(str(n).encode()).digest()
        if add:
            assert index.insert(key, n) == (truth[n] == 0)
            truth[n] += 1
        else:
            assert index.delete(key) == (truth[n] > 0)
            truth[n] = max(0, truth[n] - 1)
    assert {e[0]: e[2] for e in index.entries()} == {hashlib.sha256(str(n).encode()).digest(): c for n, c in truth.items() if c}
    assert index.size == sum(c > 0 for c in truth.values())


def test_cuckoo_filter_grows_and_hits_are_verified():
    index = exact_dedup.CuckooIndex(1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    assert all(index.insert(k, i) for i, k in enumerate(keys)) and index.resizes > 5
    assert all(k in index.filter for k in keys)
    twin = keys[0][:12] + b"\0" * 20  # same fingerprint and buckets, another key
    assert twin in index.filter and index.get(twin) is None and index.false_hits == 1


def brute_groups(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((d is None, d or 0, i))
    out = []
    for norm, members in groups.items():
        members.sort()
        keep = None if members[0][0] else members[0][1]
        for n, (null, d, _) in enumerate(members):
            out.append((str(None if null else d), str(keep), len(members), n == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("rows", [EDGE, list(enumerate(near_copies(5, 80) + ["hot copy"] * 300)), []], ids=["edge", "copies", "empty"])
def test_exact_groups(spark, rows):
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact_dedup.groups(frame(spark, rows)).collect())
    assert got == brute_groups(rows)


def test_drop_copies_keeps_columns_and_one_row(spark):
    docs = frame(spark, EDGE)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    expected = Counter((r[0], r[4]) for r in brute_groups(EDGE) if r[3])
    got = Counter((str(r.doc_id), hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in out.collect())
    assert got == expected
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_few_keys_take_few_files(spark):
    """An executor starts a process for each file, which can count as memory: one shard for few keys, no table of what is read once."""
    docs, before = frame(spark, [(i, f"text number {i % 300} of some") for i in range(1000)]), len(session._written)
    kept = {(r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()}
    assert kept == {(i, f"text number {i} of some") for i in range(300)}
    assert near_dedup.drop_near(docs).count() == 300
    paths = [Path(path.removeprefix("file://")) for _, path in session._written[before:]]
    assert not [p for p in paths if p.name.startswith(("dedup-copies-", "neardup-verdict-"))]
    assert [len(list(p.glob("part-*"))) for p in paths if p.name.startswith("dedup-keys-")] == [1]


def test_index_takes_documents_in_and_out(spark):
    a, b = frame(spark, [(1, "x"), (2, "y"), (3, "x")]), frame(spark, [(4, "z"), (0, "x")])
    index = exact_dedup.insert(exact_dedup.insert(None, a), b)
    live = lambda i: sorted((r.keep_id, r.live) for r in i.collect())
    assert live(index) == [(0, 3), (2, 1), (4, 1)]
    assert live(exact_dedup.delete(index, frame(spark, [(1, "x"), (2, " y".strip()), (9, "never")]))) == [(0, 2), (4, 1)]


def test_salted_join_spreads_a_hot_key(spark):
    from tracemill.operators.joins import salted_left_join

    rows = spark.range(1000).selectExpr("id", "if(id % 2 = 0, 0, id) AS k")
    keys = spark.createDataFrame([(0, 200_000, "hot"), (1, 1, "one")], "k long, n long, v string")
    for total in (200, 400_000):  # few rows, which aren't salted, and many
        got = {(r.id): r.v for r in salted_left_join(rows, keys, "k", "n", total).collect()}
        assert len(got) == 1000 and all(got[i] == "hot" for i in range(0, 1000, 2)) and got[1] == "one" and got[3] is None


@pytest.mark.parametrize("rows", [EDGE, list(enumerate(prose(1, 90) + ["same"] * 40)), [(7, "same")] * 70_000, []], ids=["edge", "prose", "one row", "empty"])
def test_shards(spark, rows):
    n = 40 if len(rows) < 1000 else 7
    got = sharding.shards(frame(spark, rows) if len(rows) < 1000 else spark.createDataFrame(rows, "doc_id long, text string"), n).collect()
    of = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(d), *of(t)) for d, t in rows)
    got.sort(key=lambda r: r.row)
    total = sum(r.size for r in got)
    at, slots = 0, Counter()
    for place, r in enumerate(got):
        assert (r.row, r.byte, r.law, r.grown_shard) == (place, at, "bytes", None)
        assert r.shard == (2 * at + r.size) * n // (2 * total) and r.slot == slots[r.shard]
        slots[r.shard] += 1
        at += r.size
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 70 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i))), d == least.get(find(i))) for i, (d, _) in enumerate(rows))


CHAIN = [(i, " ".join(f"c{j}" for j in range(i * 4, i * 4 + 60))) for i in range(12)]
PASSAGE = " ".join(f"p{i}" for i in range(55))
SHARED = [(100 + i, f"{' '.join(f'u{i}x{j}' for j in range(5 + i % 40))} {PASSAGE}") for i in range(60)]


@pytest.mark.parametrize("rows", [EDGE, CHAIN, SHARED, list(enumerate(near_copies(9, 160))), []], ids=["edge", "chain", "passage", "copies", "empty"])
def test_near_groups(spark, rows):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.groups(frame(spark, rows)).collect())
    assert got == brute_near(rows)


@pytest.mark.parametrize("rows", [CHAIN, SHARED, list(enumerate(near_copies(9, 160)))], ids=["chain", "passage", "copies"])
def test_near_groups_of_large_neighbourhoods(spark, rows, monkeypatch):
    """All of them too large for one task, so that rounds of pivots find every link; and lists that are spread over salts."""
    monkeypatch.setattr(near_dedup, "_PART", 1)
    monkeypatch.setattr(near_dedup, "_BLOCK", 3)
    monkeypatch.setattr(near_dedup, "_SALTED", 4)
    monkeypatch.setattr(near_dedup, "_FEW", 10)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.groups(frame(spark, rows)).collect())
    assert got == brute_near(rows)


def tail(seed, n, step=9, size=60):
    """A chain in which a text is similar to its next only, and whose classes' ids are in no order."""
    r = random.Random(seed)
    words = [f"t{r.randrange(10**9)}" for _ in range(step * n + size)]
    return [(i, " ".join(words[i * step : i * step + size])) for i in range(n)]


@pytest.mark.parametrize("rows", [tail(34, 40), tail(13, 60)], ids=["40", "60"])
def test_near_groups_of_a_tail_beyond_the_steps(spark, rows, monkeypatch):
    """The node that names the small neighbourhood at the end of the tail is itself a member of the large one before it."""
    monkeypatch.setattr(near_dedup, "_PART", 6)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.groups(frame(spark, rows)).collect())
    assert got == brute_near(rows)
    assert {r[2] for r in got} == {"0"}


def test_drop_near(spark):
    rows = list(enumerate(near_copies(11, 60))) + [(None, None), (900, ""), (901, ""), (902, "tiny"), (902, "tiny")]
    docs = frame(spark, rows)
    out = near_dedup.drop_near(docs)
    assert out.columns == docs.columns
    expected = [r[0] for r in brute_near(rows) if r[3] or r[1] == 0]
    expected.remove("902")  # of rows that agree in id and text one stays
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(expected)
