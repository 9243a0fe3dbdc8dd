import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.common import EDGE, frame
from tracemill.llm import bpe, packing

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
CODER = bpe.Encoder(RANKS)
LIBRARY = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
JSON = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
MARKS = ["hello <|endoftext|> world", "<|endoftext|>", "end.<|endoftext|>Next\n<|endoftext|><|endoftext|>  two", "<|endoftext", " <|endoftext|>"]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'sltve.,12aethn\0\x1c\x85\xa0　")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_the_libraries(text):
    ids = CODER.ids(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text) == JSON.encode(text, add_special_tokens=False).ids
    assert "<|endoftext|>" not in text
    assert bpe.StreamingDecoder(CODER.transducer.vocabulary.bytes_of, block=3).text(ids) == text


BATCHES = st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'sltve.,12aethn\x1c\x85\xa0　éſ")), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=12)


@settings(max_examples=200, deadline=None)
@given(BATCHES)
def test_batches_are_encoded_as_single_texts(texts):
    texts = [*texts, *texts[:2], *MARKS]
    column = pa.array([*texts, None])
    flat, starts = CODER.many(column)
    assert [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [*map(LIBRARY.encode_ordinary, texts), []]
    flat, starts = packing.coder(P.path("byte_bpe_50k.json"))[0].many(column.slice(1))
    assert [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [e.ids for e in JSON.encode_batch(texts[1:], add_special_tokens=False)] + [[]]


def test_memory_of_pieces_turns_over(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 5)
    small = bpe.Encoder(RANKS)
    texts = [f"word{i % 7} and other{i} words again and again" for i in range(40)]
    for i in range(0, 40, 4):
        flat, starts = small.many(pa.array(texts[i : i + 4]))
        assert [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == list(map(LIBRARY.encode_ordinary, texts[i : i + 4]))
    assert len(small.old) < 60


def test_slices_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["aaa", None, "b" * 50, "", "cc", "dddddddd"])], ["i", "text"])
    assert [p.column(0).to_pylist() for p in bpe.slices(batch, 1, 8)] == [[0, 1], [2], [3, 4], [5]]
    assert list(bpe.slices(batch.slice(0, 0), 1)) == []


def test_pieces_without_spaces_and_bounded_memory():
    small = bpe.Encoder(RANKS)
    small.transducer.limit = 50
    r = random.Random(3)
    for n in (1, 7, 400):
        text = "".join(r.choice("aehnorstié") for _ in range(n)) * 3
        assert small.ids(text).tolist() == LIBRARY.encode_ordinary(text)
    assert len(small.transducer.hops) < 2000


def test_lookahead_is_bounded():
    t = bpe.Transducer(CODER.transducer.vocabulary)
    t.encode(b" " + b"thentationally" * 200)
    longest = max(map(len, RANKS))
    assert max(len(e[2]) for entries in t.entries for e in entries) <= longest


def test_utf8_machine_holds_back_unfinished():
    text = "aé日🙂" * 5
    machine, out = bpe.Utf8Machine(), ""
    for b in text.encode():
        out += machine.feed(bytes([b]))
    assert out + machine.close() == text
    assert bpe.Utf8Machine().feed(b"\xff\xfe") == "��"


def test_round_trip_rows(spark, data):
    docs = frame(spark, EDGE).unionByName(spark.read.parquet(f"{data}/documents.parquet").limit(100), allowMissingColumns=True)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    rows = bpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken")).collect()
    expected = sorted((str(d), len(i := LIBRARY.encode_ordinary(t)), hashlib.sha256(packed(i)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, ts in texts.items() for t in ts)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected and all(r.same for r in rows)
    assert bpe.round_trip(docs.limit(0), P.path("byte_bpe_50k.tiktoken")).count() == 0


def test_encode_and_decode_columns(spark):
    docs = frame(spark, EDGE)
    coded = bpe.encode(docs, P.path("byte_bpe_50k.json"))
    back = bpe.decode(coded, P.path("byte_bpe_50k.json"), out="again")
    assert all(r.again == (r.text or "") and r.KEY == "K" for r in back.collect())
    with pytest.raises(ValueError):
        bpe.encode(docs, P.path("byte_bpe_50k.json"), out="key")


def cost(length, window):
    return 0 if length & (length - 1) == 0 else window - length


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_best_of_all_candidates(seed):
    r = random.Random(seed)
    window, length = 16, r.randrange(1, 140)
    ends = np.array(sorted({length, *(r.randrange(1, length + 1) for _ in range(r.randrange(0, 12)))}))
    sentences = np.array(sorted({r.randrange(1, length + 1) for _ in range(r.randrange(0, 20))}), int)
    got = packing.cuts(ends, sentences, length, True, window, 2, 5)
    price = lambda p: 0 if p in set(ends.tolist()) else 2 if p in set(sentences.tolist()) else 5
    strong = sorted({0, *ends.tolist(), *sentences.tolist()})
    places = sorted({*strong, *(p + window for p in strong if p + window <= length), *(q for a, b in zip(strong, [*strong[1:], length], strict=True) for q in range(a + window, b, window))})
    best = {0: 0}
    for j in places[1:]:
        if options := [best[i] + cost(j - i, window) for i in places if i < j and j - i <= window and i in best]:
            best[j] = min(options) + price(j)
    total = sum(cost(b - a, window) + price(b) for a, b in zip([0, *got], got, strict=False))
    assert got[-1] == length and all(0 < b - a <= window for a, b in zip([0, *got], got, strict=False)) and total == best[length]


def test_pack_covers_every_id_once(spark, data):
    docs = frame(spark, [*EDGE, *enumerate(MARKS, 900_000)]).unionByName(spark.read.parquet(f"{data}/documents.parquet"), allowMissingColumns=True)
    pieces = packing.pack(docs, P.path("byte_bpe_50k.json")).collect()
    expected = sorted((str(r.doc_id), packed([*JSON.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.select("doc_id", "text").collect())
    whole, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.ids_crc32 == zlib.crc32(packed(p.ids)) and len(p.ids) == p.length and p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
        whole.setdefault((str(p.doc_id), p.doc_tokens), []).append(p)
    got = []
    for (doc, tokens), parts in whole.items():
        ids, at = b"", 0
        for p in parts:  # in stream order, so repeated rows come one after another
            assert p.start == at
            ids, at = ids + packed(p.ids), at + p.length
            if at == tokens:
                got.append((doc, ids))
                ids, at = b"", 0
        assert at == 0
    assert sorted(got) == expected and max(sequences.values()) <= 2048
    padding = sum(cost(n, 2048) for n in sequences.values())
    assert padding <= 0.02 * sum(sequences.values()) + 2048 * docs.rdd.getNumPartitions()
    assert packing.pack(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_blocks_carry_over():
    coder, ends, opens = packing.coder(P.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t in EDGE] + ["word. " * 900, "nospace" * 3000]
    for block in (10, 5000, 10**9):
        packer, pieces = packing.Packer(ends, opens, 0, block), []
        for i, t in enumerate(texts):
            pieces += packer.add(i, coder.packed(t))
        pieces += packer.close()
        for i, t in enumerate(texts):
            assert b"".join(p[3] for p in pieces if p[0] == i) == packed([*LIBRARY.encode_ordinary(t), 1])
