import random
import re
import zlib

import numpy as np
import pandas as pd

import corpus_pipeline
from tests.llm.common import EDGE, frame, prose
from tracemill.llm import _linear, near_dedup, quality_classifier, registry, secret_scan, toxicity

BIG = "/root/testdata/sf0.01"


def auc(score, label):
    rank, positive = pd.Series(score).rank().to_numpy(), np.asarray(label, bool)
    return (rank[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / max(1, positive.sum() * (~positive).sum())


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_labels(spark):
    got = registry.QUERIES["op10_toxicity"](spark, BIG).toPandas()
    truth = spark.read.parquet(f"{BIG}/labels.parquet").toPandas()
    held = got.merge(truth, on="doc_id")
    assert ((held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)) == held.held_out).all()
    held = held[held.held_out]
    assert auc(held.score, held.toxic) > 0.9 and (held.predicted == (held.score >= 0.7)).all()
    assert ((held.predicted == 0) & (held.toxic == 0)).sum() >= 0.95 * (held.toxic == 0).sum()


def toxic_corpus(n=240):
    rows, marks = [], []
    for i, text in enumerate(prose(3, n, 40)):
        bad = i % 4 == 0
        rows.append((i, f"{text} {'you utter scumbag' if bad else 'good day'}"))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_toxicity_on_odd_rows(spark):
    rows, marks = toxic_corpus()
    docs = frame(spark, rows + [(1000 + i, t) for i, (_, t) in enumerate(EDGE)] + [(None, "scumbag"), (3000, "you utter scumbag")])
    table = labels(spark, marks + [(None, 1, 1), (5, 1, None), (4, 1, 1)])
    got = {r.doc_id: r for r in toxicity.classify(docs, table).collect()}
    assert got[3000].predicted == 1 and got[None].score > 0.5 and all(got[1000 + i].predicted == 0 and 0 <= got[1000 + i].score <= 1 for i in range(len(EDGE)))
    kept = toxicity.reject_toxic(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.predicted}
    assert toxicity.classify(docs.limit(0), table).count() == 0
    assert all(r.score == 0.0 or r.score < 1e-9 for r in toxicity.classify(docs, table.limit(0)).collect())


def test_counterfactual_penalty_shrinks_the_effect_of_group_terms():
    # feature 0 is abusive, 1 and 2 name groups; group 1 occurs with abuse more often than not
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(400):
        toxic = rng.random() < 0.5
        rows.append(([0] if toxic and rng.random() < 0.8 else []) + ([1] if rng.random() < (0.6 if toxic else 0.1) else [2]))
        y.append(float(toxic))
    pairs = (_linear.Rows([[1]] * 50), _linear.Rows([[2]] * 50))
    plain, b = _linear.fit(_linear.Rows(rows), np.array(y), 3)
    fair, c = _linear.fit(_linear.Rows(rows), np.array(y), 3, pairs=pairs, pair_penalty=5.0)
    gap = lambda w, b: abs(_linear.sigmoid(w[1] + b) - _linear.sigmoid(w[2] + b))
    assert gap(fair, c) < 0.35 * gap(plain, b) and fair[0] > 1


def test_group_terms_are_swapped():
    sentence = "the muslim woman is a teacher".split()
    changed = toxicity.swapped(sentence, 0)
    assert changed[1] != "muslim" and changed[1] in toxicity.IDENTITIES["religion"] and changed[2] in toxicity.IDENTITIES["gender"] and changed[3:] == sentence[3:]
    assert toxicity.swapped(["nobody"], 0) is None


def test_all_pairs_of_both_labels_count():
    """20,000 rows that name groups, most of them clean: no toxic row loses its counterfactuals."""
    import pyarrow as pa

    lookup = toxicity._Lookup({f: i for i, f in enumerate(sorted({f for t in ["scum", *toxicity._TERMS] for f in toxicity.features(t)}))})
    clean = toxicity._pairs(lookup, "A muslim came. One gay man left! Women sang. The deaf boy ran. A sikh sat. Nobody spoke.")
    toxic = toxicity._pairs(lookup, "You scum of a jewish man. " * 7)
    assert (len(clean), len(toxic)) == (10, 14)
    n = [1] * 500 + [0] * 19_500
    table = pa.table({"toxic": pa.array(n, pa.int32()), "mark": pa.array(range(20_000), pa.int64()), "ids": pa.array([[0] if t else [1] for t in n], pa.list_(pa.int32())), "pairs": pa.array([toxic if t else clean for t in n], pa.list_(pa.list_(pa.int32())))})
    ids, y, one, other, share = toxicity.gathered(table)
    assert (ids.n, y.sum(), one.n, other.n) == (20_000, 500, 500 * 7 + 19_500 * 5, one.n) and abs(share.sum() - 20_000) < 1e-6
    assert abs(share[-500 * 7 :].sum() - 500) < 1e-6 and one.ids[one.starts[-2] :].tolist() == toxic[-2] and other.ids[other.starts[-2] :].tolist() == toxic[-1]


def biased_corpus(n=600, seed=5):
    """Groups named mostly where the text is abusive."""
    r = random.Random(seed)
    rows, marks = [], []
    for i, text in enumerate(prose(seed, n, 30)):
        bad = i % 3 == 0
        group = r.choice(["muslim", "gay", "black", "woman"]) if r.random() < (0.8 if bad else 0.1) else ""
        rows.append((i, f"{text} {'you utter scumbag' if bad and r.random() < 0.7 else 'good day'} {group}."))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_neutral_mentions_are_freed_by_the_penalty(spark):
    rows, marks = biased_corpus()
    docs, table = frame(spark, rows), labels(spark, marks)
    neutral = [f"{t} The {g} teacher came" for t in prose(6, 20, 20) for g in ("muslim", "christian", "gay", "straight", "black", "european")]

    def of(penalty):
        model = toxicity.train(docs, table, penalty=penalty)
        got = toxicity.scores(frame(spark, list(enumerate(neutral))), model).orderBy("doc_id").toPandas()["__tm_score"].to_numpy().reshape(-1, 6)
        own = toxicity.scores(docs, model).orderBy("doc_id").toPandas()["__tm_score"].to_numpy()
        return np.abs(np.diff(got.reshape(-1, 3, 2))).mean(), auc(own, [m[2] for m in marks])

    (plain, _), (fair, held) = of(0.0), of(toxicity.PAIR_PENALTY)
    print(f"mean change of a neutral sentence's score under a swap: {plain:.3f} without the penalty, {fair:.3f} with it; AUC {held:.3f}")
    assert fair < 0.5 * plain and held > 0.75


def test_quality_on_held_out_labels(spark):
    got = registry.QUERIES["op1_quality_classifier"](spark, BIG).toPandas()
    held = got.merge(spark.read.parquet(f"{BIG}/labels.parquet").toPandas(), on="doc_id")
    held = held[held.held_out]
    assert auc(held.score, held.quality) > 0.93 and (held.kept & (held.quality == 1)).sum() >= 0.95 * (held.quality == 1).sum()


def test_quality_on_odd_rows(spark):
    rows = [(i, t if i % 3 else "%% " + " ## ".join(t.split())) for i, t in enumerate(prose(8, 150, 60))]
    docs = frame(spark, rows + [(1000 + i, t) for i, (_, t) in enumerate(EDGE)])
    table = labels(spark, [(i, int(i % 3 > 0), 0) for i in range(120)] + [(None, 1, 0), (1, None, 0)])
    got = quality_classifier.score(docs, table).collect()
    assert len(got) == len(rows) + len(EDGE) and all(0 <= r.score <= 1 and r.kept == (r.score >= quality_classifier.KEEP) for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert np.mean([scores[i] for i in range(120, 150) if i % 3]) > np.mean([scores[i] for i in range(120, 150, 3)])
    assert quality_classifier.score(docs.limit(0), table).count() == 0
    assert all(r.score == 0.5 for r in quality_classifier.score(docs, table.limit(0)).collect())


def test_scores_of_co_training_rise():
    assert list(quality_classifier._rising(np.array([1.0, 3.0, 2.0, 4.0]), np.ones(4))) == [1.0, 2.5, 2.5, 4.0]


def near(a, b):
    x, y = (set(near_dedup.shingle_set(t).tolist()) for t in (a, b))
    return bool(x and y) and 100 * len(x & y) >= 70 * len(x | y)


def test_pipeline_against_plain_python(spark, tmp_path):
    rows, marks = toxic_corpus(200)
    base = " ".join(f"b{i}" for i in range(80))
    rows += [(500, base), (501, base), (502, base + " tail"), (503, 'key token = "0123456789abcdef01234567" end'), (504, None), (505, ""), (506, "you utter scumbag again")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, marks).write.parquet(str(tmp_path / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()

    table = labels(spark, marks)
    toxic = {r.doc_id for r in toxicity.classify(docs, table).collect() if r.predicted}
    assert {0, 4, 8, 506} <= toxic and 500 not in toxic
    left = {}
    for d, t in sorted(rows):
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if d not in toxic and norm not in {re.sub(r"[\x20\x09-\x0D]+", " ", x or "") for x in left.values()}:
            left[d] = t
    kept = {}
    for d, t in left.items():
        if not any(near(t or "", x or "") for x in kept.values()):  # the fixture has stars only, so this is the component rule
            kept[d] = t
    masked = {d: t if t is None else secret_scan_masked(t) for d, t in kept.items()}
    from tests.llm.test_bpe_packing import LIBRARY, packed

    got = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] = got.get(p.doc_id, b"") + packed(p.ids)
    assert got == {d: packed([*LIBRARY.encode_ordinary(t or ""), 1]) for d, t in masked.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def secret_scan_masked(text):
    (spans,) = secret_scan.scan([text])
    for start, kind, end in reversed([s for i, s in enumerate(spans) if not any(o[0] <= s[0] and s[2] <= o[2] for o in spans[:i])]):
        text = f"{text[:start]}<{secret_scan.own_rules()[kind].kind.upper()}>{text[end:]}"
    return text
