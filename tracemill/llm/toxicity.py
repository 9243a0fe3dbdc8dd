"""Toxicity by a logistic model with counterfactual regularisation.

A document's features are the words in it and their beginnings (of 3 to 6 letters), so that compounds and inflections of
abusive stems count. Features are screened by association with the label over the training rows; those kept enter a logistic
model. Beside log loss it pays for every change of score when identity terms are swapped: each labelled sentence that names a
group, of either label, is paired with the same sentence naming another group of the kind; in a document that names none, one
sentence is paired with itself with a group mention put in. The pairs of a document weigh as much as those of any other, so a
neutral mention of a group moves no score. All pairs of the fitted rows count.

Training rows: labelled documents whose crc32(doc_id as text) modulo 3 is not 1, at most MAX_TRAINING of them by hash order (the
documented bound); everything else, the screening included, covers all of these. Every whole document is scored.

Defined results: null and empty texts have no features and get the base score; null labels are no labels, of several for one
id the largest counts; without labelled rows of both kinds every score is the share of toxic ones (0 without any);
`reject_toxic` keeps all columns and rows below the threshold; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tracemill.llm._linear import Rows, fit, sigmoid
from tracemill.session import ship, stable

MAX_TRAINING = 20_000
MAX_FEATURES = 20_000
THRESHOLD = 0.7
PAIR_PENALTY = 2.0
RIDGE = 1e-5
_WORDS = re.compile(r"[^\W\d_]+").findall
#: Groups by kind; terms of one kind are swapped for one another.
IDENTITIES: dict[str, tuple[str, ...]] = {
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"),
    "religions": ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs"),
    "gender": ("woman", "man", "girl", "boy"),
    "genders": ("women", "men", "girls", "boys"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    "origin": ("black", "white", "asian", "african", "european", "latino", "arab", "mexican", "chinese", "indian", "immigrant", "refugee"),
    "ability": ("deaf", "blind", "disabled", "autistic"),
    "de": ("muslimisch", "christlich", "jüdisch", "schwul", "lesbisch", "schwarz"),
    "de_people": ("frau", "mann", "muslim", "christ", "jude", "ausländer", "flüchtling"),
    "fr": ("musulman", "chrétien", "juif", "homosexuel", "noir", "arabe", "africain"),
    "fr_people": ("femme", "homme", "immigré", "réfugié"),
    "es": ("musulmán", "cristiano", "judío", "homosexual", "negro", "árabe", "africano"),
    "es_people": ("mujer", "hombre", "inmigrante", "refugiado"),
}
_KIND = {term: kind for kind, terms in reversed(IDENTITIES.items()) for term in terms}  # the first kind of a term counts
_TERMS = sorted(_KIND)


def words(text: str) -> list[str]:
    return _WORDS(text.lower())


def features(word: str) -> list[str]:
    return ["=" + word, *[word[:k] for k in range(3, 7) if len(word) > k]]


def swapped(sentence: list[str], turn: int) -> list[str] | None:
    """The sentence with each identity term replaced by the turn-th other of its kind; None without any."""
    if not any(w in _KIND for w in sentence):
        return None
    out = []
    for word in sentence:
        if word in _KIND:
            terms = IDENTITIES[_KIND[word]]
            word = terms[(terms.index(word) + 1 + turn % (len(terms) - 1)) % len(terms)]
        out.append(word)
    return out


def training_labels(labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """doc_id, toxic of the rows that may be learnt from; at most `most` rows."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    rows = rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a feature, by label; sent on whenever there are many."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def sent() -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], ["feature", "clean", "toxic"])
        counts[0].clear(), counts[1].clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            counts[toxic > 0].update({f for w in set(words(text.as_py() or "")) for f in features(w)})
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield sent()
    yield sent()


class Model:
    def __init__(self, names: list[str], weights: np.ndarray, intercept: float):
        self.names, self.weights, self.intercept = names, weights, intercept


class _Lookup(dict):
    """Word to the kept features it has; bounded."""

    def __init__(self, kept: dict[str, int]):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[int, ...]:
        kept = self.kept
        found = tuple([kept[f] for f in features(word) if f in kept])
        if len(self) > 150_000:
            self.clear()
        self[word] = found
        return found


def _document(lookup: _Lookup, text: str) -> set[int]:
    return {i for found in map(lookup.__getitem__, set(words(text))) if found for i in found}


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", most: int = MAX_TRAINING, penalty: float = PAIR_PENALTY) -> Model:
    ship(docs.sparkSession)
    known = stable(training_labels(labels, most), "toxicity-labels")  # at most `most` rows of 12 bytes
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text")).join(F.broadcast(known), "doc_id").select("text", "toxic")
    totals = {r["toxic"] > 0: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        share = 1.0 if totals.get(True) else 0.0
        return Model([], np.zeros(0), 40.0 * (2 * share - 1))
    n1, n0 = totals[True], totals[False]
    counts = rows.mapInArrow(_counted, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    p1, p0 = (F.col("t") + 0.5) / (n1 + 1), (F.col("c") + 0.5) / (n0 + 1)
    z = (F.log(p1 / (1 - p1)) - F.log(p0 / (1 - p0))) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5) + 1 / (n1 - F.col("t") + 0.5) + 1 / (n0 - F.col("c") + 0.5))
    screened = counts.where((F.col("c") + F.col("t") >= 4) & (F.col("c") <= n0) & (F.col("t") <= n1)).withColumn("z", z).where("abs(z) >= 3").orderBy(F.desc(F.abs("z")), "feature").limit(MAX_FEATURES)
    identity = {f for term in _TERMS for f in features(term)}
    names = sorted({r["feature"] for r in screened.select("feature").collect()} | identity)
    kept = {name: i for i, name in enumerate(names)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(kept)
        for batch in batches:
            ids, pairs = [], []
            for value in batch.column(0):
                body = value.as_py() or ""
                ids.append(sorted(_document(lookup, body)))
                pairs.append(_pairs(lookup, body))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.list_(pa.int32())))], ["toxic", "mark", "ids", "pairs"])

    marked = rows.select("text", "toxic", F.xxhash64("text").alias("mark"))
    fitted = marked.mapInArrow(found, "toxic int, mark bigint, ids array<int>, pairs array<array<int>>").toArrow()
    ids, toxic, one, other, share = gathered(fitted)
    balance = np.where(toxic > 0, max(1.0, n0 / n1), 1.0)
    weights, intercept = fit(ids, toxic, len(names), balance, ridge=RIDGE, pairs=(one, other), pair_penalty=penalty, pair_weight=share)
    return Model(names, weights, intercept)


def gathered(fitted: pa.Table) -> tuple[Rows, np.ndarray, Rows, Rows, np.ndarray]:
    """Features and label of each row; both sides of each pair, and its weight: those of a row have one together."""
    fitted = fitted.take(pa.array(np.lexsort((fitted["mark"].to_numpy(), fitted["toxic"].to_numpy())))).combine_chunks()  # whatever order tasks ended in
    ids, pairs = (fitted[c].combine_chunks() for c in ("ids", "pairs"))
    sides = pairs.flatten()
    places = np.arange(0, len(sides), 2)
    each = np.diff(pairs.offsets.to_numpy()) // 2
    share = np.repeat(1 / np.maximum(each, 1), each)
    return Rows.of(ids), (fitted["toxic"].to_numpy() > 0).astype(float), Rows.of(sides.take(pa.array(places))), Rows.of(sides.take(pa.array(places + 1))), share


def _pairs(lookup: _Lookup, text: str) -> list[list[int]]:
    """Features of each labelled sentence that names a group and of its counterfactual, one after the other."""
    out: list[list[int]] = []
    sentences = [s for s in re.split(r"(?<=[.!?])\s|\n", text) if s.strip()]
    side = lambda ws: sorted({i for w in ws for i in lookup[w]})
    for sentence in sentences:
        own = words(sentence)
        changed = swapped(own, zlib.crc32(sentence.encode()))
        if changed is not None:
            out += [side(own), side(changed)]
    if not out and sentences:  # a mention is put into one sentence, chosen by its text
        own = words(sentences[zlib.crc32(text.encode()) % len(sentences)])
        out += [side(own), side([*own, _TERMS[zlib.crc32(text.encode()) // 7 % len(_TERMS)]])]
    return out


def scores(docs: DataFrame, model: Model, text: str = "text", with_text: bool = True) -> DataFrame:
    """docs, with or without the text, with __tm_score appended."""
    spark = docs.sparkSession
    ship(spark)
    used = {name: float(w) for name, w in zip(model.names, model.weights, strict=True) if w}
    share = spark.sparkContext.broadcast((used, model.intercept))  # at most MAX_FEATURES and the identity terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = share.value
        names = sorted(weights)
        table = np.array([weights[n] for n in names])
        lookup = _Lookup({n: i for i, n in enumerate(names)})
        for batch in batches:
            last = batch.num_columns - 1
            logits = np.array([intercept + table[sorted(_document(lookup, v.as_py() or ""))].sum() for v in batch.column(last)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(sigmoid(logits))], [*batch.schema.names[:last], "__tm_score"])

    keep = [f for f in docs.schema.fields if with_text or f.name.lower() != text.lower()]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{text}`").alias("__tm_text"))
    return rows.mapInArrow(run, StructType([*keep, StructField("__tm_score", DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.select((F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1).alias("held_out"), "doc_id", "text")
    scored = scores(rows, model, with_text=False).select("doc_id", "held_out", F.col("__tm_score").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    model = train(docs, labels)
    return scores(docs, model).where(F.col("__tm_score") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
