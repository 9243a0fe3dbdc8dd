"""Quality by co-training of two views.

View one is the text's content (shares of symbols, capitals, digits, repeated words and lines, word lengths ...), view two the
page's metadata (language, source, length, number and length of lines). Each view is a naive Bayes model over binned features,
so a fit is one aggregation of counts over all documents. In each round, either view's confident verdicts on unlabelled
documents are counted as labels, at part weight, for the other view. After the last round each view is calibrated by the
observed share of good documents per score bin over the labelled rows, and the calibrated log odds add up, less the prior.

All documents take part in every round; what reaches the driver are counts per view, feature and bin (a few hundred numbers).
Labels of rows whose crc32(doc_id as text) modulo 3 is 1 are held out and never learnt from.

Defined results: null text counts as empty; null language or source is a value of its own; null labels are none, of several for
one id the smallest counts; without labels of both kinds every score is the prior (0.5 without any); an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.quality_rules import repeated_words
from tracemill.session import ship, stable

ROUNDS = 3
CONFIDENT = 0.95
PSEUDO_WEIGHT = 0.3
KEEP = 0.35
BINS = 32
_SYMBOLS, _CAPITALS, _DIGITS, _MARKS = b"#*$%&|<>~^_=+@{}[]\\", bytes(range(65, 91)), b"0123456789", b".,;:!?\"'()-"
TEXT_VIEW = ("words", "word_length", "symbols", "bars", "exclamations", "capitals", "digits", "marks", "distinct", "twins", "repeats", "lines_again", "short", "longest", "common")
META_VIEW = ("lang", "source", "chars", "lines", "line_length")
N_TEXT, N_META = len(TEXT_VIEW), len(META_VIEW)


def _share(part: float, whole: float) -> int:
    """Bin of a share: finer near zero."""
    return 0 if part <= 0 else min(BINS - 1, 1 + int(30 * (part / max(whole, 1)) ** 0.5))


def _scale(value: float) -> int:
    return min(BINS - 1, int(2 * np.log2(1 + value)))


def text_bins(text: str) -> list[int]:
    data = text.encode()
    words = data.split()
    n, size = len(words), len(data)
    less = lambda chars: size - len(data.translate(None, chars))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    lengths = list(map(len, words))
    return [
        _scale(n), min(BINS - 1, int(2 * sum(lengths) / max(n, 1))), _share(less(_SYMBOLS), size), _share(data.count(b"|"), n), _share(data.count(b"!"), n), _share(less(_CAPITALS), size),
        _share(less(_DIGITS), size), _share(less(_MARKS), size), _share(len(set(words)), n), _share(sum(map(bytes.__eq__, words, words[1:])), n), _share(repeated_words(words), n),
        _share(len(lines) - len(set(lines)), len(lines)), _share(sum(x <= 3 for x in lengths), n), min(BINS - 1, max(lengths, default=0)), _share(data.count(b" the ") + data.count(b" de ") + data.count(b" der "), n),
    ]


def meta_bins(lang: str | None, source: str | None, text: str) -> list[int]:
    name = lambda x: BINS - 1 if x is None else zlib.crc32(x.encode()) % (BINS - 1)
    lines = text.count("\n") + 1
    return [name(lang), name(source), _scale(len(text)), _scale(lines), _scale(len(text) / lines)]


def _binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins = []
        for text, lang, source in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            body = text.as_py() or ""
            bins.append(bytes([*text_bins(body), *meta_bins(lang, source, body)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins, pa.binary())], ["doc_id", "bins"])


class Views:
    """Log-odds tables of both views, and their calibration once there is one."""

    def __init__(self, counts: np.ndarray, prior: float):
        """counts: feature x bin x (bad, good)."""
        self.prior = prior
        smoothed = counts + 1.0
        shares = smoothed / smoothed.sum(axis=1, keepdims=True)
        self.odds = np.log(shares[:, :, 1]) - np.log(shares[:, :, 0])
        self.calibration: np.ndarray | None = None

    def raw(self, bins: np.ndarray) -> np.ndarray:
        """Rows x 2 log odds of the views. Features of a view depend on one another, so each view's sum is tempered."""
        each = self.odds[np.arange(N_TEXT + N_META), bins]
        base = np.log(self.prior / (1 - self.prior))
        return np.stack([base + each[:, :N_TEXT].sum(1) / 2, base + each[:, N_TEXT:].sum(1)], 1)

    def calibrated(self, bins: np.ndarray) -> np.ndarray:
        raw = self.raw(bins)
        if self.calibration is None:
            return raw
        return np.stack([np.interp(raw[:, v], _KNOTS, self.calibration[v]) for v in (0, 1)], 1)


_EDGES = np.linspace(-12, 12, 33)
_KNOTS = (_EDGES[:-1] + _EDGES[1:]) / 2


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, N_TEXT + N_META).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _tally(table: DataFrame, cells: int, of) -> np.ndarray:
    """Sum over all rows of of(bins, quality) -> cells numbers; one partial row a task and cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            quality = batch.column(1).to_pandas().to_numpy(float)
            if len(quality):
                total += of(_matrix(batch.column(0)), quality)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    out = np.zeros(cells)
    for row in table.select("bins", "quality").mapInArrow(run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most `cells` rows
        out[row["cell"]] = row["n"]
    return out


def _count(bins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Feature x bin sums of (bad, good) weights, flat. weights: rows x feature view (2) x 2."""
    out = np.zeros((N_TEXT + N_META, BINS, 2))
    for f in range(N_TEXT + N_META):
        for c in (0, 1):
            out[f, :, c] = np.bincount(bins[:, f], weights[:, int(f >= N_TEXT), c], BINS)
    return out.ravel()


def score(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, keep: float = KEEP, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, held_out, text_score, meta_score, score, predicted, kept."""
    ship(docs.sparkSession)
    names = {c.lower() for c in docs.columns}
    column = lambda c: F.col(c).cast("string") if c in names else F.lit(None).cast("string")
    bins = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), column("lang").alias("lang"), column("source").alias("source")).mapInArrow(_binned, "doc_id bigint, bins binary")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
    table = stable(bins.join(known, "doc_id", "left").withColumn("held_out", held).withColumn("quality", F.when(~F.col("held_out"), F.col("quality").cast("double"))), "quality-bins")
    views = _co_train(table, rounds)
    share = docs.sparkSession.sparkContext.broadcast(views)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = share.value
        base = np.log(v.prior / (1 - v.prior))
        for batch in batches:
            logits = v.calibrated(_matrix(batch.column(2)))
            parts = [_sigmoid(logits[:, 0]), _sigmoid(logits[:, 1]), _sigmoid(logits.sum(1) - base)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, parts)], ["doc_id", "held_out", "text_score", "meta_score", "score"])

    out = table.select("doc_id", "held_out", "bins").mapInArrow(run, "doc_id bigint, held_out boolean, text_score double, meta_score double, score double")
    return out.withColumns({"predicted": (F.col("score") >= keep).cast("int"), "kept": F.col("score") >= keep})


def _co_train(table: DataFrame, rounds: int) -> Views:
    n = (N_TEXT + N_META) * BINS * 2

    def labelled(bins: np.ndarray, quality: np.ndarray) -> np.ndarray:
        weights = np.stack([quality == 0, quality > 0], 1).astype(float)
        return np.append(_count(bins, np.repeat(weights[:, None, :], 2, 1)), weights.sum(0))

    counts = _tally(table, n + 2, labelled)
    bad, good = counts[n:]
    prior = (good + 0.5) / (good + bad + 1)
    fresh = lambda flat: Views(flat.reshape(N_TEXT + N_META, BINS, 2), prior)
    if not (bad and good):
        views = fresh(np.zeros(n))
        return views
    own = counts[:n]
    views = fresh(own)
    for _ in range(rounds):
        now = views

        def exchanged(bins: np.ndarray, quality: np.ndarray, now: Views = now) -> np.ndarray:
            certain = _sigmoid(now.raw(bins))
            free = np.isnan(quality)[:, None]
            verdict = np.stack([free & (certain <= 1 - CONFIDENT), free & (certain >= CONFIDENT)], 2).astype(float)
            return _count(bins, PSEUDO_WEIGHT * verdict[:, ::-1, :])  # each view learns from the other's

        views = fresh(own + _tally(table, n, exchanged))
    last = views

    def by_score(bins: np.ndarray, quality: np.ndarray) -> np.ndarray:
        raw, out = last.raw(bins), np.zeros((2, 2, len(_KNOTS)))
        for v in (0, 1):
            at = np.clip(np.searchsorted(_EDGES, raw[:, v]) - 1, 0, len(_KNOTS) - 1)
            for c in (0, 1):
                out[v, c] = np.bincount(at, (quality > 0 if c else quality == 0).astype(float), len(_KNOTS))
        return out.ravel()

    seen = _tally(table, 4 * len(_KNOTS), by_score).reshape(2, 2, len(_KNOTS))
    calibration = []
    for v in (0, 1):
        share = (seen[v, 1] + 4 * prior) / (seen[v].sum(0) + 4)
        share = _rising(share, seen[v].sum(0) + 1e-3)
        calibration.append(np.log(share / (1 - share)))
    views.calibration = np.array(calibration)
    return views


def _rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing values (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            a[0], a[1], a[2] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]
    return np.concatenate([np.full(int(c), v) for v, _, c in blocks])
