"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger stores the measurements and one bit per failed rule. Policies are
versioned sets of rules: a verdict is one bitwise AND, and ablations (what would a policy keep without one of its rules?)
come from counts per distinct bit pattern, of which there are at most 2 to the number of rules.

Defined results: null text has no words and fails `few_words`; whole texts are measured; rows with a null id and repeated rows
are measured like any other, one row each; other columns are left alone; an empty table gives an empty ledger.
Words are runs of characters other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.session import ship

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
WINDOW = 8
_SPACES, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"

#: Rules in bit order: name, and the condition under which a document fails. Integers only, so that any engine agrees.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 15 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("many_repeated_lines", "n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]
#: Versions are never changed, only added. In version 2 a share of repeated lines counts only with more than three of them: a
#: refrain or a heading said again is most of a text of few lines, and makes no junk of it.
POLICIES: dict[str, int] = {
    "base": BASE,
    "1": BASE | BITS["symbols"] | BITS["repeated_lines"] | BITS["short_words"] | BITS["long_words"],
    "1-lenient": BASE | BITS["symbols"],
    "2": BASE | BITS["symbols"] | BITS["many_repeated_lines"] | BITS["short_words"] | BITS["long_words"],
}


def measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - (len(data) - len(data.translate(None, _SPACES)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return n, chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more in this list."""
    n = len(words)
    if n <= window:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    count = n - window + 1
    rolled = np.zeros(count, np.uint64)
    for i in range(window):
        rolled = (rolled ^ hashes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    order = np.sort(rolled)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(rolled, twice)
    steps = np.zeros(n + 1, np.int64)
    steps[:count] += starts
    steps[window : window + count] -= starts
    return int((np.cumsum(steps)[:n] > 0).sum())


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last = batch.num_columns - 1
        found = np.array([measure(v.as_py() or "") for v in batch.column(last)], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays([*batch.columns[:last], *(pa.array(found[:, i]) for i in range(len(MEASURES)))], [*batch.schema.names[:last], *MEASURES])


def failures() -> Column:
    return sum((F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)) for name, condition in RULES), F.lit(0)).cast("bigint")


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, the measurements, failures (bits)."""
    ship(docs.sparkSession)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("__tm_text"))
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    return rows.mapInArrow(_measured, schema).withColumn("failures", failures())


def verdicts(book: DataFrame, policy: str = "2") -> DataFrame:
    """The ledger with base_failed and kept under a policy; no rule runs again."""
    mask = POLICIES[policy]
    return book.withColumns({"base_failed": F.col("failures").bitwiseAND(F.lit(BASE)) != 0, "kept": F.col("failures").bitwiseAND(F.lit(mask | BASE)) == 0})


def ablations(book: DataFrame, policy: str = "2") -> DataFrame:
    """Per rule of a policy: failed, only_failed (kept if this rule were left out), kept (under the whole policy)."""
    mask = POLICIES[policy]
    patterns = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("bigint").alias("bit")) for name, bit in BITS.items() if mask & bit])
    each = patterns.select("n", "bits", F.explode(rules).alias("r")).select("n", "bits", "r.*")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
    return each.groupBy("rule", "bit").agg(count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"), count(F.col("bits") == F.col("bit")).alias("only_failed"), count(F.col("bits") == 0).alias("kept"))


ORACLE = r"""
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
    i AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w),
    k AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i+7], ' ')) AS n FROM i),
    p AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM k WHERE n > 1) GROUP BY r),
    m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
          FROM w LEFT JOIN p USING (r)),
    f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                     + CASE WHEN 100 * n_symbols > 15 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                     + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
                     + CASE WHEN n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines THEN 64 ELSE 0 END)::BIGINT AS failures FROM m)
    SELECT *, failures & 3 <> 0 AS base_failed, failures & 119 = 0 AS kept FROM f"""
