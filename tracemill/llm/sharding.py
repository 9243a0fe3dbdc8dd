"""Contiguous shards of equal bytes from a global prefix sum.

Rows are put in order of (id, crc32, size) by a range shuffle of these three numbers alone. Each partition's total is
collected (one row per partition), the driver turns totals into offsets, and every partition adds its own running sum. A
document goes to the shard in which the middle of its byte range falls, so every cut is within half a document of its target.

Law: `bytes`. Defined results: null text has no bytes but keeps the fixed 16; null ids come first; rows that agree in all
three numbers are interchangeable, carried as one row with a count and expanded at the end. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import parallelism, shared_dir, ship

OVERHEAD = 16
_RUN = 65_536
_OUT = "doc_id bigint, size bigint, text_crc32 bigint, copies bigint, first_row bigint, first_byte bigint"


def _running(offsets: dict[int, tuple[int, int]]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sizes = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            doc, size, crc, n, part = batch.columns
            if rows is None:
                sizes, rows = offsets[part[0].as_py()]
            size_, n_ = size.to_numpy(), n.to_numpy()
            row_end, byte_end = rows + np.cumsum(n_), sizes + np.cumsum(size_ * n_)
            out = [doc, size, crc, n, pa.array(row_end - n_), pa.array(byte_end - size_ * n_)]
            rows, sizes = int(row_end[-1]), int(byte_end[-1])
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "size", "text_crc32", "copies", "first_row", "first_byte"])

    return add


def shards(docs: DataFrame, n_shards: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null), row, byte (global positions)."""
    spark = docs.sparkSession
    ship(spark)
    shared_dir(spark)
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    ordered = rows.repartitionByRange(parallelism(spark), "doc_id", "text_crc32", "size").sortWithinPartitions("doc_id", "text_crc32", "size")
    ordered = ordered.withColumn("part", F.spark_partition_id()).checkpoint()  # the range bounds are sampled: fixed from here on
    totals = {r["part"]: (r["b"], r["n"], r["m"]) for r in ordered.groupBy("part").agg(F.sum(F.col("size") * F.col("copies")).alias("b"), F.sum("copies").alias("n"), F.max("copies").alias("m")).collect()}
    offsets, total_bytes, total_rows = {}, 0, 0
    for part in sorted(totals):
        offsets[part] = (total_bytes, total_rows)
        total_bytes, total_rows = total_bytes + totals[part][0], total_rows + totals[part][1]
    placed = ordered.mapInArrow(_running(offsets), _OUT)
    if any(most > 1 for _, _, most in totals.values()):
        runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(_RUN).cast("bigint"))))
        runs = runs.repartition(parallelism(spark), "first_row", "run")
        placed = runs.withColumn("nth", F.explode(F.sequence("run", F.least(F.col("copies") - 1, F.col("run") + _RUN - 1))))
        placed = placed.withColumns({"first_row": F.col("first_row") + F.col("nth"), "first_byte": F.col("first_byte") + F.col("nth") * F.col("size")})
    middle = F.expr(f"(2 * first_byte + size) * {int(n_shards)} div {max(1, 2 * total_bytes)}L")
    placed = placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), middle.cast("int").alias("shard"), F.col("first_row").alias("row"), F.col("first_byte").alias("byte"))
    starts = placed.groupBy("shard").agg(F.min("row").alias("shard_row"))  # n_shards rows
    return placed.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "law", "shard", (F.col("row") - F.col("shard_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row", "byte")
