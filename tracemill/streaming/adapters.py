"""Streams of traces: JSONL files as they arrive, row-local curation, and keep-first deduplication across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.text import strip
from tracemill.operators import dedup, redact, rules


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """raw of the JSONL lines under path, as files arrive."""
    return spark.readStream.format("text").option("pathGlobFilter", "*.jsonl").load(path).select(strip(F.col("value")).alias("raw")).where("raw <> ''")


def row_local(rows: DataFrame, text: str = "text", level: str = "lite", anonymize_level: str = "strict") -> DataFrame:
    """Shortened, then redacted text; the same plan for tables and streams."""
    return redact.redact(rows.withColumn(text, rules.compress(F.col(text), level)), text, anonymize_level)


class DedupSink:
    """foreachBatch sink: appends to out_path what is no near duplicate within the batch or of anything kept before.

    A batch that is written again after a failure replaces its own output, so each row counts once.
    """

    def __init__(self, out_path: str, max_similarity: float = 0.92, text: str = "text", idx: str = "doc_id"):
        self.out_path, self.max_similarity, self.text, self.idx = out_path, max_similarity, text, idx

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = f"{self.out_path}/batch={batch_id:012d}"
        try:
            before = spark.read.parquet(self.out_path).where(F.col("batch").cast("bigint") < batch_id).select(batch.columns)
        except Exception as e:  # nothing was kept yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            before = batch.limit(0)
        # kept rows come first, so they stay and new rows are held against them
        both = before.withColumn("__tm_new", F.lit(0)).unionByName(batch.withColumn("__tm_new", F.lit(1)))
        both = both.withColumn("__tm_order", F.struct("__tm_new", self.idx))
        kept = dedup.keep_first(both.select("__tm_order", self.text), self.max_similarity, self.text, "__tm_order")
        both.join(kept, "__tm_order", "left_semi").where("__tm_new = 1").drop("__tm_new", "__tm_order").write.mode("overwrite").parquet(mine)
