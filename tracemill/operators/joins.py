"""Joins that a large group can't unbalance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.session import parallelism, stable

HOT_SHARE = 200
#: No group of a table of so many rows is too large for a task.
EVEN = 100_000


def salted_left_join(rows: DataFrame, keys: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """rows left join keys on key, where keys has one row a key and weight says how many rows have it.

    Keys of over 1/HOT_SHARE of all rows (so fewer than HOT_SHARE; these alone are broadcast) are spread over salts. total is
    the number of rows; of EVEN or fewer none is hot.
    """
    if total <= EVEN:
        return rows.join(keys.drop(weight), key, "left")
    hot = keys.where(F.col(weight) * HOT_SHARE > total).select(F.col(key).alias("__tm_hot"))
    salts = max(2, parallelism(rows.sparkSession) // 2)
    mark = lambda df, salt: df.join(F.broadcast(hot), F.col(key) == F.col("__tm_hot"), "left").withColumn("__tm_salt", salt).drop("__tm_hot")
    is_hot = F.col("__tm_hot").isNotNull()
    left = mark(rows, F.when(is_hot, F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")).otherwise(0))
    right = mark(keys.drop(weight), F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "__tm_salt"], "left").drop("__tm_salt")


def spread_join(rows: DataFrame, others: DataFrame, key: str, by: str, size: str = "size", most: int = 5_000) -> DataFrame:
    """rows join others on key, where both have the number of rows that the key has: these are spread over salts, most to each.

    by is the column of rows that salts are taken from. size is not in the result.
    """
    split = (F.col(size) / most).cast("int")
    left = rows.withColumn("__tm_salt", F.pmod(F.xxhash64(by), split + 1).cast("int")).drop(size)
    right = others.withColumn("__tm_salt", F.explode(F.sequence(F.lit(0), split))).drop(size)
    return left.join(right, [key, "__tm_salt"]).drop("__tm_salt")


def bits_for(keys: int) -> int:
    """Bits of a bitmap that tells so many keys apart: 16 a key, 64 MB at most, so its broadcast is bounded."""
    return 1 << min(29, max(20, (16 * keys).bit_length()))


def spotted(rows: DataFrame, spot: Column, keys: DataFrame, place: Column) -> DataFrame:
    """rows with __tm_known: false only where spot (from 0) is no place of keys."""
    bitmap = keys.select(place.alias("__tm_place")).groupBy(F.bitmap_bucket_number(F.col("__tm_place") + 1).alias("__tm_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("__tm_place") + 1)).alias("__tm_bits"))  # at most 16,384 rows of 4 KB
    marked = rows.withColumn("__tm_spot", spot).withColumn("__tm_bucket", F.bitmap_bucket_number(F.col("__tm_spot") + 1)).join(F.broadcast(bitmap), "__tm_bucket", "left")
    bit = F.expr("shiftright(cast(conv(hex(substring(__tm_bits, cast(__tm_spot % 32768 div 8 as int) + 1, 1)), 16, 10) as int), cast(__tm_spot % 8 as int)) & 1")
    return marked.withColumn("__tm_known", F.coalesce(bit == 1, F.lit(False))).drop("__tm_bits", "__tm_spot", "__tm_bucket")


def narrowed(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows left semi join keys on key; what a bitmap of keys doesn't know is left out before the shuffle."""
    keys = stable(keys.select(key), "narrowed")
    spot = F.pmod(F.xxhash64(key), F.lit(bits_for(keys.count())))
    return spotted(rows, spot, keys, spot).where("__tm_known").drop("__tm_known").join(keys, key, "left_semi").select(*rows.columns)


def without(docs: DataFrame, doc_id: str, mark, verdict: DataFrame) -> DataFrame:
    """docs, all columns, without what verdict (doc_id, mark, kept) refuses; verdict may leave out rows that stay anyway.

    mark is a column of docs that tells apart rows with one id. Of rows that agree in both, one stays if any is kept.
    Rows are first held against a bitmap of the refused keys (16 bits a key, 64 MB at most, so its broadcast is bounded): what
    it doesn't know stays where it is, and only the rest, the refused rows and a few others, is shuffled for the exact join.
    With more refused keys than the bitmap can tell apart, more rows go that way; the result is the same.
    """
    gone = verdict.groupBy("doc_id", "mark").agg(F.max("kept").alias("__tm_some"), F.count(F.lit(1)).alias("__tm_n")).where("not __tm_some or __tm_n > 1")
    gone = stable(gone.select(F.col("doc_id").alias("__tm_id"), F.col("mark").alias("__tm_mark"), "__tm_some"), "refused")
    bits = 1 << min(29, max(20, (16 * gone.count()).bit_length()))
    spot = lambda *c: F.pmod(F.xxhash64(*c), F.lit(bits))
    place = spot("__tm_id", "__tm_mark") + 1
    bitmap = gone.groupBy(F.bitmap_bucket_number(place).alias("__tm_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__tm_bits"))  # at most 16,384 rows of 4 KB
    keyed = docs.withColumns({"__tm_i": F.col(f"`{doc_id}`").cast("bigint"), "__tm_m": mark}).withColumn("__tm_spot", spot("__tm_i", "__tm_m"))
    marked = keyed.withColumn("__tm_bucket", F.bitmap_bucket_number(F.col("__tm_spot") + 1)).join(F.broadcast(bitmap), "__tm_bucket", "left")
    bit = F.expr("shiftright(cast(conv(hex(substring(__tm_bits, cast(__tm_spot % 32768 div 8 as int) + 1, 1)), 16, 10) as int), cast(__tm_spot % 8 as int)) & 1")
    known = F.coalesce(bit == 1, F.lit(False))
    same = F.col("__tm_i").eqNullSafe(F.col("__tm_id")) & F.col("__tm_m").eqNullSafe(F.col("__tm_mark"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    asked = marked.where(known).drop("__tm_bits")
    out = marked.where(~known).select(*columns).union(asked.join(gone, same, "left_anti").select(*columns))
    again = gone.where("__tm_some")
    if again.isEmpty():
        return out
    one = asked.join(again, same, "left_semi").groupBy("__tm_i", "__tm_m").agg(F.first(F.struct(*columns)).alias("__tm_row"))
    return out.unionByName(one.select(*[F.col("__tm_row").getField(c).alias(c) for c in docs.columns]))
