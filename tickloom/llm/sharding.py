"""Contiguous shards of near equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import written


def range_id(key: Column, bounds: list) -> Column:
    """How many of the sorted bounds are <= key, as a balanced tree of comparisons (null: 0)."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds))


def splitters(df: DataFrame, key: str, n: int) -> list:
    """At most n - 1 distinct values of key that cut df into ranges of about equal row counts.

    The sketch sees every row; its size is set by n alone.
    """
    if n < 2:
        return []
    found = df.select(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def byte_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut documents, in the order of their ids, into n_shards contiguous shards of near equal bytes.

    A document's size is the UTF-8 bytes of its text plus 8. Ids are dealt into ranges by sampled splitters, each range
    gives one total, the running sum of those totals gives the bytes before each range, and a running sum inside the
    range gives the bytes before each document. A document belongs to the shard that holds the middle of its bytes, so
    shard k ends within half a document of (k + 1) / n_shards of all bytes. No row leaves its range: only one total
    for each range is ordered globally, and texts are never shuffled.

    Null text: size 8, crc32 0. Null ids come first; rows with equal ids stand in the order of crc32 and size, and
    equal rows each keep a slot of their own. Extra columns are ignored. An empty table gives no rows. Shards can be
    empty if there are fewer documents than shards or one document is larger than a shard.

    Returns id_col, size, text_crc32, law ("bytes"), shard, slot, grown_shard (null).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    slim = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("crc"),
        ),
        "shard-sizes",
    )
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = slim.withColumn("range", range_id(F.col("id"), splitters(slim, "id", n_ranges)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = slim.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # one row for each range, at most n_ranges of them: small enough to order in one task and to broadcast
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "crc", "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        slim.select("*", F.sum("size").over(running).alias("upto"), F.row_number().over(inside).alias("nth"))
        .join(F.broadcast(offsets), "range")
        .select(
            "id",
            "size",
            "crc",
            (F.col("rows_before") + F.col("nth") - 1).alias("position"),
            F.expr(
                f"cast(least({n_shards - 1}, ((2 * (bytes_before + upto) - size) * {n_shards}) div (2 * all_bytes)) as int)"
            ).alias("shard"),
        )
    )
    # at most n_shards rows
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
