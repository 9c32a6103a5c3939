"""Global positions without a window over one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import written


def global_position(df: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """Add the position of each row (from 0) in the order of keys, which must tell rows apart, and n_rows, their number.

    Rows are range-partitioned by keys and written once, so that both counts and numbering see the same ranges; each range
    counts its rows, and the running sum of those few counts gives each range its first position.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = placed.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"), F.sum("_n").over(whole).alias("n_rows")
    )  # one row for each range
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    return placed.join(F.broadcast(firsts), "_range").withColumn(name, F.col("_first") + nth).drop("_range", "_first")
