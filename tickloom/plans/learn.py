"""Registered queries that train on features of daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import training as T
from tickloom.operators import validation as V
from tickloom.plans.checks import labelled
from tickloom.session import written

QUERIES, ORACLES = {}, {}
FEATURES = ["returns", "range", "atr", "vwap", "rsi", "oi_change"]


def rows(spark, sf_dir) -> DataFrame:
    """Complete rows of features with labels; an event lasts a day."""
    df = labelled(spark, sf_dir).dropna(subset=["returns", "rsi", "atr"])
    return df.select(
        F.xxhash64("security_id", "event_time").alias("row_id"), "security_id", "event_time", F.col("event_time").alias("prediction_time"),
        (F.col("event_time") + F.make_dt_interval(days=F.lit(1))).alias("evaluation_time"), F.col("label").cast("double").alias("label"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES],
    )


def negative_controls(spark, sf_dir) -> DataFrame:
    return T.negative_controls(rows(spark, sf_dir), FEATURES)


def guarded_train(spark, sf_dir) -> DataFrame:
    split = V.chrono_split(rows(spark, sf_dir)).withColumn("dataset_id", F.concat(F.lit("daily-"), F.col("role")))
    split = written(split, "split")
    return T.guarded_train(split, FEATURES, controls=T.negative_controls(split, FEATURES))[1]


QUERIES |= {"negative_controls": negative_controls, "guarded_train": guarded_train}
