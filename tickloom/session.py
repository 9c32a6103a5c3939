"""Session settings, input tables and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tickloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that every test and bench run shares."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode, one of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    kept = spark.sparkContext.getCheckpointDir()
    if kept is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"tickloom-{uuid.uuid4().hex[:8]}"))
        kept = spark.sparkContext.getCheckpointDir()
    return kept.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends here and lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
