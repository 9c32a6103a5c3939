"""Reading and writing the library's tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import micros, utc_date
from tickloom.operators.audit import content_checksum
from tickloom.sources import schemas

#: Columns of a vendor's instrument file and what they are called here.
MASTER_COLUMNS = {
    "SECURITY_ID": "security_id", "SYMBOL_NAME": "symbol", "EXCH_ID": "exchange", "SEGMENT": "segment", "INSTRUMENT": "instrument_type",
    "SM_EXPIRY_DATE": "expiry_date", "STRIKE_PRICE": "strike_price", "OPTION_TYPE": "option_type", "LOT_SIZE": "lot_size", "TICK_SIZE": "tick_size",
    "UNDERLYING_SECURITY_ID": "underlying_security_id", "ISIN": "isin",
}
NUMBERS = {"strike_price": "double", "tick_size": "double", "lot_size": "int", "underlying_security_id": "bigint"}


def write_bronze(events: DataFrame, path: str) -> None:
    """Append decoded events as ticks, a folder for each UTC date of capture. The payload's security id wins over the envelope's."""
    p = lambda c: F.col(f"decoded.{c}")
    ticks = events.select(
        "event_id",
        F.coalesce(p("security_id"), F.col("security_id")).cast("int").alias("security_id"),
        F.coalesce(p("packet_type"), F.lit("ticker")).alias("mode"),
        p("ltp").cast("double").alias("ltp"),
        F.element_at(p("depth"), 1)["bid"].cast("double").alias("bid"),
        F.element_at(p("depth"), 1)["ask"].cast("double").alias("ask"),
        p("oi").cast("bigint").alias("oi"),
        (p("ltp") - p("prev_close")).cast("double").alias("change"),
        p("last_trade_time").cast("bigint").alias("last_trade_time"),
        p("last_trade_qty").cast("bigint").alias("last_trade_volume"),
        *[p(f"day_{c}").cast("double").alias(c) for c in ("open", "high", "low", "close")],
        p("total_buy_qty").cast("bigint").alias("total_bid_qty"),
        p("total_sell_qty").cast("bigint").alias("total_ask_qty"),
        F.col("receive_ts_ns").alias("capture_timestamp_ns"),
        "connection_id",
    )
    ticks.withColumn("dt", utc_date(F.col("capture_timestamp_ns"))).write.mode("append").partitionBy("dt").parquet(path)


def read_bronze(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Ticks of some dates (all, if None): only their folders are read."""
    df = spark.read.schema(schemas.BRONZE_TICKS + ", dt DATE").parquet(path)
    return df if dates is None else df.filter(F.col("dt").isin([F.lit(d).cast("date") for d in dates]))


def bronze_to_ticks(bronze: DataFrame) -> DataFrame:
    """Ticks that bars are built from: capture time, price, volume (missing: 0), open interest."""
    return bronze.select(
        F.col("security_id").cast("bigint").alias("security_id"),
        micros(F.col("capture_timestamp_ns")).alias("event_time"),
        F.col("capture_timestamp_ns").alias("seq"),
        F.nanvl("ltp", F.lit(None).cast("double")).alias("price"),
        F.coalesce("last_trade_volume", F.lit(0)).alias("volume"),
        F.lit(0).alias("trade_sign"),
        "oi",
    )


def write_quarantine(events: DataFrame, path: str) -> None:
    """Append failed events with their payload as hexadecimal text, a folder for each UTC date of receipt."""
    rows = events.select(
        "event_id", "connection_id", "websocket_message_id", "packet_offset", "receive_ts_ns", "security_id", "payload_hash", "decoder_version", "decode_status",
        F.lower(F.hex("raw_payload")).alias("raw_payload_hex"), F.current_timestamp().cast("string").alias("written_at"),
    )
    rows.withColumn("dt", utc_date(F.col("receive_ts_ns"))).write.mode("append").partitionBy("dt").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.QUARANTINE + ", dt DATE").parquet(path)


def read_instrument_master(spark: SparkSession, path: str) -> DataFrame:
    """A vendor's instrument file (CSV with a header): known columns renamed, others in lower snake case, numbers that are
    none become 0, missing required columns are empty, a missing exchange or source is NSE."""
    raw = spark.read.csv(path, header=True)
    snake = lambda c: "_".join(c.strip().lower().replace("-", " ").split())
    df = raw.toDF(*[MASTER_COLUMNS.get(c.strip().upper(), snake(c)) for c in raw.columns])
    for c in MASTER_COLUMNS.values():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    for c, kind in NUMBERS.items():
        df = df.withColumn(c, F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).cast(kind))
    for c in ("exchange", "source"):
        known = F.nullif(F.col(c), F.lit("")) if c in df.columns else F.lit(None).cast("string")
        df = df.withColumn(c, F.coalesce(known, F.lit("NSE")))
    return df.withColumn("security_id", F.col("security_id").try_cast("bigint"))


def read_member_list(spark: SparkSession, path: str) -> DataFrame:
    """A list of index members (CSV): header in upper snake case without a byte-order mark, symbols trimmed and upper case."""
    raw = spark.read.csv(path, header=True)
    df = raw.toDF(*["_".join(c.lstrip("﻿").strip().upper().split()) for c in raw.columns])
    return df.withColumn("SYMBOL", F.upper(F.trim("SYMBOL")))


def read_vendor_range(bars: DataFrame, contracts: DataFrame, start: Column, end: Column) -> DataFrame:
    """Bars of some contracts between two dates, both included."""
    return bars.filter(F.col("event_time").cast("date").between(start, end)).join(contracts.select("security_id"), "security_id", "left_semi")


def append_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def save_universe_snapshot(snapshot: DataFrame, path: str) -> None:
    """Save the one row of a snapshot unless its id is there already; lists and maps are stored as JSON.

    The row goes to a folder of this attempt, then a file named by the id is made to say which attempt counts. There is one
    such file for each id and it is made once, so of writers that save one snapshot at the same time one row is left, and
    what a failed one leaves is not read.
    """
    spark = snapshot.sparkSession
    nested = [c for c, t in snapshot.dtypes if t.startswith(("array", "map"))]
    flat = snapshot.withColumns({c: F.to_json(c) for c in nested}).withColumn("created_at", F.current_timestamp())
    attempt = uuid.uuid4().hex
    flat.withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("attempt").parquet(f"{path}/rows")
    for row in spark.read.parquet(f"{path}/rows/attempt={attempt}").select("universe_snapshot_id").distinct().collect():
        _made_once(spark, f"{path}/commits/{row[0]}", attempt)


def _made_once(spark: SparkSession, file: str, text: str) -> bool:
    """Make a file, unless it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(file)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def universe_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All saved snapshots with their lists and maps, one row for each id."""
    counts = spark.read.text(f"{path}/commits").select(F.col("value").alias("attempt"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("universe_snapshot_id"))
    kinds = {"eligible": "array<string>", "contracts": "array<string>", "expiry_dates": "map<string,string>", "atm_strikes": "map<string,double>"}
    rows = spark.read.parquet(f"{path}/rows").withColumn("attempt", F.col("attempt").cast("string"))
    return rows.join(counts, ["attempt", "universe_snapshot_id"], "left_semi").drop("attempt").withColumns({c: F.from_json(c, t) for c, t in kinds.items()})


def latest_universe_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot with its lists and maps."""
    return universe_snapshots(spark, path).orderBy(F.desc("created_at"), "universe_snapshot_id").limit(1)


def write_silver(flagged: DataFrame, path: str) -> None:
    """Write ticks with the marks of research.silver_flags: valid ones to one folder in the order of event_time, security_id
    and seq, invalid ones to another, in the same pass; and an index of the valid files.

    Ranges of that order are written by one task each and sorted inside, so a file holds a span of time, which the index
    names (file, low, high, n_rows), and readers of a span open its files alone.
    """
    order = ["event_time", "security_id", "seq"]
    sink = F.when(F.col("is_invalid"), "quarantine").otherwise("silver")
    rows = flagged.withColumn("sink", sink).repartitionByRange(*order).sortWithinPartitions("sink", *order)
    rows.write.partitionBy("sink").parquet(f"{path}/rows")
    files = _silver(flagged.sparkSession, path, flagged.schema, "silver").groupBy(F.col("_metadata.file_path").alias("file"))
    files.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high"), F.count("*").alias("n_rows")).coalesce(1).write.parquet(f"{path}/index")


def _silver(spark: SparkSession, path: str, schema, sink: str) -> DataFrame:
    """Rows of one sink; none if nothing went there."""
    return spark.read.schema(schema.add("sink", "string") if "sink" not in schema.names else schema).parquet(f"{path}/rows").filter(F.col("sink") == sink)


def silver_files(spark: SparkSession, path: str, low: Column, high: Column) -> list[str]:
    """Files that can hold ticks from low to high."""
    index = spark.read.schema("file string, low timestamp, high timestamp, n_rows long").parquet(f"{path}/index")
    return sorted(r["file"] for r in index.filter((F.col("high") >= low) & (F.col("low") <= high)).select("file").collect())


def read_silver(spark: SparkSession, path: str, low: Column, high: Column) -> DataFrame:
    """Valid ticks from low to high, both included; files of other times are not opened."""
    whole = spark.read.parquet(f"{path}/rows").drop("sink")
    files = silver_files(spark, path, low, high)
    some = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    return some.filter(F.col("event_time").between(low, high))


def read_silver_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").filter("sink = 'quarantine'").drop("sink")


def snapshot_log_row(df: DataFrame, date: Column, status: str = "loaded") -> DataFrame:
    """One row for the log of loads: rows and content_checksum."""
    return df.agg(F.count("*").alias("row_count"), content_checksum(df).alias("checksum")).select(
        date.alias("snapshot_date"), F.current_timestamp().alias("loaded_at"), "row_count", "checksum", F.lit(status).alias("status")
    )


#: Fields of an exchange's daily file of derivatives, and what they are called and typed here.
DAILY_FIELDS = {
    "INSTRUMENT": ("instrument_type", "string"), "SYMBOL": ("symbol", "string"), "EXPIRY": ("expiry_date", "date"), "STRIKE": ("strike_price", "double"),
    "OPTION_TYPE": ("option_type", "string"), "OPEN": ("open", "double"), "HIGH": ("high", "double"), "LOW": ("low", "double"), "CLOSE": ("close", "double"),
    "SETTLE_PR": ("settle_price", "double"), "CONTRACTS": ("contracts", "bigint"), "VAL_INLAKH": ("value_lakh", "double"), "OPEN_INT": ("oi", "bigint"),
    "CHG_IN_OI": ("oi_change", "bigint"),
}


def read_daily_derivatives(spark: SparkSession, path: str) -> DataFrame:
    """Options of an exchange's daily files (CSV with a header, 14 fields in any order): index and stock options only.

    Expiry is like 29-Feb-2024. A value that does not parse is null; a field that a file lacks raises.
    """
    raw = spark.read.csv(path, header=True)
    raw = raw.toDF(*[c.strip().upper() for c in raw.columns])

    def typed(field: str, kind: str) -> Column:
        text = F.trim(field)
        return F.to_date(F.try_to_timestamp(text, F.lit("dd-MMM-yyyy"))) if kind == "date" else text.try_cast(kind)

    return raw.select(*[typed(f, kind).alias(name) for f, (name, kind) in DAILY_FIELDS.items()]).filter(F.col("instrument_type").isin("OPTIDX", "OPTSTK"))
