"""The given tables as ticks, packets, instruments and histories, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.bars import build_bars
from tickloom.session import table

DAY = 86_400
#: The moment that late ticks are judged at, and the expiry of all contracts.
AS_OF = "2024-01-20 12:00:00"
EXPIRY = "2024-02-29 10:00:00"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("security_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        k.alias("volume"),
        F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1).otherwise(0).alias("trade_sign"),
        F.when(F.col("event_type") != "view", k * 10).alias("oi"),
        "event_type",
    )


TICKS_SQL = """
ticks AS (
    SELECT user_id AS security_id, ts AS event_time, event_id AS seq, value AS price,
        regexp_extract(props, '-?[0-9]+')::BIGINT AS volume,
        CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS trade_sign,
        CASE WHEN event_type <> 'view' THEN regexp_extract(props, '-?[0-9]+')::BIGINT * 10 END AS oi, event_type
    FROM events
)"""


def bars_sql(interval_s: int, source: str = "ticks", name: str = "bars") -> str:
    return f"""
{name} AS (
    SELECT security_id, make_timestamp(((epoch_us(event_time) // 1000000) // {interval_s}) * {interval_s} * 1000000) AS event_time,
        arg_min(price, (event_time, seq)) AS open, max(price) AS high, min(price) AS low,
        arg_max(price, (event_time, seq)) AS close, sum(volume)::BIGINT AS volume,
        sum(CASE WHEN trade_sign <> 0 THEN volume * trade_sign END)::BIGINT AS volume_delta,
        arg_min(oi, (event_time, seq)) FILTER (oi IS NOT NULL) AS oi_open, max(oi) AS oi_high, min(oi) AS oi_low,
        arg_max(oi, (event_time, seq)) FILTER (oi IS NOT NULL) AS oi_close, count(*) AS trade_count
    FROM {source} GROUP BY ALL
)"""


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bars(ticks(spark, sf_dir), DAY)


DAILY_SQL = TICKS_SQL + "," + bars_sql(DAY)


def naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a zone, as the SQL has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def checksum_sql(**columns: str) -> str:
    """audit.content_checksum in SQL. columns: the kind of each column, as far as its text differs from a plain cast."""

    def text(name: str, kind: str) -> str:
        value = {"double": f"CASE WHEN isnan({name}) THEN 'nan' ELSE CAST({name} AS DECIMAL(28,6))::VARCHAR END", "time": f"epoch_us({name})::VARCHAR"}.get(kind, f"{name}::VARCHAR")
        return f"coalesce({value}, '~')"

    whole = ", ".join(text(n, k) for n, k in sorted(columns.items()))
    return f"coalesce(sum(('0x' || substr(md5(concat_ws('|', {whole})), 1, 12))::BIGINT), 0)::VARCHAR"
