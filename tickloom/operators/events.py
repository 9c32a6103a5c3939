"""Feed events: identity, envelopes, routing, duplicates, and how ready contracts are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_id(df: DataFrame) -> DataFrame:
    """Fill an empty event_id with the sha256 of connection, message, offset and payload hash."""
    made = F.sha2(
        F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("connection_id", "message_id", "packet_offset", "payload_hash")]),
        256,
    )
    kept = F.col("event_id") if "event_id" in df.columns else F.lit(None).cast("string")
    return df.withColumn("event_id", F.coalesce(F.nullif(kept, F.lit("")), made))


def to_envelope(packets: DataFrame, received_ns: Column | None = None) -> DataFrame:
    """Add payload hash ('' without payload), receive time, exchange time in ns, and an id; a failed payload is not kept."""
    received = received_ns if received_ns is not None else F.unix_micros(F.current_timestamp()) * 1000
    ok = F.col("decode_status") == "success"
    df = packets.withColumns(
        {
            "payload_hash": F.when(F.col("raw_payload").isNull(), "").otherwise(F.sha2("raw_payload", 256)),
            "receive_ts_ns": F.coalesce(F.col("receive_ts_ns"), received) if "receive_ts_ns" in packets.columns else received,
            "exchange_ts_ns": F.col("last_trade_time").cast("long") * 1_000_000_000,
            "decoded_payload": F.when(ok, F.col("decoded_payload")),
        }
    )
    return event_id(df)


def route_by_status(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events to keep (decoded, with a payload) and events to quarantine (all others)."""
    ok = F.coalesce((F.col("decode_status") == "success") & F.col("decoded_payload").isNotNull(), F.lit(False))
    return events.filter(ok), events.filter(~ok)


def drop_duplicate_events(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["event_id"])


def dedup_against(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events that the history does not hold."""
    return events.join(history.select("event_id"), "event_id", "left_anti")


OUTCOMES = ("persisted", "quarantined", "queued", "spooled", "dropped")


def conservation_check(events: DataFrame) -> DataFrame:
    """One row: how many events had each outcome, and whether that is all of them."""
    counts = events.agg(F.count("*").alias("received"), *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
    return counts.withColumn("balanced", F.col("received") == sum((F.col(o) for o in OUTCOMES), F.lit(0)))


def ready_flags(packets: DataFrame) -> DataFrame:
    """valid_* flags of each packet, quote_ready and full_ready."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    df = packets.withColumns(
        {
            "valid_ltp": yes(F.col("ltp") > 0),
            "valid_time": yes(F.col("last_trade_time") > 0),
            "valid_volume": yes(F.col("last_trade_volume") > 0),
            "valid_spread": yes((F.col("bid") > 0) & (F.col("bid") <= F.col("ask"))),
            "valid_depth": yes(F.size("bids") >= 1),
        }
    )
    df = df.withColumn("quote_ready", F.col("valid_ltp") & F.col("valid_time"))
    return df.withColumn("full_ready", F.col("quote_ready") & F.col("valid_spread") & F.col("valid_depth"))


def latest_flags(packets: DataFrame) -> DataFrame:
    """For each contract: the flags of its latest packet, first and last time, packets."""
    flags = ["quote_ready", "full_ready"]
    order = F.struct("ts", "seq")
    return ready_flags(packets).groupBy("contract_id").agg(
        *[F.max_by(f, order).alias(f) for f in flags],
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("packet_count"),
    )


def readiness_level(latest: DataFrame, contracts: DataFrame, flag: str = "quote_ready", strict: bool = False, min_ratio: float = 0.9) -> DataFrame:
    """One row: wanted contracts, ready ones, and whether that is enough. Strict: all; no contract at all is enough."""
    joined = contracts.select("contract_id").join(latest, "contract_id", "left")
    counts = joined.agg(F.count("*").alias("contracts"), F.count_if(F.coalesce(flag, F.lit(False))).alias("ready"))
    enough = F.col("ready") == F.col("contracts") if strict else F.col("ready") >= min_ratio * F.col("contracts")
    return counts.withColumn("enough", enough)


def contract_pair_ready(latest: DataFrame, legs: DataFrame, flag: str = "quote_ready") -> DataFrame:
    """For each (underlying, strike): whether it has both a CE and a PE leg and all its legs are ready."""
    joined = legs.join(latest.select("contract_id", flag), "contract_id", "left")
    return joined.groupBy("underlying", "strike").agg(
        ((F.count_distinct("option_type") == 2) & F.bool_and(F.coalesce(flag, F.lit(False)))).alias("pair_ready")
    )


def warm_recent(latest: DataFrame, now: Column, n: int = 3, max_age_s: int = 5) -> DataFrame:
    """Contracts with n packets or more, and whether the last one is at most max_age_s old."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros("last_ts")
    return latest.filter(F.col("packet_count") >= n).withColumn("recent", age <= max_age_s * 1_000_000)


def unregistered_packets(packets: DataFrame, contracts: DataFrame) -> DataFrame:
    """Packets for each contract that was never registered."""
    return packets.join(contracts.select("contract_id"), "contract_id", "left_anti").groupBy("contract_id").agg(F.count("*").alias("packets"))


def drop_stale_generation(packets: DataFrame, generations: DataFrame) -> DataFrame:
    """Packets of the current generation of their contract's underlying."""
    return packets.join(generations, ["underlying", "generation"], "left_semi")


def countable_packets(packets: DataFrame, desired: DataFrame) -> DataFrame:
    """Packets with an id and a code, without an error, of a desired security."""
    good = F.col("security_id").isNotNull() & F.col("response_code").isNotNull() & F.col("error").isNull()
    return packets.filter(good).join(desired.select("security_id"), "security_id", "left_semi")


def label_contracts(packets: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add contract_id by security_id; 'c<id>' where none is known. Spark broadcasts contracts if they are small."""
    named = packets.join(contracts.select("security_id", "contract_id"), "security_id", "left")
    return named.withColumn("contract_id", F.coalesce("contract_id", F.concat(F.lit("c"), F.col("security_id").cast("string"))))
