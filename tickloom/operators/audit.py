"""Vendor audits: a source's profile, fourteen checks and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.contracts import validate_contracts
from tickloom.operators.order import global_position

#: What a manifest may say.
ZONES = ("IST", "Asia/Kolkata", "UTC")
PRECISIONS = ("second", "millisecond", "microsecond")
OI_SEMANTICS = ("opening", "EOD", "intraday", "snapshot")
VOLUME_SEMANTICS = ("derived", "reported", "cumulative")
SURVIVORSHIP = ("full", "current_only", "known_gaps", "unknown")


def row_text(df: DataFrame) -> Column:
    """A row as text that any engine can write: its columns in the order of their names, joined by |, with ~ for null.

    Doubles have six decimals (or are nan), times are microseconds since the epoch, nested values JSON.
    """

    def text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.when(F.isnan(c), "nan").otherwise(c.try_cast("decimal(28,6)").cast("string"))
        elif kind.startswith("timestamp"):
            c = F.unix_micros(c.cast("timestamp")).cast("string")
        elif kind.startswith(("array", "map", "struct")):
            c = F.to_json(c)
        return F.coalesce(c.cast("string"), F.lit("~"))

    return F.concat_ws("|", *[text(n, k) for n, k in sorted(df.dtypes)])


def content_checksum(df: DataFrame) -> Column:
    """An aggregate that no order of rows changes: the sum of the first 48 bits of the md5 of each row_text, as text.

    Repeated rows count as often as they stand there, and tasks add up their own rows first.
    """
    bits = F.conv(F.substring(F.md5(row_text(df)), 1, 12), 16, 10).cast("decimal(28,0)")
    return F.coalesce(F.sum(bits), F.lit(0).cast("decimal(38,0)")).cast("string")


def source_profile(bars: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row: coverage, contracts, days, rows, and content_checksum."""
    day = F.col(time_col).cast("date")
    return bars.agg(
        F.min(day).alias("coverage_start"), F.max(day).alias("coverage_end"), F.count_distinct("security_id").alias("contract_count"),
        F.count_distinct(day).alias("day_count"), F.count("*").alias("row_count"), content_checksum(bars).alias("checksum"),
    )


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """One row: two hashes of the content that no order of rows or columns changes, content_checksum, and the number of rows."""
    h = F.xxhash64(*sorted(df.columns))
    return df.agg(F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("summed"), content_checksum(df).alias("checksum"), F.count("*").alias("rows"))


def _said(key: str, *allowed: str) -> Column:
    return F.try_element_at(F.col("metadata"), F.lit(key)).isin(*allowed)


def _manifest_checks() -> dict[str, Column]:
    """What each line of a manifest must say."""
    value = lambda key: F.try_element_at(F.col("metadata"), F.lit(key))
    zone = F.coalesce(value("timezone"), F.lit(""))
    rate = F.regexp_replace(value("missing_minute_rate"), "%", "").try_cast("double")
    return {
        "timestamp_timezone_precision": _said("timezone", *ZONES) & _said("timestamp_precision", *PRECISIONS),
        "strike_adjustment": _said("strike_adjustment", "true"),
        "oi_semantics": _said("oi_semantics", *OI_SEMANTICS),
        "volume_semantics": _said("volume_semantics", *VOLUME_SEMANTICS),
        "bid_ask_availability": _said("bid_ask_available", "true", "false"),
        "missing_minute_rate": rate.between(0, 100),
        "timezone_ambiguity": F.when(zone == "", False).when(zone.isin("IST", "Asia/Kolkata"), True).otherwise(value("dst_policy").isNotNull()),
        "corporate_action_handling": _said("corporate_actions", "true"),
        "late_correction_policy": _said("late_corrections", "true"),
        "survivorship_coverage": _said("survivorship", *SURVIVORSHIP),
    }


def manifest_lines(manifest: DataFrame) -> DataFrame:
    """Whether each line of a manifest passes each check that it alone decides."""
    return manifest.withColumns({name: F.coalesce(good, F.lit(False)) for name, good in _manifest_checks().items()})


#: The order in which a report lists its checks.
CHECKS = (
    "contract_identity_accuracy", "timestamp_timezone_precision", "expiry_mapping", "strike_adjustment", "oi_semantics", "volume_semantics", "bid_ask_availability",
    "missing_minute_rate", "duplicate_primary_keys", "unexplained_negative_volume", "timezone_ambiguity", "corporate_action_handling", "late_correction_policy",
    "survivorship_coverage",
)


def audit_source(bars: DataFrame, contracts: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row for each check: its name and whether the source passes; what cannot be told is a fail.

    Bars, contracts and manifest are aggregated once each; the three rows that are left are put side by side and stacked.
    All lines of the manifest and all contracts must pass; no bar may come twice or have a negative volume.
    """
    every = lambda good: F.coalesce(F.bool_and(F.coalesce(good, F.lit(False))), F.lit(False))
    said = manifest.agg(*[every(good).alias(name) for name, good in _manifest_checks().items()], F.min("coverage_start").alias("_first"))
    keys = bars.groupBy("security_id", "event_time").agg(F.count("*").alias("n"), F.count_if(F.col("volume") < 0).alias("negative"))
    found = keys.agg((F.count_if(F.col("n") > 1) == 0).alias("duplicate_primary_keys"), (F.coalesce(F.sum("negative"), F.lit(0)) == 0).alias("unexplained_negative_volume"))
    checked = validate_contracts(contracts)
    identity, first = every(F.col("is_valid")).alias("contract_identity_accuracy"), F.min("expiry_date").alias("_expiry")
    known = checked.agg(identity, first, every(F.col("expiry_date").isNotNull()).alias("_all_known"))
    whole = said.join(F.broadcast(found)).join(F.broadcast(known))  # one row each
    whole = whole.withColumn("expiry_mapping", F.coalesce(F.col("_all_known") & (F.col("_expiry") >= F.col("_first")), F.lit(False)))
    return whole.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("passed")) for n in CHECKS])))


def audit_verdict(report: DataFrame, source: str) -> DataFrame:
    """One row: passed checks, failures, the verdict by their number, and a line of text."""
    out = report.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))).alias("failures")
    )
    fails = F.col("checks") - F.col("passed")
    verdict = F.when(fails == 0, "APPROVED").when(fails <= 3, "LIMITED").when(fails <= 6, "QUARANTINED").otherwise("REJECTED")
    out = out.withColumns({"source": F.lit(source), "verdict": verdict})
    failed = F.when(fails > 0, F.concat(F.lit("; failed: "), F.array_join("failures", ", "))).otherwise("")
    text = F.concat("source", F.lit(": "), "verdict", F.lit(", "), F.col("passed").cast("string"), F.lit("/"), F.col("checks").cast("string"), failed)
    return out.withColumn("summary", text)


def sample_contracts(df: DataFrame, n: int = 100, key: str = "security_id") -> DataFrame:
    """Every (count // n)-th contract in the order of key, the first n of them; all if there are fewer than n."""
    placed = global_position(df, [key])
    step = F.greatest(F.floor(F.col("n_rows") / n), F.lit(1))
    return placed.filter((F.col("position") % step == 0) & (F.col("position") / step < n)).drop("position", "n_rows")
