"""Instrument master: normalisation, checksums, slowly changing history, and its quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.scalars import parse_expiry

#: Instrument types that have an expiry, and those that have a strike.
DERIVATIVES = ("FUTSTK", "FUTIDX", "OPTSTK", "OPTIDX", "OPTFUT", "FUTCUR", "OPTCUR", "FUTCOM")
OPTIONS = ("OPTSTK", "OPTIDX", "OPTFUT", "OPTCUR")


def normalize_instruments(df: DataFrame) -> DataFrame:
    """Parse expiry_date; no expiry without a derivative, no strike (0) or option type without an option; names in capitals."""
    kind = F.col("instrument_type")
    tidy = {c: F.upper(F.trim(c)) for c in ("symbol", "nse_symbol", "exchange") if c in df.columns}
    expiry = F.col("expiry_date").cast("date") if dict(df.dtypes)["expiry_date"] != "string" else parse_expiry(F.col("expiry_date"))
    return df.withColumns(
        {
            **tidy,
            "expiry_date": F.when(kind.isin(*DERIVATIVES), expiry),
            "strike_price": F.when(kind.isin(*OPTIONS), F.coalesce("strike_price", F.lit(0.0))).otherwise(F.lit(0.0)),
            "option_type": F.when(kind.isin(*OPTIONS), F.col("option_type")),
        }
    )


CHECKED = ("security_id", "symbol", "exchange", "instrument_type", "expiry_date", "strike_price", "option_type")
DIFFED = (*CHECKED, "lot_size", "tick_size", "segment", "isin", "underlying_security_id")


def row_checksum(df: DataFrame, columns: tuple[str, ...] = CHECKED, name: str = "checksum") -> DataFrame:
    """md5 of the columns as text joined by |; null counts as an empty text. Numbers with fractions have four decimals."""
    kinds = dict(df.dtypes)
    text = lambda c: F.col(c).cast("decimal(28,4)").cast("string") if kinds[c] in ("double", "float") else F.col(c).cast("string")
    return df.withColumn(name, F.md5(F.concat_ws("|", *[F.coalesce(text(c), F.lit("")) for c in columns])))


def valid_at(df: DataFrame, date: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows whose dates hold date, both ends included; a null end is open."""
    return df.filter((F.col(start) <= date) & (F.col(end).isNull() | (F.col(end) >= date)))


def latest_valid_at(df: DataFrame, date: Column, keys: tuple[str, ...] = ("security_id",)) -> DataFrame:
    """Of the versions valid at date, the one that began last."""
    order = Window.partitionBy(*keys).orderBy(F.desc("valid_from"))
    return valid_at(df, date).withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def listed_options(df: DataFrame, date: Column) -> DataFrame:
    """Distinct positive strikes of the options valid at date, by symbol and expiry."""
    listed = valid_at(df, date).filter(F.col("instrument_type").isin(*OPTIONS) & (F.col("strike_price") > 0))
    return listed.select("symbol", "expiry_date", F.col("strike_price").alias("strike")).distinct()


def strike_interval(df: DataFrame) -> DataFrame:
    """For each (symbol, expiry) of options: the most frequent gap of its sorted strikes, the least if several are; a
    single strike gives 10."""
    strikes = df.filter(F.col("instrument_type").isin(*OPTIONS) & (F.col("strike_price") > 0)).select("symbol", "expiry_date", "strike_price").distinct()
    order = Window.partitionBy("symbol", "expiry_date").orderBy("strike_price")
    gaps = strikes.withColumn("gap", F.round(F.lead("strike_price").over(order) - F.col("strike_price"), 2))
    counts = gaps.groupBy("symbol", "expiry_date", "gap").agg(F.count("*").alias("n"))
    best = F.max_by("gap", F.when(F.col("gap").isNotNull(), F.struct(F.col("n"), (-F.col("gap")).alias("g"))))
    return counts.groupBy("symbol", "expiry_date").agg(F.coalesce(best, F.lit(10.0)).alias("strike_interval"))


def with_strike_interval(df: DataFrame) -> DataFrame:
    """df with strike_interval: that of an option's symbol and expiry, 0 for what is no option or has no known strike beside it."""
    found = df.join(strike_interval(df), ["symbol", "expiry_date"], "left")
    return found.withColumn("strike_interval", F.when(F.col("instrument_type").isin(*OPTIONS), F.coalesce("strike_interval", F.lit(0.0))).otherwise(F.lit(0.0)))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "security_id") -> DataFrame:
    """Keys that were added, removed or updated, by a checksum of DIFFED columns that both tables have."""
    columns = tuple(c for c in DIFFED if c in old.columns and c in new.columns)
    a = row_checksum(old, columns, "old_sum").select(key, "old_sum")
    b = row_checksum(new, columns, "new_sum").select(key, "new_sum")
    change = (
        F.when(F.col("old_sum").isNull(), "added").when(F.col("new_sum").isNull(), "removed").when(F.col("old_sum") != F.col("new_sum"), "updated").otherwise("unchanged")
    )
    return a.join(b, key, "full").select(key, change.alias("change"))


def import_summary(diff: DataFrame) -> DataFrame:
    """One row: incoming, inserted, updated, removed and unchanged keys."""
    n = {c: F.count_if(F.col("change") == c) for c in ("added", "updated", "removed", "unchanged")}
    return diff.agg(
        F.count_if(F.col("change") != "removed").alias("incoming"),
        n["added"].alias("inserted"), n["updated"].alias("updated"), n["removed"].alias("removed"), n["unchanged"].alias("unchanged"),
    )


def change_union(diff: DataFrame, new: DataFrame, key: str = "security_id") -> DataFrame:
    """Rows of new that were added or updated, with the kind of change."""
    return new.join(diff.filter(F.col("change").isin("added", "updated")), key)


def scd2_merge(current: DataFrame, incoming: DataFrame, date: Column, key: str = "security_id") -> DataFrame:
    """The history after a load: open versions that are gone or differ are closed at date, new and differing ones open.

    current: all versions, with checksum, valid_from, valid_to, is_current; incoming: one row a key, with checksum and the
    other columns of current. Closed versions pass as they are.
    """
    rest = [c for c in current.columns if c not in ("valid_from", "valid_to", "is_current")]
    opened = current.filter("is_current")
    joined = opened.select(*rest, "valid_from", F.lit(True).alias("held")).join(
        incoming.select(key, F.col("checksum").alias("new_sum")), key, "left"
    )
    same = F.col("checksum").eqNullSafe(F.col("new_sum"))
    kept = joined.select(
        *rest, "valid_from", F.when(~same, date).alias("valid_to"), same.alias("is_current")
    )
    held = opened.select(key, "checksum")
    fresh = incoming.join(held, [key, "checksum"], "left_anti").select(
        *rest, date.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current")
    )
    closed = current.filter("NOT is_current").select(*kept.columns)
    return closed.unionByName(kept).unionByName(fresh)


def insert_missing(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """target, and the rows of incoming whose keys it lacks."""
    return target.unionByName(incoming.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def upsert_open(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert incoming rows; a key that target has is reopened: current, without an end."""
    hit = incoming.select(*keys).distinct().withColumn("_hit", F.lit(True))
    again = F.coalesce("_hit", F.lit(False))
    old = target.join(hit, keys, "left").select(
        *[
            F.when(again, F.lit(None)).otherwise(F.col(c)).alias(c) if c == "effective_to" else (again | F.col(c)).alias(c) if c == "is_current" else F.col(c)
            for c in target.columns
        ]
    )
    return insert_missing(old, incoming, keys)


def close_ineligible(history: DataFrame, current_symbols: DataFrame, date: Column) -> DataFrame:
    """Close at date the current rows of symbols that are gone; open rows for symbols that have none."""
    now = current_symbols.select("symbol").distinct().withColumn("_now", F.lit(True))
    gone = F.col("is_current") & F.col("_now").isNull()
    kept = history.join(now, "symbol", "left").select(
        "symbol", "effective_from", F.when(gone, date).otherwise(F.col("effective_to")).alias("effective_to"), (F.col("is_current") & ~gone).alias("is_current")
    )
    fresh = now.join(history.filter("is_current").select("symbol"), "symbol", "left_anti").select(
        "symbol", date.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current")
    )
    return kept.unionByName(fresh)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def overlapping_validity(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Versions that begin inside an earlier version of the same key."""
    order = Window.partitionBy(key).orderBy(start, F.col(end).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    far = F.lit("9999-12-31").cast("date")
    df = df.withColumn("_reach", F.max(F.coalesce(F.col(end), far)).over(before)).withColumn("_first", F.lag(start).over(order))
    return df.filter((F.col(start) > F.col("_first")) & (F.col(start) < F.col("_reach"))).drop("_reach", "_first")


def master_quality(df: DataFrame, date: Column) -> DataFrame:
    """One row: options without a strike, options without an expiry, current rows that have expired."""
    option = F.col("instrument_type").isin(*OPTIONS)
    return df.agg(
        F.count_if(option & (F.coalesce("strike_price", F.lit(0.0)) <= 0)).alias("no_strike"),
        F.count_if(option & F.col("expiry_date").isNull()).alias("no_expiry"),
        F.count_if(F.col("is_current") & (F.col("expiry_date") < date)).alias("expired_current"),
    )


def eligibility_periods(df: DataFrame, start: str, end: str, step: int = 7, close: bool = True) -> DataFrame:
    """Periods in which a symbol has a valid row, seen on a grid of every step days from start to end.

    A period runs from the first to the last of successive grid days; close=False leaves it open.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    low = F.greatest(F.ceil(F.datediff("valid_from", first) / step), F.lit(0))
    high = F.floor(F.datediff(F.least(F.coalesce("valid_to", last), last), first) / step)
    days = df.withColumn("low", low.cast("int")).withColumn("high", high.cast("int")).filter("low <= high")
    days = days.select("symbol", F.explode(F.sequence("low", "high")).alias("k")).distinct()
    order = Window.partitionBy("symbol").orderBy("k")
    days = days.withColumn("island", F.col("k") - F.row_number().over(order))
    grid = lambda c: F.date_add(first, c * step)
    out = days.groupBy("symbol", "island").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    until = grid(F.col("b")) if close else F.lit(None).cast("date")
    return out.select("symbol", grid(F.col("a")).alias("effective_from"), until.alias("effective_to"))
