"""Members, eligibility and the universe of contracts around the money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.contracts import build_contracts, contract_key, nearest_rank
from tickloom.operators.instruments import OPTIONS, listed_options, valid_at


def members_at(membership: DataFrame, date: Column) -> DataFrame:
    """Distinct members at date, both ends of their intervals included."""
    return valid_at(membership, date, "effective_from", "effective_to").select("symbol").distinct()


def eligible_underlyings(members: DataFrame, master: DataFrame, date: Column) -> DataFrame:
    """Members with an option that is valid at date."""
    options = valid_at(master, date).filter(F.col("instrument_type").isin(*OPTIONS))
    return members.join(options.select("symbol"), "symbol", "left_semi")


def nth_expiry(master: DataFrame, date: Column, n: int = 1) -> DataFrame:
    """The first n distinct expiries of each symbol's options on or after date, with their rank."""
    days = master.filter(F.col("instrument_type").isin(*OPTIONS) & (F.col("expiry_date") >= date)).select("symbol", "expiry_date").distinct()
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy("expiry_date"))
    return days.withColumn("rank", rank).filter(F.col("rank") <= n)


def spot_asof(prices: DataFrame, at: Column) -> DataFrame:
    """Latest price of each symbol at or before a moment. prices: symbol, ts, seq, price."""
    order = F.struct("ts", "seq")
    return prices.filter(F.col("ts") <= at).groupBy("symbol").agg(F.max_by("price", order).alias("spot"))


def select_atm(
    strikes: DataFrame, spot: DataFrame, by: tuple[str, ...] = ("symbol", "expiry_date"), fallback: bool = False
) -> DataFrame:
    """The listed strike nearest to the spot, the higher one if two are.

    fallback: symbols without a spot get their lowest listed strike, marked by is_fallback; else they are left out.
    """
    joined = strikes.join(spot, "symbol", "left" if fallback else "inner")
    if fallback:
        joined = joined.withColumn("_target", F.coalesce("spot", F.min("strike").over(Window.partitionBy(*by))))
    ranked = joined.withColumn("_nth", nearest_rank(list(by), "strike", "_target" if fallback else "spot")).filter("_nth = 1")
    marked = [F.col("spot").isNull().alias("is_fallback")] if fallback else []
    return ranked.select(*by, "spot", F.col("strike").alias("atm"), *marked)


def keep_atm(atm: DataFrame, before: DataFrame, strikes: DataFrame, ratio: float | None = 0.5, spot_threshold: float | None = None) -> DataFrame:
    """Hold on to the strike chosen before.

    ratio: unless the shift is that share of the least gap between strikes or more. spot_threshold: unless the spot is
    that share of the old strike away from it. A strike that is no longer listed is not held.
    """
    keys = ["symbol", "expiry_date"]
    order = Window.partitionBy(*keys).orderBy("strike")
    gaps = strikes.withColumn("gap", F.lead("strike").over(order) - F.col("strike")).groupBy(*keys).agg(F.min("gap").alias("gap"))
    held = before.select(*keys, F.col("atm").alias("old")).join(strikes.select(*keys, F.col("strike").alias("old")), [*keys, "old"], "left_semi")
    joined = atm.join(held, keys, "left").join(gaps, keys, "left")
    if spot_threshold is not None:
        stay = F.abs(F.col("spot") - F.col("old")) < spot_threshold * F.col("old")
    else:
        stay = F.abs(F.col("atm") - F.col("old")) < F.lit(ratio) * F.col("gap")
    return joined.withColumn("atm", F.when(F.coalesce(stay, F.lit(False)), F.col("old")).otherwise(F.col("atm"))).drop("old", "gap")


def strikes_around_atm(strikes: DataFrame, atm: DataFrame, below: int = 5, above: int = 5) -> DataFrame:
    """Listed strikes from so many below to so many above the at-the-money one (or the nearest listed one), with their
    distance in places; cut off at the ends of the list."""
    keys = ["symbol", "expiry_date"]
    order = Window.partitionBy(*keys).orderBy("strike")
    placed = strikes.join(atm.select(*keys, "atm"), keys).withColumn("place", F.row_number().over(order))
    placed = placed.withColumn("_nth", nearest_rank(keys, "strike", "atm"))
    centre = F.max(F.when(F.col("_nth") == 1, F.col("place"))).over(Window.partitionBy(*keys))
    placed = placed.withColumn("offset", F.col("place") - centre)
    return placed.filter(F.col("offset").between(-below, above)).select(*keys, "atm", "strike", "offset")


def universe_contracts(master: DataFrame, membership: DataFrame, spot: DataFrame, date: Column, expiry_rank: int = 1, around: int = 5) -> DataFrame:
    """Contracts of the universe at date: eligible members, their expiry of that rank, strikes around the money, CE and PE."""
    eligible = eligible_underlyings(members_at(membership, date), master, date)
    expiry = nth_expiry(valid_at(master, date), date, expiry_rank).filter(F.col("rank") == expiry_rank).join(eligible, "symbol", "left_semi")
    strikes = listed_options(master, date).join(expiry.select("symbol", "expiry_date"), ["symbol", "expiry_date"], "left_semi")
    chosen = strikes_around_atm(strikes, select_atm(strikes, spot), around, around)
    contracts = build_contracts(chosen).withColumnRenamed("strike", "strike_price").withColumn("exchange", F.lit("NSE"))
    return contract_key(contracts)


def resolve_universe(contracts: DataFrame, date: Column) -> DataFrame:
    """One snapshot row: symbols, their expiries and at-the-money strikes, and sorted contract keys; its id is the sha256
    of date and keys. A universe is a few thousand contracts by definition, so it fits a row."""
    by_symbol = contracts.groupBy("symbol").agg(
        F.min(F.col("expiry_date").cast("string")).alias("expiry"), F.min("atm").alias("atm"), F.array_sort(F.collect_list("contract_key")).alias("keys")
    )
    entries = F.array_sort(F.collect_list(F.struct("symbol", "expiry", "atm", "keys")))
    one = by_symbol.agg(entries.alias("e"))
    keys = F.flatten(F.col("e.keys"))
    return one.select(
        F.sha2(F.concat_ws("\n", date.cast("string"), keys), 256).alias("universe_snapshot_id"),
        date.alias("snapshot_date"),
        F.col("e.symbol").alias("eligible"),
        F.map_from_arrays(F.col("e.symbol"), F.col("e.expiry")).alias("expiry_dates"),
        F.map_from_arrays(F.col("e.symbol"), F.col("e.atm")).alias("atm_strikes"),
        keys.alias("contracts"),
        F.size(keys).alias("contract_count"),
    )


def universe_stats(master: DataFrame, membership: DataFrame, date: Column) -> DataFrame:
    """One row: members, instruments, options and derivative underlyings at date."""
    option = F.col("instrument_type").isin(*OPTIONS)
    counts = valid_at(master, date).agg(
        F.count("*").alias("instruments"), F.count_if(option).alias("options"), F.count_distinct(F.when(option, F.col("symbol"))).alias("underlyings")
    )
    return counts.join(F.broadcast(members_at(membership, date).agg(F.count("*").alias("members"))))  # one row each


def build_membership(additions: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Intervals of membership: an exclusion closes the addition that covers its start, the latest if several do; one
    that no addition covers becomes a closed record of its own.

    additions: symbol, effective_from; exclusions: symbol, excluded_from (last day as a member).
    """
    joined = exclusions.join(additions, "symbol", "left").filter("effective_from IS NULL OR effective_from <= excluded_from")
    closing = joined.groupBy("symbol", "excluded_from").agg(F.max("effective_from").alias("effective_from"))
    orphans = exclusions.join(closing.select("symbol", "excluded_from"), ["symbol", "excluded_from"], "left_anti").withColumn("effective_from", F.lit(None).cast("date"))
    closing = closing.unionByName(orphans.select(*closing.columns))
    first = closing.filter("effective_from IS NOT NULL").groupBy("symbol", "effective_from").agg(F.min("excluded_from").alias("effective_to"))
    kept = additions.join(first, ["symbol", "effective_from"], "left").select("symbol", "effective_from", "effective_to")
    own = closing.filter("effective_from IS NULL").select("symbol", F.col("excluded_from").alias("effective_from"), F.col("excluded_from").alias("effective_to"))
    return kept.unionByName(own).withColumn("is_current", F.col("effective_to").isNull())


def membership_reconcile(official: DataFrame, mine: DataFrame) -> DataFrame:
    """One row: counts of both lists and what each lacks."""
    a, b = official.select("symbol").distinct().withColumn("a", F.lit(True)), mine.select("symbol").distinct().withColumn("b", F.lit(True))
    both = a.join(b, "symbol", "full")
    only = lambda has, lacks: F.array_sort(F.collect_list(F.when(F.col(has).isNotNull() & F.col(lacks).isNull(), F.col("symbol"))))
    return both.agg(F.count("a").alias("official"), F.count("b").alias("mine"), only("a", "b").alias("missing"), only("b", "a").alias("extra"))


def membership_exceptions(official: DataFrame, membership: DataFrame, date: Column) -> DataFrame:
    """Symbols on which the official list and the history at date differ, with their last interval and what to do."""
    last = membership.groupBy("symbol").agg(F.max(F.struct("effective_from", "effective_to")).alias("last"))
    a = official.select("symbol").distinct().withColumn("a", F.lit(True))
    b = members_at(membership, date).withColumn("b", F.lit(True))
    differ = a.join(b, "symbol", "full").filter("a IS NULL OR b IS NULL").join(last, "symbol", "left")
    known = F.col("last").isNotNull()
    reason = F.when(F.col("a").isNull(), "not in official list").when(known, "interval ended").otherwise("never a member")
    return differ.select(
        "symbol", F.col("a").isNotNull().alias("in_official"), F.col("b").isNotNull().alias("in_history"),
        F.col("last.effective_from").alias("last_from"), F.col("last.effective_to").alias("last_to"),
        reason.alias("reason"), F.when(F.col("a").isNull(), "ADD_EXCLUSION").otherwise("ADD").alias("action"),
    )
