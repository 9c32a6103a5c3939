"""Contract keys, symbols, validation and lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.scalars import strike_key, strike_text

#: Exchanges, and the pattern of symbols.
EXCHANGES = ("NSE", "BSE", "NFO", "BFO", "MCX")
SYMBOL = "^[A-Z0-9]+$"


def contract_key(df: DataFrame) -> DataFrame:
    """Add contract_key: exchange|symbol|expiry|strike|type."""
    parts = [F.col("exchange"), F.col("symbol"), F.col("expiry_date").cast("string"), strike_text(F.col("strike_price")), F.col("option_type")]
    return df.withColumn("contract_key", F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


def parse_contract_key(df: DataFrame) -> DataFrame:
    """Add parsed: the five fields of contract_key, or null if one does not fit."""
    p = F.split("contract_key", r"\|")
    fields = F.struct(
        p[0].alias("exchange"), p[1].alias("symbol"), F.try_to_date(p[2], "yyyy-MM-dd").alias("expiry_date"),
        p[3].try_cast("double").alias("strike_price"), p[4].alias("option_type"),
    )
    good = (F.size(p) == 5) & F.try_to_date(F.get(p, F.lit(2)), "yyyy-MM-dd").isNotNull() & F.get(p, F.lit(3)).try_cast("double").isNotNull()
    return df.withColumn("parsed", F.when(good, fields))


def trading_symbol(df: DataFrame) -> DataFrame:
    parts = [F.col("exchange"), F.col("security_id").cast("string"), F.col("expiry_date").cast("string"), F.col("option_type"), strike_text(F.col("strike_price"))]
    return df.withColumn("trading_symbol", F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]))


def validate_contracts(df: DataFrame, known: DataFrame | None = None, pattern: str = SYMBOL) -> DataFrame:
    """Add reasons (the rules that a contract breaks, in order) and is_valid."""
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    day = lambda d: F.lit(d).cast("date")
    rules = {
        "exchange": bad(F.col("exchange").isin(*EXCHANGES)),
        "option_type": bad(F.col("option_type").isin("CE", "PE")),
        "strike": bad(F.col("strike_price") > 0),
        "expiry": bad(F.col("expiry_date").between(day("2000-01-01"), day("2030-12-31"))),
        "security_id": bad(F.col("security_id") > 0),
    }
    if known is not None:
        ids = known.select("security_id").distinct().withColumn("_known", F.lit(True))
        df = df.join(ids, "security_id", "left")
        rules["unknown_id"] = F.col("_known").isNull()
    rules["symbol"] = bad(F.col("symbol").rlike(pattern))
    reasons = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0).drop("_known")


LOOKUP = ["symbol", "expiry_date", "strike_key", "option_type"]


def resolve_security_ids(contracts: DataFrame, master: DataFrame) -> DataFrame:
    """Add security_id by symbol, expiry, strike and type: the least id of several; contracts without one go."""
    ids = master.withColumn("strike_key", strike_key(F.col("strike_price"))).groupBy(*LOOKUP).agg(F.min("security_id").alias("security_id"))
    wanted = contracts.withColumn("strike_key", strike_key(F.col("strike_price")))
    return wanted.join(ids, LOOKUP).drop("strike_key")


def verify_contracts(keys: DataFrame, master: DataFrame, date: Column) -> DataFrame:
    """For each contract_key whether a row of the master that is valid at date has it; a malformed key is false."""
    from tickloom.operators.instruments import valid_at

    listed = valid_at(master, date).withColumn("strike_key", strike_key(F.col("strike_price"))).select("exchange", *LOOKUP).distinct()
    asked = parse_contract_key(keys).select("contract_key", "parsed.*").withColumn("strike_key", strike_key(F.col("strike_price")))
    found = asked.drop("strike_price").join(listed.withColumn("_found", F.lit(True)), ["exchange", *LOOKUP], "left")
    return found.select("contract_key", F.coalesce("_found", F.lit(False)).alias("listed"))


def build_contracts(strikes: DataFrame) -> DataFrame:
    """A CE and a PE contract for each strike."""
    return strikes.withColumn("option_type", F.explode(F.array(F.lit("CE"), F.lit("PE"))))


def nearest_rank(by: list[str], strike: str, spot: str) -> Column:
    """Row number of strikes by distance from spot, ties to the higher strike."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(F.abs(F.col(strike) - F.col(spot)), F.desc(strike)))
