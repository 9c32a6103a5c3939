"""Registered queries over instruments, contracts, membership and the universe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import contracts as K
from tickloom.operators import instruments as I
from tickloom.operators import universe as U
from tickloom.session import table

QUERIES, ORACLES = {}, {}
#: Fixed value: the date that point-in-time queries ask about.
ON = "2024-01-15"
DATE = F.lit


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def on():
    return F.lit(ON).cast("date")


def master(spark, sf_dir) -> DataFrame:
    """Parts as options: the brand is the symbol, the price the strike, odd and even keys calls and puts."""
    k = F.col("p_partkey")
    start = F.date_add(F.lit("2023-01-01").cast("date"), (k % 400).cast("int"))
    option = k % 17 != 0
    end = F.when(k % 11 == 0, F.date_add(start, 200))
    df = table(spark, sf_dir, "part").select(
        k.alias("security_id"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("symbol"),
        F.lit("nse").alias("exchange"),
        F.when(option, "OPTSTK").otherwise("EQUITY").alias("instrument_type"),
        F.date_add(F.lit("2024-01-25").cast("date"), ((F.col("p_size") % 3) * 28).cast("int")).alias("expiry_date"),
        F.when(k % 13 == 0, 0.0).otherwise(F.round("p_retailprice", -1)).alias("strike_price"),
        F.when(k % 2 == 0, "CE").otherwise("PE").alias("option_type"),
        F.col("p_size").alias("lot_size"),
        start.alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
    )
    return I.normalize_instruments(df)


MASTER = f"""raw AS (
    SELECT *, (DATE '2023-01-01' + (p_partkey % 400)::INT)::DATE AS valid_from, p_partkey % 17 <> 0 AS opt FROM part
), master AS (
    SELECT p_partkey AS security_id, upper(trim(p_brand)) AS symbol, 'NSE' AS exchange, CASE WHEN opt THEN 'OPTSTK' ELSE 'EQUITY' END AS instrument_type,
        CASE WHEN opt THEN (DATE '2024-01-25' + (p_size % 3 * 28)::INT)::DATE END AS expiry_date,
        CASE WHEN NOT opt OR p_partkey % 13 = 0 THEN 0.0 ELSE round(p_retailprice, -1) END::DOUBLE AS strike_price,
        CASE WHEN opt THEN CASE WHEN p_partkey % 2 = 0 THEN 'CE' ELSE 'PE' END END AS option_type, p_size AS lot_size, valid_from,
        CASE WHEN p_partkey % 11 = 0 THEN (valid_from + 200)::DATE END AS valid_to, p_partkey % 11 <> 0 AS is_current FROM raw
), listed AS (SELECT * FROM master WHERE valid_from <= DATE '{ON}' AND (valid_to IS NULL OR valid_to >= DATE '{ON}')
)"""
_STRIKE = "regexp_replace(strike_price::DECIMAL(18,4)::VARCHAR, '0{1,3}$', '')"
_SUM = "md5(concat_ws('|', security_id, symbol, exchange, instrument_type, coalesce(expiry_date::VARCHAR, ''), strike_price::DECIMAL(28,4)::VARCHAR, coalesce(option_type, '')))"
COLUMNS = ["security_id", "symbol", "exchange", "instrument_type", "expiry_date", "strike_price", "option_type", "lot_size", "valid_from", "valid_to", "is_current"]


@query("instruments_norm", f"WITH {MASTER} SELECT {', '.join(COLUMNS)} FROM master")
def instruments_norm(spark, sf_dir):
    return master(spark, sf_dir).select(*COLUMNS)


@query("row_checksums", f"WITH {MASTER} SELECT security_id, {_SUM} AS checksum FROM master")
def row_checksums(spark, sf_dir):
    return I.row_checksum(master(spark, sf_dir)).select("security_id", "checksum")


_STRIKES = "SELECT DISTINCT symbol, expiry_date, strike_price AS strike FROM {} WHERE instrument_type = 'OPTSTK' AND strike_price > 0"


@query("listed_options", f"WITH {MASTER} " + _STRIKES.format("listed"))
def listed_options(spark, sf_dir):
    return I.listed_options(master(spark, sf_dir), on())


@query(
    "strike_interval",
    f"""WITH {MASTER}, s AS ({_STRIKES.format("master")}), g AS (
        SELECT *, round(lead(strike) OVER (PARTITION BY symbol, expiry_date ORDER BY strike) - strike, 2) AS gap FROM s),
    n AS (SELECT symbol, expiry_date, gap, count(*) AS n FROM g GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY symbol, expiry_date ORDER BY gap IS NULL, n DESC, gap) AS k FROM n)
    SELECT symbol, expiry_date, coalesce(gap, 10.0) AS strike_interval FROM r WHERE k = 1""",
)
def strike_interval(spark, sf_dir):
    return I.strike_interval(master(spark, sf_dir))


@query(
    "strike_interval_rows",
    f"""WITH {MASTER}, s AS ({_STRIKES.format("master")}), g AS (
        SELECT *, round(lead(strike) OVER (PARTITION BY symbol, expiry_date ORDER BY strike) - strike, 2) AS gap FROM s),
    n AS (SELECT symbol, expiry_date, gap, count(*) AS n FROM g GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY symbol, expiry_date ORDER BY gap IS NULL, n DESC, gap) AS k FROM n)
    SELECT security_id, CASE WHEN instrument_type = 'OPTSTK' THEN coalesce(CASE WHEN r.k = 1 THEN coalesce(gap, 10.0) END, 0.0) ELSE 0.0 END::DOUBLE AS strike_interval
    FROM master LEFT JOIN r ON r.symbol = master.symbol AND r.expiry_date = master.expiry_date AND r.k = 1""",
)
def strike_interval_rows(spark, sf_dir):
    return I.with_strike_interval(master(spark, sf_dir)).select("security_id", "strike_interval")


def _snapshots(spark, sf_dir):
    m = master(spark, sf_dir).drop("valid_from", "valid_to", "is_current")
    old = m.filter("security_id % 10 <> 0")
    new = m.filter("security_id % 10 <> 1").withColumn("lot_size", F.when(F.col("security_id") % 7 == 0, F.col("lot_size") + 1).otherwise(F.col("lot_size")))
    return old, new


_DIFF = f"""{MASTER}, diff AS (SELECT security_id, CASE WHEN security_id % 10 = 0 THEN 'added' WHEN security_id % 10 = 1 THEN 'removed'
    WHEN security_id % 7 = 0 THEN 'updated' ELSE 'unchanged' END AS change FROM master)"""


@query("snapshot_diff", f"WITH {_DIFF} SELECT * FROM diff")
def snapshot_diff(spark, sf_dir):
    return I.snapshot_diff(*_snapshots(spark, sf_dir))


@query(
    "import_summary",
    f"""WITH {_DIFF} SELECT count_if(change <> 'removed')::BIGINT AS incoming, count_if(change = 'added')::BIGINT AS inserted,
    count_if(change = 'updated')::BIGINT AS updated, count_if(change = 'removed')::BIGINT AS removed, count_if(change = 'unchanged')::BIGINT AS unchanged FROM diff""",
)
def import_summary(spark, sf_dir):
    return I.import_summary(snapshot_diff(spark, sf_dir))


@query(
    "change_union",
    f"""WITH {_DIFF} SELECT security_id, change, symbol, (lot_size + (security_id % 7 = 0)::INT)::INT AS lot_size
    FROM diff JOIN master USING (security_id) WHERE change IN ('added', 'updated')""",
)
def change_union(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return I.change_union(I.snapshot_diff(old, new), new).select("security_id", "change", "symbol", F.col("lot_size").cast("int").alias("lot_size"))


@query(
    "scd2_merge",
    f"""WITH {_DIFF}, s AS (SELECT *, md5(concat_ws('|', security_id, lot_size)) AS a, md5(concat_ws('|', security_id, lot_size + (security_id % 7 = 0)::INT)) AS b
        FROM master JOIN diff USING (security_id)), v AS (
        SELECT security_id, a AS checksum, DATE '2020-01-01' AS valid_from, CASE WHEN change <> 'unchanged' THEN DATE '{ON}' END AS valid_to, change = 'unchanged' AS is_current
        FROM s WHERE change <> 'added'
        UNION ALL SELECT security_id, b, DATE '{ON}', NULL, true FROM s WHERE change IN ('added', 'updated'))
    SELECT * FROM v""",
)
def scd2_merge(spark, sf_dir):
    old, new = (I.row_checksum(x, ("security_id", "lot_size")).select("security_id", "checksum") for x in _snapshots(spark, sf_dir))
    start = {"valid_from": F.lit("2020-01-01").cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
    return I.scd2_merge(old.withColumns(start), new, on())


@query("valid_at", f"WITH {MASTER} SELECT security_id, symbol, valid_from, valid_to FROM listed")
def valid_at(spark, sf_dir):
    return I.valid_at(master(spark, sf_dir), on()).select("security_id", "symbol", "valid_from", "valid_to")


@query("duplicate_keys", f"WITH {MASTER} SELECT symbol, valid_from, count(*) AS n FROM master GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return I.duplicate_keys(master(spark, sf_dir), ["symbol", "valid_from"])


@query(
    "master_quality",
    f"""WITH {MASTER} SELECT count_if(instrument_type = 'OPTSTK' AND strike_price <= 0)::BIGINT AS no_strike,
    count_if(instrument_type = 'OPTSTK' AND expiry_date IS NULL)::BIGINT AS no_expiry,
    count_if(is_current AND expiry_date < DATE '2024-02-01')::BIGINT AS expired_current FROM master""",
)
def master_quality(spark, sf_dir):
    return I.master_quality(master(spark, sf_dir), F.lit("2024-02-01").cast("date"))


@query(
    "eligibility_periods",
    f"""WITH {MASTER}, d AS (
        SELECT DISTINCT symbol, k FROM master, range(0, 80) AS r(k)
        WHERE DATE '2023-01-01' + (7 * k)::INT <= DATE '2024-06-30' AND valid_from <= DATE '2023-01-01' + (7 * k)::INT
            AND (valid_to IS NULL OR valid_to >= DATE '2023-01-01' + (7 * k)::INT)),
    i AS (SELECT *, k - row_number() OVER (PARTITION BY symbol ORDER BY k) AS island FROM d)
    SELECT symbol, (DATE '2023-01-01' + (7 * min(k))::INT)::DATE AS effective_from, (DATE '2023-01-01' + (7 * max(k))::INT)::DATE AS effective_to
    FROM i GROUP BY symbol, island""",
)
def eligibility_periods(spark, sf_dir):
    return I.eligibility_periods(master(spark, sf_dir), "2023-01-01", "2024-06-30")


# -- contracts --------------------------------------------------------------------------------------------------------

_KEY = f"concat_ws('|', exchange, symbol, coalesce(expiry_date::VARCHAR, ''), {_STRIKE}, coalesce(option_type, ''))"


@query("contract_keys", f"WITH {MASTER} SELECT security_id, {_KEY} AS contract_key FROM master")
def contract_keys(spark, sf_dir):
    return K.contract_key(master(spark, sf_dir)).select("security_id", "contract_key")


@query("parsed_keys", f"WITH {MASTER} SELECT security_id, symbol, expiry_date, strike_price, option_type FROM master WHERE expiry_date IS NOT NULL")
def parsed_keys(spark, sf_dir):
    keys = K.contract_key(master(spark, sf_dir)).select("security_id", "contract_key")
    return K.parse_contract_key(keys).filter("parsed IS NOT NULL").select("security_id", "parsed.symbol", "parsed.expiry_date", "parsed.strike_price", "parsed.option_type")


@query(
    "trading_symbols",
    f"WITH {MASTER} SELECT security_id, concat_ws(':', exchange, security_id, coalesce(expiry_date::VARCHAR, ''), coalesce(option_type, ''), {_STRIKE}) AS trading_symbol FROM master",
)
def trading_symbols(spark, sf_dir):
    return K.trading_symbol(master(spark, sf_dir)).select("security_id", "trading_symbol")


@query(
    "validate_contracts",
    f"""WITH {MASTER}, r AS (SELECT security_id, list_filter([CASE WHEN option_type IS NULL THEN 'option_type' END, CASE WHEN strike_price <= 0 THEN 'strike' END,
        CASE WHEN expiry_date IS NULL THEN 'expiry' END, CASE WHEN security_id <= 0 THEN 'security_id' END,
        CASE WHEN security_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'unknown_id' END,
        CASE WHEN NOT regexp_matches(symbol, '^[A-Z0-9]+$') THEN 'symbol' END], lambda x: x IS NOT NULL) AS reasons FROM master)
    SELECT security_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS is_valid FROM r""",
)
def validate_contracts(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("security_id"))
    return K.validate_contracts(master(spark, sf_dir), known).select("security_id", F.array_join("reasons", ",").alias("reasons"), "is_valid")


@query(
    "verify_contracts",
    f"""WITH {MASTER}, keys AS (SELECT DISTINCT CASE WHEN security_id % 5 = 0 THEN 'broken' ELSE {_KEY} END AS contract_key FROM master),
    l AS (SELECT DISTINCT {_KEY} AS contract_key FROM listed WHERE expiry_date IS NOT NULL)
    SELECT contract_key, contract_key IN (SELECT contract_key FROM l) AS listed FROM keys""",
)
def verify_contracts(spark, sf_dir):
    key = F.when(F.col("security_id") % 5 == 0, "broken").otherwise(F.col("contract_key"))
    keys = K.contract_key(master(spark, sf_dir)).select(key.alias("contract_key")).distinct()
    return K.verify_contracts(keys, master(spark, sf_dir), on())


@query(
    "resolve_ids",
    f"""WITH {MASTER}, i AS (SELECT symbol, expiry_date, strike_price, option_type, min(security_id) AS security_id FROM master GROUP BY ALL),
    c AS (SELECT symbol, expiry_date, unnest([strike_price, strike_price + 10]) AS strike_price, option_type, security_id AS asked FROM master)
    SELECT asked, c.strike_price, i.security_id FROM c JOIN i USING (symbol, expiry_date, strike_price, option_type)""",
)
def resolve_ids(spark, sf_dir):
    m = master(spark, sf_dir)
    wanted = m.select("symbol", "expiry_date", F.explode(F.array("strike_price", F.col("strike_price") + 10)).alias("strike_price"), "option_type", F.col("security_id").alias("asked"))
    return K.resolve_security_ids(wanted, m).select("asked", "strike_price", "security_id")


# -- membership and universe ------------------------------------------------------------------------------------------


def membership(spark, sf_dir) -> DataFrame:
    """Customers' first and last order dates as intervals of membership of the symbol of their number."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("effective_from"), F.max("o_orderdate").cast("date").alias("last"))
    symbol = F.concat(F.lit("BRAND#"), (F.col("o_custkey") % 40).cast("string"))
    end = F.when(F.col("o_custkey") % 3 == 0, F.col("last"))
    return o.select(symbol.alias("symbol"), "effective_from", end.alias("effective_to"), end.isNull().alias("is_current"))


MEMBERSHIP = f"""o AS (SELECT o_custkey, min(o_orderdate)::DATE AS effective_from, max(o_orderdate)::DATE AS last FROM orders GROUP BY 1),
membership AS (SELECT 'BRAND#' || (o_custkey % 40) AS symbol, effective_from, CASE WHEN o_custkey % 3 = 0 THEN last END AS effective_to, o_custkey % 3 <> 0 AS is_current FROM o),
members AS (SELECT DISTINCT symbol FROM membership WHERE effective_from <= DATE '{ON}' AND (effective_to IS NULL OR effective_to >= DATE '{ON}'))"""


@query(
    "validity_overlaps",
    f"""WITH {MEMBERSHIP}, w AS (SELECT *, max(coalesce(effective_to, DATE '9999-12-31')) OVER p AS reach, lag(effective_from) OVER q AS before FROM membership
        WINDOW p AS (PARTITION BY symbol ORDER BY effective_from, effective_to NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            q AS (PARTITION BY symbol ORDER BY effective_from, effective_to NULLS LAST))
    SELECT symbol, effective_from, effective_to FROM w WHERE effective_from > before AND effective_from < reach""",
)
def validity_overlaps(spark, sf_dir):
    return I.overlapping_validity(membership(spark, sf_dir), "symbol", "effective_from", "effective_to").select("symbol", "effective_from", "effective_to")


@query("members_at", f"WITH {MEMBERSHIP} SELECT symbol FROM members")
def members_at(spark, sf_dir):
    return U.members_at(membership(spark, sf_dir), on())


_ELIGIBLE = f"""{MASTER}, {MEMBERSHIP}, eligible AS (SELECT symbol FROM members WHERE symbol IN (SELECT symbol FROM listed WHERE instrument_type = 'OPTSTK'))"""


@query("eligible", f"WITH {_ELIGIBLE} SELECT symbol FROM eligible")
def eligible(spark, sf_dir):
    return U.eligible_underlyings(members_at(spark, sf_dir), master(spark, sf_dir), on())


@query(
    "close_ineligible",
    f"""WITH {MEMBERSHIP}, h AS (SELECT DISTINCT symbol, DATE '2020-01-01' AS effective_from, is_current FROM membership),
    now AS (SELECT DISTINCT upper(p_brand) AS symbol FROM part WHERE p_partkey % 3 = 0)
    SELECT symbol, effective_from, CASE WHEN is_current AND symbol NOT IN (FROM now) THEN DATE '{ON}' END AS effective_to, is_current AND symbol IN (FROM now) AS is_current FROM h
    UNION ALL SELECT symbol, DATE '{ON}', NULL, true FROM now WHERE symbol NOT IN (SELECT symbol FROM h WHERE is_current)""",
)
def close_ineligible(spark, sf_dir):
    history = membership(spark, sf_dir).select("symbol", "is_current").distinct().withColumns({"effective_from": F.lit("2020-01-01").cast("date"), "effective_to": F.lit(None).cast("date")})
    now = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0").select(F.upper("p_brand").alias("symbol"))
    return I.close_ineligible(history, now, on())


@query(
    "upsert",
    f"""WITH {MEMBERSHIP}, t AS (SELECT DISTINCT symbol, effective_from, effective_to, is_current FROM membership WHERE hash(symbol) IS NOT NULL AND day(effective_from) % 2 = 0),
    n AS (SELECT DISTINCT symbol, effective_from FROM membership WHERE day(effective_from) % 4 < 2)
    SELECT symbol, effective_from, CASE WHEN (symbol, effective_from) IN (FROM n) THEN NULL ELSE effective_to END AS effective_to,
        (symbol, effective_from) IN (FROM n) OR is_current AS is_current FROM t
    UNION ALL SELECT symbol, effective_from, NULL, true FROM n WHERE (symbol, effective_from) NOT IN (SELECT (symbol, effective_from) FROM t)""",
)
def upsert(spark, sf_dir):
    m = membership(spark, sf_dir).distinct()
    new = m.filter("day(effective_from) % 4 < 2").select("symbol", "effective_from").distinct()
    new = new.withColumns({"effective_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    return I.upsert_open(m.filter("day(effective_from) % 2 = 0"), new, ["symbol", "effective_from"])


def _changes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    added = o.filter("o_orderstatus = 'O'").select("symbol", F.col("day").alias("effective_from")).distinct()
    return added, o.filter("o_orderstatus = 'P'").select("symbol", F.col("day").alias("excluded_from")).distinct()


@query(
    "membership_build",
    """WITH a AS (SELECT DISTINCT 'C' || o_custkey AS symbol, o_orderdate::DATE AS effective_from FROM orders WHERE o_orderstatus = 'O'),
    x AS (SELECT DISTINCT 'C' || o_custkey AS symbol, o_orderdate::DATE AS excluded_from FROM orders WHERE o_orderstatus = 'P'),
    c AS (SELECT x.symbol, excluded_from, max(effective_from) AS effective_from FROM x LEFT JOIN a ON a.symbol = x.symbol AND effective_from <= excluded_from GROUP BY ALL),
    f AS (SELECT symbol, effective_from, min(excluded_from) AS effective_to FROM c WHERE effective_from IS NOT NULL GROUP BY ALL)
    SELECT symbol, effective_from, effective_to, effective_to IS NULL AS is_current FROM a LEFT JOIN f USING (symbol, effective_from)
    UNION ALL SELECT symbol, excluded_from, excluded_from, false FROM c WHERE effective_from IS NULL""",
)
def membership_build(spark, sf_dir):
    return U.build_membership(*_changes(spark, sf_dir))


def _official(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.upper("p_brand").alias("symbol")).distinct()


_OFFICIAL = "official AS (SELECT DISTINCT upper(p_brand) AS symbol FROM part WHERE p_partkey % 2 = 0)"


@query(
    "membership_reconcile",
    f"""WITH {MEMBERSHIP}, {_OFFICIAL} SELECT (SELECT count(*) FROM official) AS official, (SELECT count(*) FROM members) AS mine,
    (SELECT coalesce(string_agg(symbol, ',' ORDER BY symbol), '') FROM official WHERE symbol NOT IN (FROM members)) AS missing,
    (SELECT coalesce(string_agg(symbol, ',' ORDER BY symbol), '') FROM members WHERE symbol NOT IN (FROM official)) AS extra""",
)
def membership_reconcile(spark, sf_dir):
    found = U.membership_reconcile(_official(spark, sf_dir), members_at(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, ",") for c in ("missing", "extra")})


@query(
    "membership_exceptions",
    f"""WITH {MEMBERSHIP}, {_OFFICIAL}, l AS (SELECT symbol, max(effective_from) AS last_from FROM membership GROUP BY 1),
    t AS (SELECT symbol, last_from, CASE WHEN bool_or(effective_to IS NOT NULL) THEN max(effective_to) END AS last_to
        FROM membership JOIN l USING (symbol) WHERE effective_from = last_from GROUP BY ALL),
    d AS (SELECT coalesce(o.symbol, m.symbol) AS symbol, o.symbol IS NOT NULL AS in_official, m.symbol IS NOT NULL AS in_history
        FROM official o FULL JOIN members m ON o.symbol = m.symbol WHERE o.symbol IS NULL OR m.symbol IS NULL)
    SELECT symbol, in_official, in_history, last_from, last_to, CASE WHEN NOT in_official THEN 'not in official list' WHEN last_from IS NOT NULL THEN 'interval ended'
        ELSE 'never a member' END AS reason, CASE WHEN in_official THEN 'ADD' ELSE 'ADD_EXCLUSION' END AS action FROM d LEFT JOIN t USING (symbol)""",
)
def membership_exceptions(spark, sf_dir):
    return U.membership_exceptions(_official(spark, sf_dir), membership(spark, sf_dir), on())


@query(
    "nth_expiry",
    f"""WITH {MASTER}, d AS (SELECT DISTINCT symbol, expiry_date FROM master WHERE instrument_type = 'OPTSTK' AND expiry_date >= DATE '2024-01-26'),
    r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY expiry_date)::INT AS rank FROM d) SELECT * FROM r WHERE rank <= 2""",
)
def nth_expiry(spark, sf_dir):
    return U.nth_expiry(master(spark, sf_dir), F.lit("2024-01-26").cast("date"), 2)


def _spot(spark, sf_dir) -> DataFrame:
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    prices = item.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.upper("p_brand").alias("symbol"), F.col("l_shipdate").alias("ts"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("seq"), F.col("p_retailprice").alias("price")
    )
    return U.spot_asof(prices, F.lit("2000-06-30").cast("timestamp_ntz"))


_SPOT = """spot AS (SELECT upper(p_brand) AS symbol, arg_max(p_retailprice, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS spot
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate <= TIMESTAMP '2000-06-30' GROUP BY 1)"""


@query("spot_asof", f"WITH {_SPOT} SELECT * FROM spot")
def spot_asof(spark, sf_dir):
    return _spot(spark, sf_dir)


_ATM = f"""{MASTER}, {_SPOT}, s AS ({_STRIKES.format("listed")}), k AS (SELECT s.*, spot, row_number() OVER (PARTITION BY s.symbol, expiry_date ORDER BY abs(strike - spot), strike DESC) AS nth
    FROM s JOIN spot USING (symbol)), atm AS (SELECT symbol, expiry_date, spot, strike AS atm FROM k WHERE nth = 1)"""


@query("select_atm", f"WITH {_ATM} SELECT * FROM atm")
def select_atm(spark, sf_dir):
    return U.select_atm(I.listed_options(master(spark, sf_dir), on()), _spot(spark, sf_dir))


_AROUND = f"""{_ATM}, p AS (SELECT s.*, atm, row_number() OVER (PARTITION BY symbol, expiry_date ORDER BY strike) AS place FROM s JOIN atm USING (symbol, expiry_date)),
    around AS (SELECT symbol, expiry_date, atm, strike, (place - max(CASE WHEN strike = atm THEN place END) OVER (PARTITION BY symbol, expiry_date))::INT AS places FROM p)"""


@query("strikes_around_atm", f"WITH {_AROUND} SELECT symbol, expiry_date, atm, strike, places AS distance FROM around WHERE places BETWEEN -5 AND 5")
def strikes_around_atm(spark, sf_dir):
    strikes = I.listed_options(master(spark, sf_dir), on())
    return U.strikes_around_atm(strikes, U.select_atm(strikes, _spot(spark, sf_dir))).withColumnRenamed("offset", "distance")


@query(
    "atm_held",
    f"""WITH {_ATM}, b AS (SELECT symbol, expiry_date, max(strike) AS old FROM s WHERE (symbol, expiry_date) IN (SELECT (symbol, expiry_date) FROM atm) AND strike <=
        (SELECT a.atm + 200 FROM atm a WHERE a.symbol = s.symbol AND a.expiry_date = s.expiry_date) GROUP BY ALL)
    SELECT symbol, expiry_date, spot, CASE WHEN abs(spot - old) < 0.1 * old THEN old ELSE atm END AS atm FROM atm JOIN b USING (symbol, expiry_date)""",
)
def atm_held(spark, sf_dir):
    """The strike before is the highest one up to 200 above the money; it is held while the spot is within a tenth of it."""
    strikes = I.listed_options(master(spark, sf_dir), on())
    atm = U.select_atm(strikes, _spot(spark, sf_dir))
    before = strikes.join(atm, ["symbol", "expiry_date"]).filter("strike <= atm + 200").groupBy("symbol", "expiry_date").agg(F.max("strike").alias("atm"))
    return U.keep_atm(atm, before, strikes, spot_threshold=0.1)


@query(
    "atm_kept_by_ratio",
    f"""WITH {_ATM}, b AS (SELECT symbol, expiry_date, max(strike) AS old FROM s WHERE (symbol, expiry_date) IN (SELECT (symbol, expiry_date) FROM atm) AND strike <=
        (SELECT a.atm + 200 FROM atm a WHERE a.symbol = s.symbol AND a.expiry_date = s.expiry_date) GROUP BY ALL),
    gaps AS (SELECT symbol, expiry_date, min(gap) AS gap FROM (SELECT *, lead(strike) OVER (PARTITION BY symbol, expiry_date ORDER BY strike) - strike AS gap FROM s) GROUP BY ALL)
    SELECT symbol, expiry_date, spot, CASE WHEN abs(atm - old) < 12 * gap THEN old ELSE atm END AS atm FROM atm JOIN b USING (symbol, expiry_date) JOIN gaps USING (symbol, expiry_date)""",
)
def atm_kept_by_ratio(spark, sf_dir):
    """As atm_held, but the strike before stays unless the shift is twelve of the least gaps between strikes or more."""
    strikes = I.listed_options(master(spark, sf_dir), on())
    atm = U.select_atm(strikes, _spot(spark, sf_dir))
    before = strikes.join(atm, ["symbol", "expiry_date"]).filter("strike <= atm + 200").groupBy("symbol", "expiry_date").agg(F.max("strike").alias("atm"))
    return U.keep_atm(atm, before, strikes, ratio=12.0)


_UNIVERSE = f"""{_AROUND}, {MEMBERSHIP}, first AS (SELECT symbol, min(expiry_date) AS expiry_date FROM listed WHERE instrument_type = 'OPTSTK' AND expiry_date >= DATE '{ON}' GROUP BY 1),
    universe AS (SELECT 'NSE' AS exchange, symbol, expiry_date, atm, strike AS strike_price, unnest(['CE', 'PE']) AS option_type FROM around JOIN first USING (symbol, expiry_date)
        WHERE places BETWEEN -5 AND 5 AND symbol IN (FROM members)), keyed AS (SELECT *, {_KEY} AS contract_key FROM universe)"""


def _universe(spark, sf_dir):
    return U.universe_contracts(master(spark, sf_dir), membership(spark, sf_dir), _spot(spark, sf_dir), on())


@query("build_contracts", f"WITH {_UNIVERSE} SELECT symbol, contract_key, atm FROM keyed")
def build_contracts(spark, sf_dir):
    return _universe(spark, sf_dir).select("symbol", "contract_key", "atm")


@query(
    "universe",
    f"""WITH {_UNIVERSE}, c AS (SELECT symbol, min(expiry_date) AS e, min(atm) AS atm, string_agg(contract_key, chr(10) ORDER BY contract_key) AS keys, count(*) AS n FROM keyed GROUP BY 1)
    SELECT sha256('{ON}' || chr(10) || string_agg(keys, chr(10) ORDER BY symbol)) AS universe_snapshot_id, string_agg(symbol, ',' ORDER BY symbol) AS eligible,
        string_agg(e::VARCHAR, ',' ORDER BY symbol) AS expiries, sum(atm) AS atm_sum, sum(n)::INT AS contract_count FROM c""",
)
def universe(spark, sf_dir):
    return flat_universe(U.resolve_universe(_universe(spark, sf_dir), on()))


def flat_universe(one: DataFrame) -> DataFrame:
    """A snapshot without lists and maps."""
    total = F.aggregate(F.map_values("atm_strikes"), F.lit(0.0), lambda a, x: a + x)
    return one.select(
        "universe_snapshot_id", F.array_join("eligible", ",").alias("eligible"), F.array_join(F.map_values("expiry_dates"), ",").alias("expiries"), total.alias("atm_sum"), "contract_count"
    )


@query(
    "universe_stats",
    f"""WITH {MASTER}, {MEMBERSHIP} SELECT count(*) AS instruments, count_if(instrument_type = 'OPTSTK')::BIGINT AS options,
    count(DISTINCT symbol) FILTER (instrument_type = 'OPTSTK') AS underlyings, (SELECT count(*) FROM members) AS members FROM listed""",
)
def universe_stats(spark, sf_dir):
    return U.universe_stats(master(spark, sf_dir), membership(spark, sf_dir), on())
