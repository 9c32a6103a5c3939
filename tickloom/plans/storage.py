"""Registered queries over sources and sinks: what is written to the shared folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import audit as A
from tickloom.operators import bars as B
from tickloom.operators import events as E
from tickloom.operators import features as X
from tickloom.operators import research as R
from tickloom.operators import training as T
from tickloom.operators import universe as U
from tickloom.operators.order import global_position
from tickloom.plans import master as M
from tickloom.plans.feed import PACKETS_SQL, packets
from tickloom.plans.market import _FEATURES, BAR, FEATURES, features
from tickloom.plans.views import AS_OF, DAILY_SQL, TICKS_SQL, checksum_sql, daily_bars, naive, ticks
from tickloom.session import shared_dir, table
from tickloom.sources import tables as S

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"


_NS = "epoch_us(event_time) * 1000 + seq % 1000"


def _envelopes(spark, sf_dir) -> DataFrame:
    """Events as envelopes with decoded payloads; every fifth lacks its security, every seventh its open interest."""
    t = ticks(spark, sf_dir)
    seq, price = F.col("seq"), F.col("price")
    none = lambda kind: F.lit(None).cast(kind)
    depth = F.array(F.struct((price - 1).alias("bid"), (price + 1).alias("ask")))
    decoded = F.struct(
        F.when(seq % 5 != 0, F.col("security_id")).alias("security_id"),
        F.when(seq % 3 == 0, "quote").alias("packet_type"),
        F.when(seq % 11 == 0, F.lit(float("nan"))).otherwise(price).alias("ltp"),
        F.when(seq % 2 == 0, depth).alias("depth"),
        F.when(seq % 7 != 0, F.col("volume") * 10).alias("oi"),
        (price / 2).alias("prev_close"),
        F.unix_seconds("event_time").alias("last_trade_time"),
        F.when(seq % 13 != 0, F.col("volume")).alias("last_trade_qty"),
        *[none("double").alias(f"day_{c}") for c in ("open", "high", "low", "close")],
        *[none("bigint").alias(c) for c in ("total_buy_qty", "total_sell_qty")],
    )
    return t.select(
        F.col("seq").cast("string").alias("event_id"), (F.col("security_id") + F.when(seq % 5 == 0, 0).otherwise(1000)).alias("security_id"),
        decoded.alias("decoded"), (F.unix_micros("event_time") * 1000 + seq % 1000).alias("receive_ts_ns"), F.lit("c").alias("connection_id"),
    )


_DAYS = ["2024-01-03", "2024-01-09"]
_SOME = ", ".join(f"DATE '{d}'" for d in _DAYS)


@query(
    "bronze_written",
    f"""WITH {TICKS_SQL} SELECT seq::VARCHAR AS event_id, security_id::INT AS security_id, CASE WHEN seq % 3 = 0 THEN 'quote' ELSE 'ticker' END AS mode,
        CASE WHEN seq % 2 = 0 THEN price - 1 END AS bid, CASE WHEN seq % 2 = 0 THEN price + 1 END AS ask, CASE WHEN seq % 7 <> 0 THEN volume * 10 END AS oi,
        {_NS} AS capture_timestamp_ns, event_time::DATE AS dt FROM ticks""",
)
def bronze_written(spark, sf_dir):
    path = _fresh(spark, "bronze")
    S.write_bronze(_envelopes(spark, sf_dir), path)
    return S.read_bronze(spark, path).select("event_id", "security_id", "mode", "bid", "ask", "oi", "capture_timestamp_ns", "dt")


@query(
    "bronze_days",
    f"""WITH {TICKS_SQL} SELECT security_id, event_time, {_NS} AS seq, CASE WHEN seq % 11 <> 0 THEN price END AS price,
        CASE WHEN seq % 13 <> 0 THEN volume ELSE 0 END AS volume, CASE WHEN seq % 7 <> 0 THEN volume * 10 END AS oi FROM ticks WHERE event_time::DATE IN ({_SOME})""",
)
def bronze_days(spark, sf_dir):
    """Ticks of two days, of which alone the folders are read."""
    path = _fresh(spark, "bronze")
    S.write_bronze(_envelopes(spark, sf_dir), path)
    return naive(S.bronze_to_ticks(S.read_bronze(spark, path, _DAYS)).drop("trade_sign"), "event_time")


def _failed(spark, sf_dir) -> DataFrame:
    p = packets(spark, sf_dir)
    ok = F.col("decode_status") == "success"
    return p.select(
        F.col("connection_id"), F.col("message_id").cast("int").alias("message_id"), F.col("message_id").cast("int").alias("websocket_message_id"),
        F.col("packet_offset").cast("int").alias("packet_offset"), (F.unix_micros("ts") * 1000).alias("receive_ts_ns"), "last_trade_time",
        F.col("security_id").cast("int").alias("security_id"), F.lit("2").alias("decoder_version"), "decode_status", F.when(ok, "{}").alias("decoded_payload"),
        F.when(F.col("seq") % 9 != 0, F.col("payload").cast("binary")).alias("raw_payload"),
    )


_ENVELOPES = f"""{PACKETS_SQL}, enveloped AS (SELECT *, CASE WHEN seq % 9 <> 0 THEN payload END AS raw, CASE WHEN seq % 9 <> 0 THEN sha256(payload) ELSE '' END AS payload_hash FROM packets)"""


@query(
    "envelopes",
    f"""WITH {_ENVELOPES} SELECT message_id::INT AS message_id, payload_hash, epoch_us(ts) * 1000 AS receive_ts_ns, last_trade_time * 1000000000 AS exchange_ts_ns,
        sha256(connection_id || message_id || packet_offset || payload_hash) AS event_id, CASE WHEN decode_status = 'success' THEN '{{}}' END AS decoded_payload FROM enveloped""",
)
def envelopes(spark, sf_dir):
    return E.to_envelope(_failed(spark, sf_dir)).select("message_id", "payload_hash", "receive_ts_ns", "exchange_ts_ns", "event_id", "decoded_payload")


@query(
    "quarantine_written",
    f"""WITH {_ENVELOPES} SELECT message_id::INT AS websocket_message_id, connection_id, payload_hash, lower(hex(raw::BLOB)) AS raw_payload_hex, ts::DATE AS dt FROM enveloped WHERE decode_status <> 'success'""",
)
def quarantine_written(spark, sf_dir):
    path = _fresh(spark, "quarantine")
    S.write_quarantine(E.to_envelope(_failed(spark, sf_dir)).filter("decode_status <> 'success'"), path)
    return S.read_quarantine(spark, path).select("websocket_message_id", "connection_id", "payload_hash", "raw_payload_hex", "dt")


@query(
    "master_file",
    """SELECT p_partkey AS security_id, p_brand AS symbol, CASE WHEN p_partkey % 3 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange, CASE WHEN p_partkey % 5 = 0 THEN 0.0 ELSE p_size::DOUBLE END AS strike_price,
        p_size::INT AS lot_size, '' AS isin, 'NSE' AS source, p_type AS extra_column FROM part""",
)
def master_file(spark, sf_dir):
    """Parts as a vendor's file: some exchanges are missing, some strikes are no numbers."""
    path, k = _fresh(spark, "master"), F.col("p_partkey")
    table(spark, sf_dir, "part").select(
        k.alias("SECURITY_ID"), F.col("p_brand").alias("SYMBOL_NAME"), F.when(k % 3 != 0, "BSE").alias("EXCH_ID"),
        F.when(k % 5 == 0, "none").otherwise(F.col("p_size").cast("string")).alias("STRIKE_PRICE"), F.col("p_size").alias("LOT_SIZE"), F.col("p_type").alias(" Extra-Column"),
    ).write.csv(path, header=True)
    return S.read_instrument_master(spark, path).select("security_id", "symbol", "exchange", "strike_price", "lot_size", "isin", "source", "extra_column")


@query("member_file", """SELECT upper(trim(s_name)) AS "SYMBOL", s_suppkey::VARCHAR AS "INDEX_WEIGHT" FROM supplier""")
def member_file(spark, sf_dir):
    path = _fresh(spark, "members")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("  "), F.lower("s_name")).alias("Symbol "), F.col("s_suppkey").alias("index weight"))
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    return S.read_member_list(spark, path).select("SYMBOL", "INDEX_WEIGHT")


@query(
    "vendor_range",
    f"""WITH {DAILY_SQL} SELECT {", ".join(BAR)} FROM bars WHERE event_time::DATE BETWEEN '2024-01-05' AND '2024-01-20' AND security_id IN (SELECT s_suppkey FROM supplier)""",
)
def vendor_range(spark, sf_dir):
    day = lambda d: F.lit(d).cast("date")
    contracts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("security_id"))
    return naive(S.read_vendor_range(daily_bars(spark, sf_dir), contracts, day("2024-01-05"), day("2024-01-20")).select(*BAR), "event_time")


@query("universe_saved", M.ORACLES["universe"])
def universe_saved(spark, sf_dir):
    """A snapshot that is saved twice, and read back as the newest one with its lists and maps."""
    path = _fresh(spark, "universe")
    one = U.resolve_universe(M._universe(spark, sf_dir), M.on())
    S.save_universe_snapshot(one, path)
    S.save_universe_snapshot(one, path)
    return M.flat_universe(S.latest_universe_snapshot(spark, path))


@query(
    "snapshot_load",
    f"""WITH {M.MASTER} SELECT DATE '2024-02-01' AS snapshot_date, count(*) AS row_count, {checksum_sql(**{c: "double" if c == "strike_price" else "" for c in M.COLUMNS})} AS checksum,
    'loaded' AS status FROM master""",
)
def snapshot_load(spark, sf_dir):
    rows = M.master(spark, sf_dir).select(*M.COLUMNS)
    return S.snapshot_log_row(rows, F.lit("2024-02-01").cast("date")).select("snapshot_date", "row_count", "checksum", "status")


@query(
    "manifest_lines",
    f"""WITH {DAILY_SQL}, d AS (SELECT *, CASE WHEN day(event_time) <= 20 THEN 'train' ELSE 'early_stopping' END AS role, 'week-' || (day(event_time) // 7) AS dataset_id FROM bars)
    SELECT string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) AS dataset_ids, string_agg(DISTINCT role, ',' ORDER BY role) AS dataset_roles,
        string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) FILTER (role = 'early_stopping') AS early_stopping_dataset, count_if(role = 'train')::BIGINT AS train_rows,
        (SELECT {checksum_sql(label="", open="double", close="double")} FROM (SELECT (close > open)::INT AS label, open, close FROM d WHERE role = 'train')) AS data_hash, 'open,close' AS features,
        'm1' AS model_id, 'purged_kfold(5)' AS splitter, '1800s' AS purge, 7 AS best_iteration, true AS negative_control_passed, NULL::VARCHAR AS study_id FROM d""",
)
def manifest_lines(spark, sf_dir):
    """The manifest of a training set of bars, written as a line of JSON and read again."""
    path, day = _fresh(spark, "manifest"), F.dayofmonth("event_time")
    rows = daily_bars(spark, sf_dir).withColumns(
        {"role": F.when(day <= 20, "train").otherwise("early_stopping"), "dataset_id": F.concat(F.lit("week-"), F.floor(day / 7).cast("string")), "label": (F.col("close") > F.col("open")).cast("int")}
    )
    one = T.training_manifest(rows, ["open", "close"], model_id="m1", splitter="purged_kfold(5)", purge="1800s", best_iteration=7, negative_control_passed=True)
    S.append_manifest(one, path)
    back = spark.read.schema(one.schema).json(path)
    lists = {c: F.array_join(c, ",") for c in ("dataset_ids", "dataset_roles", "early_stopping_dataset")}
    return back.withColumns(lists).select(*lists, "train_rows", "data_hash", "features", "model_id", "splitter", "purge", "best_iteration", "negative_control_passed", "study_id")


_EVENTS = checksum_sql(event_id="", ts="", user_id="", event_type="", value="double", props="")


@query(
    "fingerprints",
    f"""WITH e AS (SELECT * REPLACE (epoch_us(ts) AS ts) FROM events), c AS (SELECT * REPLACE (value + (event_id % 1000 = 0)::INT AS value) FROM e)
    SELECT count(*) AS rows, {_EVENTS} AS checksum, {_EVENTS} AS shuffled, (SELECT {_EVENTS} FROM c) AS changed FROM e""",
)
def fingerprints(spark, sf_dir):
    """The content's hashes when rows and columns are dealt anew, and when a few values change."""
    df = table(spark, sf_dir, "events")
    one, two = A.dataset_fingerprint(df), A.dataset_fingerprint(df.select(*reversed(df.columns)).repartition("event_type"))
    changed = A.dataset_fingerprint(df.withColumn("value", F.col("value") + (F.col("event_id") % 1000 == 0).cast("int")))
    named = [d.select(F.struct("mixed", "summed", "checksum").alias(n)) for d, n in ((two, "b"), (changed, "c"))]
    whole = one.join(F.broadcast(named[0])).join(F.broadcast(named[1]))  # one row each
    same = (F.col("mixed") == F.col("b.mixed")) & (F.col("summed") == F.col("b.summed"))
    return whole.select("rows", "checksum", F.when(same, F.col("b.checksum")).alias("shuffled"), F.col("c.checksum").alias("changed"))


@query(
    "bar_at",
    f"""WITH {DAILY_SQL}, a AS (SELECT DISTINCT security_id, TIMESTAMP '{AS_OF}' AS moment FROM bars) SELECT a.security_id, moment AS "at", bars.event_time, close
        FROM a ASOF JOIN bars ON a.security_id = bars.security_id AND moment >= bars.event_time""",
)
def bar_at(spark, sf_dir):
    """The newest bar of each security that had begun at a moment."""
    bars = daily_bars(spark, sf_dir)
    asked = bars.select("security_id").distinct().withColumn("at", F.lit(AS_OF).cast("timestamp"))
    return naive(B.bar_at(bars, asked).select("security_id", "at", "event_time", "close"), "at", "event_time")


def _parity_sql(c: str) -> str:
    first = f"""(SELECT count_if(min_a IS DISTINCT FROM min_b) FROM (SELECT min(event_time) FILTER ({c} IS NOT NULL) AS min_a,
        min(event_time) FILTER ({c} IS NOT NULL AND k NOT IN (3, 5) AND (k <> 6 OR late)) AS min_b FROM p GROUP BY security_id))"""
    return f"""SELECT '{c}' AS feature, count_if(k <> 3)::BIGINT AS rows, count_if(k = 3)::BIGINT AS unpaired, count_if(k = 4 AND {c} IS NOT NULL)::BIGINT AS differ,
        count_if((k = 5 OR k = 6 AND NOT late) AND {c} IS NOT NULL)::BIGINT AS null_differ, {first}::BIGINT AS first_differ FROM p"""


@query("parity", f"{_FEATURES}, p AS (SELECT *, security_id % 10 AS k, event_time >= TIMESTAMP '2024-01-10' AS late FROM features) " + " UNION ALL ".join(map(_parity_sql, FEATURES)))
def parity(spark, sf_dir):
    """All features against a copy that lacks some securities, is off for some, null for others, and for some begins later."""
    a = features(spark, sf_dir)
    kind, late = F.col("security_id") % 10, F.col("event_time") >= F.lit("2024-01-10").cast("timestamp")
    keep = (kind != 5) & ((kind != 6) | late)
    b = a.filter(kind != 3).withColumns({c: F.when(kind == 4, F.col(c) + 0.5).when(keep, F.col(c)) for c in FEATURES})
    return X.feature_parity(a, b, FEATURES)


@query(
    "atm_or_lowest",
    f"""WITH {M._ATM}, low AS (SELECT symbol, expiry_date, min(strike) AS low FROM s GROUP BY ALL)
    SELECT symbol, expiry_date, spot, coalesce(atm, low) AS atm, atm IS NULL AS is_fallback FROM low LEFT JOIN (FROM atm WHERE symbol NOT LIKE '%2') USING (symbol, expiry_date)""",
)
def atm_or_lowest(spark, sf_dir):
    """Symbols that end in 2 have no spot; their lowest listed strike stands in."""
    from tickloom.operators import instruments as I

    spot = M._spot(spark, sf_dir).filter("symbol NOT LIKE '%2'")
    return U.select_atm(I.listed_options(M.master(spark, sf_dir), M.on()), spot, fallback=True)


@query(
    "model_input_iv",
    f"""WITH {TICKS_SQL}, v AS (SELECT seq, price / 1000 AS local_iv, volume % 3 = 0 AS converged, CASE WHEN volume % 11 <> 0 THEN price / 900 END AS provider_iv, volume AS age_s, volume % 7 / 100.0 AS spread FROM ticks)
    SELECT seq, CASE WHEN converged AND local_iv > 0 THEN local_iv WHEN provider_iv > 0 AND age_s <= 60 AND spread <= 0.03 THEN provider_iv END AS iv,
        CASE WHEN converged AND local_iv > 0 THEN 'local' WHEN provider_iv > 0 AND age_s <= 60 AND spread <= 0.03 THEN 'provider' ELSE 'none' END AS iv_source FROM v""",
)
def model_input_iv(spark, sf_dir):
    v = F.col("volume")
    rows = ticks(spark, sf_dir).select(
        "seq", (F.col("price") / 1000).alias("local_iv"), (v % 3 == 0).alias("converged"), F.when(v % 11 != 0, F.col("price") / 900).alias("provider_iv"), v.alias("age_s"), (v % 7 / 100).alias("spread")
    )
    return R.model_input_iv(rows, max_age_s=60, max_spread=0.03).select("seq", "iv", "iv_source")


_SILVER = f"""{TICKS_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY security_id, event_time, price, volume ORDER BY seq) > 1 AS is_duplicate,
    epoch(TIMESTAMP '{AS_OF}')::BIGINT - epoch_us(event_time) // 1000000 > 300 AS is_late, price <= 0 OR seq % 50 = 0 OR seq % 31 = 0 AS is_invalid FROM ticks)"""


def _silver(spark, sf_dir) -> str:
    """Ticks of which some have no price and some a negative volume, written as silver."""
    path, t = _fresh(spark, "silver"), ticks(spark, sf_dir)
    odd = t.withColumns({"price": F.when(F.col("seq") % 50 != 0, F.col("price")), "volume": F.when(F.col("seq") % 31 == 0, -1 - F.col("volume")).otherwise(F.col("volume"))})
    S.write_silver(R.silver_flags(odd, F.lit(AS_OF)), path)
    return path


@query(
    "silver_range",
    f"""WITH {_SILVER} SELECT seq, security_id, event_time, is_duplicate, is_late, row_number() OVER (ORDER BY event_time, security_id, seq) - 1 AS position FROM s
    WHERE NOT is_invalid AND event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
)
def silver_range(spark, sf_dir):
    """Ticks of two days, of which alone the files are read, in the order of a replay."""
    at = lambda d: F.lit(d).cast("timestamp")
    found = S.read_silver(spark, _silver(spark, sf_dir), at("2024-01-10"), at("2024-01-12"))
    placed = global_position(found, ["event_time", "security_id", "seq"])
    return naive(placed.select("seq", "security_id", "event_time", "is_duplicate", "is_late", "position"), "event_time")


@query("silver_quarantine", f"WITH {_SILVER} SELECT seq, security_id, event_time, is_late FROM s WHERE is_invalid")
def silver_quarantine(spark, sf_dir):
    return naive(S.read_silver_quarantine(spark, _silver(spark, sf_dir)).select("seq", "security_id", "event_time", "is_late"), "event_time")
