"""Instruments, contracts, universe, audits, splits and tables on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import audit as A
from tickloom.operators import contracts as K
from tickloom.operators import instruments as I
from tickloom.operators import universe as U
from tickloom.operators import validation as V
from tickloom.operators.order import global_position
from tickloom.sources import tables as S

D = dt.date


def day(text):
    return F.lit(text).cast("date")


def strikes(spark, values):
    return spark.createDataFrame([("X", D(2026, 7, 30), float(v)) for v in values], "symbol string, expiry_date date, strike double")


@pytest.mark.parametrize("spot,atm", [(1445.0, 1450.0), (1453.0, 1450.0), (1460.0, 1460.0)])
def test_atm(spark, spot, atm):
    df = strikes(spark, range(1000, 2001, 10))
    chosen = U.select_atm(df, spark.createDataFrame([("X", spot)], "symbol string, spot double"))
    assert chosen.first()["atm"] == atm
    around = U.strikes_around_atm(df, chosen)
    assert around.count() == 11 and K.build_contracts(around).count() == 22
    assert U.strikes_around_atm(df, chosen.withColumn("atm", F.lit(1005.0))).count() == 7


def test_expiry_formats(spark):
    texts = ["2026-07-30", "30-07-2026", "30/07/2026", "30 Jul 2026", "30-Jul-2026", "2026-07-30 14:30:00", "soon", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(I.parse_expiry(F.col("t"))).collect()]
    assert got == [D(2026, 7, 30)] * 6 + [None, None]


def test_keys_round_trip(spark):
    df = spark.createDataFrame([("X", "SYM", D(2026, 7, 30), 1500.0, "CE"), ("X", "SYM", D(2026, 7, 30), 12345678.25, "PE")], "exchange string, symbol string, expiry_date date, strike_price double, option_type string")
    keyed = K.contract_key(df)
    assert [r["contract_key"] for r in keyed.collect()] == ["X|SYM|2026-07-30|1500.0|CE", "X|SYM|2026-07-30|12345678.25|PE"]
    back = [r["parsed"] for r in K.parse_contract_key(keyed).collect()]
    assert [tuple(b) for b in back] == [tuple(r) for r in df.collect()]
    broken = spark.createDataFrame([("a|b",), ("X|S|soon|1|CE",), ("X|S|2026-07-30|high|CE",), (None,)], "contract_key string")
    assert all(r["parsed"] is None for r in K.parse_contract_key(broken).collect())


def test_scd2(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "security_id long, checksum string").withColumns({"valid_from": day("2024-01-01"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    new = spark.createDataFrame([(1, "b"), (2, "a"), (4, "a")], "security_id long, checksum string")
    got = sorted((r["security_id"], r["checksum"], r["is_current"], r["valid_to"]) for r in I.scd2_merge(old, new, day("2024-02-01")).collect())
    end = D(2024, 2, 1)
    assert got == [(1, "a", False, end), (1, "b", True, None), (2, "a", True, None), (3, "a", False, end), (4, "a", True, None)]
    merged = I.scd2_merge(old, new, day("2024-02-01"))
    assert I.duplicate_keys(merged.filter("is_current"), ["security_id"]).count() == 0
    assert I.overlapping_validity(merged, "security_id", "valid_from", "valid_to").count() == 0
    assert I.latest_valid_at(merged, day("2024-02-01")).filter("security_id = 1").first()["checksum"] == "b"


def test_strike_interval_of_one_strike(spark):
    df = spark.createDataFrame([("X", D(2026, 7, 30), 100.0, "OPTSTK"), ("Y", D(2026, 7, 30), 1.0, "OPTSTK"), ("Y", D(2026, 7, 30), 2.0, "OPTSTK"), ("Y", D(2026, 7, 30), 4.0, "OPTSTK")], "symbol string, expiry_date date, strike_price double, instrument_type string")
    assert {r["symbol"]: r["strike_interval"] for r in I.strike_interval(df).collect()} == {"X": 10.0, "Y": 1.0}


def test_validation_reasons(spark):
    df = spark.createDataFrame([("NSE", "ABC", 1, D(2026, 1, 1), "CE", 5.0), ("XXX", "M&M", -1, D(1999, 1, 1), "XX", 0.0), (None,) * 6], "exchange string, symbol string, security_id long, expiry_date date, option_type string, strike_price double")
    got = [r["reasons"] for r in K.validate_contracts(df).collect()]
    everything = ["exchange", "option_type", "strike", "expiry", "security_id", "symbol"]
    assert got == [[], everything, everything]


def test_membership(spark):
    added = spark.createDataFrame([("A", D(2015, 1, 1)), ("A", D(2020, 1, 1)), ("B", D(2016, 1, 1))], "symbol string, effective_from date")
    excluded = spark.createDataFrame([("A", D(2018, 1, 1)), ("C", D(2017, 1, 1))], "symbol string, excluded_from date")
    built = U.build_membership(added, excluded)
    on = lambda d: sorted(r["symbol"] for r in U.members_at(built, day(d)).collect())
    assert on("2018-01-01") == ["A", "B"] and on("2018-01-02") == ["B"] and on("2021-01-01") == ["A", "B"] and on("2017-01-01") == ["A", "B", "C"]


@pytest.mark.parametrize("fails,verdict", [(0, "APPROVED"), (3, "LIMITED"), (4, "QUARANTINED"), (6, "QUARANTINED"), (7, "REJECTED")])
def test_verdict_borders(spark, fails, verdict):
    report = spark.createDataFrame([(f"c{i}", i >= fails) for i in range(14)], "check string, passed boolean")
    assert A.audit_verdict(report, "v").first()["verdict"] == verdict


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    assert A.dataset_fingerprint(df).first() == A.dataset_fingerprint(df.orderBy(F.desc("id")).select("x", "id")).first()
    assert A.dataset_fingerprint(df).first() != A.dataset_fingerprint(df.filter("id > 0")).first()


def test_global_position(spark):
    got = global_position(spark.range(1000).repartition(7), ["id"]).collect()
    assert all(r["position"] == r["id"] and r["n_rows"] == 1000 for r in got)


def test_roles(spark):
    df = lambda *roles: spark.createDataFrame([(f"d{i}", r) for i, r in enumerate(roles)], "dataset_id string, role string")
    V.assert_roles(df("train", "early_stopping"), "training")
    V.assert_roles(df("train", "early_stopping"), "eval_set")
    for roles, purpose in [(("final_vault",), "training"), (("outer_test",), "training"), (("calibration", "early_stopping"), "eval_set"), (("train",), "eval_set"), (("odd",), "training")]:
        with pytest.raises(V.LeakageError):
            V.assert_roles(df(*roles), purpose)


def events(spark, n, start=0):
    rows = spark.range(start, start + n).withColumnRenamed("id", "row_id")
    return rows.withColumn("prediction_time", F.timestamp_seconds(F.col("row_id") * 60)).withColumn("evaluation_time", F.timestamp_seconds(F.col("row_id") * 60 + 1800))


def test_leakage_is_found(spark):
    assert V.temporal_leakage(events(spark, 300), events(spark, 300, 200)).count() == 300 - 170
    assert V.temporal_leakage(events(spark, 100), events(spark, 100, 200)).count() == 0
    with pytest.raises(V.LeakageError):
        V.event_intervals(events(spark, 3).withColumn("evaluation_time", F.lit(None).cast("timestamp")))


def test_purged_folds_do_not_leak(spark):
    folded = V.purged_kfold(events(spark, 502), 5, 0, 600)
    sizes = {(r["fold"], r["role"]): r["count"] for r in folded.groupBy("fold", "role").count().collect()}
    assert [sizes[f, "test"] for f in range(5)] == [101, 101, 100, 100, 100]
    for f in range(5):
        own = folded.filter(F.col("fold") == f)
        assert V.temporal_leakage(own.filter("role = 'train'"), own.filter("role = 'test'")).isEmpty()


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 3 + [(0.0, 0.0)] * 4 + [(1.0, 0.0)] * 2 + [(0.0, 1.0)], "prediction double, label double")
    r = V.classification_metrics(df).first()
    assert (r["accuracy"], round(r["balanced_accuracy"], 6), round(r["mcc"], 6)) == (0.7, 0.708333, 0.408248)


def test_tables_round_trip(spark, tmp_path):
    path = f"{tmp_path}/master.csv"
    with open(path, "w") as f:
        f.write("SECURITY_ID,SYMBOL_NAME,EXCH_ID,INSTRUMENT,STRIKE_PRICE,LOT_SIZE,Extra Col\n1,abc,,OPTSTK,bad,5,z\n2,def,BSE,EQUITY,10.5,,y\n")
    got = S.read_instrument_master(spark, path).orderBy("security_id").collect()
    assert [(r["exchange"], r["strike_price"], r["lot_size"], r["extra_col"], r["isin"], r["source"]) for r in got] == [("NSE", 0.0, 5, "z", "", "NSE"), ("BSE", 10.5, 0, "y", "", "NSE")]
    with open(f"{tmp_path}/members.csv", "w") as f:
        f.write("﻿Company Name, symbol \nx, abc \n")
    assert S.read_member_list(spark, f"{tmp_path}/members.csv").first()["SYMBOL"] == "ABC"


def test_bronze_and_quarantine(spark, tmp_path):
    from tickloom.sources.schemas import ENVELOPE, PACKETS

    ns = 1_704_110_400_000_000_000
    decoded = F.from_json(F.lit('{"security_id": 8, "ltp": 2.5, "day_open": 2.0, "last_trade_qty": 4, "packet_type": "quote"}'), PACKETS)
    events = spark.createDataFrame([(1, "e", "c", 1, 0, ns, None, 4, 7, 2, bytearray(b"\xab"), "h", "2", "success", "{}")], ENVELOPE).withColumn("decoded", decoded)
    S.write_bronze(events, f"{tmp_path}/bronze")
    row = S.read_bronze(spark, f"{tmp_path}/bronze", ["2024-01-01"]).first()
    assert (row["security_id"], row["mode"], row["ltp"], row["open"], row["last_trade_volume"]) == (8, "quote", 2.5, 2.0, 4)
    assert S.read_bronze(spark, f"{tmp_path}/bronze", ["2024-01-02"]).count() == 0
    assert S.bronze_to_ticks(S.read_bronze(spark, f"{tmp_path}/bronze")).first()["price"] == 2.5
    S.write_quarantine(events, f"{tmp_path}/failed")
    assert S.read_quarantine(spark, f"{tmp_path}/failed").first()["raw_payload_hex"] == "ab"


def test_snapshots(spark, tmp_path):
    contracts = K.contract_key(K.build_contracts(strikes(spark, [100, 110])).withColumns({"exchange": F.lit("NSE"), "strike_price": F.col("strike"), "atm": F.lit(100.0)}))
    one = U.resolve_universe(contracts, day("2026-07-01"))
    path = f"{tmp_path}/universe"
    S.save_universe_snapshot(one, path)
    S.save_universe_snapshot(one, path)
    assert S.universe_snapshots(spark, path).count() == 1
    back = S.latest_universe_snapshot(spark, path).first()
    assert back["contract_count"] == 4 and len(back["contracts"]) == 4 and back["atm_strikes"] == {"X": 100.0}
    assert S.snapshot_log_row(contracts, day("2026-07-01")).first()["row_count"] == 4
    S.append_manifest(one.select("universe_snapshot_id"), f"{tmp_path}/manifest")
    assert spark.read.json(f"{tmp_path}/manifest").count() == 1


def test_scalars(spark):
    from tickloom.functions.scalars import config_hash, short_id

    a, b = (F.create_map(*[F.lit(x) for kv in pairs for x in kv]) for pairs in ([("x", "1"), ("y", "2")], [("y", "2"), ("x", "1")]))
    row = spark.range(1).select(config_hash(a).alias("a"), config_hash(b).alias("b"), short_id(F.lit(1), F.lit("u")).alias("s")).first()
    assert row["a"] == row["b"] and len(row["a"]) == 16 and len(row["s"]) == 8
