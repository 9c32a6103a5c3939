"""Leakage over all rows of a table, by brute force."""

from datetime import datetime, timedelta

import __spark_entry__ as entry

START = datetime(2024, 1, 1)
#: (security_id, hours after the start): the tests are securities 3, 7 and 51, of which the last alone is 1 mod 50.
EVENTS = [(2, 0), (3, 2), (2, 20), (7, 23), (4, 40), (51, 40), (6, 70), (9, 80), (8, 81)]


def test_leakage_whole(spark, tmp_path):
    rows = [(i, START + timedelta(hours=h), s, "view", 1.0, '{"k": 10}') for i, (s, h) in enumerate(EVENTS)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    hold = timedelta(minutes=330)
    even, odd = ([r for r in rows if r[2] % 2 == k] for k in (0, 1))
    want = {a[0] for a in even if any(a[1] <= b[1] + hold and a[1] + hold >= b[1] for b in odd)}
    assert want == {0, 2, 4, 8}
    assert {r["row_id"] for r in entry.queries()["leakage_pairs"](spark, str(tmp_path)).collect()} == want
