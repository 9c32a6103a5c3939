"""What a stream costs follows its rows: few runs and few keys of state, however many securities there are."""

import datetime as dt

from pyspark.sql import functions as F

from tickloom.plans.live import _stateful
from tickloom.streaming import keyed, stateless


def at(s):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)


def test_more_keys_make_no_more_slices(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 40).alias("security_id"), F.timestamp_seconds(F.col("id")).alias("event_time"))
    seen = []
    stateless.replay(rows, f"{tmp_path}/many", lambda s: s, lambda s, c: seen.append(spark.read.schema(rows.schema).parquet(f"{tmp_path}/many/in").count()), F.col("security_id"), 100)
    assert len(seen) <= 2 and seen[-1] == 2000
    one = []
    stateless.replay(rows, f"{tmp_path}/one", lambda s: s, lambda s, c: one.append(spark.read.schema(rows.schema).parquet(f"{tmp_path}/one/in").count()), F.lit(0), 100)
    assert len(one) > 10 and one[-1] == 2000 and max(b - a for a, b in zip([0, *one], one)) < 300


def test_neighbouring_bars_share_a_state(spark, tmp_path):
    rows = [(i, at(60 * m), 100 * i + m, 1.0 + m, 1, 1, None) for i in range(40) for m in range(10)]
    schema = "security_id long, event_time timestamp, seq long, price double, volume long, trade_sign int, oi long"
    _stateful(spark)
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = keyed.stream_revised_bars(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 60, 86_400, 86_400)
    done = stateless.run_to_end(stream, f"{tmp_path}/checkpoint", "append", f"{tmp_path}/out")
    assert sum(s.numRowsTotal for s in done.lastProgress.stateOperators) < 40
    assert spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").filter("kind = 'bar'").count() == 400
