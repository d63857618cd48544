import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import sensor
from kiln.schemas import RAW_READING

EDGES = [99.99, 100.0, 100.01, None, float("nan"), 28.22, -5.0]


def _raw(spark, temps, ts="2026-04-08 10:00:00"):
    import datetime as dt

    t = dt.datetime.fromisoformat(ts)
    rows = [(f"SENSOR_{i}", t, v, "on") for i, v in enumerate(temps)]
    return spark.createDataFrame(rows, RAW_READING)


def test_filter_is_strict_and_drops_null_nan(spark):
    df = _raw(spark, EDGES)
    kept = sorted(r.temperature for r in sensor.filter_normal(df).collect())
    assert kept == [-5.0, 28.22, 99.99]


def test_quarantine_is_the_complement(spark):
    df = _raw(spark, EDGES)
    q = sensor.quarantine(df)
    reasons = {(r.temperature if r.temperature is None or not math.isnan(r.temperature) else "nan"): r.reject_reason for r in q.collect()}
    assert reasons == {100.0: "over_limit", 100.01: "over_limit", None: "missing", "nan": "not_a_number"}
    assert sensor.filter_normal(df).count() + q.count() == df.count()


def test_fahrenheit_keeps_the_order_of_operations(spark):
    r = sensor.to_fahrenheit(_raw(spark, [28.22])).first()
    assert r.temperature_f == 82.79599999999999
    from tests.fixtures import RAW_DAYS

    temps = [t for _, ts in RAW_DAYS.values() for t in ts if t < 100]
    assert sum(t * 9 / 5 + 32 != t * 1.8 + 32 for t in temps) > 0  # the reordered form differs on some


def test_project_target_narrows_and_dates(spark):
    df = sensor.project_target(sensor.to_fahrenheit(_raw(spark, [91.71])))
    assert df.columns == ["sensor_id", "timestamp", "temperature_c", "temperature_f", "reading_date"]
    assert dict(df.dtypes)["temperature_c"] == "float"
    r = df.first()
    assert str(r.reading_date) == "2026-04-08"


def test_day_and_trailing_days(spark):
    import datetime as dt

    rows = [("S", dt.datetime(2024, 1, d, 12), 1.0, "on") for d in range(1, 31)]
    df = sensor.project_target(sensor.to_fahrenheit(spark.createDataFrame(rows, RAW_READING)))
    assert sensor.day(df, "2024-01-15").count() == 1
    assert sensor.day(df, "2024-01-15", None).count() == 1
    got = sorted(r.reading_date.day for r in sensor.trailing_days(df, "2024-01-15", 7).collect())
    assert got == list(range(8, 16))


def test_day_on_partition_column_prunes(spark, tmp_path):
    import datetime as dt

    rows = [("S", dt.datetime(2024, 1, d, 12), 1.0, "on") for d in range(1, 5)]
    df = sensor.project_target(sensor.to_fahrenheit(spark.createDataFrame(rows, RAW_READING)))
    df.write.partitionBy("reading_date").parquet(str(tmp_path / "t"))
    plan = sensor.day(spark.read.parquet(str(tmp_path / "t")), "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan


def test_dense_ids_equal_global_row_number_at_any_partitioning(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    # many ties on the leading column: order by a coarse key + tiebreak
    df = ev.select("event_id", F.date_trunc("hour", "ts").alias("hour"), "value")
    want = {
        r.event_id: r.rn
        for r in df.withColumn("rn", F.row_number().over(Window.orderBy("hour", "event_id"))).collect()
    }
    for n in (1, 4, 32):
        got = {r.event_id: r.id for r in sensor.dense_ids(df, ["hour", "event_id"], num_partitions=n).collect()}
        assert got == want, n
    shifted = sensor.dense_ids(df, ["hour", "event_id"], start=100)
    assert shifted.agg(F.min("id"), F.max("id")).first() == (101, 100 + df.count())
