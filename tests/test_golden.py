"""Golden pairs: day file -> S1 -> S7 -> S8 (-> S3 text) equals the sample clean CSV."""

import glob

import pytest

from kiln.plans.sensor_etl import CLEAN_COLUMNS, transform
from kiln.sinks.files import write_clean_csv
from kiln.sources.files import read_clean_csv, scan_raw_json
from tests.fixtures import CLEAN_CSV, RAW_DAYS, write_day_file


def _expected_rows(day):
    lines = CLEAN_CSV[day].strip().splitlines()[1:]
    out = []
    for line in lines:
        sid, ts, t, st, tf = line.split(",")
        out.append((sid, ts, float(t), st, float(tf)))
    return sorted(out)


@pytest.mark.parametrize("day", sorted(RAW_DAYS))
def test_day_file_to_clean_rows(spark, tmp_path, day):
    path = write_day_file(tmp_path, day)
    raw = scan_raw_json(spark, path)
    assert raw.count() == 10
    got = sorted(
        (r.sensor_id, r.timestamp.strftime("%Y-%m-%d %H:%M:%S"), r.temperature, r.status, r.temperature_f)
        for r in transform(raw).collect()
    )
    assert got == _expected_rows(day)  # exact floats, incl. 82.79599999999999


def test_multiline_array_and_all_days(spark, tmp_path):
    for day in RAW_DAYS:
        write_day_file(tmp_path, day)
    df = scan_raw_json(spark, str(tmp_path))
    assert df.count() == 40
    assert df.where("sensor_id IS NULL OR timestamp IS NULL OR temperature IS NULL").count() == 0
    assert transform(df).count() == 31
    # a pretty-printed array needs multiLine
    pretty = tmp_path / "pretty"
    pretty.mkdir()
    import json

    from tests.fixtures import raw_records

    (pretty / "p.json").write_text(json.dumps(raw_records("2026-04-08"), indent=2))
    assert scan_raw_json(spark, str(pretty), multi_line=True).count() == 10


def test_clean_csv_text_matches_samples(spark, tmp_path):
    for day in RAW_DAYS:
        write_day_file(tmp_path, day)
    clean = transform(scan_raw_json(spark, str(tmp_path))).select(*CLEAN_COLUMNS)
    out = str(tmp_path / "clean")
    write_clean_csv(clean, out)
    for day in RAW_DAYS:
        files = glob.glob(f"{out}/ds={day}/*.csv")
        lines = set()
        for f in files:
            lines.update(open(f).read().strip().splitlines())
        assert lines == set(CLEAN_CSV[day].strip().splitlines())
    # S4 reads it back typed
    back = read_clean_csv(spark, out)
    assert back.count() == 31
    assert dict(back.dtypes)["timestamp"] == "timestamp_ntz"
    assert "2026-04-11" not in {str(r.ds) for r in back.select("ds").distinct().collect()}


def test_run_date_from_file_names(spark, tmp_path):
    for day in RAW_DAYS:
        write_day_file(tmp_path, day)
        (tmp_path / f"preprocessing_data_{day.replace('-', '')}.csv").write_text(CLEAN_CSV[day])
    raw = scan_raw_json(spark, str(tmp_path / "*.json"), with_file_date=True)
    per_day = {str(r.file_date): r["count"] for r in raw.groupBy("file_date").count().collect()}
    assert per_day == {d: 10 for d in RAW_DAYS}
    assert raw.where("to_date(timestamp) <> file_date").count() == 0
    clean = read_clean_csv(spark, str(tmp_path / "*.csv"), with_file_date=True)
    assert clean.count() == 31 and clean.where("file_date IS NULL").count() == 0


def test_malformed_lines_are_not_lost(spark, tmp_path):
    from kiln.operators.sensor import quarantine

    (tmp_path / "day.json").write_text(
        '{"sensor_id": "SENSOR_1", "timestamp": "2026-04-08 10:00:00", "temperature": 50.5, "status": "on"}\n'
        '{"sensor_id": "SENSOR_2", "timestamp": "2026-04-08 10:00:00", "temperature": \n'
        '{"sensor_id": "SENSOR_3", "timestamp": "2026-04-08 10:00:00.250000", "temperature": 101.0, "status": "on"}\n'
    )
    raw = scan_raw_json(spark, str(tmp_path / "day.json"))
    assert raw.count() == 3
    assert transform(raw).count() == 1
    reasons = sorted(r.reject_reason for r in quarantine(raw).collect())
    assert reasons == ["missing", "over_limit"]
    assert raw.where("sensor_id = 'SENSOR_3'").first().timestamp.microsecond == 250000
