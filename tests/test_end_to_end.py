"""End to end on the sample day files: single workflow per run date, reruns, empty day, chain."""

import pytest

from kiln.plans.sensor_etl import extract_stage, load_stage, run_daily, transform_stage
from kiln.sinks.warehouse import Warehouse
from kiln.sources.files import scan_raw_json
from tests.fixtures import CLEAN_CSV, RAW_DAYS, write_day_file

REJECTED = {"2026-04-08": 2, "2026-04-09": 2, "2026-04-10": 2, "2026-04-12": 3}


@pytest.fixture()
def landed(tmp_path):
    folders = {}
    for day in RAW_DAYS:
        f = tmp_path / "landing" / f"ds={day}"
        f.mkdir(parents=True)
        write_day_file(f, day)
        folders[day] = str(f)
    return folders


def _per_day(wh):
    return {str(r.reading_date): r["count"] for r in wh.sensor_readings().groupBy("reading_date").count().collect()}


def test_daily_runs_load_the_31_clean_rows_and_rerun_is_idempotent(spark, tmp_path, landed):
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    for _ in range(2):
        for day, folder in landed.items():
            audit = run_daily(spark, folder, day, str(tmp_path / "work"), wh)
            assert audit.rows_rejected == REJECTED[day]
            assert audit.rows_inserted == 10 - REJECTED[day]
            assert audit.rows_out_of_day == 0
    assert _per_day(wh) == {d: 10 - r for d, r in REJECTED.items()}
    got = sorted((r.sensor_id, str(r.reading_date), round(r.temperature_f, 3)) for r in wh.sensor_readings().collect())
    want = sorted(
        (line.split(",")[0], day, round(float(line.split(",")[4]), 3))
        for day, text in CLEAN_CSV.items() for line in text.strip().splitlines()[1:]
    )
    assert got == want


def test_empty_day_file_empties_the_day(spark, tmp_path, landed):
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    for day, folder in landed.items():
        run_daily(spark, folder, day, str(tmp_path / "work"), wh)
    empty = tmp_path / "empty" / "ds=2026-04-09"
    empty.mkdir(parents=True)
    (empty / "sensor_data_20260409.json").write_text("")
    assert scan_raw_json(spark, str(empty)).count() == 0
    audit = run_daily(spark, str(empty), "2026-04-09", str(tmp_path / "work"), wh)
    assert (audit.rows_in, audit.rows_deleted) == (0, 8)
    assert "2026-04-09" not in _per_day(wh)
    assert sum(_per_day(wh).values()) == 23


def test_chain_stages_hand_over_paths(spark, tmp_path, landed):
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    raw = scan_raw_json(spark, str(tmp_path / "landing")).drop("ds")
    raw_path = extract_stage(raw, str(tmp_path / "chain" / "raw"), "2026-04-12")
    assert raw_path.endswith("ds=2026-04-12")
    metrics = {}
    csv_path = transform_stage(spark, raw_path, str(tmp_path / "chain" / "clean"), "2026-04-12", metrics=metrics)
    assert metrics == {"rows_raw": 40, "rows_clean": 31}  # the whole landing went into this run's file
    audit = load_stage(spark, csv_path, wh, "2026-04-12")
    assert audit.rows_in == 31 and audit.rows_out_of_day == 24  # other days' rows are appended, as in the reference
    assert _per_day(wh) == {d: 10 - r for d, r in REJECTED.items()}


def test_quarantine_sink_keeps_the_rejected_readings(spark, tmp_path, landed):
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    for day, folder in landed.items():
        run_daily(spark, folder, day, str(tmp_path / "work"), wh, keep_quarantine=True)
    q = spark.read.parquet(str(tmp_path / "work" / "sensor_daily" / "quarantine"))
    got = {(str(r.ds), r.sensor_id): (r.temperature, r.reject_reason) for r in q.collect()}
    assert len(got) == sum(REJECTED.values()) == 9
    assert got[("2026-04-12", "SENSOR_9")] == (144.46, "over_limit")
    assert wh.sensor_readings().count() == 31
