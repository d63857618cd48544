"""S17: a run hands over its own batch; no value is cut on the way."""

import os

import pytest
from pyspark.sql import functions as F

from kiln.plans.sensor_etl import extract_stage, load_stage, run_chain, run_daily, transform_stage
from kiln.sinks.files import land_raw, write_clean_csv
from kiln.sinks.manifest import HandoffError, check, seal
from kiln.sinks.warehouse import Warehouse
from kiln.sources.files import read_clean_csv, scan_raw_json

GOOD = '{"sensor_id": "%s", "timestamp": "%s", "temperature": %s, "status": "on"}\n'


def _rows(spark, tmp_path, *rows):
    f = tmp_path / f"in{len(list(tmp_path.iterdir()))}.json"
    f.write_text("".join(GOOD % r for r in rows))
    return scan_raw_json(spark, str(f))


def _days(wh):
    return {str(r.reading_date): r["count"] for r in wh.sensor_readings().groupBy("reading_date").count().collect()}


@pytest.mark.parametrize("handoff", ["parquet", "text"])
def test_runs_do_not_see_each_other(spark, tmp_path, handoff):
    wh, root = Warehouse(spark, root=str(tmp_path / "wh")), str(tmp_path / "root")
    one = _rows(spark, tmp_path, ("A", "2026-04-08 10:00:00", 1.0))
    two = _rows(spark, tmp_path, ("B", "2026-04-09 10:00:00", 2.0))
    run_chain(spark, one, root, wh, mode="append", handoff=handoff)
    run_chain(spark, two, root, wh, mode="append", handoff=handoff)
    assert _days(wh) == {"2026-04-08": 1, "2026-04-09": 1}
    # a day of which every reading is over the limit now: emptied, and only that day
    hot = _rows(spark, tmp_path, ("A", "2026-04-08 10:00:00", 150.0))
    audit = run_chain(spark, hot, root, wh, handoff=handoff, keep_quarantine=True)
    assert _days(wh) == {"2026-04-09": 1} and audit.rows_rejected == 1


def test_fractions_spaces_and_iso_text(spark, tmp_path):
    raw = _rows(spark, tmp_path, (" S1 ", "2026-04-08T10:00:00.25", 1.5), ("S2", "2026-04-08 10:00:00", 2.5), ("S3", "2026-04-08T10:00:00.123456", 3.5))
    landed = scan_raw_json(spark, land_raw(raw, str(tmp_path / "raw")))
    want = sorted((r.sensor_id, str(r.timestamp)) for r in raw.collect())
    assert want == [(" S1 ", "2026-04-08 10:00:00.250000"), ("S2", "2026-04-08 10:00:00"), ("S3", "2026-04-08 10:00:00.123456")]
    assert sorted((r.sensor_id, str(r.timestamp)) for r in landed.collect()) == want
    from kiln.plans.sensor_etl import CLEAN_COLUMNS, transform

    back = read_clean_csv(spark, write_clean_csv(transform(raw).select(*CLEAN_COLUMNS), str(tmp_path / "csv")))
    assert sorted((r.sensor_id, str(r.timestamp)) for r in back.collect()) == want


def test_bad_records_are_quarantined_and_never_loaded(spark, tmp_path):
    day = tmp_path / "day.json"
    day.write_text(GOOD % ("A", "2026-04-08 10:00:00", 1.0) + GOOD % ("B", "08.04.2026", 2.0) + '{"sensor_id": "C", "temp\n'
                   + '{"sensor_id": "D", "temperature": 3.0}\n' + GOOD % ("E", "2026-04-08 11:00:00", 101.0))
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    for _ in range(2):
        audit = run_daily(spark, str(day), "2026-04-08", str(tmp_path / "work"), wh, keep_quarantine=True)
    assert (audit.rows_inserted, audit.rows_rejected) == (1, 4) and _days(wh) == {"2026-04-08": 1}
    q = spark.read.parquet(str(tmp_path / "work" / "sensor_daily" / "quarantine")).collect()
    assert sorted(r.reject_reason for r in q) == ["bad_timestamp", "malformed", "no_timestamp", "over_limit"]
    assert '{"sensor_id": "C", "temp' in {r["_corrupt_record"] for r in q}


def test_run_dates_from_file_names(spark, tmp_path):
    """Rows keyed by their file's date: the hand-off folders follow the files, the table follows the rows."""
    import os

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "sensor_data_20260409.json").write_text(GOOD % ("A", "2026-04-08 23:59:59", 1.0) + GOOD % ("B", "2026-04-09 10:00:00", 2.0))
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    run_chain(spark, scan_raw_json(spark, str(landing), with_file_date=True), str(tmp_path / "root"), wh, run_id="r")
    folders = os.listdir(tmp_path / "root" / "sensor_chain" / "raw" / "run=r")
    assert [f for f in folders if f.startswith("ds=")] == ["ds=2026-04-09"]
    assert _days(wh) == {"2026-04-08": 1, "2026-04-09": 1}
    run_chain(spark, scan_raw_json(spark, str(landing), with_file_date=True), str(tmp_path / "root"), wh)
    assert _days(wh) == {"2026-04-08": 2, "2026-04-09": 1}  # the stray row is appended again, as in the reference


def test_multi_day_writes_leave_few_files(spark, tmp_path):
    import os

    rows = spark.range(600).selectExpr(
        "concat('S', id) AS sensor_id", "timestamp_ntz'2026-04-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 30 AS INT)) AS timestamp",
        "CAST(1 AS DOUBLE) AS temperature", "'on' AS status").repartition(20)
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    from kiln.operators.sensor import to_fahrenheit

    wh.load_append(to_fahrenheit(rows))
    land_raw(rows, str(tmp_path / "raw"))
    for top, end in ((tmp_path / "wh" / "sensor_readings", ".parquet"), (tmp_path / "raw", ".json")):
        files = [f for _, _, fs in os.walk(top) for f in fs if f.endswith(end)]
        assert len(files) <= 60


def test_staging_is_removed(spark, tmp_path):
    import glob

    from kiln.session import shared_dir

    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/kiln/stage-*"))
    from kiln.operators.sensor import to_fahrenheit

    wh.load_overwrite_day(to_fahrenheit(_rows(spark, tmp_path, ("A", "2026-04-08 10:00:00", 1.0))), "2026-04-08")
    assert set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/kiln/stage-*")) == before and _days(wh) == {"2026-04-08": 1}


def _files(top):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(top) for f in fs
                  if f.startswith("part-") and os.path.basename(d) != "_manifest")


def _cut(path, keep):
    """A file that was not written to its end; Spark's local file system keeps a checksum beside it."""
    with open(path, "rb") as f:
        head = f.read()[:keep]
    with open(path, "wb") as f:
        f.write(head)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


@pytest.mark.parametrize("raw_fmt,fmt", [("json", "csv"), ("parquet", "parquet")])
@pytest.mark.parametrize("harm", ["none", "cut", "lost", "added"])
def test_a_hand_off_that_disagrees_is_refused(spark, tmp_path, raw_fmt, fmt, harm):
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    rows = _rows(spark, tmp_path, *[(f"S{k}", f"2026-04-{8 + k % 3:02} 10:00:00", float(k)) for k in range(30)])
    raw = extract_stage(rows, str(tmp_path / "raw"), fmt=raw_fmt, manifest="rows")
    assert check(spark, raw, raw_fmt) == 30
    clean = transform_stage(spark, raw, str(tmp_path / "clean"), raw_fmt=raw_fmt, fmt=fmt, manifest="rows")
    one = _files(clean)[0]
    if harm == "cut":
        _cut(one, os.path.getsize(one) // 2)
    elif harm == "lost":
        os.remove(one)
    elif harm == "added":
        with open(one, "rb") as f, open(os.path.join(os.path.dirname(one), "part-99999.more"), "wb") as g:
            g.write(f.read())
    if harm == "none":
        assert load_stage(spark, clean, wh, fmt=fmt, manifest="rows").rows_inserted == 30
        return
    with pytest.raises(Exception) as e:  # noqa: PT011 - half a Parquet file fails in its reader already
        load_stage(spark, clean, wh, fmt=fmt)
    assert isinstance(e.value, HandoffError) or (harm, fmt) == ("cut", "parquet")
    assert wh.sensor_readings().count() == 0


def test_manifest_sees_changed_rows_and_missing_seals(spark, tmp_path):
    raw = land_raw(_rows(spark, tmp_path, ("A", "2026-04-08 10:00:00", 1.5)), str(tmp_path / "raw"), "2026-04-08")
    with pytest.raises(HandoffError, match="no manifest"):
        check(spark, raw, "json", required=True)
    assert check(spark, raw, "json") is None
    seal(spark, raw, "json", checksum=True)
    one = _files(raw)[0]
    text = open(one).read()
    _cut(one, 0)
    with open(one, "w") as f:
        f.write(text.replace("1.5", "1.6"))  # same length, same number of rows
    with pytest.raises(HandoffError, match="became"):
        check(spark, raw, "json")


def test_manifest_of_an_empty_batch(spark, tmp_path):
    none = _rows(spark, tmp_path, ("A", "2026-04-08 10:00:00", 1.5)).where(F.lit(False))
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    for handoff in ("parquet", "text"):
        for ds in (None, "2026-04-08"):
            audit = run_chain(spark, none, str(tmp_path / "root"), wh, ds, handoff=handoff, manifest="files")
            assert audit.rows_in == 0
