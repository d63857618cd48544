"""T1: file-stream ingest; rerun adds nothing, a new file for an old day adds rows."""

import json

from kiln.streaming.ingest import read_ingested, stream_ingest
from tests.fixtures import RAW_DAYS, raw_records, write_day_file


def test_stream_ingest_once_and_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for day in ("2026-04-08", "2026-04-09"):
        write_day_file(landing, day)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    stream_ingest(spark, str(landing), sink, ck)
    assert read_ingested(spark, sink).count() == 16
    stream_ingest(spark, str(landing), sink, ck)  # rerun: nothing new
    assert read_ingested(spark, sink).count() == 16
    write_day_file(landing, "2026-04-10")
    late = [dict(r, sensor_id="LATE_" + r["sensor_id"]) for r in raw_records("2026-04-08")]
    (landing / "sensor_data_20260408_late.json").write_text(json.dumps(late))
    stream_ingest(spark, str(landing), sink, ck)
    df = read_ingested(spark, sink)
    assert df.count() == 16 + 8 + 8
    assert df.where("reading_date = DATE'2026-04-08'").count() == 16
    from kiln.streaming.ingest import read_stream_audit

    audit = read_stream_audit(spark, sink).agg({"rows_in": "sum", "rows_inserted": "sum", "rows_rejected": "sum"}).first()
    assert (audit["sum(rows_in)"], audit["sum(rows_inserted)"], audit["sum(rows_rejected)"]) == (40, 32, 8)
    assert read_stream_audit(spark, sink).select("query").distinct().count() == 1
    assert set(RAW_DAYS) >= {str(r.reading_date) for r in df.select("reading_date").distinct().collect()}


def test_stream_archives_processed_files(spark, tmp_path):
    import os

    landing = tmp_path / "landing"
    landing.mkdir()
    write_day_file(landing, "2026-04-08")
    write_day_file(landing, "2026-04-09")
    sink, ck, archive = str(tmp_path / "sink"), str(tmp_path / "ck"), str(tmp_path / "archive")
    stream_ingest(spark, str(landing), sink, ck, archive_dir=archive)
    write_day_file(landing, "2026-04-10")
    stream_ingest(spark, str(landing), sink, ck, archive_dir=archive)  # archives the first run's files
    assert read_ingested(spark, sink).count() == 24
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".json")]
    assert len(archived) >= 2


def test_old_dated_file_is_taken(spark, tmp_path):
    import os
    import time

    landing = tmp_path / "landing"
    landing.mkdir()
    write_day_file(landing, "2026-04-09")
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    stream_ingest(spark, str(landing), sink, ck)
    old = write_day_file(landing, "2026-04-08")
    then = time.time() - 30 * 86400
    os.utime(old, (then, then))
    stream_ingest(spark, str(landing), sink, ck)
    assert read_ingested(spark, sink).count() == 16


def test_second_query_adds_to_the_sink_and_warns(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for k, day in enumerate(("2026-04-08", "2026-04-09")):
        landing = tmp_path / f"landing{k}"
        landing.mkdir()
        write_day_file(landing, day)
        stream_ingest(spark, str(landing), sink, str(tmp_path / f"ck{k}"))
    rows = read_ingested(spark, sink)
    assert {str(r.reading_date) for r in rows.collect()} == {"2026-04-08", "2026-04-09"} and rows.count() == 16


def test_all_rejected_sink_reads_as_no_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "d.json").write_text('{"sensor_id": "A", "timestamp": "2026-04-08 10:00:00", "temperature": 500.0, "status": "on"}\n')
    sink = str(tmp_path / "sink")
    stream_ingest(spark, str(landing), sink, str(tmp_path / "ck"))
    assert read_ingested(spark, sink).count() == 0


def test_publish_ingested_into_the_warehouse(spark, tmp_path):
    from kiln.sinks.warehouse import Warehouse
    from kiln.streaming.ingest import publish_ingested

    landing = tmp_path / "landing"
    landing.mkdir()
    write_day_file(landing, "2026-04-08")
    sink = str(tmp_path / "sink")
    stream_ingest(spark, str(landing), sink, str(tmp_path / "ck"))
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    for _ in range(2):
        publish_ingested(spark, sink, wh)
    assert wh.sensor_readings().count() == 8


ARRAY = ('[{"sensor_id": "A", "timestamp": "2026-04-08 10:00:00", "temperature": 1.5, "status": "on"}, '
         '{"sensor_id": "B", "timestamp": "bad", "temperature": 2.5, "status": "on"}, '
         '{"sensor_id": "C", "timestamp": "2026-04-09 10:00:00", "temperature": "hot", "status": "on"}, '
         '{"sensor_id": "D", "timestamp": "2026-04-09 11:00:00", "temperature": 250.0, "status": "on"}, '
         '{"sensor_id": "E", "timestamp": "2026-04-09 12:00:00", "temperature": 3.5, "status": "on"}]\n')


def _names(df):
    return sorted(r.sensor_id for r in df.collect())


def test_reset_checkpoint_and_second_query_add_nothing(spark, tmp_path):
    from kiln.streaming.ingest import read_ledger, read_stream_audit

    landing = tmp_path / "landing"
    landing.mkdir()
    for day in ("2026-04-08", "2026-04-09"):
        write_day_file(landing, day)
    sink = str(tmp_path / "sink")
    for ck in ("ck", "reset", "another"):
        stream_ingest(spark, str(landing), sink, str(tmp_path / ck), max_files_per_trigger=1)
        assert read_ingested(spark, sink).count() == 16
    write_day_file(landing, "2026-04-10")
    stream_ingest(spark, str(landing), sink, str(tmp_path / "reset"))
    assert read_ingested(spark, sink).count() == 24 and read_ledger(spark, sink).count() == 3
    assert read_stream_audit(spark, sink).agg({"rows_in": "sum"}).first()[0] == 30
    # a changed file is a new file
    (landing / "sensor_data_20260408.json").write_text(ARRAY)
    stream_ingest(spark, str(landing), sink, str(tmp_path / "third"))
    assert read_ingested(spark, sink).count() == 26


def test_failed_batch_is_not_seen_and_replays(spark, tmp_path, monkeypatch):
    import kiln.streaming.ingest as ingest

    landing = tmp_path / "landing"
    landing.mkdir()
    write_day_file(landing, "2026-04-08")
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    seen = ingest.observed

    def dies(*args):  # after the rows are written, before the commit
        raise RuntimeError("driver lost")

    monkeypatch.setattr(ingest, "observed", dies)
    try:
        stream_ingest(spark, str(landing), sink, ck)
        raise AssertionError("the failure was swallowed")
    except Exception as e:
        assert "driver lost" in str(e)
    assert read_ingested(spark, sink).count() == 0
    monkeypatch.setattr(ingest, "observed", seen)
    stream_ingest(spark, str(landing), sink, str(tmp_path / "other"))  # another query takes the file first
    stream_ingest(spark, str(landing), sink, ck)  # the failed batch replays and finds it taken
    assert read_ingested(spark, sink).count() == 8


def test_batch_and_stream_agree_and_lose_nothing(spark, tmp_path):
    from kiln.plans.sensor_etl import run_chain
    from kiln.schemas import CORRUPT
    from kiln.sinks.warehouse import Warehouse
    from kiln.sources.files import scan_raw_json
    from kiln.streaming.ingest import read_quarantined, read_stream_audit

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(ARRAY)
    (landing / "b.json").write_text('{"sensor_id": "F", "timestamp": "2026-04-08 10:00:00", "temperature": 4.5}\n{"sensor_id": "G", "temp\n\n[]\n[{"sensor_id": "H"\n')
    sink = str(tmp_path / "sink")
    stream_ingest(spark, str(landing), sink, str(tmp_path / "ck"))
    loaded, left_out = read_ingested(spark, sink), read_quarantined(spark, sink)
    assert _names(loaded) == ["A", "E", "F"]
    reasons = sorted((r.sensor_id or "", r.reject_reason) for r in left_out.collect())
    assert reasons == [("", "malformed"), ("", "malformed"), ("B", "bad_timestamp"), ("C", "malformed"), ("D", "over_limit")]
    texts = {r.sensor_id: r[CORRUPT] for r in left_out.collect()}
    assert json.loads(texts["B"])["timestamp"] == "bad" and json.loads(texts["C"])["temperature"] == "hot" and texts["D"] is None
    audit = read_stream_audit(spark, sink).first()
    assert (audit.rows_in, audit.rows_inserted, audit.rows_rejected) == (8, 3, 5)
    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    run_chain(spark, scan_raw_json(spark, str(landing), keep_corrupt=True), str(tmp_path / "root"), wh, keep_quarantine=True, run_id="r")
    cols = loaded.columns
    assert sorted(map(tuple, wh.sensor_readings().select(*cols).collect())) == sorted(map(tuple, loaded.collect()))
    kept = spark.read.parquet(str(tmp_path / "root" / "sensor_chain" / "quarantine" / "run=r"))
    assert sorted((r.sensor_id or "", r.reject_reason) for r in kept.collect()) == reasons


def test_pretty_printed_arrays(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(json.loads(ARRAY), indent=2))
    stream_ingest(spark, str(landing), str(tmp_path / "sink"), str(tmp_path / "ck"), multi_line=True)
    assert _names(read_ingested(spark, str(tmp_path / "sink"))) == ["A", "E"]
