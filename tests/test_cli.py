"""The command-line jobs on the sample day files."""

from kiln.cli import main
from kiln.streaming.ingest import read_ingested
from tests.fixtures import RAW_DAYS, write_day_file


def test_daily_chain_score_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for day in RAW_DAYS:
        write_day_file(landing, day)
    root = str(tmp_path / "root")
    out = main(["daily", "--raw", str(landing / "sensor_data_20260408.json"), "--ds", "2026-04-08",
                "--root", root, "--database", "kiln_cli_a"], spark)
    assert (out["rows_inserted"], out["rows_rejected"]) == (8, 2)
    out = main(["chain", "--raw", str(landing), "--root", str(tmp_path / "root2"), "--database", "kiln_cli_b",
                "--keep-quarantine"], spark)
    assert (out["rows_in"], out["rows_rejected"]) == (31, 9)
    assert spark.read.parquet(str(tmp_path / "root2" / "sensor_chain" / "quarantine")).count() == 9
    assert spark.table("kiln_cli_b.sensor_readings").count() == 31
    apps = tmp_path / "apps"
    spark.createDataFrame([("C001", 5000, 2000), ("C002", 4000, 5000), ("C003", 8000, 1000)],
                          "user_id string, income int, loan_amt int").write.parquet(str(apps))
    out = main(["score", "--root", root, "--database", "kiln_cli_a", "--applicants", str(apps)], spark)
    assert out["rows_updated"] == 3
    out = main(["ingest", "--landing", str(landing), "--sink", str(tmp_path / "sink")], spark)
    assert read_ingested(spark, str(tmp_path / "sink")).count() == 31
