"""Sensor ETL as Spark jobs.

Single workflow (SURVEY 3.1): scan day file -> filter -> Fahrenheit -> clean
file -> load (replace the day). S17 ``sensor_run_chain``: the same as three
separately runnable stages that hand over a path, never the data. A run hands
over its own folder (``.../run=<id>``), so a stage sees that run's batch and
nothing landed before. With ``ds=None`` a stage handles every day in its input
in one job (a backfill): the run date of a row is the date of its timestamp,
or the date in its file's name where the source carries ``file_date``.
A run with ``manifest`` ends each stage by writing what its folder holds, and
begins the next by comparing: a hand-off that lost or changed a file is refused.

Records that did not parse, have no valid timestamp, or are not normal are
never loaded; the quarantine keeps them with the reason.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.sensor import TEMP_LIMIT_C, is_loadable, scan_reject_reason
from kiln.operators.sensor import filter_normal, to_fahrenheit
from kiln.schemas import CLEAN_READING, CORRUPT, RAW_READING
from kiln.session import observed
from kiln.sinks.files import land_raw, write_clean_csv
from kiln.sinks.manifest import check, seal
from kiln.sinks.warehouse import LoadAudit, Warehouse
from kiln.sources.files import read_clean_csv, scan_raw_json

RAW_COLUMNS = [f.name for f in RAW_READING.fields]
CLEAN_COLUMNS = RAW_COLUMNS + ["temperature_f"]
FILE_DATE = "file_date"


def transform(raw: DataFrame, limit: float = TEMP_LIMIT_C) -> DataFrame:
    """S7 then S8: keep normal readings, add Fahrenheit."""
    return to_fahrenheit(filter_normal(raw, limit))


def _require(path: str | None, what: str) -> str:
    if not path:
        raise ValueError(f"{what}: no input path given")  # 2.5-d: never run on a missing hand-off
    return path


def _sealed(spark: SparkSession, path: str, fmt: str, manifest: str | None) -> str:
    if manifest not in (None, "files", "rows"):
        raise ValueError(f"unknown manifest {manifest!r}")
    return seal(spark, path, fmt, manifest == "rows") if manifest else path


def extract_stage(source: DataFrame, raw_root: str, ds: str | date | None = None,
                  timestamp_format: str | None = None, fmt: str = "json", manifest: str | None = None) -> str:
    """Stage 1: land raw readings (S2); returns the path handed to stage 2, sealed if ``manifest`` says so.

    A ``file_date`` column in the source (``scan_raw_json(with_file_date=True)``)
    keys a multi-day landing by the file's date instead of the row's.
    """
    by_file = FILE_DATE in source.columns
    extra = [c for c in (FILE_DATE, CORRUPT) if c in source.columns and (c != CORRUPT or fmt == "parquet")]
    path = land_raw(source.select(*RAW_COLUMNS, *extra), raw_root, None if ds is None else str(ds), timestamp_format,
                    fmt, FILE_DATE if by_file else None)
    return _sealed(source.sparkSession, path, fmt, manifest)


def _raw(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The landed batch, with the text of what did not parse and, if it was landed by day, ``ds``."""
    if fmt == "json":
        return scan_raw_json(spark, path, keep_corrupt=True)
    # by schema: a batch without files reads as no rows, one without corrupt text has NULL there
    return spark.read.schema(T.StructType(RAW_READING.fields + [T.StructField(CORRUPT, T.StringType())])).parquet(path)


def day_counts(spark: SparkSession, path: str, fmt: str = "json") -> dict[str | None, int]:
    """Rows of a landed batch by run date, rejected ones included.

    One row for each day; of a Parquet landing no column is read, only its folders and row counts.
    """
    raw = _raw(spark, _require(path, "days"), fmt)
    day = F.col("ds") if "ds" in raw.columns else F.to_date("timestamp")
    return {None if r.ds is None else str(r.ds): r["count"] for r in raw.groupBy(day.alias("ds")).count().collect()}


def _clean_counts(spark: SparkSession, path: str, fmt: str) -> dict[str | None, int]:
    """Rows of a clean batch by run date: its folder's, or else the row's own."""
    clean = read_clean_csv(spark, path) if fmt == "csv" else spark.read.schema(CLEAN_READING).parquet(path)
    day = F.col("ds") if "ds" in clean.columns else F.to_date("timestamp")
    return {None if r.ds is None else str(r.ds): r["count"] for r in clean.groupBy(day.alias("ds")).count().collect()}


def transform_stage(spark: SparkSession, raw_path: str, clean_root: str, ds: str | date | None = None,
                    limit: float = TEMP_LIMIT_C, timestamp_format: str | None = None,
                    metrics: dict | None = None, quarantine_root: str | None = None,
                    raw_fmt: str = "json", fmt: str = "csv", manifest: str | None = None) -> str:
    """Stage 2: S1 scan -> S7 -> S8 -> S3 clean file; returns the path handed to stage 3.

    A landing with a manifest is compared with it first; with ``manifest``
    there has to be one, and the clean folder gets its own.

    Rows read and rows kept are observed on the write itself (no second pass)
    and put into ``metrics`` when given. With ``quarantine_root`` the rejected
    records are kept as Parquet under ``quarantine_root/ds=...`` with their
    reason and, if they did not parse, their text; that is a second scan of
    the landed batch, nothing is held on executors in between.
    """
    check(spark, _require(raw_path, "transform"), raw_fmt, required=bool(manifest))
    raw = _raw(spark, raw_path, raw_fmt)
    # a multi-day landing keeps its own run dates, whether they are the rows' or the files'
    by_day = ds is None and "ds" in raw.columns
    key = [F.col("ds").cast("date").alias(FILE_DATE)] if by_day else []
    raw = raw.select(*RAW_COLUMNS, CORRUPT, *key)
    obs = Observation(f"transform_{uuid.uuid4().hex[:12]}")
    ok = is_loadable("temperature", limit, CORRUPT)
    counts = (F.count(F.lit(1)).alias("rows_raw"), F.count_if(ok).alias("rows_clean"))
    clean = to_fahrenheit(raw.observe(obs, *counts).where(ok)).select(*CLEAN_COLUMNS, *([FILE_DATE] if by_day else []))
    path = write_clean_csv(clean, clean_root, None if ds is None else str(ds), timestamp_format, fmt,
                           FILE_DATE if by_day else None)
    if quarantine_root:
        rejected = raw.where(~ok).withColumn("reject_reason", scan_reject_reason("temperature", limit, CORRUPT))
        if ds is None:
            day = F.col(FILE_DATE) if by_day else F.to_date("timestamp")
            (rejected.withColumn("ds", day).drop(FILE_DATE).hint("rebalance", "ds").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(quarantine_root))
        else:
            rejected.write.mode("overwrite").parquet(f"{quarantine_root}/ds={ds}")
    if metrics is not None:
        metrics.update(observed(obs, raw, *counts))
    return _sealed(spark, path, fmt, manifest)


def load_stage(spark: SparkSession, clean_path: str, warehouse: Warehouse, ds: str | date | None = None,
               mode: str = "overwrite", rows_rejected: int = 0, fmt: str = "csv",
               days: list[str] | None = None, by_file: bool = False,
               rejected_by_day: dict[str | None, int] | None = None, manifest: str | None = None) -> LoadAudit:
    """Stage 3: S4 read -> S10 -> load. ``overwrite`` replaces the day ``ds``
    (S11) or, with no ``ds``, the given ``days`` and every day in the batch
    (a day of which nothing is left is emptied); ``append`` is S12. ``by_file``:
    the days are the files' own, and rows dated otherwise are appended. A clean
    folder is compared with its manifest before anything is replaced; with
    ``manifest`` there has to be one."""
    path = _require(clean_path, "load")
    check(spark, path, fmt, required=bool(manifest))
    if fmt == "csv":
        clean = read_clean_csv(spark, path)
    else:
        clean = spark.read.schema(CLEAN_READING).parquet(path)
    clean = clean.select(*CLEAN_COLUMNS)
    warehouse.ensure_tables()
    if mode == "append":
        return warehouse.load_append(clean, rows_rejected)
    if mode != "overwrite":
        raise ValueError(f"unknown mode {mode!r}")
    if ds is None:
        return warehouse.load_overwrite_days(clean, rows_rejected, days=days, append_others=by_file, written=True,
                                             rejected_by_day=rejected_by_day)
    return warehouse.load_overwrite_day(clean, ds, rows_rejected, written=True)


def run_chain(spark: SparkSession, source: DataFrame, root: str, warehouse: Warehouse,
              ds: str | date | None = None, mode: str = "overwrite",
              timestamp_format: str | None = None, keep_quarantine: bool = False,
              handoff: str = "parquet", run_id: str | None = None, manifest: str | None = None) -> LoadAudit:
    """S17 ``sensor_run_chain``: extract -> transform -> load; paths keyed by job name (``sensor_chain``) and run.

    ``handoff``: ``parquet`` (typed, compressed, splittable) or ``text`` (JSON
    Lines and CSV, as the reference's files). ``manifest``: hand-offs are sealed
    and checked (``kiln.sinks.manifest``), by ``files`` (place, length, rows) or
    by ``rows`` (a checksum of every row too, which reads the folder twice more).
    """
    if handoff not in ("parquet", "text"):
        raise ValueError(f"unknown handoff {handoff!r}")
    raw_fmt, fmt = ("parquet", "parquet") if handoff == "parquet" else ("json", "csv")
    base, run = f"{root.rstrip('/')}/sensor_chain", f"run={run_id or uuid.uuid4().hex[:12]}"
    raw_path = extract_stage(source, f"{base}/raw/{run}", ds, timestamp_format, raw_fmt, manifest)
    metrics: dict = {}
    clean_path = transform_stage(spark, raw_path, f"{base}/clean/{run}", ds, timestamp_format=timestamp_format,
                                 metrics=metrics, quarantine_root=f"{base}/quarantine/{run}" if keep_quarantine else None,
                                 raw_fmt=raw_fmt, fmt=fmt, manifest=manifest)
    days = rejected = None
    if ds is None and mode == "overwrite":
        raw_days, clean_days = day_counts(spark, raw_path, raw_fmt), _clean_counts(spark, clean_path, fmt)
        days = sorted(d for d in raw_days if d is not None)
        rejected = {d: n - clean_days.get(d, 0) for d, n in raw_days.items() if n > clean_days.get(d, 0)}
    return load_stage(spark, clean_path, warehouse, ds, mode, metrics["rows_raw"] - metrics["rows_clean"], fmt, days,
                      FILE_DATE in source.columns, rejected, manifest)


def run_daily(spark: SparkSession, raw_path: str, ds: str | date, root: str, warehouse: Warehouse,
              limit: float = TEMP_LIMIT_C, timestamp_format: str | None = None,
              keep_quarantine: bool = False) -> LoadAudit:
    """Single workflow for one run date: day file -> clean CSV -> replace the day (S11 + S15).

    ``keep_quarantine`` keeps the rejected readings under ``root/sensor_daily/quarantine``.
    """
    base = f"{root.rstrip('/')}/sensor_daily"
    metrics: dict = {}
    csv_path = transform_stage(spark, raw_path, f"{base}/clean", ds, limit, timestamp_format, metrics,
                               f"{base}/quarantine" if keep_quarantine else None)
    return load_stage(spark, csv_path, warehouse, ds, "overwrite", metrics["rows_raw"] - metrics["rows_clean"])
