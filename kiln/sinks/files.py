"""S2 and S3: file sinks keyed by run date.

A run date ``ds`` maps to the folder ``<root>/ds=<ds>``; writing replaces
that folder as a whole (also with an empty batch), so a rerun of one day
replaces that day's file and leaves other days alone. With ``ds=None`` the
date is taken from each row (its timestamp, or ``date_column``) and every day
present is replaced (dynamic partition overwrite), which writes a multi-day
backfill in one job; the rows are rebalanced by day first, so a day gets few
files and a large day several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spark's CSV writer trims strings unless told not to.
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _write(df: DataFrame, fmt: str, root: str, ds: str | None, options: dict, date_column: str | None) -> str:
    day = F.to_date("timestamp") if date_column is None else F.col(date_column)
    if ds is None:
        df = df.withColumn("ds", day)
    if date_column is not None:
        df = df.drop(date_column)
    if fmt != "parquet" and "timestampNTZFormat" not in options:
        # the text of a timestamp has its fraction only if there is one
        df = df.withColumn("timestamp", F.col("timestamp").cast("string"))
    if ds is not None:
        # one run date: replace its folder as a whole, so an empty batch leaves
        # an empty day instead of the previous run's file
        path = f"{root}/ds={ds}"
        df.write.mode("overwrite").options(**options).format(fmt).save(path)
        return path
    (
        df.hint("rebalance", "ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy("ds")
        .format(fmt)
        .save(root)
    )
    return root


def land_raw(df: DataFrame, root: str, ds: str | None = None, timestamp_format: str | None = None,
             fmt: str = "json", date_column: str | None = None) -> str:
    """S2 ``sensor_land_raw``: raw readings under ``root/ds=...``; returns the path written.

    ``fmt``: JSON Lines, or ``parquet`` for a hand-off between jobs.
    """
    return _write(df, fmt, root, ds, {"timestampNTZFormat": timestamp_format} if timestamp_format else {}, date_column)


def write_clean_csv(df: DataFrame, root: str, ds: str | None = None, timestamp_format: str | None = None,
                    fmt: str = "csv", date_column: str | None = None) -> str:
    """S3 ``sensor_write_csv``: header CSV, no index column, one folder per run date; returns the path written.

    The text of whole-second rows equals the reference's sample files.
    ``fmt="parquet"``: the same rows as a hand-off between jobs.
    """
    options = dict(CSV_OPTIONS) if fmt == "csv" else {}
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    return _write(df, fmt, root, ds, options, date_column)
