"""Sensor transforms: S7 filter, S8 Fahrenheit, S9 quarantine, S10 target
projection, S13 day slice, S14 dense ids, S16 trailing days.

All but S14 are narrow (Filter/Project inside one codegen stage, no shuffle);
filters on raw columns reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.sensor import TEMP_LIMIT_C, fahrenheit, is_normal, reject_reason
from kiln.session import scratch_dir


def _date(ds: str | date) -> Column:
    return F.lit(str(ds)).cast("date")


def filter_normal(df: DataFrame, limit: float = TEMP_LIMIT_C, column: str = "temperature") -> DataFrame:
    """S7 ``sensor_filter_normal``: keep ``column < limit`` (strict); NULL and NaN are dropped."""
    return df.where(is_normal(column, limit))


def to_fahrenheit(df: DataFrame, source: str = "temperature", target: str = "temperature_f") -> DataFrame:
    """S8 ``sensor_to_fahrenheit``: add ``target = source * 9 / 5 + 32``."""
    return df.withColumn(target, fahrenheit(source))


def quarantine(df: DataFrame, limit: float = TEMP_LIMIT_C, column: str = "temperature") -> DataFrame:
    """S9 ``sensor_quarantine``: exactly the rows S7 drops, with a ``reject_reason``.

    ``filter_normal(df) UNION ALL quarantine(df)`` is the whole input, NULL and
    NaN readings included.
    """
    return df.where(~F.coalesce(is_normal(column, limit), F.lit(False))).withColumn(
        "reject_reason", reject_reason(column, limit)
    )


def project_target(df: DataFrame, temperature: str = "temperature") -> DataFrame:
    """S10 ``sensor_project_target``: the warehouse shape.

    ``temperature -> temperature_c``, both temperatures narrowed to 32-bit float
    (the table's FLOAT columns), ``status`` dropped, ``reading_date`` added as
    the partition column. Extra columns (e.g. a tiebreak id) are kept at the end.
    """
    extra = [c for c in df.columns if c not in ("sensor_id", "timestamp", temperature, "status", "temperature_f")]
    return df.select(
        F.col("sensor_id"),
        F.col("timestamp"),
        F.col(temperature).cast("float").alias("temperature_c"),
        F.col("temperature_f").cast("float").alias("temperature_f"),
        F.to_date("timestamp").alias("reading_date"),
        *extra,
    )


def day(df: DataFrame, ds: str | date, date_column: str = "reading_date") -> DataFrame:
    """S13 ``sensor_day``: one calendar day.

    On the warehouse table ``reading_date`` is the partition column, so this
    prunes to one folder. On a raw frame pass ``date_column=None`` to filter on
    ``to_date(timestamp)``, which Spark turns into a range filter pushed into Parquet.
    """
    if date_column is None:
        return df.where(F.to_date("timestamp") == _date(ds))
    return df.where(F.col(date_column) == _date(ds))


def trailing_days(df: DataFrame, ds: str | date, days: int = 7, date_column: str = "reading_date") -> DataFrame:
    """S16 ``sensor_trailing_days``: ``date_column BETWEEN ds - days AND ds`` (inclusive)."""
    end = _date(ds)
    return df.where(F.col(date_column).between(F.date_add(end, -days), end))


def max_id(df: DataFrame, id_column: str = "id") -> int:
    """The largest id in ``df`` (0 when empty): where the next load's ids continue.

    One aggregate, a single number to the driver.
    """
    return int(df.agg(F.max(id_column)).first()[0] or 0)


_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_ids(
    df: DataFrame,
    order_by: list[str],
    id_column: str = "id",
    start: int | Callable[[int], int] = 0,
    num_partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """S14 ``sensor_dense_ids``: ``id = start + row_number() OVER (ORDER BY order_by)``.

    A global ``row_number`` moves every row into one task. Instead:
    1. range-partition on the order (Spark samples the boundaries), sort within
       partitions, tag each row with ``monotonically_increasing_id`` (partition
       index in the high bits, row number in the low 33 bits) and write the
       rows once as Parquet into the shared folder, so both passes see the same tags;
    2. count rows per partition from the tag column alone and prefix-sum the
       counts - one row per partition, bounded by the partition count, not by data;
    3. broadcast-join those offsets back: id = offset + row-in-partition + 1.
    ``order_by`` must be a total order (add a unique tiebreak column); ties on
    the leading column are split across partitions by the tiebreak.

    ``start``: the number before the first id, or a function that is given the
    number of rows and returns it (a reservation). ``path``: where the tagged
    rows are written; the caller removes that folder once the result is read.
    """
    spark = df.sparkSession
    # Without a fixed count AQE may merge small adjacent ranges; merged ranges
    # are still in order, so the partition index still orders the rows.
    ranged = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    path = path or scratch_dir(spark, "dense-ids")
    rows = ranged.sortWithinPartitions(*order_by).withColumn("_kiln_mid", F.monotonically_increasing_id())
    rows.write.parquet(path)
    tagged = spark.read.schema(rows.schema).parquet(path)
    part = F.shiftright("_kiln_mid", _ROW_BITS)
    counts = tagged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row for each partition
    at = start(sum(r.n for r in counts)) if callable(start) else start
    offsets = []
    for r in sorted(counts, key=lambda r: r.part):
        offsets.append((r.part, at))
        at += r.n
    before = spark.createDataFrame(offsets, "_kiln_part bigint, _kiln_off bigint")
    low = F.col("_kiln_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        tagged.join(F.broadcast(before), part == F.col("_kiln_part"))
        .withColumn(id_column, (F.col("_kiln_off") + low + 1).cast("bigint"))
        .drop("_kiln_mid", "_kiln_part", "_kiln_off")
    )
