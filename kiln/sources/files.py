"""S1 and S4: scans of raw JSON day files and clean CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from kiln.schemas import CLEAN_READING, CORRUPT, RAW_READING

# Day files carry their run date as eight digits in the name,
# e.g. sensor_data_20260408.json, preprocessing_data_20260408.csv.
FILE_DATE_PATTERN = r"(\d{8})"
FILE_DATE_FORMAT = "yyyyMMdd"


def _with_file_date(df: DataFrame) -> DataFrame:
    """Add ``file_date``: the run date in the file's name (from the ``_metadata`` column)."""
    digits = F.regexp_extract(F.col("_metadata.file_name"), FILE_DATE_PATTERN, 1)
    return df.withColumn("file_date", F.to_date(F.nullif(digits, F.lit("")), FILE_DATE_FORMAT))


def parse_readings(lines: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """Readings from the text column ``value``: a row for each JSON object, or for each element of a JSON array.

    Every element is parsed by itself, so a bad field spoils its own element
    only; an array that is not whole is one record that did not parse. With
    ``keep_corrupt`` the text of a record that did not parse is kept as
    ``_corrupt_record`` (NULL for good ones). Other columns follow the reading's.
    """
    others = [c for c in lines.columns if c != "value"]
    value = F.col("value")
    elements = F.when(F.ltrim(value).startswith("["), F.coalesce(F.from_json(value, "array<string>"), F.array(value))).otherwise(F.array(value))
    texts = lines.where(F.trim(value) != "").select(F.explode(elements).alias("_kiln_text"), *others)
    schema = T.StructType(RAW_READING.fields + [T.StructField(CORRUPT, T.StringType())])
    text = F.coalesce("_kiln_text", F.lit("null"))
    parsed = texts.withColumn("_kiln_reading", F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}))
    reading = F.col("_kiln_reading")
    corrupt = F.when(reading.isNull(), text).otherwise(reading[CORRUPT]).alias(CORRUPT)
    return parsed.select(*(reading[f.name].alias(f.name) for f in RAW_READING.fields), *([corrupt] if keep_corrupt else []), *others)


def scan_raw_json(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                  with_file_date: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """S1 ``sensor_scan_json``: raw readings from JSON files.

    Accepts JSON Lines and files holding one top-level array (one row per
    element, see ``parse_readings``). A one-line array file is a single record
    that cannot be split, so land large raw data as JSON Lines; pretty-printed
    arrays need ``multi_line=True``. Partition folders such as ``ds=2026-04-08``
    add a column; ``with_file_date`` adds ``file_date`` for flat folders of files
    named by run date. ``keep_corrupt`` adds the text of records that did not
    parse as ``_corrupt_record`` (NULL for good ones).
    """
    lines = spark.read.text(path, wholetext=multi_line)
    return parse_readings(_with_file_date(lines) if with_file_date else lines, keep_corrupt)


def read_clean_csv(spark: SparkSession, path: str | list[str], with_file_date: bool = False) -> DataFrame:
    """S4 ``sensor_read_csv``: clean readings from header CSV files, typed by schema."""
    df = (
        spark.read.schema(CLEAN_READING)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return _with_file_date(df) if with_file_date else df
