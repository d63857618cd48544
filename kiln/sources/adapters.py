"""Shape the driver's test tables like the reference's records.

These only rename and derive columns; they are not operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> raw readings (+ ``event_id`` as a unique tiebreak)."""
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("SENSOR_"), F.col("user_id").cast("string")).alias("sensor_id"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("value").cast("double").alias("temperature"),
        F.lit("on").alias("status"),
        F.col("event_id"),
    )


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer (+ orders) -> credit applicants.

    ``income = floor(c_acctbal * 4)`` covers negative incomes and all three
    grades; ``loan_amt = floor(max(o_totalprice) / 100)`` (max, not a double
    sum, so the value does not depend on summation order); ``first_order`` is
    when the customer first appeared. The order aggregate is partial
    (map-side) before its shuffle, so a customer with a huge share of orders
    does not load one task.
    """
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    per_cust = (
        _table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").alias("max_price"), F.min("o_orderdate").alias("first_order"))
    )
    return cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.floor(F.col("c_acctbal") * 4).cast("int").alias("income"),
        F.floor(F.col("max_price") / 100).cast("int").alias("loan_amt"),
        F.to_date("first_order").alias("first_order"),
    )
