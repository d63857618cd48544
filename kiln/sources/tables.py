"""S5: scan side of a warehouse query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, table: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Read a catalog table; column pruning and the predicate reach the Parquet scan."""
    df = spark.read.table(table)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_sql(spark: SparkSession, query: str) -> DataFrame:
    """S5 as a query text: ``(sql) -> DataFrame`` through Catalyst (pushdown still applies)."""
    return spark.sql(query)


def scan_jdbc(spark: SparkSession, url: str, query: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """S5 against a JDBC database (needs the vendor's JDBC driver on the classpath).

    Give ``partition_column``/``lower``/``upper``/``num_partitions`` to read
    in parallel ranges; otherwise one task reads the whole result.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("dbtable", f"({query}) AS q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", num_partitions)
        )
    else:
        reader = reader.option("query", query)
    return reader.load()
