"""Manifests of hand-offs between stages (S17).

A stage that has written its folder seals it: one small Parquet table,
``_manifest`` in the folder (Spark's readers skip that name), with a row for
each file that holds rows: its place, length, number of rows and a checksum of
the rows. The next stage compares the folder with it before it starts, and
refuses one that lost, gained or changed a file.

Lengths and row counts of Parquet files come from their footers; the checksum
reads every row, and text has to be read for its rows in any case. The
comparison is a join of two tables with a row for each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import hadoop_path

MANIFEST = "_manifest"
SHOWN = 5  # differences named in the error


class HandoffError(RuntimeError):
    """A folder does not hold what the stage before wrote."""


def describe(spark: SparkSession, path: str, fmt: str, checksum: bool = False) -> DataFrame:
    """``file`` (its folder and name), ``length``, ``n_rows`` and, if asked for, ``checksum`` of each file with rows.

    The checksum is the sum of the upper 32 bits of the rows' XXH64 hashes, so
    it does not depend on their order. Rows of text formats are lines.
    """
    if fmt == "parquet" and not _has_files(spark, path):  # no file to take a schema from
        return spark.createDataFrame([], "file string, length bigint, n_rows bigint, checksum bigint")
    df = spark.read.option("recursiveFileLookup", "true").format("parquet" if fmt == "parquet" else "text").load(path)
    hashes = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), 32)
    sums = F.sum(hashes) if checksum else F.lit(None).cast("bigint")
    place = F.array_join(F.slice(F.split("_metadata.file_path", "/"), -2, 2), "/")
    return (df.groupBy(place.alias("file"), F.col("_metadata.file_size").alias("length"))
            .agg(F.count(F.lit(1)).alias("n_rows"), sums.alias("checksum")))


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a file below the folder whose name Spark reads."""
    root, fs = hadoop_path(spark, path)
    found = fs.listFiles(root, True)
    while found.hasNext():
        f = found.next().getPath()
        if not f.getName().startswith(("_", ".")) and f.getParent().getName() != MANIFEST:
            return True
    return False


def seal(spark: SparkSession, path: str, fmt: str, checksum: bool = False) -> str:
    """Write the manifest of a folder that is whole; returns the folder."""
    describe(spark, path, fmt, checksum).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return path


def check(spark: SparkSession, path: str, fmt: str, required: bool = False) -> int | None:
    """Compare a folder with its manifest; returns its number of rows.

    None if there is no manifest, which ``required`` refuses. The checksum is
    compared if the manifest has it.
    """
    at, fs = hadoop_path(spark, f"{path}/{MANIFEST}/_SUCCESS")
    if not fs.exists(at):
        if required:
            raise HandoffError(f"{path} has no manifest: the stage before did not finish")
        return None
    sealed = spark.read.parquet(f"{path}/{MANIFEST}")
    summed = sealed.where("checksum IS NOT NULL").take(1)
    now = describe(spark, path, fmt, bool(summed))
    value = F.struct("length", "n_rows", "checksum")
    both = sealed.select("file", value.alias("sealed")).join(now.select("file", value.alias("now")), "file", "full_outer")
    wrong = both.where(~F.col("sealed").eqNullSafe(F.col("now"))).orderBy("file").limit(SHOWN).collect()
    if wrong:
        raise HandoffError(f"{path} is not what was handed over: " + "; ".join(
            f"{r.file}: {tuple(r.sealed) if r.sealed else 'absent'} became {tuple(r.now) if r.now else 'absent'}" for r in wrong))
    return sealed.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
