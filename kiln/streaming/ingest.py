"""T1 ``sensor_stream_ingest``: pick up new raw day files, clean and load them.

``readStream`` over the landing folder (partition folders are followed) ->
``foreachBatch``: S1, S7, S8, S10 -> one write to ``<sink>/query=<id>/batch_id=<n>``,
where the id is the streaming query's own, kept in its checkpoint.

* **One parse, two sinks.** The same write holds the loaded rows
  (``rejected=false``, by day) and the quarantined ones (``rejected=true``, with
  reason and text), so together they are the rows that came in. Files are parsed
  and judged as in the batch workflow: the same file gives the same rows.
* **Ledger.** ``<sink>/_commits`` has a row for each micro-batch with the files it
  took (path, length, modification time; no more than the file source itself
  lists in the driver for a micro-batch) and its counts (S15), all observed on
  the write. A micro-batch leaves out files that another batch has taken, so a
  reset checkpoint, or a second query over the same landing, adds nothing. A
  file that changed is a new file.
* **Commit.** That row is a micro-batch's last write, and readers see only the
  batches that have one. A batch that failed before is not seen; replayed, it
  overwrites its own folder and commits.

No dynamic day overwrite is used: a second file for the same
day must add rows, not replace the first file's rows. Queries that write to
one sink at the same time must not share files.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.sensor import TEMP_LIMIT_C, is_loadable, scan_reject_reason
from kiln.operators.sensor import project_target, to_fahrenheit
from kiln.schemas import CORRUPT, RAW_READING, SENSOR_TARGET_COLUMNS
from kiln.session import observed
from kiln.sinks.warehouse import TARGET_SCHEMA, LoadAudit, Warehouse
from kiln.sources.files import parse_readings

RAW_COLUMNS = [f.name for f in RAW_READING.fields]
#: The file source skips files that are older than the newest by more than this (Spark's own default: 7 days),
#: so it is far beyond any backfill.
MAX_FILE_AGE = "36500d"
_FILE = ["file_path", "file_size", "file_modification_time"]
_COUNTS = ["rows_in", "rows_inserted", "rows_rejected"]
_COMMIT = ("rows_in bigint, rows_inserted bigint, rows_rejected bigint, "
           "files array<struct<file_path string, file_size bigint, file_modification_time timestamp>>")
_SINK = T.StructType(
    TARGET_SCHEMA.fields
    + [T.StructField("temperature_read", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("status_read", "reject_reason", CORRUPT, "query")]
    + [T.StructField("rejected", T.BooleanType()), T.StructField("batch_id", T.LongType())]
)


def stream_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str | None = None,
                  limit: float = TEMP_LIMIT_C, max_files_per_trigger: int | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  archive_dir: str | None = None, max_file_age: str = MAX_FILE_AGE, multi_line: bool = False):
    """Start the ingest. With ``available_now`` (default) it processes every
    file present and returns after the run; otherwise it returns the running
    ``StreamingQuery`` triggered every ``processing_time``.

    ``archive_dir``: move processed files there (the file source's
    ``cleanSource=archive``), so that the landing folder, which is listed on
    every trigger, stays small. ``max_file_age``: files older than the newest by
    more than this are never taken; copied or backfilled files keep old dates.
    ``multi_line``: each file is one JSON value (pretty-printed arrays).
    """
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.text(landing, wholetext=multi_line).select("value", *(f"_metadata.{c}" for c in _FILE))
    run = uuid.uuid4().hex[:12]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("no streaming query id: the sink's folders are named by it")
        mine = (F.col("query") == query) & (F.col("batch_id") == batch_id)
        taken = _ledger(spark, sink)
        if taken is not None:
            batch = batch.join(taken.where(~mine).select(*_FILE), _FILE, "left_anti")
        folder = f"query={query}/batch_id={batch_id}"
        obs = Observation(f"stream_{run}_{batch_id}")
        counts = (F.count(F.lit(1)).alias("rows_in"), F.count_if(~F.col("rejected")).alias("rows_inserted"),
                  F.collect_set(F.struct(*_FILE)).alias("files"))
        judged = _judged(parse_readings(batch, keep_corrupt=True), limit)
        # few files for each day, and a large day in several tasks
        (judged.observe(obs, *counts).drop(*_FILE).hint("rebalance", "rejected", "reading_date")
         .write.mode("overwrite").partitionBy("rejected", "reading_date").parquet(f"{sink}/{folder}"))
        m = observed(obs, judged, *counts)
        commit = [(m["rows_in"], m["rows_inserted"], m["rows_in"] - m["rows_inserted"], m["files"])]
        # next to the data; '_' keeps it out of reads of the sink
        spark.createDataFrame(commit, _COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{sink}/_commits/{folder}")

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint or f"{sink}/_checkpoint")
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def _judged(raw: DataFrame, limit: float) -> DataFrame:
    """Loaded rows in warehouse shape; of rejected ones also what was read, the reason, and the text that did not parse."""
    rejected = ~is_loadable("temperature", limit, CORRUPT)
    reason = scan_reject_reason("temperature", limit, CORRUPT)
    kept = {c: F.when(rejected, F.col(of)) for c, of in (("temperature_read", "temperature"), ("status_read", "status"), (CORRUPT, CORRUPT))}
    rows = raw.withColumns({"rejected": rejected, "reject_reason": reason, **kept})
    return project_target(to_fahrenheit(rows))


def _commits(spark: SparkSession, sink: str) -> DataFrame | None:
    """A row for each committed micro-batch; None before the first."""
    try:
        return spark.read.schema(f"{_COMMIT}, query string, batch_id bigint").parquet(f"{sink}/_commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _ledger(spark: SparkSession, sink: str) -> DataFrame | None:
    commits = _commits(spark, sink)
    return None if commits is None else commits.select(F.explode("files").alias("file"), "query", "batch_id").select("file.*", "query", "batch_id")


def read_ledger(spark: SparkSession, sink: str) -> DataFrame:
    """``file_path, file_size, file_modification_time, query, batch_id`` of every file taken."""
    files = _ledger(spark, sink)
    if files is None:
        raise FileNotFoundError(f"{sink}: nothing ingested yet")
    return files


def read_stream_audit(spark: SparkSession, sink: str) -> DataFrame:
    """Counts per micro-batch: ``query, batch_id, rows_in, rows_inserted, rows_rejected``."""
    commits = _commits(spark, sink)
    if commits is None:
        raise FileNotFoundError(f"{sink}: nothing ingested yet")
    return commits.select("query", "batch_id", *_COUNTS)


def _read_sink(spark: SparkSession, sink: str, rejected: bool) -> DataFrame:
    """Read by schema: no file is opened to infer it, and a sink without rows reads as no rows."""
    rows = spark.read.schema(_SINK).parquet(sink).where(F.col("rejected") == rejected)
    commits = _commits(spark, sink)
    if commits is None:
        return rows.where("false")
    # joined on partition folders: those of batches that did not commit are not read
    return rows.join(commits.select("query", "batch_id"), ["query", "batch_id"], "left_semi")


def read_ingested(spark: SparkSession, sink: str) -> DataFrame:
    """The ingested rows in warehouse shape (query and batch folders dropped)."""
    return _read_sink(spark, sink, False).select(*SENSOR_TARGET_COLUMNS)


def read_quarantined(spark: SparkSession, sink: str) -> DataFrame:
    """The rows left out, as read, with ``reject_reason`` and the text of those that did not parse."""
    rows = _read_sink(spark, sink, True)
    return rows.select("sensor_id", "timestamp", F.col("temperature_read").alias("temperature"), F.col("status_read").alias("status"),
                       "reject_reason", CORRUPT)


def publish_ingested(spark: SparkSession, sink: str, warehouse: Warehouse) -> LoadAudit:
    """Compact the sink's many small files into the warehouse table: every day it holds is replaced there."""
    return warehouse.load_overwrite_days(read_ingested(spark, sink), written=True)
