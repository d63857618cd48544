"""The two warehouse tables and their loads.

``sensor_readings`` is a Parquet table partitioned by ``reading_date``;
``customers`` is one partitioned by ``key_bucket``, a hash of the key. Both live in a
database whose location is under the shared folder (``spark.checkpoint.dir``
by default), so every executor sees the same files.

Loads (SURVEY 2.2, 2.3, 2.5):

* S11 ``load_overwrite_day``: result = rows with date <> ds, plus the whole
  batch. A batch that is a read of files is used as it is (``written``);
  any other is written once to a staging folder partitioned by date (load
  counts observed on that write), which is removed after the load. The day is replaced - by a
  dynamic overwrite that swaps the day's folder only at job commit, or, for an
  empty batch, a static ``INSERT OVERWRITE ... PARTITION (reading_date = ds)``
  that empties it - and rows dated otherwise are appended. A failed publish
  can be retried from the staging folder (``publish_staged_day``).
* S12 ``load_append``: plain insert; a rerun duplicates rows, by design. With a
  ``batch_id`` (a warehouse with ``batch_ids``) a batch is added once: its rows
  carry the id, a marker under the root says that it is whole, and a rerun
  after a failure adds the rows that are missing, none twice.
* ``load_overwrite_days``: backfill form, replaces every day present in the
  batch (dynamic partition overwrite) in one job, and then drops the given days
  of which the batch has no row with one ``ALTER TABLE``. What can fail in the
  batch fails before anything is replaced; a failed publish can be retried
  (``publish_staged_days``).
* S14: ranges of ids are reserved in a log under the root before rows are
  numbered, so loads that run at the same time never share ids.
* C11 update: only the partitions of the updated keys are read and written, by
  a dynamic overwrite that swaps them when its job commits, so a failed job
  leaves the old rows. C1 reload: the same for all partitions; those that the new
  state has no row of are dropped afterwards.
* C10 insert: keys already present are an error (or skipped with ``ignore``);
  only the partitions of the batch's keys are read for that.
* Customer keys are unique and not NULL: checked in the write itself, on
  rows that are partitioned by the key's hash anyway.
* C12 with the built-in rule (``score_pending_in_place``): one projection
  over the partitions that have pending rows, no join.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.credit import credit_draw, credit_grade, credit_score
from kiln.operators.credit import apply_updates
from kiln.operators.sensor import dense_ids, max_id, project_target
from kiln.schemas import CUSTOMER_COLUMNS, CUSTOMERS_DDL, SENSOR_READINGS_DDL
from kiln.session import hadoop_path, observed, remove_dir, scratch_dir

TARGET_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("temperature_c", T.FloatType()),
        T.StructField("temperature_f", T.FloatType()),
        T.StructField("reading_date", T.DateType()),
    ]
)
_BUCKET = "key_bucket"
_VALUE_COLUMNS = "sensor_id, timestamp, temperature_c, temperature_f"


_AUDIT_DDL = "ds date, rows_in bigint, rows_inserted bigint, rows_deleted bigint, rows_out_of_day bigint, rows_rejected bigint"


@dataclass
class LoadAudit:
    """S15 ``sensor_load_audit``: what one load did, in all and, for a load of several days, by day."""

    ds: str | None
    rows_in: int
    rows_inserted: int
    rows_deleted: int
    rows_out_of_day: int
    rows_rejected: int = 0
    days: list["LoadAudit"] = field(default_factory=list)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The load as one row."""
        return _audit_df(spark, [self])

    def by_day(self, spark: SparkSession) -> DataFrame:
        """A row for each day: ``ds`` NULL holds the rows without a date."""
        return _audit_df(spark, self.days or [self])


def _audit_df(spark: SparkSession, audits: list[LoadAudit]) -> DataFrame:
    rows = [(date.fromisoformat(a.ds) if a.ds else None, a.rows_in, a.rows_inserted, a.rows_deleted, a.rows_out_of_day,
             a.rows_rejected) for a in audits]
    return spark.createDataFrame(rows, _AUDIT_DDL)


@dataclass
class StagedBatch:
    """A batch written to staging: where, for which run date, and its counts."""

    path: str
    ds: str
    rows_in: int
    rows_day: int


@dataclass
class StagedDays:
    """A batch of several days written to files: where, its rows by day, and what it replaces."""

    path: str
    counts: dict[str | None, int]
    listed: list[str]
    append_others: bool = False
    rejected: dict[str | None, int] = field(default_factory=dict)
    written: DataFrame | None = None  # a read of files that were there before; else ``path`` is staging

    def replaces(self, ds: str | None) -> bool:
        return not self.append_others or ds in self.listed


class LoadError(RuntimeError):
    def __init__(self, message: str, stage: StagedBatch | StagedDays):
        super().__init__(message)
        self.stage = stage


#: Ids are reserved one load at a time in this process; between processes the file system decides.
_ID_LOCK = threading.Lock()
_ID_TRIES = 200


def _uid() -> str:
    return uuid.uuid4().hex[:12]


def _unique_keys(rows: DataFrame) -> DataFrame:
    """Fail on a NULL or repeated ``user_id``; the rows are partitioned by its hash, so this only sorts within partitions."""
    nth = F.row_number().over(Window.partitionBy(_BUCKET, "user_id").orderBy("user_id"))
    checked = rows.withColumn("_kiln_nth", nth).where(
        F.when(F.col("user_id").isNull(), F.raise_error(F.lit("NULL user_id")))
        .when(F.col("_kiln_nth") > 1, F.raise_error(F.concat(F.lit("duplicate user_id "), F.col("user_id"))))
        .otherwise(F.lit(True)))
    return checked.drop("_kiln_nth")


class Warehouse:
    """The two tables of one warehouse (a database under ``root``).

    ``sensor_ids``: the sensor table gets the running ``id`` column of the
    reference's table. Every load counts its rows, reserves that many ids in an
    append-only log under the root and numbers its rows with them (S14), so
    loads that run at the same time never share ids, ids of deleted rows are
    not reused and no scan of the table is needed to find the maximum.

    ``batch_ids``: the sensor table gets a ``batch_id`` column, which appends
    keyed by batch fill (S12).

    ``customer_buckets``: the customer table is partitioned by the hash of
    ``user_id`` into this many partitions (default:
    ``spark.sql.shuffle.partitions`` when the table is created). The number is
    part of the table's folder name, so another session finds it again. An
    update or insert touches the partitions of its keys only.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None,
                 customer_buckets: int | None = None, sensor_ids: bool = False, batch_ids: bool = False):
        self.spark = spark
        self._fresh = root is None  # a new scratch folder: nothing to attach again
        self.root = (root or scratch_dir(spark, "warehouse")).rstrip("/")
        self.database = database or f"kiln_{_uid()}"
        self._buckets = customer_buckets
        self.sensor_ids = sensor_ids
        self.batch_ids = batch_ids
        self._cols = ("id, " if sensor_ids else "") + _VALUE_COLUMNS
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    # ---- S6 -------------------------------------------------------------
    @property
    def sensor_table(self) -> str:
        return f"{self.database}.sensor_readings"

    @property
    def customer_table(self) -> str:
        return f"{self.database}.customers"

    def ensure_tables(self) -> list[str]:
        """S6 ``ensure_tables``: create both tables if absent; safe to repeat.

        Data already under ``root`` (from an earlier session whose catalog is
        gone) is attached again: the sensor table's days are recovered from
        its folders, the customer table points at the version named in
        ``customers_current``.
        """
        catalog = self.spark.catalog
        if not catalog.tableExists(self.sensor_table):
            id_column = "id BIGINT, " if self.sensor_ids else ""
            id_column += "batch_id STRING, " if self.batch_ids else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.sensor_table} ({id_column}{SENSOR_READINGS_DDL}) "
                "USING parquet PARTITIONED BY (reading_date) "
                # an overwrite replaces only the days it writes; a fully static
                # PARTITION (reading_date = ...) still replaces (or empties) that day.
                # Kept on the table, so no session setting is changed.
                "OPTIONS ('partitionOverwriteMode' = 'dynamic') "
                f"LOCATION '{self.root}/sensor_readings'"
            )
            if not self._fresh:
                try:
                    catalog.recoverPartitions(self.sensor_table)  # days already on disk
                except Py4JJavaError as e:
                    if "FileNotFoundException" not in str(e):  # a new table has no folder yet
                        raise
        if not catalog.tableExists(self.customer_table):
            found = None if self._fresh else self._customer_folder()
            n = found or self._buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.customer_table} ({CUSTOMERS_DDL}, {_BUCKET} INT) "
                f"USING parquet PARTITIONED BY ({_BUCKET}) OPTIONS ('partitionOverwriteMode' = 'dynamic') "
                f"LOCATION '{self._customer_path(n)}'")
            if found:
                catalog.recoverPartitions(self.customer_table)
        self._buckets = self._table_buckets()
        return [self.sensor_table, self.customer_table]

    def _customer_path(self, n: int) -> str:
        return f"{self.root}/customers_by_{n}"

    def _customer_folder(self) -> int | None:
        """The number of partitions of the customer table whose folder is under the root, if there is one."""
        path, fs = hadoop_path(self.spark, self.root)
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        counts = [int(n.removeprefix("customers_by_")) for n in names if n.startswith("customers_by_")]
        return counts[0] if counts else None

    def _table_buckets(self) -> int:
        """The number of partitions, from the table's location (the table may predate this object)."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.customer_table}").where("col_name = 'Location'").collect()
        return int(rows[0].data_type.rstrip("/").rpartition("_")[2])

    def sensor_readings(self) -> DataFrame:
        return self.spark.read.table(self.sensor_table)

    def customers(self) -> DataFrame:
        return self.spark.read.table(self.customer_table).drop(_BUCKET)

    def _in_buckets(self, buckets: list[int]) -> DataFrame:
        """The customers of some partitions; the others are not read."""
        return self.spark.read.table(self.customer_table).where(F.col(_BUCKET).isin(buckets)).drop(_BUCKET)

    def _bucket(self) -> Column:
        n = self._buckets or self._table_buckets()
        return F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int").alias(_BUCKET)

    def _touched(self, rows: DataFrame) -> list[int]:
        """The partitions that the keys of ``rows`` are in: no more than the table has."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect() if r[0] is not None)

    # ---- sensor loads ----------------------------------------------------
    def _view(self, df: DataFrame) -> str:
        name = f"kiln_batch_{_uid()}"
        df.createOrReplaceTempView(name)
        return name

    def _target(self, batch: DataFrame) -> DataFrame:
        """Accept clean readings (``temperature``) or rows already in target shape."""
        if "temperature_c" not in batch.columns:
            batch = project_target(batch)
        return batch.select(*[F.col(f.name).cast(f.dataType) for f in TARGET_SCHEMA.fields])

    @contextmanager
    def _numbered(self, rows: DataFrame) -> Iterator[DataFrame]:
        """The rows with ids when the table has them; what was written for that is removed afterwards."""
        if not self.sensor_ids:
            yield rows
            return
        path = scratch_dir(self.spark, "dense-ids")
        order = ["timestamp", "sensor_id", "temperature_c", "temperature_f", "_kiln_row"]  # equal readings by their place
        try:
            tagged = rows.withColumn("_kiln_row", F.monotonically_increasing_id())
            yield dense_ids(tagged, order, start=self.reserve_ids, path=path).select("id", *[f.name for f in TARGET_SCHEMA.fields])
        finally:
            remove_dir(self.spark, path)

    def _schema(self) -> T.StructType:
        if not self.sensor_ids:
            return TARGET_SCHEMA
        return T.StructType([T.StructField("id", T.LongType())] + TARGET_SCHEMA.fields)

    @property
    def _id_log(self) -> str:
        return f"{self.root}/sensor_ids"

    def last_id(self) -> int:
        """The largest id handed out so far (0 before the first load).

        Kept in the log of reservations: a file for each, named by the id
        before its first and holding how many there are. Without a log the
        largest id in the table stands in.
        """
        path, fs = hadoop_path(self.spark, self._id_log)
        names = sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []
        names = [n for n in names if n.isdigit()]
        if not names:
            return max_id(self.sensor_readings()) if self.sensor_ids and self.spark.catalog.tableExists(self.sensor_table) else 0
        row = self.spark.read.text(f"{self._id_log}/{names[-1]}").first()
        return int(names[-1]) + int(row[0]) if row else -1  # claimed, size not yet written

    def reserve_ids(self, n: int) -> int:
        """Reserve ``n`` ids; returns the number before the first.

        The claim is the exclusive creation of a file, so of two loads that
        start from the same number one has to look again.
        """
        if not n:
            return 0
        with _ID_LOCK:
            for _ in range(_ID_TRIES):
                first = self.last_id()
                if first >= 0:
                    path, fs = hadoop_path(self.spark, f"{self._id_log}/{first:020d}")
                    try:
                        out = fs.create(path, False)
                    except Py4JJavaError as e:
                        if "FileAlreadyExists" not in str(e):
                            raise
                    else:
                        out.write(bytearray(str(n).encode()))
                        out.close()
                        return first
                time.sleep(0.05)
        raise RuntimeError(f"no ids could be reserved in {self._id_log}: its last claim was never finished")

    def load_overwrite_day(self, batch: DataFrame, ds: str | date, rows_rejected: int = 0,
                           written: bool = False) -> LoadAudit:
        """S11 ``sensor_load_overwrite_day`` (with the S15 audit).

        ``written``: the batch is a plain read of files that stay, so it is
        loaded straight from them. Otherwise it is staged first; the staging
        folder is removed after the load. If publishing fails, ``LoadError.stage``
        names the staged batch and ``publish_staged_day`` retries without
        recomputing it.
        """
        if written and not self.sensor_ids:
            rows, day = self._target(batch), F.col("reading_date") == F.lit(str(ds)).cast("date")
            n, n_day = rows.agg(F.count(F.lit(1)), F.count_if(day)).first()
            return self._publish_day(rows, str(ds), n, n_day, rows_rejected)
        stage = self.stage_batch(batch, ds)
        try:
            audit = self.publish_staged_day(stage, rows_rejected)
        except Exception as e:  # keep the staged batch reachable for a retry
            raise LoadError(f"publishing {stage.ds} failed; staged batch at {stage.path}", stage) from e
        remove_dir(self.spark, stage.path)
        return audit

    def stage_batch(self, batch: DataFrame, ds: str | date) -> "StagedBatch":
        """Write the batch once to a staging folder partitioned by date; count on the way."""
        ds = str(ds)
        path = scratch_dir(self.spark, "stage")
        obs = Observation(f"load_{_uid()}")
        day = F.col("reading_date") == F.lit(ds).cast("date")
        counts = (F.count(F.lit(1)).alias("rows_in"), F.count_if(day).alias("rows_day"))
        with self._numbered(self._target(batch)) as target:
            (
                target.observe(obs, *counts)
                .hint("rebalance", "reading_date")
                .write.mode("errorifexists")
                .partitionBy("reading_date")
                .parquet(path)
            )
            m = observed(obs, target, *counts)
        return StagedBatch(path, ds, m["rows_in"], m["rows_day"])

    def publish_staged_day(self, stage: "StagedBatch", rows_rejected: int = 0) -> LoadAudit:
        """Replace day ``stage.ds`` with the staged rows of that day; append the others.

        A non-empty day is written with dynamic partition overwrite: Spark
        writes into a job staging folder and swaps the day's folder only when
        the job commits, so a failed job leaves the old day in place. Only the
        day's rows are selected, so no other day can be replaced. An empty day
        uses the static form, which just empties it (2.5-a).
        """
        rows = self.spark.read.schema(self._schema()).parquet(stage.path)
        return self._publish_day(rows, stage.ds, stage.rows_in, stage.rows_day, rows_rejected)

    def _publish_day(self, rows: DataFrame, ds: str, rows_in: int, rows_day: int, rows_rejected: int) -> LoadAudit:
        spark = self.spark
        deleted = self.sensor_readings().where(F.col("reading_date") == F.lit(ds).cast("date")).count()
        staged = self._view(rows)
        cols = self._cols
        try:
            if rows_day > 0:
                spark.sql(
                    f"INSERT OVERWRITE TABLE {self.sensor_table} PARTITION (reading_date) "
                    f"({cols}, reading_date) SELECT {cols}, reading_date "
                    f"FROM {staged} WHERE reading_date = DATE'{ds}'"
                )
            else:
                spark.sql(
                    f"INSERT OVERWRITE TABLE {self.sensor_table} PARTITION (reading_date = DATE'{ds}') "
                    f"({cols}) SELECT {cols} FROM {staged} WHERE FALSE"
                )
            if rows_in > rows_day:
                spark.sql(
                    f"INSERT INTO {self.sensor_table} ({cols}, reading_date) "
                    f"SELECT /*+ REBALANCE(reading_date) */ {cols}, reading_date FROM {staged} "
                    f"WHERE reading_date IS DISTINCT FROM DATE'{ds}'"
                )
        finally:
            spark.catalog.dropTempView(staged)
        return LoadAudit(ds, rows_in, rows_in, deleted, rows_in - rows_day, rows_rejected)

    def load_append(self, batch: DataFrame, rows_rejected: int = 0, batch_id: str | None = None) -> LoadAudit:
        """S12 ``sensor_load_append``: insert without delete; a rerun duplicates rows.

        ``batch_id``: the batch is added once. A rerun of a batch that is whole
        adds nothing; one of a batch whose load broke off adds the rows that
        are not there yet (multisets: equal readings count). The same id stands
        for the same rows, and for one load at a time.
        """
        rows = self._target(batch)
        if batch_id is not None:
            if not self.batch_ids:
                raise ValueError("appends keyed by batch need Warehouse(batch_ids=True)")
            if self._batch_mark(batch_id, "whole", look=True):
                return LoadAudit(None, rows.count(), 0, 0, 0, rows_rejected)
            if self._batch_mark(batch_id, "begun", look=True):  # some of it may be there
                days = list(self._day_counts(rows))
                there = self.sensor_readings().where(self._in_days(days) & (F.col("batch_id") == batch_id))
                rows = rows.exceptAll(there.select(*[F.col(f.name).cast(f.dataType) for f in TARGET_SCHEMA.fields]))
            self._batch_mark(batch_id, "begun")
        n = self._append(rows, batch_id)
        if batch_id is not None:
            self._batch_mark(batch_id, "whole")
        return LoadAudit(None, n, n, 0, 0, rows_rejected)

    def _append(self, rows: DataFrame, batch_id: str | None) -> int:
        obs = Observation(f"append_{_uid()}")
        counted = F.count(F.lit(1)).alias("rows_in")
        with self._numbered(rows) as target:
            # rebalanced by day: a multi-day batch leaves few files in each day's folder
            self._insert("INTO", target.observe(obs, counted).hint("rebalance", "reading_date"), batch_id)
            return observed(obs, target, counted)["rows_in"]

    def _batch_mark(self, batch_id: str, mark: str, look: bool = False) -> bool:
        """Leave, or with ``look`` look for, an empty file that says how far the batch got."""
        path, fs = hadoop_path(self.spark, f"{self.root}/sensor_batches/{hashlib.sha256(batch_id.encode()).hexdigest()}/{mark}")
        if not look:
            fs.create(path, True).close()
        return look and fs.exists(path)

    def _insert(self, how: str, rows: DataFrame, batch_id: str | None = None) -> None:
        """``INSERT INTO``, or ``INSERT OVERWRITE`` of the days that ``rows`` holds."""
        view = self._view(rows if batch_id is None else rows.withColumn("batch_id", F.lit(batch_id)))
        into = "INTO" if how == "INTO" else "OVERWRITE TABLE"
        part = "" if how == "INTO" else "PARTITION (reading_date) "
        cols = self._cols + ("" if batch_id is None else ", batch_id")
        try:
            self.spark.sql(f"INSERT {into} {self.sensor_table} {part}({cols}, reading_date) "
                           f"SELECT {cols}, reading_date FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def load_overwrite_days(self, batch: DataFrame, rows_rejected: int = 0, days: list[str] | None = None,
                            append_others: bool = False, written: bool = False,
                            rejected_by_day: dict[str | None, int] | None = None) -> LoadAudit:
        """Backfill: replace every day present in ``batch``, and the given ``days``, in one job.

        ``days``: run dates that are replaced even if the batch has no row of
        them (2.5-a for many days). ``append_others``: only ``days`` are
        replaced, rows dated otherwise are appended (2.5-b for many days).
        ``written``: the batch is a plain read of files that stay, so it is
        loaded straight from them; otherwise it is staged first.

        The order of steps keeps every old day until its replacement is whole:
        the batch is computed and staged; a dynamic overwrite swaps the days it
        holds when its job commits; then the days without rows are dropped;
        then rows dated otherwise are appended. A failure while publishing is a
        ``LoadError`` with the staged batch, and ``publish_staged_days`` retries;
        the steps before the append give the same result again.

        The audit has a row for each day; ``rejected_by_day`` are the rows that
        an earlier step left out.
        """
        listed = sorted(set(days or []))
        if written and not self.sensor_ids:
            rows = self._target(batch)
            stage = StagedDays("", self._day_counts(rows), listed, append_others, rejected_by_day or {}, rows)
        else:
            path = scratch_dir(self.spark, "stage")
            with self._numbered(self._target(batch)) as rows:
                # few files for each day, and a large day in several tasks; no sampling pass as a range repartition needs
                rows.hint("rebalance", "reading_date").write.partitionBy("reading_date").parquet(path)
            staged = self.spark.read.schema(self._schema()).parquet(path)
            stage = StagedDays(path, self._day_counts(staged), listed, append_others, rejected_by_day or {})
        try:
            audit = self.publish_staged_days(stage)
        except Exception as e:  # keep the staged batch reachable for a retry
            raise LoadError(f"publishing {len(stage.counts)} days failed; staged batch at {stage.path or 'the files given'}", stage) from e
        if stage.path:
            remove_dir(self.spark, stage.path)
        audit.rows_rejected = audit.rows_rejected or rows_rejected
        return audit

    def _day_counts(self, rows: DataFrame) -> dict[str | None, int]:
        """Rows by day, one row for each day; of a table partitioned by day no column is read."""
        return {None if r.reading_date is None else str(r.reading_date): r["count"]
                for r in rows.groupBy("reading_date").count().collect()}

    @staticmethod
    def _in_days(days: list[str | None]) -> Column:
        listed = F.col("reading_date").isin([date.fromisoformat(d) for d in days if d is not None])
        return F.coalesce(listed, F.lit(None in days))

    def publish_staged_days(self, stage: StagedDays) -> LoadAudit:
        """Replace and append what ``stage`` holds; see ``load_overwrite_days``."""
        rows = stage.written if stage.written is not None else self.spark.read.schema(self._schema()).parquet(stage.path)
        replaced = [d for d in {*stage.counts, *stage.listed} if stage.replaces(d)]
        deleted = self._day_counts(self.sensor_readings().where(self._in_days(replaced))) if replaced else {}
        held = [d for d in replaced if d in stage.counts]
        others = [d for d in stage.counts if not stage.replaces(d)]
        if held:
            self._insert("OVERWRITE", rows.where(self._in_days(held)).hint("rebalance", "reading_date"))
        self._drop_days([d for d in replaced if d not in stage.counts])
        if others:
            self._insert("INTO", rows.where(self._in_days(others)).hint("rebalance", "reading_date"))
        audits = []
        for d in sorted({*stage.counts, *deleted, *stage.rejected}, key=lambda d: (d is not None, d)):
            n = stage.counts.get(d, 0)
            audits.append(LoadAudit(d, n, n, deleted.get(d, 0), 0 if stage.replaces(d) else n, stage.rejected.get(d, 0)))
        sums = (sum(getattr(a, c) for a in audits) for c in ("rows_in", "rows_inserted", "rows_deleted", "rows_out_of_day", "rows_rejected"))
        return LoadAudit(None, *sums, audits)

    def _drop_days(self, days: list[str | None]) -> None:
        """Drop days with one statement, and their files (the table's files outlive its entries in the catalog)."""
        if not days:
            return
        parts = ", ".join(f"PARTITION (reading_date = DATE'{d}')" for d in sorted(days))
        self.spark.sql(f"ALTER TABLE {self.sensor_table} DROP IF EXISTS {parts}")
        for d in days:
            remove_dir(self.spark, f"{self.root}/sensor_readings/reading_date={d}")
        self.spark.catalog.refreshTable(self.sensor_table)

    # ---- customer writes ---------------------------------------------------
    def _write_customers(self, rows: DataFrame, checked: bool = False, whole: bool = False) -> None:
        """Replace the partitions that ``rows`` holds (``whole``: and drop the others).

        ``checked``: the rows come from a read of this table, whose keys were
        checked when they came in, and are written without a shuffle. Otherwise
        they are first hash-partitioned like the table, so that every partition
        is written by one task, and a NULL or repeated key fails the job.
        """
        rows = rows.select(
            F.when(F.length("user_id") > 50, F.raise_error(F.lit("user_id longer than VARCHAR(50)")))
            .otherwise(F.col("user_id"))
            .alias("user_id"),
            F.col("income").cast("int"),
            F.col("loan_amt").cast("int"),
            F.col("credit_score").cast("int"),
            F.when(F.length("grade") > 10, F.raise_error(F.lit("grade longer than VARCHAR(10)")))
            .otherwise(F.col("grade"))
            .alias("grade"),
            F.col("created_at").cast("timestamp"),
        ).withColumn(_BUCKET, self._bucket())
        if not checked:
            rows = _unique_keys(rows.repartition(self._buckets or self._table_buckets(), _BUCKET))
        obs = Observation(f"customers_{_uid()}")
        held = F.collect_set(_BUCKET).alias("held")  # no more than the table has partitions
        view = self._view(rows.observe(obs, held))
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.customer_table} PARTITION ({_BUCKET}) "
                           f"SELECT {', '.join(rows.columns)} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        if whole:
            self._drop_buckets({*range(self._buckets or self._table_buckets())} - {*observed(obs, rows, held)["held"]})

    def _drop_buckets(self, buckets: set[int]) -> None:
        """Drop partitions with one statement, and their files (they outlive the catalog's entries)."""
        if not buckets:
            return
        parts = ", ".join(f"PARTITION ({_BUCKET} = {k})" for k in sorted(buckets))
        self.spark.sql(f"ALTER TABLE {self.customer_table} DROP IF EXISTS {parts}")
        root = self._customer_path(self._buckets or self._table_buckets())
        for k in buckets:
            remove_dir(self.spark, f"{root}/{_BUCKET}={k}")
        self.spark.catalog.refreshTable(self.customer_table)

    def reload_customers(self, applicants: DataFrame) -> None:
        """C1 ``customer_reload``: truncate and insert ``(user_id, income, loan_amt)``; scores NULL."""
        self._write_customers(
            applicants.select(
                "user_id",
                "income",
                "loan_amt",
                F.lit(None).cast("int").alias("credit_score"),
                F.lit(None).cast("string").alias("grade"),
                F.current_timestamp().alias("created_at"),
            ),
            whole=True,
        )

    def seed_customers(self, rows: DataFrame) -> None:
        """Publish a given customer state (``user_id, income, loan_amt, credit_score, grade``)."""
        self._write_customers(rows.select(*CUSTOMER_COLUMNS, F.current_timestamp().alias("created_at")), whole=True)

    def insert_scores(self, responses: DataFrame, on_conflict: str = "fail", order: str | None = None) -> int:
        """C10 ``credit_insert``: insert ``(user_id, credit_score, grade)``; other columns NULL.

        A key that exists already (or twice in the batch) is an error, as with
        a primary key, and so is a NULL key; ``on_conflict="ignore"`` skips keys
        that exist, and of duplicates within the batch keeps the first by
        ``order`` (without an order, duplicates are an error).

        The batch is computed once, into a staging folder; checks and insert
        read it from there. It is hash-partitioned like the table before the
        write, so an insert adds at most one file to a partition, and present
        keys are looked for in the partitions of the batch's keys only.
        """
        if on_conflict not in ("fail", "ignore"):
            raise ValueError(f"unknown on_conflict {on_conflict!r}")
        path = scratch_dir(self.spark, "insert")
        try:
            return self._insert_staged(responses, on_conflict, order, path)
        finally:
            remove_dir(self.spark, path)

    def _insert_staged(self, responses: DataFrame, on_conflict: str, order: str | None, path: str) -> int:
        spark = self.spark
        responses.select("user_id", "credit_score", "grade", *([order] if order else [])).write.parquet(path)
        staged = spark.read.parquet(path)
        keys = self._in_buckets(self._touched(staged)).select("user_id")
        counts = staged.groupBy("user_id").count()
        bad = counts.agg(F.count_if(F.col("user_id").isNull()), F.count_if(F.col("count") > 1)).first()
        if bad[0]:
            raise ValueError("NULL user_id in the batch")
        if bad[1] and (on_conflict == "fail" or order is None):
            raise ValueError("duplicate user_id in the batch" + ("" if on_conflict == "fail" else ": an order column decides which is first"))
        batch = staged.select("user_id", "credit_score", "grade")
        # The table streams and the batch's keys are the build side: when the
        # batch is small AQE broadcasts them and the table is not shuffled.
        clashes = keys.join(batch.select("user_id"), "user_id", "left_semi")
        if on_conflict == "fail":
            if not clashes.isEmpty():
                raise ValueError("duplicate user_id: key exists in customers")
        else:
            if bad[1]:
                batch = (staged.groupBy("user_id").agg(F.min_by(F.struct("credit_score", "grade"), F.col(order)).alias("_v"))
                         .select("user_id", "_v.credit_score", "_v.grade"))
            batch = batch.join(clashes, "user_id", "left_anti")
        obs = Observation(f"insert_{_uid()}")
        n = self._buckets or self._table_buckets()
        counted = F.count(F.lit(1)).alias("n")
        view = self._view(batch.withColumn(_BUCKET, self._bucket()).observe(obs, counted).repartition(n, _BUCKET))
        try:
            spark.sql(
                f"INSERT INTO {self.customer_table} (user_id, credit_score, grade, {_BUCKET}) "
                f"SELECT user_id, credit_score, grade, {_BUCKET} FROM {view}"
            )
        finally:
            spark.catalog.dropTempView(view)
        return observed(obs, batch, counted)["n"]

    def score_pending_in_place(self, salt: str = "", strict: bool = False, empty: str = "skip") -> dict[str, int]:
        """C12 with the built-in rule, fused: one scan of the partitions with pending rows, one write of them.

        Scoring pending rows needs no join when the scorer is a column
        expression: every row is projected once, pending rows with a valid
        request get ``credit_score``/``grade``, all others keep theirs. Same
        result as pending -> predict -> update by key, without the shuffle.
        """
        from kiln.operators.contracts import batch_gate, request_checks

        is_pending = F.col("credit_score").isNull()
        if empty == "fail":
            batch_gate(self.customers().where(is_pending), "fail")
        table = self.spark.read.table(self.customer_table)
        buckets = [r[0] for r in table.where(is_pending).select(_BUCKET).distinct().collect()]  # no more than the table has
        if not buckets:
            return {"rows": 0, "rows_updated": 0}
        current = self._in_buckets(buckets)
        typed, parts = request_checks(current)
        ok = F.coalesce(*parts).isNull()
        if strict:
            bad = F.raise_error(F.concat(F.lit("invalid request: "), F.concat_ws("; ", *parts)))
            current = current.where(F.when(is_pending & ~ok, bad).otherwise(F.lit(True)))
        hit = is_pending & ok
        new_score = credit_score(credit_draw("user_id", salt), "income")
        scored = current.select(
            "user_id", "income", "loan_amt",
            F.when(hit, new_score).otherwise(F.col("credit_score")).alias("credit_score"),
            "grade", "created_at", hit.alias("_kiln_hit"),
        ).withColumn("grade", F.when(F.col("_kiln_hit"), credit_grade("credit_score")).otherwise(F.col("grade")))
        obs = Observation(f"score_{_uid()}")
        scored = scored.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if("_kiln_hit").alias("rows_updated"))
        self._write_customers(scored.drop("_kiln_hit"), checked=True)
        m = obs.get
        return {"rows": int(m["rows"]), "rows_updated": int(m["rows_updated"])}

    def update_scores(self, updates: DataFrame, order: str | None = None) -> dict[str, int]:
        """C11 ``credit_update_by_key``: ``UPDATE customers SET credit_score, grade WHERE user_id``.

        Last duplicate wins by ``order`` (without one, duplicates are an
        error); unknown keys are ignored. The updates are computed once, into a
        staging folder; then the partitions of their keys are read, joined and
        replaced. ``rows``: the rows of those partitions.
        """
        path = scratch_dir(self.spark, "update")
        try:
            updates.select("user_id", "credit_score", "grade", *([order] if order else [])).write.parquet(path)
            staged = self.spark.read.parquet(path)
            buckets = self._touched(staged.where("user_id IS NOT NULL"))
            if not buckets:
                return {"rows": 0, "rows_updated": 0}
            obs = Observation(f"update_{_uid()}")
            counts = (F.count(F.lit(1)).alias("rows"), F.count_if("_kiln_hit").alias("rows_updated"))
            merged = apply_updates(self._in_buckets(buckets), staged, order=order)
            self._write_customers(merged.observe(obs, *counts).drop("_kiln_hit"), checked=True)
            m = observed(obs, merged, *counts)
            return {"rows": int(m["rows"]), "rows_updated": int(m["rows_updated"])}
        finally:
            remove_dir(self.spark, path)
