"""The queries registered with the driver, one per SURVEY section 2 name.

Each takes ``(spark, sf_dir)``, reads the driver's tables through the
adapters, runs the operator on all of their rows, and returns a DataFrame.
Sinks write into fresh folders under the shared folder and read back.
``ORACLE_SQL`` holds the same result as DuckDB SQL over the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators import contracts, credit, sensor
from kiln.plans.credit_run import credit_run
from kiln.plans.sensor_etl import CLEAN_COLUMNS, RAW_COLUMNS, extract_stage, run_chain, run_daily, transform
from kiln.schemas import CUSTOMER_COLUMNS, SENSOR_TARGET_COLUMNS
from kiln.session import scratch_dir
from kiln.sinks.files import land_raw, write_clean_csv
from kiln.sinks.warehouse import Warehouse
from kiln.sources.adapters import applicants, readings
from kiln.sources.files import read_clean_csv, scan_raw_json
from kiln.streaming.ingest import read_ingested, read_quarantined, stream_ingest

# Fixed parameters of the registered queries.
DS = "2024-01-15"  # the run date used for one-day operators
TRAILING = 7  # days back for the trailing slice
PREVIOUS_RUN = "1995-03-01"  # customers first seen before this were scored by an earlier run
PREVIOUS_SALT = "previous-run"  # that earlier run's draw salt

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- helpers
def _clean(spark: SparkSession, d: str) -> DataFrame:
    return transform(readings(spark, d))


def _target(spark: SparkSession, d: str) -> DataFrame:
    return sensor.project_target(_clean(spark, d)).select(*SENSOR_TARGET_COLUMNS)


def _stale(spark: SparkSession, d: str) -> DataFrame:
    """A wrong earlier load: every reading, over-limit ones included."""
    return sensor.project_target(sensor.to_fahrenheit(readings(spark, d))).select(*SENSOR_TARGET_COLUMNS)


def _requests(spark: SparkSession, d: str) -> DataFrame:
    return applicants(spark, d).select("user_id", "income", "loan_amt")


def _customer_state(spark: SparkSession, d: str) -> DataFrame:
    """Customers as an earlier run left them: scored if first seen before PREVIOUS_RUN."""
    a = applicants(spark, d)
    earlier = F.coalesce(F.col("first_order") < F.lit(PREVIOUS_RUN).cast("date"), F.lit(False))
    scored = credit.grade(credit.score(a, PREVIOUS_SALT))
    return scored.select(
        "user_id", "income", "loan_amt",
        F.when(earlier, F.col("credit_score")).alias("credit_score"),
        F.when(earlier, F.col("grade")).alias("grade"),
    )


def _seeded_warehouse(spark: SparkSession, d: str) -> Warehouse:
    wh = Warehouse(spark)
    wh.ensure_tables()
    wh.seed_customers(_customer_state(spark, d))
    return wh


def _sensor_warehouse(spark: SparkSession, d: str, rows: DataFrame | None = None) -> Warehouse:
    wh = Warehouse(spark)
    wh.ensure_tables()
    wh.load_overwrite_days(_target(spark, d) if rows is None else rows)
    return wh


def _table_rows(wh: Warehouse) -> DataFrame:
    return wh.sensor_readings().select(*SENSOR_TARGET_COLUMNS)


def _custkey(df_key: str = "user_id") -> Column:
    return F.substring(df_key, 2, 20).cast("bigint")


def _out_of_day() -> Column:
    """Readings that a day's batch carries although they are dated otherwise."""
    return F.col("event_id") % 97 == 0


def _age_files(spark: SparkSession, path: str, before: str, days: int) -> None:
    """Date the files of the folders ``ds < before`` under ``path`` back, as copied or backfilled files are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    for folder in fs.listStatus(root):  # one folder for each day
        name = folder.getPath().getName()
        if name.startswith("ds=") and name[3:] < before:
            for file in fs.listStatus(folder.getPath()):
                fs.setTimes(file.getPath(), file.getModificationTime() - days * 86_400_000, -1)


def _customer_rows(wh: Warehouse) -> DataFrame:
    return wh.customers().select(*CUSTOMER_COLUMNS)


# ---------------------------------------------------------------- sources and sinks
def sensor_scan_json(spark, d):
    """A third of the readings in ISO text ('T'), a third in the day files' text, a third as arrays of which some
    elements have a temperature or a timestamp that is none: those fields are lost, the other elements are not."""
    rows, third = readings(spark, d), F.col("event_id") % 3
    root = scratch_dir(spark, "raw")
    land_raw(rows.where(third == 0).select(*RAW_COLUMNS), f"{root}/iso", timestamp_format="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    land_raw(rows.where(third == 1).select(*RAW_COLUMNS), f"{root}/plain")
    _land_arrays(rows.where(third == 2), f"{root}/arrays")
    scans = [scan_raw_json(spark, f"{root}/{k}").select(*RAW_COLUMNS) for k in ("iso", "plain", "arrays")]
    return scans[0].unionAll(scans[1]).unionAll(scans[2])


def _land_arrays(rows: DataFrame, path: str) -> None:
    """Readings as one-line JSON arrays of up to 50, some of their fields spoilt by ``event_id``."""
    text = F.col("timestamp").cast("string")
    bad_time = F.when(F.col("event_id") % 10 == 9, "some day").otherwise(text).alias("timestamp")
    head, tail = ["sensor_id", bad_time], ["status"]
    element = F.when(F.col("event_id") % 10 == 7, F.to_json(F.struct(*head, F.lit("hot").alias("temperature"), *tail))).otherwise(
        F.to_json(F.struct(*head, "temperature", *tail)))
    arrays = rows.groupBy(F.floor(F.col("event_id") / 150)).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(element)), F.lit("]")).alias("value"))
    arrays.select("value").write.text(path)


def sensor_land_raw(spark, d):
    root = scratch_dir(spark, "raw")
    for _ in range(2):  # a rerun replaces each day's file instead of adding to it
        land_raw(readings(spark, d).select(*RAW_COLUMNS), root)
    return scan_raw_json(spark, root).select(*RAW_COLUMNS, "ds")


def sensor_write_csv(spark, d):
    root = write_clean_csv(_clean(spark, d).drop("event_id"), scratch_dir(spark, "clean"))
    return read_clean_csv(spark, root).select(*CLEAN_COLUMNS)


def sensor_read_csv(spark, d):
    """Round trip through text: fractions of a second and spaces at the ends of strings come back."""
    spaced = _clean(spark, d).drop("event_id").withColumn("sensor_id", F.concat(F.lit(" "), "sensor_id", F.lit("  ")))
    root = write_clean_csv(spaced, scratch_dir(spark, "clean"))
    return read_clean_csv(spark, root).select(*CLEAN_COLUMNS)


def customer_pending(spark, d):
    wh = _seeded_warehouse(spark, d)
    return credit.pending(wh.customers())


def ensure_tables(spark, d):
    wh = Warehouse(spark)
    wh.ensure_tables()
    wh.ensure_tables()  # safe to repeat
    wh.load_append(_clean(spark, d))
    return wh.sensor_readings().select(*SENSOR_TARGET_COLUMNS, F.col("created_at").isNotNull().alias("has_created_at"))


# ---------------------------------------------------------------- sensor transforms
def sensor_filter_normal(spark, d):
    return sensor.filter_normal(readings(spark, d))


def sensor_to_fahrenheit(spark, d):
    return sensor.to_fahrenheit(readings(spark, d))


def sensor_quarantine(spark, d):
    return sensor.quarantine(readings(spark, d))


def sensor_project_target(spark, d):
    return sensor.project_target(_clean(spark, d))


def sensor_load_overwrite_day(spark, d):
    wh = _sensor_warehouse(spark, d, _stale(spark, d))
    in_batch = (F.to_date("timestamp") == F.lit(DS).cast("date")) | _out_of_day()
    wh.load_overwrite_day(_clean(spark, d).where(in_batch), DS)
    return _table_rows(wh)


def sensor_load_append(spark, d):
    wh = Warehouse(spark)
    wh.ensure_tables()
    for _ in range(2):  # a rerun duplicates, as in the reference
        wh.load_append(_clean(spark, d))
    return _table_rows(wh)


def sensor_append_once(spark, d):
    """Two batches keyed by id, each loaded again as a restarted driver would: every reading is there once."""
    wh = Warehouse(spark, batch_ids=True)
    wh.ensure_tables()
    rows = _clean(spark, d)
    early = F.coalesce(F.to_date("timestamp") < F.lit(DS).cast("date"), F.lit(False))
    for _ in range(2):
        wh.load_append(rows.where(early), batch_id="early")
        wh.load_append(rows.where(~early), batch_id="late")
    return wh.sensor_readings().select("batch_id", *SENSOR_TARGET_COLUMNS)


def sensor_day(spark, d):
    return sensor.day(_table_rows(_sensor_warehouse(spark, d)), DS)


def sensor_dense_ids(spark, d):
    """Ids for the days before DS, then the later days' ids continue from their maximum."""
    rows = sensor.project_target(_clean(spark, d))
    order = ["timestamp", "event_id"]
    # NULL dates sort first (Spark orders NULLs first ascending), so they belong to the first half
    before = F.coalesce(F.col("reading_date") < F.lit(DS).cast("date"), F.lit(True))
    first = sensor.dense_ids(rows.where(before), order)
    later = sensor.dense_ids(rows.where(~before), order, start=sensor.max_id(first))
    return first.unionByName(later)


def sensor_load_audit(spark, d):
    """One day's load, and a load of all days by day, after which DS has nothing left: every reading of it is over the limit."""
    wh = _sensor_warehouse(spark, d, _stale(spark, d))
    root, rows = scratch_dir(spark, "daily"), readings(spark, d)
    in_file = (F.to_date("timestamp") == F.lit(DS).cast("date")) | _out_of_day()
    raw_day = extract_stage(rows.where(in_file), f"{root}/raw", DS)
    one = run_daily(spark, raw_day, DS, root, wh).to_df(spark)
    wh = _sensor_warehouse(spark, d, _stale(spark, d))
    hot = F.when(F.to_date("timestamp") == F.lit(DS).cast("date"), F.col("temperature") + 1000).otherwise(F.col("temperature"))
    many = run_chain(spark, rows.withColumn("temperature", hot), root, wh).by_day(spark)
    return one.withColumn("load", F.lit("day")).unionByName(many.withColumn("load", F.lit("days")))


def sensor_trailing_days(spark, d):
    return sensor.trailing_days(_table_rows(_sensor_warehouse(spark, d)), DS, TRAILING)


def sensor_run_chain(spark, d):
    """Three runs in one root: everything; then DS again with every reading over the limit, which empties
    that day; then an append of everything (text hand-off, sealed and checked), which adds just those rows."""
    wh, root, rows = Warehouse(spark), scratch_dir(spark, "chain"), readings(spark, d)
    run_chain(spark, rows, root, wh)
    hot_day = sensor.day(rows, DS, None).withColumn("temperature", F.col("temperature") + 1000)
    run_chain(spark, hot_day, root, wh, keep_quarantine=True)
    run_chain(spark, rows, root, wh, mode="append", handoff="text", manifest="rows")
    return _table_rows(wh)


# ---------------------------------------------------------------- credit
def customer_reload(spark, d):
    wh = Warehouse(spark)
    wh.ensure_tables()
    wh.reload_customers(_requests(spark, d))
    return _customer_rows(wh)


def batch_gate(spark, d):
    """Both policies on a batch with rows and on an empty one: what passes and what is refused."""
    pending = credit.pending(_seeded_warehouse(spark, d).customers())
    out = None
    for name, batch in (("pending", pending), ("empty", pending.where("loan_amt < 0 AND loan_amt > 0"))):
        for policy in ("skip", "fail"):
            try:
                row = contracts.batch_gate(batch, policy).agg(F.count(F.lit(1)).alias("n"))
                outcome = "passed"
            except contracts.EmptyBatchError:
                row, outcome = spark.range(1).select(F.lit(0).cast("bigint").alias("n")), "refused"
            row = row.select(F.lit(name).alias("batch"), F.lit(policy).alias("policy"), F.lit(outcome).alias("outcome"), "n")
            out = row if out is None else out.unionAll(row)
    return out


def _text_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests as text, some bad by ``c_custkey % 7``: NULL, a fraction, out of range, no number; spaces are fine."""
    k = _custkey() % 7
    income, loan = F.col("income").cast("string"), F.col("loan_amt").cast("string")
    return _requests(spark, d).select(
        F.when(_custkey() % 49 != 6, F.col("user_id")).alias("user_id"),
        F.when(k == 1, F.lit(None)).when(k == 2, F.concat(income, F.lit(".5"))).when(k == 3, "99999999999").when(k == 4, "n/a")
        .otherwise(income).alias("income"),
        F.when(k == 5, F.concat(F.lit(" "), loan, F.lit(" "))).otherwise(loan).alias("loan_amt"))


def credit_validate_request(spark, d):
    return contracts.validate_request(_text_requests(spark, d))


def credit_score(spark, d):
    return credit.score(_requests(spark, d)).select("user_id", "income", "draw", "credit_score")


def credit_grade(spark, d):
    return credit.grade(credit.score(_requests(spark, d))).select("user_id", "credit_score", "grade")


def credit_validate_response(spark, d):
    """Scored requests, some spoilt by ``c_custkey % 7``: NULL score, out of range, unknown, wrong and NULL grade."""
    k = _custkey() % 7
    scored = credit.grade(credit.score(_requests(spark, d))).select(
        "user_id",
        F.when(k == 1, F.lit(None)).when(k == 2, 1200).otherwise(F.col("credit_score")).cast("int").alias("credit_score"),
        F.when(k == 3, "Z").when(k == 4, F.when(F.col("grade") == "A", "B").otherwise("A")).when(k == 5, F.lit(None))
        .otherwise(F.col("grade")).alias("grade"))
    return contracts.validate_response(scored)


def credit_predict(spark, d):
    return credit.predict(_requests(spark, d), strict=False)


def credit_predict_udf(spark, d):
    return credit.predict_udf(_requests(spark, d), strict=False)


def credit_insert(spark, d):
    """Insert into a new warehouse, and the rows as another catalog attaches them."""
    root = scratch_dir(spark, "insert-warehouse")
    wh = Warehouse(spark, root=root)
    wh.ensure_tables()
    wh.insert_scores(credit.predict(_requests(spark, d), strict=False))
    again = Warehouse(spark, root=root)
    again.ensure_tables()
    return _customer_rows(again)


def credit_update_by_key(spark, d):
    """Predictions for the pending; older wrong ones for the same keys; unknown keys; later updates to NULL."""
    wh = _seeded_warehouse(spark, d)
    new = credit.predict(credit.pending(wh.customers()), strict=False)
    old = new.select("user_id", F.lit(1).alias("credit_score"), F.lit("C").alias("grade"))
    unknown = new.select(F.concat(F.lit("X"), "user_id").alias("user_id"), "credit_score", "grade")
    cleared = wh.customers().where(_custkey() % 7 == 3).select(
        "user_id", F.lit(None).cast("int").alias("credit_score"), F.lit(None).cast("string").alias("grade"))
    updates = None
    for order, rows in enumerate((old, new, unknown, cleared)):
        rows = rows.withColumn("at", F.lit(order))
        updates = rows if updates is None else updates.unionAll(rows)
    wh.update_scores(updates, order="at")
    return _customer_rows(wh)


def credit_run_query(spark, d):
    wh = Warehouse(spark)
    credit_run(wh, _requests(spark, d))
    return _customer_rows(wh)


# ---------------------------------------------------------------- streaming
def sensor_stream_ingest(spark, d):
    """Five rounds. A sink of which every row is rejected holds no loaded row, but all of them in quarantine. The days
    from DS on; then the same landing gets earlier days in files dated ten days back; then a second landing with its own
    checkpoint writes to the same sink; then a reset checkpoint over the first landing, which adds nothing."""
    root, rows = scratch_dir(spark, "stream"), readings(spark, d)
    early = F.to_date("timestamp") < F.lit(DS).cast("date")
    other = early & (F.col("event_id") % 2 == 0)
    land_raw(rows.select(*RAW_COLUMNS).withColumn("temperature", F.lit(500.0)), f"{root}/hot")
    stream_ingest(spark, f"{root}/hot", f"{root}/hot-sink", f"{root}/hot-checkpoint")
    land_raw(rows.where(~F.coalesce(early, F.lit(False))).select(*RAW_COLUMNS), f"{root}/landing")
    stream_ingest(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint")
    land_raw(rows.where(early & ~other).select(*RAW_COLUMNS), f"{root}/landing")
    _age_files(spark, f"{root}/landing", DS, 10)
    stream_ingest(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint")
    land_raw(rows.where(other).select(*RAW_COLUMNS), f"{root}/landing-2")
    stream_ingest(spark, f"{root}/landing-2", f"{root}/sink", f"{root}/checkpoint-2")
    stream_ingest(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint-3")
    loaded = read_ingested(spark, f"{root}/sink").unionAll(read_ingested(spark, f"{root}/hot-sink"))
    left_out = None
    for sink in ("sink", "hot-sink"):
        some = read_quarantined(spark, f"{root}/{sink}").select(
            "sensor_id", "timestamp", F.col("temperature").cast("float").alias("temperature_c"),
            F.lit(None).cast("float").alias("temperature_f"), F.to_date("timestamp").alias("reading_date"), "reject_reason")
        left_out = some if left_out is None else left_out.unionByName(some)
    return loaded.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(left_out)


QUERIES: dict[str, Query] = {
    "sensor_scan_json": sensor_scan_json,
    "sensor_land_raw": sensor_land_raw,
    "sensor_write_csv": sensor_write_csv,
    "sensor_read_csv": sensor_read_csv,
    "customer_pending": customer_pending,
    "ensure_tables": ensure_tables,
    "sensor_filter_normal": sensor_filter_normal,
    "sensor_to_fahrenheit": sensor_to_fahrenheit,
    "sensor_quarantine": sensor_quarantine,
    "sensor_project_target": sensor_project_target,
    "sensor_load_overwrite_day": sensor_load_overwrite_day,
    "sensor_load_append": sensor_load_append,
    "sensor_append_once": sensor_append_once,
    "sensor_day": sensor_day,
    "sensor_dense_ids": sensor_dense_ids,
    "sensor_load_audit": sensor_load_audit,
    "sensor_trailing_days": sensor_trailing_days,
    "sensor_run_chain": sensor_run_chain,
    "customer_reload": customer_reload,
    "batch_gate": batch_gate,
    "credit_validate_request": credit_validate_request,
    "credit_score": credit_score,
    "credit_grade": credit_grade,
    "credit_validate_response": credit_validate_response,
    "credit_predict": credit_predict,
    "credit_predict_udf": credit_predict_udf,
    "credit_insert": credit_insert,
    "credit_update_by_key": credit_update_by_key,
    "credit_run": credit_run_query,
    "sensor_stream_ingest": sensor_stream_ingest,
}


# ---------------------------------------------------------------- DuckDB oracle
_R = """readings AS (
    SELECT 'SENSOR_' || CAST(user_id AS VARCHAR) AS sensor_id, ts AS timestamp,
           CAST(value AS DOUBLE) AS temperature, 'on' AS status, event_id
    FROM events)"""
_CLEAN = """clean AS (
    SELECT *, temperature * 9 / 5 + 32 AS temperature_f FROM readings WHERE temperature < 100)"""
_TARGET = """target AS (
    SELECT sensor_id, timestamp, CAST(temperature AS FLOAT) AS temperature_c,
           CAST(temperature_f AS FLOAT) AS temperature_f, CAST(timestamp AS DATE) AS reading_date, event_id
    FROM clean)"""
_STALE = """stale AS (
    SELECT sensor_id, timestamp, CAST(temperature AS FLOAT) AS temperature_c,
           CAST(temperature * 9 / 5 + 32 AS FLOAT) AS temperature_f, CAST(timestamp AS DATE) AS reading_date
    FROM readings)"""
_SENSOR = f"WITH {_R},\n{_CLEAN},\n{_TARGET},\n{_STALE}\n"
_T = "sensor_id, timestamp, temperature_c, temperature_f, reading_date"


def _draw(key: str, salt: str = "") -> str:
    return f"CAST(300 + CAST(('0x' || substr(md5({key} || '{salt}'), 1, 8)) AS BIGINT) % 301 AS INTEGER)"


def _score(key: str, income: str, salt: str = "") -> str:
    base = f"{_draw(key, salt)} + CAST(floor({income} / 1000) AS INTEGER) * 10"
    return f"CAST(CASE WHEN {base} IS NOT NULL THEN least({base}, 990) END AS INTEGER)"


def _grade(s: str) -> str:
    return f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} >= 800 THEN 'A' WHEN {s} >= 600 THEN 'B' ELSE 'C' END"


_A = """applicants AS (
    SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS user_id, CAST(floor(c.c_acctbal * 4) AS INTEGER) AS income,
           CAST(floor(o.max_price / 100) AS INTEGER) AS loan_amt, CAST(o.first_order AS DATE) AS first_order
    FROM customer c LEFT JOIN (
        SELECT o_custkey, max(o_totalprice) AS max_price, min(o_orderdate) AS first_order
        FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"""
_STATE = f"""state AS (
    SELECT user_id, income, loan_amt,
           CASE WHEN first_order < DATE '{PREVIOUS_RUN}' THEN {_score('user_id', 'income', PREVIOUS_SALT)} END AS credit_score,
           CASE WHEN first_order < DATE '{PREVIOUS_RUN}' THEN {_grade(_score('user_id', 'income', PREVIOUS_SALT))} END AS grade
    FROM applicants)"""
_PRED = f"""predicted AS (
    SELECT user_id, {_score('user_id', 'income')} AS credit_score, {_grade(_score('user_id', 'income'))} AS grade
    FROM applicants WHERE user_id IS NOT NULL AND income IS NOT NULL AND loan_amt IS NOT NULL)"""
_CREDIT = f"WITH {_A},\n{_STATE},\n{_PRED}\n"

_RAW = "sensor_id, timestamp, temperature, status"
_K = "CAST(substr(user_id, 2) AS BIGINT)"
_IN_FILE = f"(CAST(timestamp AS DATE) = DATE '{DS}' OR event_id % 97 = 0)"
_SPOILT = f"""spoilt AS (
    SELECT user_id, CASE {_K} % 7 WHEN 1 THEN NULL WHEN 2 THEN 1200 ELSE s END AS credit_score,
           CASE {_K} % 7 WHEN 3 THEN 'Z' WHEN 4 THEN CASE WHEN g = 'A' THEN 'B' ELSE 'A' END WHEN 5 THEN NULL ELSE g END AS grade
    FROM (SELECT user_id, {_score('user_id', 'income')} AS s, {_grade(_score('user_id', 'income'))} AS g FROM applicants))"""

ORACLE_SQL: dict[str, str] = {
    "sensor_scan_json": _SENSOR + """SELECT sensor_id, CASE WHEN event_id % 3 = 2 AND event_id % 10 = 9 THEN NULL ELSE timestamp END AS timestamp,
        CASE WHEN event_id % 3 = 2 AND event_id % 10 = 7 THEN NULL ELSE temperature END AS temperature, status FROM readings""",
    "sensor_land_raw": _SENSOR + f"SELECT {_RAW}, CAST(timestamp AS DATE) AS ds FROM readings",
    "sensor_write_csv": _SENSOR + f"SELECT {_RAW}, temperature_f FROM clean",
    "sensor_read_csv": _SENSOR + "SELECT ' ' || sensor_id || '  ' AS sensor_id, timestamp, temperature, status, temperature_f FROM clean",
    "customer_pending": _CREDIT + "SELECT user_id, income, loan_amt FROM state WHERE credit_score IS NULL",
    "ensure_tables": _SENSOR + f"SELECT {_T}, TRUE AS has_created_at FROM target",
    "sensor_filter_normal": _SENSOR + "SELECT * FROM readings WHERE temperature < 100",
    "sensor_to_fahrenheit": _SENSOR + "SELECT *, temperature * 9 / 5 + 32 AS temperature_f FROM readings",
    "sensor_quarantine": _SENSOR + """SELECT *, CASE WHEN temperature IS NULL THEN 'missing'
        WHEN isnan(temperature) THEN 'not_a_number' ELSE 'over_limit' END AS reject_reason
        FROM readings WHERE NOT coalesce(temperature < 100, FALSE)""",
    "sensor_project_target": _SENSOR + "SELECT * FROM target",
    "sensor_load_overwrite_day": _SENSOR + f"""SELECT {_T} FROM stale WHERE reading_date IS DISTINCT FROM DATE '{DS}'
        UNION ALL SELECT {_T} FROM target WHERE {_IN_FILE}""",
    "sensor_load_append": _SENSOR + f"SELECT {_T} FROM target UNION ALL SELECT {_T} FROM target",
    "sensor_append_once": _SENSOR + f"""SELECT {_T},
        CASE WHEN reading_date < DATE '{DS}' THEN 'early' ELSE 'late' END AS batch_id FROM target""",
    "sensor_day": _SENSOR + f"SELECT {_T} FROM target WHERE reading_date = DATE '{DS}'",
    "sensor_dense_ids": _SENSOR + "SELECT *, row_number() OVER (ORDER BY timestamp NULLS FIRST, event_id NULLS FIRST) AS id FROM target",
    "sensor_load_audit": _SENSOR + f"""SELECT 'day' AS load, DATE '{DS}' AS ds,
        (SELECT count(*) FROM clean WHERE {_IN_FILE}) AS rows_in,
        (SELECT count(*) FROM clean WHERE {_IN_FILE}) AS rows_inserted,
        (SELECT count(*) FROM stale WHERE reading_date = DATE '{DS}') AS rows_deleted,
        (SELECT count(*) FROM clean WHERE event_id % 97 = 0 AND CAST(timestamp AS DATE) <> DATE '{DS}') AS rows_out_of_day,
        (SELECT count(*) FROM readings WHERE {_IN_FILE}
            AND NOT coalesce(temperature < 100, FALSE)) AS rows_rejected
        UNION ALL
        SELECT 'days', d, CASE WHEN d = DATE '{DS}' THEN 0 ELSE n_clean END, CASE WHEN d = DATE '{DS}' THEN 0 ELSE n_clean END, n, 0,
            CASE WHEN d = DATE '{DS}' THEN n ELSE n - n_clean END
        FROM (SELECT CAST(timestamp AS DATE) AS d, count(*) AS n, count(*) FILTER (coalesce(temperature < 100, FALSE)) AS n_clean
              FROM readings GROUP BY 1)""",
    "sensor_trailing_days": _SENSOR + f"""SELECT {_T} FROM target
        WHERE reading_date BETWEEN DATE '{DS}' - INTERVAL {TRAILING} DAY AND DATE '{DS}'""",
    "sensor_run_chain": _SENSOR + f"""SELECT {_T} FROM target WHERE reading_date <> DATE '{DS}'
        UNION ALL SELECT {_T} FROM target""",
    "customer_reload": _CREDIT + """SELECT user_id, income, loan_amt, CAST(NULL AS INTEGER) AS credit_score,
        CAST(NULL AS VARCHAR) AS grade FROM applicants""",
    "batch_gate": _CREDIT + """SELECT batch, policy, outcome, CASE batch WHEN 'pending' THEN
            (SELECT count(*) FROM state WHERE credit_score IS NULL) ELSE 0 END AS n
        FROM (VALUES ('pending', 'skip', 'passed'), ('pending', 'fail', 'passed'), ('empty', 'skip', 'passed'),
                     ('empty', 'fail', 'refused')) AS v(batch, policy, outcome)""",
    "credit_validate_request": _CREDIT + f"""SELECT CASE WHEN {_K} % 49 <> 6 THEN user_id END AS user_id,
        CASE WHEN {_K} % 7 IN (1, 2, 3, 4) THEN NULL ELSE income END AS income, loan_amt,
        nullif(concat_ws('; ', CASE WHEN {_K} % 49 = 6 THEN 'user_id: missing' END,
                               CASE WHEN {_K} % 7 IN (3, 4) THEN 'income: not an integer'
                                    WHEN {_K} % 7 = 1 OR income IS NULL THEN 'income: missing'
                                    WHEN {_K} % 7 = 2 THEN 'income: not an integer' END,
                               CASE WHEN loan_amt IS NULL THEN 'loan_amt: missing' END), '') AS reject_reason
        FROM applicants""",
    "credit_score": _CREDIT + f"""SELECT user_id, income, {_draw('user_id')} AS draw,
        {_score('user_id', 'income')} AS credit_score FROM applicants""",
    "credit_grade": _CREDIT + f"""SELECT user_id, {_score('user_id', 'income')} AS credit_score,
        {_grade(_score('user_id', 'income'))} AS grade FROM applicants""",
    "credit_validate_response": f"WITH {_A},\n{_SPOILT}\n" + """SELECT user_id, credit_score, grade,
        nullif(concat_ws('; ', CASE WHEN credit_score IS NULL THEN 'credit_score: missing' END,
            CASE WHEN grade IS NULL THEN 'grade: missing' END,
            CASE WHEN credit_score NOT BETWEEN 0 AND 1000 THEN 'credit_score: outside 0..1000' END,
            CASE WHEN grade NOT IN ('A', 'B', 'C') THEN 'grade: not one of A, B, C' END,
            CASE WHEN grade IN ('A', 'B', 'C') AND grade <> CASE WHEN credit_score >= 800 THEN 'A' WHEN credit_score >= 600 THEN 'B' ELSE 'C' END
                 THEN 'grade: does not match credit_score' END), '') AS reject_reason
        FROM spoilt""",
    "credit_predict": _CREDIT + "SELECT * FROM predicted",
    "credit_predict_udf": _CREDIT + "SELECT * FROM predicted",
    "credit_insert": _CREDIT + """SELECT user_id, CAST(NULL AS INTEGER) AS income, CAST(NULL AS INTEGER) AS loan_amt,
        credit_score, grade FROM predicted""",
    "credit_update_by_key": _CREDIT + f"""SELECT s.user_id, s.income, s.loan_amt,
        CASE WHEN {_K.replace('user_id', 's.user_id')} % 7 = 3 THEN NULL WHEN p.user_id IS NOT NULL THEN p.credit_score ELSE s.credit_score END AS credit_score,
        CASE WHEN {_K.replace('user_id', 's.user_id')} % 7 = 3 THEN NULL WHEN p.user_id IS NOT NULL THEN p.grade ELSE s.grade END AS grade
        FROM state s LEFT JOIN predicted p ON s.user_id = p.user_id AND s.credit_score IS NULL""",
    "credit_run": _CREDIT + """SELECT a.user_id, a.income, a.loan_amt, p.credit_score, p.grade
        FROM applicants a LEFT JOIN predicted p ON a.user_id = p.user_id""",
    "sensor_stream_ingest": _SENSOR + f"""SELECT {_T}, NULL AS reject_reason FROM target
        UNION ALL SELECT sensor_id, timestamp, CAST(temperature AS FLOAT), NULL, CAST(timestamp AS DATE),
            CASE WHEN temperature IS NULL THEN 'missing' WHEN isnan(temperature) THEN 'not_a_number' ELSE 'over_limit' END
        FROM readings WHERE NOT coalesce(temperature < 100 AND NOT isnan(temperature), FALSE)
        UNION ALL SELECT sensor_id, timestamp, CAST(500 AS FLOAT), NULL, CAST(timestamp AS DATE), 'over_limit' FROM readings""",
}
