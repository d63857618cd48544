"""kiln: sensor ETL and batch credit scoring as plain Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function (usable through
``df.transform``) or a sink that writes through Spark's own writers and SQL.
"""

from kiln.session import get_spark, scratch_dir, shared_dir
from kiln.sinks.warehouse import Warehouse
from kiln.plans.credit_run import credit_run
from kiln.plans.sensor_etl import run_chain, run_daily
from kiln.streaming.ingest import stream_ingest

__all__ = ["get_spark", "shared_dir", "scratch_dir", "Warehouse", "credit_run", "run_chain", "run_daily", "stream_ingest"]
