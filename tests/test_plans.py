"""Plan shape: what must hold for the jobs to scale (pushdown, pruning, no stray shuffles)."""

from kiln.operators import sensor
from kiln.plans.sensor_etl import transform
from kiln.sources.adapters import applicants, readings

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sensor_transforms_are_narrow_and_pushed_down(spark):
    df = sensor.project_target(transform(readings(spark, SF)))
    plan = _plan(df)
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(value), LessThan(value,100.0)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "event_type" not in plan and "props" not in plan
    assert plan.startswith("*(1)")  # one whole-stage-codegen span


def test_pending_filter_reaches_the_scan(spark, tmp_path):
    from kiln.operators.credit import pending
    from kiln.sinks.warehouse import Warehouse

    wh = Warehouse(spark, root=str(tmp_path / "wh"))
    wh.ensure_tables()
    wh.reload_customers(applicants(spark, SF).select("user_id", "income", "loan_amt"))
    plan = _plan(pending(wh.customers()))
    assert "PushedFilters: [IsNull(credit_score)]" in plan
    assert "created_at" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_order_aggregate_is_partial_before_its_shuffle(spark):
    plan = _plan(applicants(spark, SF))
    assert "partial_max(o_totalprice" in plan and "partial_min(o_orderdate" in plan


def test_dense_ids_broadcasts_only_offsets(spark):
    df = sensor.project_target(transform(readings(spark, SF)))
    plan = _plan(sensor.dense_ids(df, ["timestamp", "event_id"]))
    assert "BroadcastExchange" in plan
    # the broadcast side is the per-partition offsets table (two columns)
    assert "_kiln_off" in plan


def test_predict_is_one_projection(spark):
    from kiln.operators.credit import predict

    req = applicants(spark, SF).select("user_id", "income", "loan_amt")
    plan = _plan(predict(req, strict=False))
    # only the adapter's order aggregate shuffles; scoring adds no exchange
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("md5(") <= 2


def test_update_reads_the_touched_partitions(spark, tmp_path):
    from kiln.operators.credit import apply_updates
    from kiln.sinks.warehouse import Warehouse

    wh = Warehouse(spark, root=str(tmp_path / "wh"), customer_buckets=16)
    wh.ensure_tables()
    wh.reload_customers(applicants(spark, SF).select("user_id", "income", "loan_amt"))
    updates = wh.customers().limit(1).selectExpr("user_id", "700 AS credit_score", "'B' AS grade")
    plan = _plan(apply_updates(wh._in_buckets(wh._touched(updates)), updates))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "key_bucket" in filters and filters.count(" IN ") == 0  # one of sixteen
