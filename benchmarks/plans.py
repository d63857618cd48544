"""Print the physical plans of the core operators (for PLANS.md).

Usage: python benchmarks/plans.py [sf_dir] > plans.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from kiln.operators import credit, sensor
    from kiln.plans import registered as R
    from kiln.plans.sensor_etl import transform
    from kiln.session import get_spark
    from kiln.sources.adapters import applicants, readings

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("plans", shuffle_partitions=8)

    def show(title: str, df) -> None:
        df.collect()  # run this DataFrame itself, so the adaptive plan printed is the final one
        print(f"\n### {title}\n\n```")
        print(df._jdf.queryExecution().executedPlan().toString().rstrip())
        print("```")

    show("S7+S8+S10: clean readings in warehouse shape", sensor.project_target(transform(readings(spark, sf))))
    show("C8: predict over the applicants", credit.predict(applicants(spark, sf).select("user_id", "income", "loan_amt"), strict=False))
    show("S14: dense ids", sensor.dense_ids(sensor.project_target(transform(readings(spark, sf))), ["timestamp", "event_id"]))
    wh = R._seeded_warehouse(spark, sf)
    show("C2: pending customers", credit.pending(wh.customers()))
    ups = credit.predict(credit.pending(wh.customers()), strict=False)
    show("C11: keyed merge (small batch: AQE broadcast)", credit.apply_updates(wh.customers(), ups))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    show("C11: keyed merge (batch too large to broadcast: bucketed table, only the batch shuffles)",
         credit.apply_updates(wh.customers(), credit.predict(credit.pending(wh.customers()), strict=False)))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sw = R._sensor_warehouse(spark, sf)
    show("S13: one day from the partitioned table", sensor.day(sw.sensor_readings(), R.DS))


if __name__ == "__main__":
    main()
