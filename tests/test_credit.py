"""Credit operators and keyed writes: C2-C12, SURVEY 2.5-e..k."""

import hashlib

import pytest
from pyspark.sql import functions as F

from kiln.functions.credit import credit_draw, credit_grade, credit_score
from kiln.operators import contracts, credit
from kiln.plans.credit_run import credit_run
from kiln.sinks.warehouse import Warehouse

REQ = "user_id string, income int, loan_amt int"


def _draw_py(uid, salt=""):
    return 300 + int(hashlib.md5((uid + salt).encode()).hexdigest()[:8], 16) % 301


def test_score_formula_edges(spark):
    rows = [("C1", -1500, 1), ("C2", 0, 1), ("C3", 999, 1), ("C4", 20000, 1), ("C5", 90000, 1), ("C6", None, 1)]
    got = {r.user_id: (r.draw, r.credit_score) for r in credit.score(spark.createDataFrame(rows, REQ)).collect()}
    for uid, inc, _ in rows:
        d = _draw_py(uid)
        assert got[uid][0] == d
        want = None if inc is None else min(d + (inc // 1000) * 10, 990)  # Python floor division
        assert got[uid][1] == want, uid
    assert got["C5"][1] == 990  # capped


def test_grade_edges(spark):
    df = spark.createDataFrame([(599,), (600,), (799,), (800,), (990,), (None,)], "s int")
    assert [r.g for r in df.select(credit_grade("s").alias("g")).collect()] == ["C", "B", "B", "A", "A", None]


def test_draw_range_and_partition_independence(spark):
    ids = spark.range(20000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("user_id"))
    a = ids.select("user_id", credit_draw("user_id").alias("d"))
    lo, hi = a.agg(F.min("d"), F.max("d")).first()
    assert (lo, hi) == (300, 600)
    b = ids.repartition(13).select("user_id", credit_draw("user_id").alias("d"))
    assert a.exceptAll(b).count() == 0
    salted = ids.select(credit_draw("user_id", "x").alias("d")).agg(F.sum("d")).first()[0]
    assert salted != a.agg(F.sum("d")).first()[0]


def test_validate_request_coercions(spark):
    df = spark.createDataFrame(
        [("C1", "5000", "2000"), ("C2", "5000.0", "1"), (None, "1", "1"), ("C4", "x", None), ("C5", " -12 ", "3"), ("C6", "99999999999", "1")],
        "user_id string, income string, loan_amt string",
    )
    got = {r.user_id: (r.income, r.loan_amt, r.reject_reason) for r in contracts.validate_request(df).collect()}
    assert got["C1"] == (5000, 2000, None)
    assert got["C2"][2] == "income: not an integer"
    assert got[None][2] == "user_id: missing"
    assert got["C4"][2] == "income: not an integer; loan_amt: missing"
    assert got["C5"] == (-12, 3, None)
    assert got["C6"][2] == "income: not an integer"
    dbl = spark.createDataFrame([("A", 5000.0, 1.0), ("B", 5000.5, 1.0), ("C", float("nan"), 1.0)], "user_id string, income double, loan_amt double")
    got = {r.user_id: r.reject_reason for r in contracts.validate_request(dbl).collect()}
    assert got == {"A": None, "B": "income: not an integer", "C": "income: not an integer"}


def test_strict_request_fails_whole_batch(spark):
    df = spark.createDataFrame([("C1", 5000, 1), ("C2", None, 1)], REQ)
    with pytest.raises(Exception, match="invalid request"):
        credit.predict(df, strict=True).collect()
    assert credit.predict(df, strict=False).count() == 1


def test_validate_response(spark):
    df = spark.createDataFrame([("A", 850, "A"), ("B", 1200, "A"), ("C", 700, "A"), ("D", 500, "Z"), ("E", None, "C")], "user_id string, credit_score int, grade string")
    got = {r.user_id: r.reject_reason for r in contracts.validate_response(df).collect()}
    assert got["A"] is None
    assert got["B"] == "credit_score: outside 0..1000"
    assert got["C"] == "grade: does not match credit_score"
    assert got["D"] == "grade: not one of A, B, C"
    assert got["E"] == "credit_score: missing"


def test_predict_one_result_per_input_and_udf_agrees(spark):
    df = spark.createDataFrame([("C001", 5000, 2000), ("C002", 4000, 5000), ("C003", 8000, 1000), ("C004", 30000, 1), ("C005", -1500, 1)], REQ)
    a = credit.predict(df)
    b = credit.predict_udf(df)
    assert a.count() == 5
    assert sorted(a.collect()) == sorted(b.collect())
    ranges = {"C001": (350, 650), "C002": (340, 640), "C003": (380, 680)}
    for r in a.collect():
        if r.user_id in ranges:
            lo, hi = ranges[r.user_id]
            assert lo <= r.credit_score <= hi


def test_custom_scorer(spark):
    import pandas as pd

    def flat(batches):
        for pdf in batches:
            yield pd.DataFrame({"user_id": pdf["user_id"], "credit_score": 700, "grade": "B"})

    df = spark.createDataFrame([("C1", 1, 1), ("C2", 2, 2)], REQ)
    assert {tuple(r) for r in credit.predict_udf(df, flat).collect()} == {("C1", 700, "B"), ("C2", 700, "B")}


def test_batch_gate(spark):
    empty = spark.createDataFrame([], REQ)
    assert contracts.batch_gate(empty).count() == 0
    with pytest.raises(contracts.EmptyBatchError):
        contracts.batch_gate(empty, "fail")


@pytest.fixture()
def wh(spark, tmp_path):
    w = Warehouse(spark, root=str(tmp_path / "wh"))
    w.ensure_tables()
    return w


def _state(wh):
    return {r.user_id: (r.income, r.loan_amt, r.credit_score, r.grade) for r in wh.customers().collect()}


def test_update_by_key_semantics(spark, wh):
    wh.reload_customers(spark.createDataFrame([("C1", 5000, 10), ("C2", 6000, 20), ("C3", 7000, 30)], REQ))
    assert credit.pending(wh.customers()).count() == 3
    ups = spark.createDataFrame(
        [("C1", 500, "C", 1), ("C1", 810, "A", 2), ("C2", None, None, 1), ("C9", 1, "C", 1)],
        "user_id string, credit_score int, grade string, ord int",
    )
    wh.update_scores(ups.select("user_id", "credit_score", "grade", "ord"), order="ord")
    s = _state(wh)
    assert s["C1"] == (5000, 10, 810, "A")  # last wins
    assert s["C2"] == (6000, 20, None, None)  # update to NULL sets NULL
    assert s["C3"] == (7000, 30, None, None)
    assert "C9" not in s and len(s) == 3  # unknown key ignored, row count kept
    assert wh.customers().where("created_at IS NULL").count() == 0


def test_insert_fails_on_existing_key_or_ignores(spark, wh):
    resp = spark.createDataFrame([("C1", 700, "B"), ("C2", 650, "B")], "user_id string, credit_score int, grade string")
    assert wh.insert_scores(resp) == 2
    assert _state(wh)["C1"] == (None, None, 700, "B")
    with pytest.raises(ValueError):
        wh.insert_scores(resp)
    more = spark.createDataFrame([("C2", 1, "C", 1), ("C3", 2, "C", 2), ("C3", 3, "C", 3)], "user_id string, credit_score int, grade string, at int")
    with pytest.raises(ValueError):
        wh.insert_scores(more.where("user_id = 'C3'"))
    with pytest.raises(ValueError, match="order"):
        wh.insert_scores(more, on_conflict="ignore")  # rows of a frame have no order of their own
    assert wh.insert_scores(more, on_conflict="ignore", order="at") == 1
    assert len(_state(wh)) == 3 and _state(wh)["C3"][2] == 2
    with pytest.raises(ValueError, match="NULL"):
        wh.insert_scores(spark.createDataFrame([(None, 1, "C")], "user_id string, credit_score int, grade string"))


def test_customer_keys_are_unique_and_not_null(spark, wh):
    for rows in ([("C1", 1, 1), ("C1", 2, 2)], [(None, 1, 1)]):
        with pytest.raises(Exception, match="user_id"):
            wh.reload_customers(spark.createDataFrame(rows, REQ))
    assert wh.customers().count() == 0


def test_repeated_update_needs_an_order(spark, wh):
    wh.reload_customers(spark.createDataFrame([("C1", 5000, 10)], REQ))
    ups = spark.createDataFrame([("C1", 500, "C"), ("C1", 810, "A")], "user_id string, credit_score int, grade string")
    with pytest.raises(Exception, match="repeated key"):
        wh.update_scores(ups)
    assert _state(wh)["C1"][2] is None


def test_insert_is_computed_once_and_adds_one_file_to_a_bucket(spark, tmp_path):
    import os

    w = Warehouse(spark, root=str(tmp_path / "ins"), customer_buckets=4)
    w.ensure_tables()
    calls = spark.sparkContext.accumulator(0)

    def scorer(batches):
        for pdf in batches:
            calls.add(len(pdf))
            yield pdf.assign(credit_score=700, grade="B")[["user_id", "credit_score", "grade"]]

    reqs = spark.range(1000).selectExpr("concat('C', id) AS user_id", "5000 AS income", "1 AS loan_amt").repartition(12)
    assert w.insert_scores(credit.predict_udf(reqs, scorer)) == 1000
    assert calls.value == 1000
    files = [f for _, _, fs in os.walk(tmp_path / "ins" / "customers_by_4") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 4
    again = Warehouse(spark, root=str(tmp_path / "ins"))
    again.ensure_tables()
    assert again.customers().count() == 1000  # found by another catalog


def test_attached_again_with_its_own_number_of_partitions(spark, tmp_path):
    root = str(tmp_path / "v")
    a = Warehouse(spark, root=f"file:{root}", customer_buckets=5)
    a.ensure_tables()
    a.reload_customers(spark.createDataFrame([("C1", 1, 1)], REQ))
    b = Warehouse(spark, root=root, customer_buckets=3)  # the same folder, spelled otherwise
    b.ensure_tables()
    b.reload_customers(spark.createDataFrame([("C1", 1, 1), ("C2", 2, 2)], REQ))
    c = Warehouse(spark, root=f"file:{root}")
    c.ensure_tables()
    assert c.customers().count() == 2 and c._buckets == b._buckets == 5
    c.reload_customers(spark.createDataFrame([], REQ))  # truncated: every partition goes
    d = Warehouse(spark, root=root)
    d.ensure_tables()
    assert d.customers().count() == 0


def _files(top):
    import os

    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet")}


def test_update_and_insert_touch_their_partitions_only(spark, tmp_path):
    w = Warehouse(spark, root=str(tmp_path / "t"), customer_buckets=64)
    w.ensure_tables()
    w.reload_customers(spark.range(2000).selectExpr("concat('C', id) AS user_id", "5000 AS income", "1 AS loan_amt"))
    before = _files(tmp_path / "t" / "customers_by_64")
    ups = spark.range(10).selectExpr("concat('C', id * 100) AS user_id", "700 AS credit_score", "'B' AS grade")
    touched = set(w._touched(ups))
    assert 1 < len(touched) <= 10
    assert w.update_scores(ups)["rows_updated"] == 10
    after = _files(tmp_path / "t" / "customers_by_64")
    changed = {p.split("key_bucket=")[1].split("/")[0] for p in set(before.items()) ^ set(after.items()) for p in [p[0]]}
    assert changed == {str(k) for k in touched}
    assert w.customers().count() == 2000 and w.customers().where("credit_score = 700").count() == 10
    plan = w._in_buckets(sorted(touched))._jdf.queryExecution().executedPlan().toString()
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # an insert adds files to its own partitions, and a clash is found there
    new = spark.createDataFrame([("N1", 1, "C")], "user_id string, credit_score int, grade string")
    assert w.insert_scores(new) == 1
    added = set(_files(tmp_path / "t" / "customers_by_64")) - set(after)
    assert len(added) == 1 and f"key_bucket={w._touched(new)[0]}/" in added.pop()
    with pytest.raises(ValueError, match="exists"):
        w.insert_scores(new)


def test_failed_update_leaves_the_old_rows(spark, tmp_path):
    w = Warehouse(spark, root=str(tmp_path / "f"), customer_buckets=4)
    w.ensure_tables()
    w.seed_customers(spark.createDataFrame([("C1", 1, 1, 500, "C"), ("C2", 2, 2, None, None)], "user_id string, income int, loan_amt int, credit_score int, grade string"))
    before = _state(w)
    with pytest.raises(Exception, match="VARCHAR"):
        w.update_scores(spark.createDataFrame([("C1", 700, "B" * 20)], "user_id string, credit_score int, grade string"))
    with pytest.raises(Exception, match="duplicate|NULL"):
        w.reload_customers(spark.createDataFrame([("C7", 1, 1), ("C7", 2, 2)], REQ))
    assert _state(w) == before
    assert w.update_scores(spark.createDataFrame([(None, 700, "B")], "user_id string, credit_score int, grade string"))["rows_updated"] == 0


@pytest.mark.parametrize("change", ["drop", "repeat", "invent"])
def test_scorer_returns_each_key_once(spark, change):
    import pandas as pd

    def scorer(batches):
        for pdf in batches:
            out = pdf.assign(credit_score=700, grade="B")[["user_id", "credit_score", "grade"]]
            if change == "drop":
                out = out.iloc[1:]
            elif change == "repeat":
                out = pd.concat([out, out.iloc[:1]])
            else:
                out.loc[out.index[0], "user_id"] = "other"
            yield out

    df = spark.createDataFrame([("C1", 1, 1), ("C2", 2, 2)], REQ).coalesce(1)
    with pytest.raises(Exception, match="each user_id once"):
        credit.predict_udf(df, scorer).collect()


def test_credit_run_end_to_end_and_rerun(spark, wh):
    apps = spark.createDataFrame([("C1", 5000, 1), ("C2", 25000, 2), ("C3", None, 3)], REQ)
    counts = credit_run(wh, apps)
    assert counts["rows_updated"] == 2
    s = _state(wh)
    assert s["C3"][2] is None  # invalid request stays pending
    assert s["C1"][2] == min(_draw_py("C1") + 50, 990)
    again = credit_run(wh)  # only C3 is pending; nothing valid to score
    assert again["rows_updated"] == 0


def test_credit_run_empty_batch_policy(spark, wh):
    credit_run(wh, spark.createDataFrame([("C1", 5000, 1)], REQ))
    assert credit_run(wh)["rows_updated"] == 0  # skip: nothing pending is normal
    with pytest.raises(contracts.EmptyBatchError):
        credit_run(wh, empty="fail")


def test_fused_run_equals_step_by_step(spark, tmp_path):
    from kiln.plans.credit_run import credit_run_by_key
    from kiln.sources.adapters import applicants

    apps = applicants(spark, "/root/testdata/sf0.001").select("user_id", "income", "loan_amt")
    a = Warehouse(spark, root=str(tmp_path / "a"))
    b = Warehouse(spark, root=str(tmp_path / "b"))
    c = Warehouse(spark, root=str(tmp_path / "c"))
    ca = credit_run(a, apps)
    cb = credit_run_by_key(b, apps)
    cc = credit_run(c, apps, scorer=credit.formula_scorer())
    assert ca == cb == cc
    cols = ["user_id", "income", "loan_amt", "credit_score", "grade"]
    sa = sorted(a.customers().select(*cols).collect())
    assert sa == sorted(b.customers().select(*cols).collect()) == sorted(c.customers().select(*cols).collect())


def test_pending_as_sql_text_equals_operator(spark, wh):
    from kiln.sources.tables import scan_sql, scan_table

    wh.reload_customers(spark.createDataFrame([("C1", 5000, 1), ("C2", 6000, 2)], REQ))
    wh.update_scores(spark.createDataFrame([("C1", 700, "B")], "user_id string, credit_score int, grade string"))
    by_sql = scan_sql(spark, f"SELECT user_id, income, loan_amt FROM {wh.customer_table} WHERE credit_score IS NULL")
    by_table = scan_table(spark, wh.customer_table, ["user_id", "income", "loan_amt"], "credit_score IS NULL")
    want = sorted(credit.pending(wh.customers()).collect())
    assert sorted(by_sql.collect()) == sorted(by_table.collect()) == want == [("C2", 6000, 2)]
    assert "PushedFilters: [IsNull(credit_score)]" in by_sql._jdf.queryExecution().executedPlan().toString()


def test_fused_run_keeps_scored_rows_and_strict_fails(spark, tmp_path):
    from kiln.plans.credit_run import credit_run_by_key

    state = spark.createDataFrame(
        [("C1", 5000, 1, 777, "B"), ("C2", 25000, 2, None, None), ("C3", -1500, 3, None, None)],
        "user_id string, income int, loan_amt int, credit_score int, grade string",
    )
    a = Warehouse(spark, root=str(tmp_path / "a"))
    b = Warehouse(spark, root=str(tmp_path / "b"))
    for w in (a, b):
        w.ensure_tables()
        w.seed_customers(state)
    assert credit_run(a)["rows_updated"] == credit_run_by_key(b)["rows_updated"] == 2
    cols = ["user_id", "income", "loan_amt", "credit_score", "grade"]
    got = {r.user_id: r for r in a.customers().select(*cols).collect()}
    assert sorted(got.values()) == sorted(b.customers().select(*cols).collect())
    assert (got["C1"].credit_score, got["C1"].grade) == (777, "B")  # scored earlier: untouched
    assert got["C3"].credit_score == _draw_py("C3") - 20  # floor(-1.5) = -2
    c = Warehouse(spark, root=str(tmp_path / "c"))
    c.ensure_tables()
    c.seed_customers(spark.createDataFrame([("C9", None, 1, None, None)], "user_id string, income int, loan_amt int, credit_score int, grade string"))
    with pytest.raises(Exception, match="invalid request"):
        credit_run(c, strict=True)
    assert c.customers().where("credit_score IS NOT NULL").count() == 0  # nothing published
