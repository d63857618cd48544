"""Batch contracts: C3 batch gate, C4 request validation, C7 response validation.

Validation adds a ``reject_reason`` column (NULL = valid) instead of failing
on the first bad record, so rejects can be counted and named. ``strict=True``
fails the whole batch as the reference's typed service does; the failure is
a ``raise_error`` inside the same lazy plan, so it costs no extra pass.

Our coercion rule for integer fields (not a claim of parity with any
particular validation library): integer types pass; 64-bit integers and
integral floats/decimals pass when they fit in 32 bits; strings pass when they
are an optionally signed run of digits that fits; NULL, NaN, fractions,
booleans and everything else are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.credit import GRADE_A_FROM, GRADE_B_FROM, GRADES

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
SCORE_MIN, SCORE_MAX = 0, 1000  # the response contract's documented range


class EmptyBatchError(ValueError):
    pass


def batch_gate(df: DataFrame, policy: str = "skip") -> DataFrame:
    """C3 ``batch_gate``: decide what an empty batch means.

    ``skip`` (default): an empty batch is normal and passes through empty;
    ``fail``: raise ``EmptyBatchError``. The emptiness test reads at most one row.
    """
    if policy not in ("skip", "fail"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "fail" and df.isEmpty():
        raise EmptyBatchError("empty batch")
    return df


def _as_int(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(typed value, reason) for a required 32-bit integer field."""
    c = F.col(name)
    dtype = df.schema[name].dataType
    missing = F.lit(f"{name}: missing")
    bad = F.lit(f"{name}: not an integer")
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int"), F.when(c.isNull(), missing)
    if isinstance(dtype, T.LongType):
        ok = c.between(INT_MIN, INT_MAX)
        return F.when(ok, c.cast("int")), F.when(c.isNull(), missing).when(~ok, bad)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = c.cast("double")
        ok = ~F.isnan(d) & (d == F.floor(d)) & d.between(INT_MIN, INT_MAX)
        return F.when(ok, d.cast("int")), F.when(c.isNull(), missing).when(~ok, bad)
    if isinstance(dtype, T.StringType):
        s = F.trim(c)
        v = F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))
        return v, F.when(c.isNull(), missing).when(v.isNull(), bad)
    return F.lit(None).cast("int"), F.when(c.isNull(), missing).otherwise(bad)


def _as_str(df: DataFrame, name: str) -> tuple[Column, Column]:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.StringType, T.VarcharType, T.CharType)):
        return c.cast("string"), F.when(c.isNull(), F.lit(f"{name}: missing"))
    return F.lit(None).cast("string"), F.when(c.isNull(), F.lit(f"{name}: missing")).otherwise(
        F.lit(f"{name}: not a string")
    )


def _reasons(*parts: Column) -> Column:
    joined = F.concat_ws("; ", *parts)
    return F.when(joined != "", joined)


def _finish(df: DataFrame, typed: dict[str, Column], parts: list[Column], strict: bool, what: str,
            keep_rejected: bool = True) -> DataFrame:
    """Typed columns + other input columns + ``reject_reason``.

    With ``keep_rejected=False`` the invalid rows are filtered out by a plain
    null test on the checks (no reason strings are built for that) and no
    reason column is added.
    """
    keep = [F.col(c) for c in df.columns if c not in typed and c != "reject_reason"]
    cols = [v.alias(k) for k, v in typed.items()]
    if strict:
        # a filter that raises on the first invalid row: unlike a column it
        # cannot be pruned away when nobody reads it
        fail = F.raise_error(F.concat(F.lit(f"invalid {what}: "), _reasons(*parts)))
        df = df.where(F.when(F.coalesce(*parts).isNotNull(), fail).otherwise(F.lit(True)))
        if not keep_rejected:
            return df.select(*cols, *keep)
        return df.select(*cols, *keep, F.lit(None).cast("string").alias("reject_reason"))
    if not keep_rejected:
        return df.where(F.coalesce(*parts).isNull()).select(*cols, *keep)
    return df.select(*cols, *keep, _reasons(*parts).alias("reject_reason"))


def request_checks(df: DataFrame) -> tuple[dict[str, Column], list[Column]]:
    uid, r_uid = _as_str(df, "user_id")
    inc, r_inc = _as_int(df, "income")
    loan, r_loan = _as_int(df, "loan_amt")
    return {"user_id": uid, "income": inc, "loan_amt": loan}, [r_uid, r_inc, r_loan]


def response_checks(df: DataFrame, full: bool) -> tuple[dict[str, Column], list[Column]]:
    uid, r_uid = _as_str(df, "user_id")
    score, r_score = _as_int(df, "credit_score")
    grade, r_grade = _as_str(df, "grade")
    parts = [r_uid, r_score, r_grade]
    if full:
        parts.append(F.when(~score.between(SCORE_MIN, SCORE_MAX), F.lit(f"credit_score: outside {SCORE_MIN}..{SCORE_MAX}")))
        parts.append(F.when(~grade.isin(*GRADES), F.lit("grade: not one of " + ", ".join(GRADES))))
        expected = F.when(score >= GRADE_A_FROM, "A").when(score >= GRADE_B_FROM, "B").otherwise("C")
        parts.append(F.when(grade.isin(*GRADES) & (grade != expected), F.lit("grade: does not match credit_score")))
    return {"user_id": uid, "credit_score": score, "grade": grade}, parts


def validate_request(df: DataFrame, strict: bool = False) -> DataFrame:
    """C4 ``credit_validate_request``: typed ``user_id:str, income:int, loan_amt:int``, all required.

    Output: ``user_id, income, loan_amt`` typed (NULL where that field is
    invalid), any other input columns, and ``reject_reason``.
    """
    typed, parts = request_checks(df)
    return _finish(df, typed, parts, strict, "request")


def valid_requests(df: DataFrame, strict: bool = False) -> DataFrame:
    """The valid requests only, typed (strict: fail on any invalid one)."""
    typed, parts = request_checks(df)
    return _finish(df, typed, parts, strict, "request", keep_rejected=False)


def validate_response(df: DataFrame, strict: bool = False, full: bool = True) -> DataFrame:
    """C7 ``credit_validate_response``: typed ``user_id:str, credit_score:int, grade:str``.

    Types are the service contract (``full=False`` checks only those); the
    range 0..1000, the grade set and the grade/score agreement are our
    additional checks.
    """
    typed, parts = response_checks(df, full)
    return _finish(df, typed, parts, strict, "response")


def valid_responses(df: DataFrame, strict: bool = False, full: bool = False) -> DataFrame:
    typed, parts = response_checks(df, full)
    return _finish(df, typed, parts, strict, "response", keep_rejected=False)


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())
