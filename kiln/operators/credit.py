"""Credit operators: C2 pending, C5 score, C6 grade, C8 predict, C9 predict
with a user scorer, and the keyed-merge logic behind C10/C11.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.credit import (
    BONUS_PER_STEP,
    GRADE_A_FROM,
    GRADE_B_FROM,
    INCOME_STEP,
    SCORE_CAP,
    credit_draw,
    credit_grade,
    credit_score,
)
from kiln.operators.contracts import valid_requests, valid_responses

RESPONSE_DDL = "user_id string, credit_score int, grade string"


def pending(customers: DataFrame) -> DataFrame:
    """C2 ``customer_pending``: ``SELECT user_id, income, loan_amt WHERE credit_score IS NULL``."""
    return customers.where(F.col("credit_score").isNull()).select("user_id", "income", "loan_amt")


def score(df: DataFrame, salt: str = "") -> DataFrame:
    """C5 ``credit_score``: add ``draw`` and ``credit_score``."""
    return df.withColumn("draw", credit_draw("user_id", salt)).withColumn(
        "credit_score", credit_score("draw", "income")
    )


def grade(df: DataFrame) -> DataFrame:
    """C6 ``credit_grade``: add ``grade`` from ``credit_score``."""
    return df.withColumn("grade", credit_grade("credit_score"))


def predict(requests: DataFrame, salt: str = "", strict: bool = True) -> DataFrame:
    """C8 ``credit_predict``: request batch -> response batch, one result per valid input.

    C4 -> C5 -> C6 as one lazy projection (no shuffle). ``strict`` fails the
    job on any invalid request, as the typed service fails the whole request;
    otherwise invalid requests are left out (``validate_request`` lists them
    with reasons). The built-in rule always meets the response types, so C7
    is not re-run here: a filter on the derived columns would be pushed below
    the projection and recompute the score expression once per check.
    """
    checked = valid_requests(requests.select("user_id", "income", "loan_amt"), strict=strict)
    return grade(score(checked, salt)).select("user_id", "credit_score", "grade")


def formula_scorer() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The built-in rule as a pandas batch scorer (the default for C9).

    Same values as ``predict``: the draw comes in as a column that Spark
    computed, and all else is vectorised over the Arrow batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bonus = (pdf["income"].to_numpy(np.int64) // INCOME_STEP) * BONUS_PER_STEP
            s = np.minimum(pdf["draw"].to_numpy(np.int64) + bonus, SCORE_CAP).astype(np.int32)
            g = np.where(s >= GRADE_A_FROM, "A", np.where(s >= GRADE_B_FROM, "B", "C"))
            yield pd.DataFrame({"user_id": pdf["user_id"], "credit_score": s, "grade": g})

    return run


def _one_result_each(scorer: Callable) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``scorer``, failing if the keys it returns for a partition are not exactly those it was given.

    Counts and sums of key hashes only, so a partition of any size is checked in constant memory.
    """

    def keys(pdf: pd.DataFrame) -> tuple[int, int]:
        hashes = pd.util.hash_pandas_object(pdf["user_id"].astype(object), index=False).to_numpy(np.uint64)
        return len(hashes), int(hashes.sum(dtype=np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given, got = [0, 0], [0, 0]

        def counted() -> Iterator[pd.DataFrame]:
            for pdf in batches:
                n, h = keys(pdf)
                given[0], given[1] = given[0] + n, (given[1] + h) % 2**64
                yield pdf

        for out in scorer(counted()):
            n, h = keys(out)
            got[0], got[1] = got[0] + n, (got[1] + h) % 2**64
            yield out
        if given != got:
            raise ValueError(f"the scorer must return each user_id once: {given[0]} requests, {got[0]} results"
                             + (", other keys" if given[0] == got[0] else ""))

    return run


def predict_udf(
    requests: DataFrame,
    scorer: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
    strict: bool = True,
    salt: str = "",
) -> DataFrame:
    """C9 ``credit_predict_udf``: the swap-in point for a real model.

    ``scorer`` maps an iterator of pandas request batches to response batches
    (``user_id, credit_score, grade``); it runs in the Python workers over
    Arrow batches via ``mapInPandas``, partition by partition, with no HTTP
    and nothing collected. Requests are validated before, and responses after
    against the response types (the service contract; ``validate_response``
    adds the range and grade checks). The request batches carry ``draw`` as a
    fourth column. A scorer that drops, repeats or invents a key fails the job.
    """
    checked = valid_requests(requests.select("user_id", "income", "loan_amt"), strict=strict)
    out = checked.withColumn("draw", credit_draw("user_id", salt)).mapInPandas(
        _one_result_each(scorer or formula_scorer()), RESPONSE_DDL)
    return valid_responses(out, strict=strict)


def latest_per_key(
    updates: DataFrame, key: str, columns: list[str], order: str | Column | None = None
) -> DataFrame:
    """One update per key, the last in ``order`` winning (2.5-g).

    ``max_by`` is a partial aggregate: each map task folds its rows per key
    before the shuffle, so a key holding a large share of the updates costs
    one row per task, not one task. Rows of a frame have no order of their own,
    so without ``order`` a repeated key is an error, raised by the same aggregate.
    """
    if order is None:
        once = updates.groupBy(key).agg(F.count(F.lit(1)).alias("_kiln_n"), F.any_value(F.struct(*columns)).alias("_kiln_new"))
        fail = F.raise_error(F.concat(F.lit("repeated key without an order column: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
        return once.where(F.when(F.col("_kiln_n") > 1, fail).otherwise(F.lit(True))).drop("_kiln_n")
    o = F.col(order) if isinstance(order, str) else order
    return (
        updates.withColumn("_kiln_ord", o)
        .groupBy(key)
        .agg(F.max_by(F.struct(*columns), F.col("_kiln_ord")).alias("_kiln_new"))
    )


def apply_updates(
    current: DataFrame,
    updates: DataFrame,
    key: str = "user_id",
    columns: tuple[str, ...] = ("credit_score", "grade"),
    order: str | Column | None = None,
) -> DataFrame:
    """C11 core: ``UPDATE current SET columns WHERE key`` as a left join with a hit flag.

    Unknown keys are ignored, other columns kept, and an update to NULL sets
    NULL (a flag, not ``coalesce``). Adds ``_kiln_hit`` for counting.
    The join is 1:1 (keys unique on both sides after ``latest_per_key``);
    AQE turns it into a broadcast join when the update side is small at run
    time and keeps a sort-merge join otherwise.
    """
    latest = latest_per_key(updates, key, list(columns), order).withColumn("_kiln_hit", F.lit(True))
    joined = current.join(latest, on=key, how="left")
    hit = F.coalesce(F.col("_kiln_hit"), F.lit(False))
    out = [
        (F.when(hit, F.col(f"_kiln_new.{c}")).otherwise(F.col(c)).cast(current.schema[c].dataType).alias(c))
        if c in columns
        else F.col(c)
        for c in current.columns
    ]
    return joined.select(*out, hit.alias("_kiln_hit"))
