"""Temperature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readings strictly below this many degrees Celsius are normal.
TEMP_LIMIT_C = 100.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fahrenheit(c: str | Column) -> Column:
    """(c * 9 / 5) + 32, in exactly this order: ``c * 1.8 + 32`` differs in the last digit."""
    return _col(c) * 9 / 5 + 32


def is_normal(c: str | Column, limit: float = TEMP_LIMIT_C) -> Column:
    """Strict ``c < limit``; NULL stays NULL and NaN is false, so a filter drops both."""
    return _col(c) < F.lit(limit)


def is_loadable(c: str | Column, limit: float = TEMP_LIMIT_C, corrupt: str | None = None) -> Column:
    """Normal, dated and read whole: what the workflow loads. Never NULL."""
    ok = F.coalesce(is_normal(c, limit), F.lit(False)) & F.col("timestamp").isNotNull()
    return ok & F.col(corrupt).isNull() if corrupt else ok


def scan_reject_reason(c: str | Column, limit: float = TEMP_LIMIT_C, corrupt: str = "_corrupt_record") -> Column:
    """Why a scanned record is not loaded; NULL if it is.

    ``bad_timestamp``: the record has a timestamp that is none; ``malformed``:
    the record did not parse; ``no_timestamp``: it has none.
    """
    text = F.get_json_object(F.col(corrupt), "$.timestamp")
    return (
        F.when(F.col(corrupt).isNotNull() & F.col("timestamp").isNull() & text.isNotNull(), F.lit("bad_timestamp"))
        .when(F.col(corrupt).isNotNull(), F.lit("malformed"))
        .when(F.col("timestamp").isNull(), F.lit("no_timestamp"))
        .otherwise(reject_reason(c, limit))
    )


def reject_reason(c: str | Column, limit: float = TEMP_LIMIT_C) -> Column:
    """Why a reading is not normal; NULL for normal readings."""
    c = _col(c)
    return (
        F.when(c.isNull(), F.lit("missing"))
        .when(F.isnan(c), F.lit("not_a_number"))
        .when(c >= F.lit(limit), F.lit("over_limit"))
    )
