"""Credit score expressions.

score = least(draw + floor(income / 1000) * 10, 990); grade A from 800, B from
600, else C. The draw is an integer in 300..600 inclusive. The reference draws
it at random on every call; here it is derived from the key so that it is
repeatable, independent of partitioning, and computable in plain SQL:
``300 + (first 32 bits of md5(user_id || salt)) mod 301``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring rule.
DRAW_LOW = 300
DRAW_HIGH = 600
INCOME_STEP = 1000
BONUS_PER_STEP = 10
SCORE_CAP = 990
GRADE_A_FROM = 800
GRADE_B_FROM = 600
GRADES = ("A", "B", "C")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def credit_draw(user_id: str | Column, salt: str = "") -> Column:
    """Deterministic draw in DRAW_LOW..DRAW_HIGH from md5 of the key."""
    head = F.substring(F.md5(F.concat(_col(user_id).cast("string"), F.lit(salt))), 1, 8)
    bits = F.conv(head, 16, 10).cast("bigint")
    return (F.lit(DRAW_LOW) + F.pmod(bits, F.lit(DRAW_HIGH - DRAW_LOW + 1))).cast("int")


def income_bonus(income: str | Column) -> Column:
    """floor(income / 1000) * 10 with floor division (-1500 gives -20, not -10)."""
    return F.floor(_col(income) / F.lit(INCOME_STEP)).cast("int") * F.lit(BONUS_PER_STEP)


def credit_score(draw: str | Column, income: str | Column) -> Column:
    """min(draw + bonus, 990); NULL when an input is NULL (``least`` alone would skip the NULL)."""
    base = _col(draw) + income_bonus(income)
    return F.when(base.isNotNull(), F.least(base, F.lit(SCORE_CAP))).cast("int")


def credit_grade(score: str | Column) -> Column:
    s = _col(score)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s >= F.lit(GRADE_A_FROM), F.lit("A"))
        .when(s >= F.lit(GRADE_B_FROM), F.lit("B"))
        .otherwise(F.lit("C"))
    )
