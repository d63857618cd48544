"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from kiln.functions.credit import credit_draw, credit_grade, credit_score, income_bonus
from kiln.functions.sensor import fahrenheit, is_normal, reject_reason

__all__ = [
    "credit_draw",
    "credit_grade",
    "credit_score",
    "income_bonus",
    "fahrenheit",
    "is_normal",
    "reject_reason",
]
