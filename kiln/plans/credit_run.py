"""C12 ``credit_run``: reload -> pending -> gate -> predict -> update by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from kiln.operators.contracts import batch_gate
from kiln.operators.credit import pending, predict, predict_udf
from kiln.sinks.warehouse import Warehouse


def credit_run(warehouse: Warehouse, applicants: DataFrame | None = None, salt: str = "",
               scorer: Callable | None = None, strict: bool = False, empty: str = "skip") -> dict[str, int]:
    """One scoring run. ``applicants`` given: full refresh first (C1), as the
    reference's demo does; ``None``: score whatever is pending in the table.
    Returns the update counts (``rows``, ``rows_updated``).

    With the built-in rule the score is a column expression, so the run is
    fused into one pass over the table (no join). A user ``scorer`` (C9) runs
    as ``mapInPandas`` over the pending batch and its responses are merged
    back by key (C11).
    """
    warehouse.ensure_tables()
    if applicants is not None:
        warehouse.reload_customers(applicants)
    if scorer is None:
        return warehouse.score_pending_in_place(salt, strict, empty)
    batch = batch_gate(pending(warehouse.customers()), empty)
    return warehouse.update_scores(predict_udf(batch, scorer, strict, salt))


def credit_run_by_key(warehouse: Warehouse, applicants: DataFrame | None = None, salt: str = "",
                      strict: bool = False, empty: str = "skip") -> dict[str, int]:
    """The reference's step-by-step form: pending -> predict -> update by key (C2, C8, C11)."""
    warehouse.ensure_tables()
    if applicants is not None:
        warehouse.reload_customers(applicants)
    batch = batch_gate(pending(warehouse.customers()), empty)
    return warehouse.update_scores(predict(batch, salt, strict))
