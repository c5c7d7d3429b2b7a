"""Totals over the delay cause columns and the cause that dominates.

Guards are SQL conditions such as ``"Cancelled = 1"``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(cols: Iterable[str]) -> str:
    return "int(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def sum_or_null(cols: Iterable[str]) -> Column:
    """Sum with NULL as 0, but NULL when every column is NULL."""
    cols = list(cols)
    return F.expr(f"CASE WHEN coalesce({', '.join(cols)}) IS NOT NULL THEN {_total(cols)} END")


def sum_unless(cols: Iterable[str], guard: str) -> Column:
    """Sum with NULL as 0, but NULL where the guard holds; a NULL guard does not hold."""
    return F.expr(f"CASE WHEN ({guard}) IS NOT TRUE THEN {_total(cols)} END")


def argmax_label(
    causes: Mapping[str, str],
    total: str,
    blank_when: str | None = None,
    nulls_as_zero: bool = False,
) -> Column:
    """Label of the largest cause, the earlier one on a tie.

    The result is NULL where ``blank_when`` holds (by default where the total
    is NULL) and "None" where the total is 0. Each cause is compared with the
    ones after it. A NULL cause leaves its comparison undecided, and the search
    moves on to the next cause; ``nulls_as_zero`` compares NULL as 0 instead.
    """
    labels = list(causes)
    minutes = [f"coalesce({c}, 0)" if nulls_as_zero else c for c in causes.values()]
    cases = [f"WHEN {blank_when or f'{total} IS NULL'} THEN NULL", f"WHEN {total} = 0 THEN 'None'"]
    for i, label in enumerate(labels[:-1]):
        largest = " AND ".join(f"{minutes[i]} >= {later}" for later in minutes[i + 1 :])
        cases.append(f"WHEN {largest} THEN '{label}'")
    return F.expr(f"CASE {' '.join(cases)} ELSE '{labels[-1]}' END")
