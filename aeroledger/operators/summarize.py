"""Aggregate a fact table first and enrich the aggregate afterwards.

Every summary table joins dimensions to a very large fact table and then
aggregates. The joins only read the airport code and the day, so the facts can
be reduced to one row per fact key before them: map-side partial aggregation
takes hot keys apart, the joins see a table that no longer grows with the
number of flights, and the final step combines the partial results. A dimension
key that occurs twice repeats the partial row, exactly as it would have
repeated each of its facts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One output column, as SQL expressions.

    ``partial`` is aggregated per fact key, ``combine`` over the enriched
    partial rows, and ``result`` is what the output shows.
    """

    name: str
    result: str
    combine: dict[str, str]
    partial: dict[str, str] = field(default_factory=dict)


def _quotient(name: str, digits: int, percent: bool) -> str:
    value = f"try_divide({name}_sum, {name}_n)"
    return f"round({value} * 100, {digits})" if percent else f"round({value}, {digits})"


def counted(name: str) -> Measure:
    """Number of facts."""
    return Measure(name, name, {name: f"sum({name})"}, {name: "count(*)"})


def added(name: str, value: str) -> Measure:
    """Sum of a fact expression."""
    return Measure(name, name, {name: f"sum({name})"}, {name: f"sum({value})"})


def largest(name: str, value: str) -> Measure:
    """Maximum of a fact expression."""
    return Measure(name, name, {name: f"max({name})"}, {name: f"max({value})"})


def averaged(name: str, value: str, digits: int, percent: bool = False) -> Measure:
    """Rounded mean of the non-NULL values of a fact expression, or their percentage if flags."""
    total, count = f"{name}_sum", f"{name}_n"
    return Measure(
        name,
        _quotient(name, digits, percent),
        {total: f"sum({total})", count: f"sum({count})"},
        {total: f"sum({value})", count: f"count({value})"},
    )


def added_over(name: str, value: str, facts: str) -> Measure:
    """Sum over facts of a dimension expression; ``facts`` counts the facts of a partial row."""
    return Measure(name, name, {name: f"sum({value} * {facts})"})


def averaged_over(name: str, value: str, facts: str, digits: int, percent: bool = False) -> Measure:
    """Rounded mean over facts of a dimension expression; ``facts`` as in :func:`added_over`.

    Values count to four decimals, in decimals, so that the order of the rows does not matter.
    """
    combine = {
        f"{name}_sum": f"double(sum(cast({value} AS decimal(18,4)) * cast({facts} AS decimal(18,0))))",
        f"{name}_n": f"sum(CASE WHEN {value} IS NOT NULL THEN {facts} END)",
    }
    return Measure(name, _quotient(name, digits, percent), combine)


def reduce_facts(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row of partial results per fact key."""
    partial = {name: sql for m in measures for name, sql in m.partial.items()}
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in partial.items()])


def combine(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Combine partial rows per result key and finish the measures."""
    merged = {name: sql for m in measures for name, sql in m.combine.items()}
    combined = df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in merged.items()])
    return combined.selectExpr(*keys, *[f"{m.result} AS {m.name}" for m in measures])


def aggregate(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Measures of the facts per key, without a dimension; Spark's own partial aggregation does the reducing."""
    return combine(reduce_facts(df, keys, measures), keys, measures)


def summarize(
    facts: DataFrame,
    fact_keys: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Reduce the facts, enrich the partial rows, combine them."""
    return combine(enrich(reduce_facts(facts, fact_keys, measures)), keys, measures)
