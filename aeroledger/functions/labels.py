"""Labels derived from one or two columns."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroledger.functions.fixed_values import MISSPELT_HIGH, SEASON_MONTHS, WEEKDAYS

_COMPARE = {"==": operator.eq, "<": operator.lt, "<=": operator.le}


def _first_match(cases: Iterable[tuple[Column, str]]) -> Column:
    """CASE WHEN over (condition, label) pairs; NULL when none holds."""
    chain = None
    for condition, label in cases:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain


def normalize_key(col: str) -> Column:
    """Join-key form of a code: no outer blanks, upper case."""
    return F.upper(F.trim(col))


def fix_label(col: str) -> Column:
    """Spell every "Hight", in any case, as "High"."""
    return F.regexp_replace(col, MISSPELT_HIGH, "High")


def map_labels(col: str, mapping: Mapping[str, str]) -> Column:
    """Replace exact matches; other labels and NULL pass through."""
    value = F.col(col)
    return F.coalesce(_first_match((value == old, new) for old, new in mapping.items()), value)


def delay_status(col: str) -> Column:
    """Early, On Time or Delayed by the sign of a delay; NULL stays NULL."""
    delay = F.col(col)
    return _first_match([(delay < 0, "Early"), (delay == 0, "On Time"), (delay > 0, "Delayed")])


def weekday_from_int(col: str) -> Column:
    """Name of day 1 (Monday) to 7 (Sunday); NULL for any other number."""
    return F.get(F.array(*[F.lit(day) for day in WEEKDAYS]), F.col(col) - 1)


def flight_status(cancelled: str, diverted: str) -> Column:
    """Cancelled before Diverted; Completed when neither flag is 1."""
    flags = _first_match([(F.col(cancelled) == 1, "Cancelled"), (F.col(diverted) == 1, "Diverted")])
    return F.coalesce(flags, F.lit("Completed"))


def season(month: str) -> Column:
    """Season of a month number; NULL outside 1 to 12."""
    return _first_match((F.col(month).isin(months), name) for name, months in SEASON_MONTHS.items())


def bucket(col: str, steps: Sequence[tuple[str, float, str]], above: str) -> Column:
    """Label of the first step whose comparison holds, else ``above``; NULL stays NULL."""
    value = F.col(col)
    cases = [(_COMPARE[sign](value, limit), label) for sign, limit, label in steps]
    return _first_match([*cases, (value.isNotNull(), above)])


def group_of(col: str, members: Mapping[str, Sequence[str]]) -> Column:
    """Name of the group that lists the value; NULL when no group does."""
    return _first_match((F.col(col).isin(values), name) for name, values in members.items())


def is_in(col: str, values: Sequence[str]) -> Column:
    """Two-valued membership: NULL counts as not a member."""
    return F.coalesce(F.col(col).isin(list(values)), F.lit(False))
