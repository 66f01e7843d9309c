"""Conditional, mapped and cast values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: str) -> Column:
    """An exact amount with two places."""
    return F.col(column).cast(MONEY)


def band(
    column: str, steps: Sequence[tuple[Any, Any]], otherwise: Any, missing: Any = None
) -> Column:
    """The label of the first step ``(lower bound, label)`` the value reaches.

    ``missing`` is the label of NULL; without it NULL falls to ``otherwise``, as in SQL.
    """
    result = F.when(F.lit(False), F.lit(None))
    if missing is not None:
        result = result.when(F.col(column).isNull(), F.lit(missing))
    for bound, label in steps:
        result = result.when(F.col(column) >= bound, F.lit(label))
    return result.otherwise(F.lit(otherwise))


def mapped(column: str, values: Mapping[Any, Any]) -> Column:
    """The value a short constant map holds for the column, NULL for other values."""
    literals = [F.lit(item) for item in chain.from_iterable(values.items())]
    return F.try_element_at(F.create_map(*literals), F.col(column))


def tolerant_cast(column: str, kind: str) -> Column:
    """Cast with NULL for values that cannot be converted."""
    return F.col(column).try_cast(kind)
