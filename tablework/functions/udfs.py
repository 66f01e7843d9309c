"""Arbitrary Python on columns and rows, in Arrow batches.

For work no built-in expression covers. Values keep their exact types: NULL arrives as None and
a whole number as int, whatever its size. The functions are made inside these functions, so that
executors receive them by value and need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string


def value_function(function: Callable[[Any], Any], kind: str):
    """A column function that applies ``function`` to each value, NULL included."""
    return F.udf(lambda value: function(value), kind, useArrow=True)


def map_rows(
    df: DataFrame, function: Callable[[dict[str, Any]], Iterable[dict[str, Any]]], schema: str
) -> DataFrame:
    """Each row through ``function``, which returns any number of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(_parse_datatype_string(schema))

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [new for row in batch.to_pylist() for new in function(row)]
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=fields)

    return df.mapInArrow(apply, schema)
