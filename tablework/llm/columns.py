"""Keep a table's own columns apart from those an operator works with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def packed(df: DataFrame, **working: Column) -> DataFrame:
    """The whole row as one struct beside the working columns, so that no names clash."""
    return df.select(F.struct(*[df[f"`{name}`"] for name in df.columns]).alias(ROW),
                     *[value.alias(name) for name, value in working.items()])


def unpacked(df: DataFrame, own: list[str], **results: Column) -> DataFrame:
    """The row's own columns, then ``results``; a result replaces an own column of its name."""
    # Results are computed beside the row first, where none of its names can be meant.
    places = {name: f"_result_{i}" for i, name in enumerate(results)}
    df = df.select(ROW, *[value.alias(places[name]) for name, value in results.items()])
    replaced = {name.lower(): F.col(place) for name, place in places.items()}
    kept = [
        replaced.pop(name.lower(), F.col(f"{ROW}.`{name}`")).alias(name) for name in own
    ]
    return df.select(*kept, *[
        F.col(place).alias(name) for name, place in places.items() if name.lower() in replaced
    ])
