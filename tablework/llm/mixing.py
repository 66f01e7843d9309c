"""Repeat documents so that sources reach target weights.

Each source has a mean repetition rate: its target number of rows by its own number. A document
is repeated as often as a Poisson variable with that mean says, drawn by inverting the
distribution at a number hashed from the document's id, so a rerun repeats the same documents
equally often. The copies are then dealt out in hash order over all partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.columns import ROW, packed, unpacked
from tablework.workspace import checkpointed

#: A draw has at most this mean; a larger rate is the sum of several independent draws.
MAX_MEAN = 8.0
#: Terms of a draw's distribution; what lies beyond has a probability below 1e-35.
TERMS = 64


def hashed_bits(*parts: Column | str) -> Column:
    """52 bits of a hash of the parts, as a long."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def poisson_terms(mean: Column) -> Column:
    """The cumulative distribution at 0, 1, ... ``TERMS``."""
    first = F.exp(-mean)
    state = F.struct(first.alias("p"), first.alias("total"), F.array(first).alias("terms"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        total = acc["total"] + p
        return F.struct(
            p.alias("p"), total.alias("total"),
            F.concat(acc["terms"], F.array(total)).alias("terms"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), state, step, lambda acc: acc["terms"])


def tempered_weight(rows: Column) -> Column:
    """The square root of a source's size, in thousandths: large sources lose share, none all."""
    return F.floor(F.sqrt(rows.cast("double")) * 1000).cast("long")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, int] | None = None,
    target_rows: int | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Copies of ``docs`` with ``rate``, ``draw``, ``copy`` and ``order_key``, in hash order.

    ``weights`` names the sources' relative shares (others get none); without it a source weighs
    the square root of its number of rows. ``target_rows`` is the expected size of the result,
    by default that of ``docs``. A null source is a source of its own under the default weights.
    Rows without id are drawn by a hash of their text; rows with the same id are repeated
    equally often. Columns named like a result are replaced; an empty table gives an empty one.

    Only the sources' counts are gathered; they are written, and joined by broadcast only where
    Spark finds the written table small. The copies are dealt by a hash of document and copy, so
    neither a large source nor a much repeated document fills one partition.
    """
    rows = packed(
        docs,
        source=F.col(f"`{source_col}`"),
        key=F.coalesce(
            F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
        ),
    )
    if weights is None:
        weight = tempered_weight(F.col("n"))
    else:
        named = F.create_map(*[F.lit(part) for pair in weights.items() for part in pair])
        weight = F.coalesce(F.try_element_at(named, "to_source"), F.lit(0)).cast("long")
    counts = checkpointed(
        rows.groupBy(F.col("source").alias("to_source"))
        .agg(F.count("*").alias("n"))
        .withColumn("weight", weight),
        "sources",
    )
    n_rows, total = counts.agg(F.sum("n"), F.sum("weight")).first()
    wanted = float(target_rows if target_rows is not None else (n_rows or 0))
    rates = (
        counts.withColumn(
            "rate",
            F.col("weight").cast("double") * F.lit(wanted)
            / (F.lit(float(total or 1)) * F.col("n").cast("double")),
        )
        .withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN)).cast("long"))
        .withColumn("terms", poisson_terms(F.col("rate") / F.col("draws").cast("double")))
    )
    drawn = (
        rows.join(rates, F.col("source").eqNullSafe(F.col("to_source")))
        .withColumn("draw", F.explode(F.sequence(F.lit(1).cast("long"), "draws")))
        .withColumn(
            "u", hashed_bits(F.lit(seed), "key", F.col("draw").cast("string")) / float(2**52)
        )
        .withColumn("copies", F.size(F.filter("terms", lambda term: term <= F.col("u"))))
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
        .select(
            ROW, "rate", "draw", "copy",
            hashed_bits(
                F.lit(seed), F.lit("order"), "key",
                F.col("draw").cast("string"), F.col("copy").cast("string"),
            ).alias("order_key"),
        )
        .repartition("order_key")
        .sortWithinPartitions("order_key")
    )
    results = {name: F.col(name) for name in ("rate", "draw", "copy", "order_key")}
    return unpacked(drawn, docs.columns, **results)
