"""Drop lines that several documents share.

Each text is cut into lines, lines are normalised and hashed, and distinct documents are counted
per hash. A hash held by too many documents loses all its lines but those of the smallest
document id. What is left is put together again by line position.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.columns import ROW, packed, unpacked
from tablework.workspace import checkpointed

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    stripped = F.btrim(line, F.lit(BLANKS))
    return F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase)


def without_positions(lines: Column, dropped: Column) -> Column:
    """The elements of ``lines`` whose positions are not in the sorted array ``dropped``.

    Copies the stretches between dropped positions, so the work grows with the number of lines
    and not with lines times dropped lines.
    """
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    stretches = F.transform(
        F.sequence(F.lit(1), F.size(edges) - 1),
        lambda i: F.slice(
            lines, F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1
        ),
    )
    return F.when(F.size(dropped) > 0, F.flatten(stretches)).otherwise(lines)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """All columns of ``docs``, the text without repeated lines, ``n_lines`` and ``n_dropped``.

    A line's key has blanks stripped and A-Z lower-cased; keys below ``min_chars`` code points
    never count. A key found in ``min_docs`` documents or more loses its lines everywhere but in
    the smallest id that holds it. Null and empty texts are one empty line. Rows with the same
    id are one document and are judged alike. Rows without id are one document that comes after
    all others. Columns named like a result are replaced.

    The pairs of document and digest are written once; the digests that several documents share
    are joined back to them, and Spark splits a crowded digest there at run time.
    """
    spark_rows = packed(
        docs, id=F.col(f"`{id_col}`"), text=F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ).withColumn("text_hash", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    pairs = checkpointed(
        spark_rows.select("id", "text_hash", F.posexplode(lines).alias("position", "line"))
        .select("id", "text_hash", "position", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "position", F.unhex(F.md5("key")).alias("digest")),
        "lines",
    )
    shared = checkpointed(
        pairs.groupBy("digest")
        .agg(F.count_distinct(F.struct("id")).alias("n_docs"), F.min("id").alias("first_id"))
        .where(F.col("n_docs") >= min_docs)
        .select("digest", "first_id"),
        "shared-lines",
    )
    repeated = F.col("first_id").isNotNull() & (
        F.col("id").isNull() | (F.col("id") > F.col("first_id"))
    )
    drops = (
        pairs.join(shared, "digest")
        .where(repeated)
        .groupBy(F.col("id").alias("drop_id"), F.col("text_hash").alias("drop_hash"))
        .agg(F.array_sort(F.collect_set("position")).alias("dropped"))
    )
    joined = spark_rows.join(
        drops,
        F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash")),
        "left",
    ).select(
        ROW,
        lines.alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    return unpacked(
        joined,
        docs.columns,
        **{
            text_col: F.array_join(without_positions(F.col("lines"), F.col("dropped")), "\n"),
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.size("dropped").cast("long"),
        },
    )
