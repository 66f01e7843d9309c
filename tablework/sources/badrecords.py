"""Reading files that hold malformed records.

Spark parses only the fields a query asks for, and a field that is not parsed cannot be found
malformed: counting rows, or selecting one column, would let bad records through. The readers
here ask for every field themselves, so what counts as malformed does not depend on the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.sources.files import CSV_OPTIONS

CORRUPT = "_corrupt_record"
BAD_RECORD = "MALFORMED_RECORD_IN_PARSING"
SMALLEST_LONG = -(2**63)


def _all_fields(rows: DataFrame) -> DataFrame:
    """``rows`` with a filter that is always true but needs every column."""
    return rows.filter(F.xxhash64(*rows.columns) >= F.lit(SMALLEST_LONG))


def _read(spark: SparkSession, path: str, schema: str, mode: str, header: bool) -> DataFrame:
    return _all_fields(
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("header", header)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_permissive(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """All records; a malformed one has NULL fields and its text in ``_corrupt_record``."""
    return _read(spark, path, f"{schema}, {CORRUPT} string", "PERMISSIVE", header)


def read_dropping(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """The well-formed records only."""
    return _read(spark, path, schema, "DROPMALFORMED", header)


def gate(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[str, int | None]:
    """Read everything once and say ``accepted`` with the row count, or ``rejected``."""
    strict = _read(spark, path, schema, "FAILFAST", header)
    try:
        return "accepted", strict.count()
    except Exception as error:  # the kind depends on the client; the message names the cause
        if BAD_RECORD not in str(error):
            raise
        return "rejected", None


def quarantine(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write good and malformed records of a permissive read to two folders in one pass.

    Returns both as read back, so the text is parsed once and neither side is recomputed.
    """
    marked = parsed.withColumn("side", F.when(F.col(CORRUPT).isNull(), "good").otherwise("bad"))
    marked.write.partitionBy("side").parquet(path)
    written = parsed.sparkSession.read.schema(marked.schema).parquet(path)
    good = written.filter(F.col("side") == "good").drop("side", CORRUPT)
    bad = written.filter(F.col("side") == "bad").select(CORRUPT)
    return good, bad
