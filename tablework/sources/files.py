"""File readers. The path may be local or a URI of any storage Spark knows."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

# Without the format, text files lose the microseconds of a timestamp; without
# the escape, a quote inside a quoted field does not come back.
TEXT_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CSV_OPTIONS = TEXT_OPTIONS | {"header": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, **options: str
) -> DataFrame:
    """CSV with a header under a declared schema."""
    return spark.read.schema(schema).options(**(CSV_OPTIONS | options)).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with a header, types found by a pass over all of it.

    A sample (``samplingRatio``) is cheaper but may miss a rare value that needs a wider type.
    """
    return spark.read.options(**(CSV_OPTIONS | {"inferSchema": "true"} | options)).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: StructType | str, **options: str
) -> DataFrame:
    """JSON, one object per line, or arrays over many lines with ``multiLine="true"``.

    A multi-line file is read by one task, so a large table should lie in many files.
    """
    return spark.read.schema(schema).options(**(TEXT_OPTIONS | options)).json(path)


def read_fields(
    spark: SparkSession, path: str, fields: Mapping[str, str], separator: str = ","
) -> DataFrame:
    """Text lines split into typed fields; a missing, empty or unreadable field is NULL.

    The separator stands for itself, whatever characters it has.
    """
    quoted = "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.split(F.col("value"), quoted, -1)
    return spark.read.text(path).select(
        *[
            F.nullif(F.get(parts, F.lit(index)), F.lit("")).try_cast(kind).alias(name)
            for index, (name, kind) in enumerate(fields.items())
        ]
    )


def read_any(
    spark: SparkSession,
    kind: str,
    path: str,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """A format chosen at run time."""
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV under a declared schema, or an empty table of that schema if there is no such path."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def storage_uri(spark: SparkSession, path: str) -> str:
    """The path of a folder of Parquet files with the scheme and authority of its storage.

    A URI comes back as it is. The folder must hold a file, with or without rows.
    """
    if "://" in path:
        return path
    df = spark.read.parquet(path)
    first = df.select("_metadata.file_path").first()
    place = urlsplit(first[0] if first else df.inputFiles()[0])
    return f"{place.scheme}://{place.netloc}{path}"


def file_sizes(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(``path``, ``length``) of the files with a suffix; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
