"""Versioned tables with several writers: one commit record per version, written if absent.

A writer stores its changes in a folder of its own, which nobody reads yet, and then tries to put the
record of the next version. Only one writer can put a number's record; the others find out which
keys the versions between have changed. Where none is theirs they take the next number, otherwise
they build their changes again from what the table holds now. Readers take the folders that
records name, so a writer that fails leaves nothing to be seen.

Changes are those of ``tablework.versions.changes``: ``_op`` is I, U or D, a key occurs once per
version, and ``snapshot``, ``restoration``, ``history`` and ``retained`` read them as they are.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple
from urllib.parse import unquote, urlparse
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.versions.changes import AT, CONTROL, OP, VERSION

PART = "_part"
RECORD = "version bigint, part string, operation string, at string, read_version bigint"


class ConflictError(RuntimeError):
    """Others changed the same keys as often as the writer was allowed to try."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless it is there; whether this call wrote it.

    The text goes to a name of its own first, and the name is then changed or linked in a step that
    fails if the target exists. On file systems that executors share by mount this is a hard link,
    elsewhere the storage's rename without overwriting, which must be atomic there.
    """
    java = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target = java.Path(path)
    storage = target.getFileSystem(conf)
    folder = target.getParent()
    storage.mkdirs(folder)
    staged = java.Path(folder, f"_staged-{uuid4().hex}")
    if storage.getScheme() == "file":
        names = [unquote(urlparse(str(p.toUri())).path) for p in (staged, target)]
        with open(names[0], "x") as out:
            out.write(text)
        try:
            os.link(*names)
        except FileExistsError:
            return False
        finally:
            os.unlink(names[0])
        return True
    out = storage.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = java.FileContext.getFileContext(storage.getUri(), conf)
    plain = spark.sparkContext._gateway.new_array(java.Options.Rename, 0)
    try:
        context.rename(staged, target, plain)
    except Py4JJavaError as error:
        storage.delete(staged, False)
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True


def records(spark: SparkSession, path: str) -> list:
    """The commit records in order of their versions, one short row each."""
    try:
        found = spark.read.schema(RECORD).json(f"{path}/commits").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(found, key=lambda record: record.version)


def _changes_of(spark: SparkSession, path: str, taken: list) -> DataFrame:
    """The changes of these records; other folders are not listed.

    The few versions go to the rows: a shuffle by folder would bring all rows of a version to one task.
    """
    folders = [f"{path}/data/{PART}={record.part}" for record in taken]
    rows = spark.read.option("basePath", f"{path}/data").parquet(*folders)
    numbers = spark.createDataFrame(
        [(record.part, record.version) for record in taken], f"{PART} string, {VERSION} bigint"
    )
    names = [name for name in rows.columns if name != PART]
    return rows.join(F.broadcast(numbers), PART).select(*names, VERSION)


def committed_changes(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """All committed changes with ``_version``, up to ``as_of``; an error if there are none."""
    taken = [record for record in records(spark, path) if as_of is None or record.version <= as_of]
    if not taken:
        raise ValueError(f"no committed version in {path}")
    return _changes_of(spark, path, taken)


def transact(
    spark: SparkSession,
    path: str,
    key: Sequence[str],
    build: Callable[[DataFrame | None], DataFrame],
    operation: str,
    at: datetime,
    *,
    serializable: bool = False,
    attempts: int = 10,
) -> int:
    """Commit the changes that ``build`` makes of the table's changes (None: no version yet).

    ``build`` returns rows with ``_op``; they are written once and committed as the next version, whose
    number is returned. Versions that others commit in between are no conflict if they change
    none of the same keys; otherwise ``build`` runs again on the newer changes. So two writers never
    lose each other's rows (snapshot isolation). With ``serializable`` any version in between makes
    it run again, for changes that depend on rows they don't change. Rows that hold a key twice are
    refused with nothing committed.
    """
    for _ in range(attempts):
        before = records(spark, path)
        base = before[-1].version if before else 0
        part = f"p{uuid4().hex}"
        folder = f"{path}/data/{PART}={part}"
        rows = build(_changes_of(spark, path, before) if before else None)
        stamp = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
        rows.withColumn(AT, stamp).write.parquet(folder)
        mine = spark.read.parquet(folder)
        repeated = mine.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
        if repeated is not None:
            raise ValueError(f"the changes hold a key {repeated['n']} times: {repeated}")
        read_version = base
        while True:
            record = {
                "version": base + 1, "part": part, "operation": operation,
                "at": at.isoformat(sep=" "), "read_version": read_version,
            }
            if put_if_absent(spark, f"{path}/commits/{base + 1:020d}.json", json.dumps(record)):
                return base + 1
            others = [record for record in records(spark, path) if record.version > base]
            theirs = _changes_of(spark, path, others).select(*key)
            if serializable or not mine.join(theirs, list(key), "left_semi").isEmpty():
                break
            base = others[-1].version
    raise ConflictError(f"{operation}: {attempts} attempts met changes of the same keys")


class Update(NamedTuple):
    """Change a matched row where ``condition`` holds; columns not in ``values`` stay."""

    values: dict[str, Column]
    condition: Column | None = None


class Delete(NamedTuple):
    """Delete the row where ``condition`` holds."""

    condition: Column | None = None


class Insert(NamedTuple):
    """Add a source row; columns not in ``values`` come from the source, or are NULL."""

    values: dict[str, Column] = {}
    condition: Column | None = None


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    *,
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    not_matched_by_source: Sequence[Update | Delete] = (),
) -> DataFrame:
    """The changes, with ``_op``, of a MERGE of ``source`` into the rows ``target``.

    Conditions and values name columns as ``target.x`` and ``source.x``. Of each list the first clause
    whose condition holds is taken; a row that none fits stays as it is. Without clauses for rows
    that the source lacks, target rows without a source row are not read further than the join. A
    source key that comes twice gives its key twice, which committing refuses. NULL keys match
    nothing.
    """
    payload = [name for name in target.columns if name not in {*key, *CONTROL}]
    ours = target.select(*key, *payload, F.lit(True).alias("_here")).alias("target")
    theirs = source.withColumn("_here", F.lit(True)).alias("source")
    same = F.lit(True)
    for name in key:
        same = same & (F.col(f"target.`{name}`") == F.col(f"source.`{name}`"))
    both = ours.join(theirs, same, "full" if not_matched_by_source else "right")
    in_target = F.col("target._here").isNotNull()
    in_source = F.col("source._here").isNotNull()
    given = set(source.columns)

    def change(clause) -> Column:
        values = getattr(clause, "values", {})
        unknown = sorted(set(values) - {*key, *payload})
        if unknown:
            raise ValueError(f"no such columns to set: {unknown}")
        op = {Update: "U", Delete: "D", Insert: "I"}[type(clause)]

        def value(name: str) -> Column:
            kind = target.schema[name].dataType
            if name in values:
                return values[name].cast(kind)
            if op != "I":
                return F.col(f"target.`{name}`")
            return (F.col(f"source.`{name}`") if name in given else F.lit(None)).cast(kind)

        row = [value(name).alias(name) for name in (*key, *payload)]
        return F.struct(*row, F.lit(op).alias(OP))

    chosen = None
    for clauses, kinds, place in (
        (matched, (Update, Delete), in_target & in_source),
        (not_matched, (Insert,), ~in_target & in_source),
        (not_matched_by_source, (Update, Delete), in_target & ~in_source),
    ):
        for clause in clauses:
            if not isinstance(clause, kinds):
                raise TypeError(f"{type(clause).__name__} does not fit here")
            holds = place if clause.condition is None else place & clause.condition
            chosen = F.when(holds, change(clause)) if chosen is None else chosen.when(holds, change(clause))
    if chosen is None:
        raise ValueError("a merge needs a clause")
    return both.select(chosen.alias("_change")).where("_change IS NOT NULL").select("_change.*")
