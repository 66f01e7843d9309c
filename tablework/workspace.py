"""Folders for files that a job writes and reads again.

Every path lies under the shared folder the cluster names in ``spark.checkpoint.dir``, so any
executor can read what another one wrote. Each call makes a new folder; nothing is overwritten.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session; a temporary one only in local mode."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="tablework-")
    return _local_roots[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_root(spark)}/tablework/{label}-{uuid4().hex}"


def new_name(label: str) -> str:
    """An identifier for a database or table that nobody has used before."""
    return f"{label}_{uuid4().hex}"


def checkpointed(df, label: str):
    """Write ``df`` once below the shared folder and go on from the files.

    Cuts the lineage with a written table, so that a lost executor costs a re-read, not a
    recomputation, and later branches read the same rows.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
