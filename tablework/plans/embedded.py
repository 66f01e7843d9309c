"""The database the JDBC queries talk to.

On a cluster, ``spark.tablework.jdbc.url`` (and ``.user``, ``.password``, ``.driver``) names a
database that every executor can reach. In local mode the queries use the embedded database
that comes with Spark, in the memory of the one process; it opens no port.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.workspace import new_name, shared_root

URL = "spark.tablework.jdbc.url"
PROPERTIES = ("user", "password", "driver")
EMBEDDED_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def database_url(spark: SparkSession) -> tuple[str, dict[str, str]]:
    """URL and connection properties of the session's database."""
    url = spark.conf.get(URL, None)
    if url:
        named = {name: spark.conf.get(f"spark.tablework.jdbc.{name}", None) for name in PROPERTIES}
        return url, {name: value for name, value in named.items() if value}
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {URL} to a database that every executor can reach")
    spark.sparkContext._jvm.java.lang.System.setProperty(
        "derby.stream.error.file", f"{shared_root(spark).removeprefix('file:')}/derby.log"
    )
    return f"jdbc:derby:memory:{new_name('db')};create=true", {"driver": EMBEDDED_DRIVER}


#: Bytes a slice of a read is meant to hold; a database reads each slice by its key's index.
SLICE_BYTES = 64 * 2**20


def key_slices(df: DataFrame, key: str) -> tuple[int, int, int]:
    """Bounds of a whole-number key and the number of slices to read: one per core, more where
    the rows, written out as text, are more than that many slices should hold."""
    n_bytes = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    low, high, n, size = df.agg(F.min(key), F.max(key), F.count(F.lit(1)), n_bytes).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return (low or 0), (high or 0) + 1, max(1, min(n, max(cores, -(-(size or 0) // SLICE_BYTES))))
