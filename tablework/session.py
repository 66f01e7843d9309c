"""Session defaults the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tablework", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` (dots as ``__``) overrides the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
