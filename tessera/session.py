"""Session defaults. On a cluster the submitter's settings win; these are for local work and for what is unset."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
LEAST_VERSION = (4, 1)


def session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if tuple(int(x) for x in spark.version.split(".")[:2]) < LEAST_VERSION:
        raise RuntimeError(f"Spark {spark.version} is too old")
    return spark
