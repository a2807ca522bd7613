"""Session settings the library is run and tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    # A hot foreign key is split at run time even where a later operator then needs another shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording the calling line of every Column costs round trips to the JVM; plans here have many.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app_name: str = "plumbline") -> SparkSession.Builder:
    """Builder with the settings above. Master, memory and spark.checkpoint.dir come from the deployment."""
    configured = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        configured = configured.config(name, value)
    return configured
