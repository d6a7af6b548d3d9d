"""Session settings that suit wide flow tables. The library never sets them itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The JVM does not compile methods above 8000 bytes of bytecode. Fused code for some tens of
    # columns passes that and runs interpreted; below the limit Spark uses smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
