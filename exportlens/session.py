"""Session settings the library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"
FILLED = "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin"

# Plain Spark SQL settings, applied when the session is built.
SETTINGS = {
    # Dates and day arithmetic must not depend on the driver's time zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime plans: merged small partitions, split skewed joins, broadcast by actual size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes of bytecode. A wide projection of decimal
    # expressions generates larger ones; below this limit Spark falls back to one method each.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A table of a few rows fills few of many shuffle partitions. Below a fifth of them Spark would by default no longer broadcast
    # it when its size is known, and shuffle the facts by its key instead: with 25 markets from 125 partitions on.
    FILLED: "0",
}


def size_shuffles(spark: SparkSession, parts: int) -> None:
    """At least ``parts`` shuffle partitions in this session from here on, and tables that are small at run time broadcast beside any number.

    With a fixed number of them the rows of one task, and the memory that it sorts them in, grow with the tables until it spills.
    Adaptive execution merges partitions that stay small. The settings are read when a plan runs, so they stay.
    """
    spark.conf.set(FILLED, SETTINGS[FILLED])
    if int(spark.conf.get(PARTITIONS)) < parts:
        spark.conf.set(PARTITIONS, str(parts))


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
