"""Session settings sized to the input."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_BYTES = 128 << 20
# Rows of the source tables per piece of a shuffle, and bytes that one task takes of a shuffle and of files.
PIECE_ROWS, PIECE_BYTES, SPLIT_BYTES = 50_000, 8 << 20, 16 << 20
# The longest method that the JVM compiles; wide rows whose code is longer would be interpreted.
METHOD_BYTES = 8000


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffles cut into pieces that fit an executor's share of memory.

    Adaptive execution merges pieces that turn out small and splits hot ones,
    so the number only has to be large enough.
    """
    pieces = max(cores, math.ceil(input_bytes / TARGET_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(pieces),
        "spark.sql.files.maxPartitionBytes": str(TARGET_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": str(METHOD_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }


def builder(input_bytes: int, cores: int, name: str = "lumenlake") -> SparkSession.Builder:
    made = SparkSession.builder.appName(name)
    for key, value in settings(input_bytes, cores).items():
        made = made.config(key, value)
    return made


def sized(spark: SparkSession, rows: int) -> SparkSession:
    """A session of the same application and settings whose shuffles are cut to so many source rows.

    With a fixed number of pieces each task takes more as the input grows.
    Here their number grows, and adaptive execution merges those that stay
    below ``PIECE_BYTES``, so a task's memory does not depend on the input;
    nor does that of a partial aggregate, which follows the split it reads.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / PIECE_ROWS))
    own.conf.set("spark.sql.shuffle.partitions", str(pieces))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PIECE_BYTES))
    # A side none of whose pieces is larger is held as a hash table; sides with a hot piece are sorted.
    own.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(PIECE_BYTES))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    own.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
    return own
