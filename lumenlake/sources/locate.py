"""Choose the input file: the named one, else the newest that fits a pattern."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

# Fixed value: name pattern of fallback files.
FALLBACK_PATTERN = "Amostra*.csv"
NO_PRIMARY = "{}: no such file, and taking another one is switched off"
NO_CANDIDATE = "{}: no file to load, neither the named one nor any " + FALLBACK_PATTERN


@dataclass(frozen=True)
class Located:
    path: str | None
    used_fallback: bool = False
    message: str | None = None


def listing(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """(path, modified) of matching files; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .load(f"{directory.rstrip('/')}/{pattern}")
        .select("path", F.col("modificationTime").alias("modified"))
    )


def newest(files: DataFrame) -> DataFrame:
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def locate(spark: SparkSession, directory: str, primary: str, allow_fallback: bool = True) -> Located:
    wanted = directory.rstrip("/") + "/" + primary

    def pick(pattern: str) -> str | None:
        try:
            return newest(listing(spark, directory, pattern)).first()["path"]
        except AnalysisException:
            return None

    found = pick(primary)
    if found:
        return Located(found)
    if not allow_fallback:
        return Located(None, message=NO_PRIMARY.format(wanted))
    found = pick(FALLBACK_PATTERN)
    if found:
        return Located(found, used_fallback=True)
    return Located(None, message=NO_CANDIDATE.format(directory))
