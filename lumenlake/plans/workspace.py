"""Written tables that several plans share within one application."""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Shared tables carry hashes and numbers, which Spark's default codec hardly shortens.
CODEC = "zstd"
_lock = threading.RLock()
_written: dict[tuple[str, str], DataFrame] = {}
_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a scratch folder only on a local master."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lumenlake-")
    return _local_roots[app]


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to a folder of their own and read back, for plans that use them more than once."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/lumenlake/{spark.sparkContext.applicationId}/steps/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Workspace:
    """Tables written once per application and source, then read back.

    Writing cuts lineage: a lost executor costs a re-read of a file, not the
    plan behind it, and readers fetch only the columns they use.
    """

    def __init__(self, spark: SparkSession, source: str):
        self.spark = spark
        self.source = source
        tag = hashlib.sha256(source.encode()).hexdigest()[:16]
        self.root = f"{shared_folder(spark)}/lumenlake/{spark.sparkContext.applicationId}/{tag}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.root, name)
        with _lock:
            if key not in _written:
                rows = build()
                rows.write.mode("overwrite").option("compression", CODEC).parquet(self.path(name))
                _written[key] = self.spark.read.schema(rows.schema).parquet(self.path(name))
            return _written[key]

    def files(self, name: str, write: Callable[[str], None]) -> str:
        """Like ``table`` for files in another format; returns their path."""
        key = (self.root, name)
        with _lock:
            if key not in _written:
                write(self.path(name))
                _written[key] = None
            return self.path(name)
