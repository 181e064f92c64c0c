"""A log that grows: each call parses only the files that were added since the last one.

Layout under the root, all Parquet::

    files/batch=N     paths and lengths of the files of batch N; written last, it releases the batch
    events/batch=N    landmark lines of batch N
    loads/batch=N     first time of each milestone per load creation, as far as batch N shows it
    retries/batch=N   attempt and connection times per opening of a retry sequence, likewise

What batch N leaves open, the load created last and the retry sequence opened
last, is in its own tables: the group whose opening stands last in the log.
The next batch starts with that opening, so its first lines find their owner
without a look at earlier files.  Groups of several batches are merged when
they are read: the tables hold one row per load or sequence, not per line.

Defined results: the order of the log is the order of the paths, so a new file
that sorts before a parsed one is refused, as is a parsed file whose length
has changed; a call without new files writes nothing; an interrupted call
leaves a batch that no reader sees and the next call replaces.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenlake.plans import logs
from lumenlake.plans.workspace import CODEC
from lumenlake.sources import logtext
from lumenlake.sources.logtext import Phrases

FILES = "path string, length bigint"


class LogStore:
    def __init__(self, spark: SparkSession, root: str, phrases: Phrases):
        self.spark = spark
        self.root = root.rstrip("/")
        self.phrases = phrases

    # --- growing ------------------------------------------------------------

    def ingest(self, path: str) -> int:
        """Parse the files under ``path`` that are new; returns how many."""
        listed = self.spark.read.format("binaryFile").load(path)
        listed = listed.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
        seen = self.files()
        last = self._last_batch()
        new = listed.join(seen.select("path"), "path", "left_anti")
        self._check(listed, seen, new)
        rows = new.collect()  # the driver lists the files of a scan in any case
        if not rows:
            return 0
        batch = last + 1
        paths = sorted(_plain(row["path"]) for row in rows)
        scanned = logtext.scan_log(self.spark, paths, name="file_path")
        events = logtext.classify(logtext.parse_lines(scanned), self.phrases)
        events = self._write("events", batch, events)
        self._write("loads", batch, logs.load_parts(events, self._opening("loads", last)))
        self._write("retries", batch, logs.retry_parts(events, self._opening("retries", last)))
        self._write("files", batch, self.spark.createDataFrame(rows, FILES).coalesce(1))
        return len(rows)

    def _check(self, listed: DataFrame, seen: DataFrame, new: DataFrame) -> None:
        grown = listed.join(seen.withColumnRenamed("length", "_was"), "path").where("length <> _was")
        changed = grown.agg(F.min("path")).first()[0]
        if changed is not None:
            raise ValueError(f"a parsed log file has changed: {changed}")
        first, end = new.agg(F.min("path")).first()[0], seen.agg(F.max("path")).first()[0]
        if first is not None and end is not None and first < end:
            raise ValueError(f"a new log file stands before a parsed one: {first}")

    def _write(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        target = f"{self.root}/{name}/batch={batch}"
        rows.write.mode("overwrite").option("compression", CODEC).parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target)

    def _opening(self, name: str, batch: int) -> DataFrame | None:
        """The owner whose opening stands last, in one row, or none."""
        if batch < 0:
            return None
        parts = self.spark.read.parquet(f"{self.root}/{name}/batch={batch}")
        place = F.struct("_owner.file", "_owner.split", "_owner.at")
        return parts.agg(F.max_by("_owner", place).alias("_opening")).where("_opening is not null")

    # --- reading ------------------------------------------------------------

    def files(self) -> DataFrame:
        """(path, length) of every parsed file."""
        try:
            return self.spark.read.schema(f"{FILES}, batch bigint").parquet(f"{self.root}/files").select("path", "length")
        except AnalysisException:
            return self.spark.createDataFrame([], FILES)

    def _last_batch(self) -> int:
        try:
            found = self.spark.read.schema(f"{FILES}, batch bigint").parquet(f"{self.root}/files")
        except AnalysisException:
            return -1
        return found.agg(F.max("batch")).first()[0]

    def _released(self, name: str) -> DataFrame:
        last = self._last_batch()
        if last < 0:
            raise ValueError("no log file has been parsed")
        return self.spark.read.parquet(f"{self.root}/{name}").where(F.col("batch") <= last).drop("batch")

    def events(self) -> DataFrame:
        return self._released("events")

    def landmarks(self) -> DataFrame:
        """As ``logs.log_landmarks`` of the whole log."""
        return logs.merged_landmarks(self._released("loads"))

    def retry_sequences(self) -> DataFrame:
        """As ``logs.retry_sequences`` of the whole log."""
        return logs.merged_sequences(self._released("retries"))


def _plain(path: str) -> str:
    """The path of a file as a reader takes it: decoded, with its pattern characters escaped."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in unquote(path))
