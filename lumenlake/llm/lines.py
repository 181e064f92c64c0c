"""Line deduplication against levelled sorted runs; DataFrame functions only.

Lines are compared by a 128-bit hash of their key: blanks stripped at both
ends, A-Z lower-cased.  One scan turns texts into (row, line number, hash),
which is written by batch; texts are not read again until the end.  The index
holds the hashes seen so far, each with the document that owns it, as runs:
tables bucketed and sorted by hash.  A new batch is reduced to its distinct
hashes, merge-anti-joined with every run, and what is left becomes a run of its
own.  Runs of a level are compacted into one run of the next level when
``fan_in`` of them have gathered, with one sorted file a bucket.  All runs have
the same buckets, so neither the joins nor lookups shuffle them again.

Batches come in ascending order of doc_id, so the first owner is the least
document.  Lines whose owner is another document are lost; their numbers are
gathered per row, and only rows that lose any are cut and joined again.  Rows
are known by doc_id and a 128-bit hash of the text, which every scan gives
alike: rows that share both lose the same lines.

Defined results: a null or empty text is one empty line; a null doc_id is one
document that comes last; rows that repeat a doc_id are one document and keep
the same lines; a line repeated inside its owner stays each time; an empty
table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumenlake.llm.common import BLANK_CHARS, new_folder, text_key, text_or_empty, written

LEAST_LENGTH = 10
BATCHES = 4
FAN_IN = 3
_MOST_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK_CHARS))


def _hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of a stripped line, the same for both cases of A-Z and for nothing else.

    The bytes are read as one character each and lower-cased.  Beyond A-Z that
    shifts the lead bytes of two-byte characters by 32; as the number of bytes
    that follow a lead byte still tells its kind, no two keys fall together.
    """
    folded = F.lower(F.decode(key.cast("binary"), "ISO-8859-1"))
    return F.xxhash64(folded), F.xxhash64(F.lit("second"), folded)


def bucket_count(spark: SparkSession) -> int:
    """One bucket per shuffle partition, as far as Spark allows."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(_MOST_BUCKETS)))


class LineIndex:
    """Runs of (h1, h2, owner), by level."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_in: int = FAN_IN):
        self.spark = spark
        self.buckets = buckets or bucket_count(spark)
        self.fan_in = fan_in
        self.folder = new_folder(spark, "line-runs")
        self.levels: list[list[str]] = []

    def _write_run(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        )
        return name

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def owners(self) -> DataFrame:
        """All hashes with their owners; no hash is in two runs."""
        return self._united(self.runs())

    def _united(self, names: list[str]) -> DataFrame:
        """Runs as files without buckets: joins by sorted buckets do not go through here."""
        shape = self.spark.table(names[0]).schema
        return self.spark.read.schema(shape).parquet(*map(self.path, names))

    def add(self, lines: DataFrame) -> None:
        """Enter a batch of (h1, h2, doc_id)."""
        # Aggregated before it is dealt out: a hot line is one row per map task.
        fresh = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner")).repartition(self.buckets, "h1", "h2")
        for name in self.runs():
            fresh = fresh.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._enter(self._write_run(fresh), 0)

    def _enter(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) < self.fan_in:
            return
        merged = self._write_run(self._united(self.levels[level]))
        self._drop(self.levels[level])
        self.levels[level] = []
        self._enter(merged, level + 1)

    def _drop(self, names: list[str]) -> None:
        """Forget tables; their files stay in the shared folder for plans that still read them."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._drop(self.runs())


def long_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, batch: Column | None = None) -> DataFrame:
    """(doc_id, t1, t2, place, h1, h2, batch) of every line whose key is long enough; t1, t2 stand for the text."""
    batch = F.lit(0) if batch is None else batch
    text = text_or_empty()
    lines = docs.select("doc_id", batch.alias("batch"), *text_key(text), F.posexplode(F.split(text, "\n")).alias("place", "line"))
    keys = lines.withColumn("line", _stripped(F.col("line"))).where(F.char_length("line") >= least_length)
    h1, h2 = _hashes(F.col("line"))
    return keys.select("doc_id", "t1", "t2", "place", h1.alias("h1"), h2.alias("h2"), "batch")


def batch_edges(docs: DataFrame, batches: int = BATCHES) -> list[int]:
    """Greatest doc_id of each batch but the last; batches are about equal."""
    shares = [i / batches for i in range(1, batches)]
    edges = docs.agg(F.percentile_approx("doc_id", shares).alias("e")).first()["e"] if shares else None
    return sorted(set(edges or []))


def _batch_of(edges: list[int]) -> Column:
    """Number of the batch of a doc_id; null comes last."""
    number = F.lit(len(edges))
    for i, edge in reversed(list(enumerate(edges))):
        number = F.when(F.col("doc_id") <= edge, i).otherwise(number)
    return number


def lost_lines(
    docs: DataFrame, least_length: int = LEAST_LENGTH, batches: int = BATCHES, fan_in: int = FAN_IN
) -> DataFrame:
    """(doc_id, t1, t2, lost): numbers of the lines that another document owns, for rows that have any."""
    spark = docs.sparkSession
    edges = batch_edges(docs, batches)
    path = new_folder(spark, "line-hashes")
    hashed = long_lines(docs.select("doc_id", "text"), least_length, _batch_of(edges))
    hashed.write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema(hashed.schema).parquet(path)
    index = LineIndex(spark, fan_in=fan_in)
    for number in range(len(edges) + 1):
        index.add(hashed.where(F.col("batch") == number))
    # Both sides are shuffled, so adaptive execution can split a hot line.
    owned = hashed.join(index.owners(), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    lost = owned.groupBy("doc_id", "t1", "t2").agg(F.collect_set("place").alias("lost"))
    lost = written(lost, "lost-lines")
    index.close()
    return lost


def dedup_lines(
    docs: DataFrame, least_length: int = LEAST_LENGTH, batches: int = BATCHES, fan_in: int = FAN_IN
) -> DataFrame:
    """(row, n_lines, n_dropped, kept_text) for every row of ``docs``."""
    lost = lost_lines(docs, least_length, batches, fan_in)
    lost = lost.select(F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "lost")
    text = text_or_empty()
    rows = docs.select(F.struct("*").alias("row"), text.alias("_text"), *text_key(text))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    joined = rows.join(lost, same, "left")
    n_lines = F.char_length("_text") - F.char_length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1
    # Numbers of the lines that stay, by a set difference; one element stands for the cut text, which is made once.
    cut = F.array(F.split("_text", "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("lost"))
    kept = F.transform(cut, lambda lines: F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n"))
    counted = joined.select("row", "_text", "lost", n_lines.alias("n_lines"))
    return counted.select(
        "row",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNull(), F.col("_text")).otherwise(F.get(kept, F.lit(0))).alias("kept_text"),
    )
