"""Records whose quoted fields hold line breaks, from files that stay splittable.

Files are read as lines, cut anywhere.  A line break ends a record if the
quotes before it in its file are even in number.  One aggregate counts the
quotes of every split, a running sum over the splits tells which of them begin
inside a quoted field, and then each split cuts its records knowing its start
state.  A record belongs to the split it begins in; pieces of one that ends in
a later split, at most two per split, are carried there and joined.

Cutting depends on the lines before, so it runs as a batched Arrow function
over whole columns of lines; all else is DataFrame functions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lumenlake.plans.workspace import written

# Executors need not have this package: what runs there is sent with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECES = "file string, split bigint, place bigint, piece string, part int"
# Parts of a record: whole, its beginning, and what continues one from an earlier split.
WHOLE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as they are, a carriage return at the end included, with the split they come from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )


def _quotes(text: str):
    return F.length(text) - F.length(F.replace(F.col(text), F.lit('"'), F.lit("")))


def splits_inside(lines: DataFrame) -> DataFrame:
    """(file, split) of the splits that begin inside a quoted field."""
    counted = lines.groupBy("file", "split").agg(F.sum(_quotes("value")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("before", F.sum("quotes").over(before)).where("before % 2 = 1").select("file", "split")


class _Split:
    """The open end of the split at hand."""

    def __init__(self, key: tuple[str, int], inside: bool):
        self.key, self.inside = key, inside
        self.place, self.header = 0, key[1] == 0
        self.part = TAIL if inside else WHOLE
        self.open: list[str] = []

    def cut(self, lines: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """Pieces that end within these lines, with their parts; the last open one is kept."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.inside) % 2
        ends = np.flatnonzero(after == 0) + 1  # places behind the last line of a piece
        if not len(ends):
            self.open += lines.to_pylist()
        else:
            first = [*self.open, *lines.slice(0, int(ends[0])).to_pylist()]
            offsets = pa.array((ends - ends[0]).astype(np.int32))
            joined = pa.ListArray.from_arrays(offsets, lines.slice(int(ends[0]), int(ends[-1] - ends[0])))
            pieces = pa.concat_arrays([pa.array(["\n".join(first)]), pc.binary_join(joined, "\n")])
            parts = np.zeros(len(pieces), dtype=np.int32)
            parts[0] = self.part
            self.part = WHOLE
            self.open = lines.slice(int(ends[-1])).to_pylist()
            yield pieces, parts
        self.inside = bool(after[-1]) if len(after) else self.inside

    def rest(self) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """What the end of the split leaves open: the beginning of a record, or more of an earlier one."""
        if self.open:
            yield pa.array(["\n".join(self.open)]), np.array([TAIL if self.part == TAIL else HEAD], dtype=np.int32)

    def rows(self, pieces: pa.Array, parts: np.ndarray) -> pa.RecordBatch:
        """The pieces without the header and blank records, which have no place."""
        begins = parts != TAIL
        kept = ~begins | pc.not_equal(pc.utf8_trim_whitespace(pieces), "").to_numpy(zero_copy_only=False)
        if self.header and begins.any():
            kept[begins.argmax()] = self.header = False
        pieces, parts, begins = pieces.filter(pa.array(kept)), parts[kept], begins[kept]
        places = np.cumsum(begins) - 1 + self.place
        self.place += int(begins.sum())
        n = len(pieces)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.key[0]] * n, pa.string()), pa.array(np.full(n, self.key[1])), pa.array(places), pieces, pa.array(parts)],
            names=["file", "split", "place", "piece", "part"],
        )


def cut_pieces(batches: Iterable[pa.RecordBatch], inside: set[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Pieces of records from lines (value, file, split) that come in the order of their splits."""
    current = None
    for batch in batches:
        files, splits = batch.column("file").dictionary_encode(), batch.column("split").to_numpy()
        codes = files.indices.to_numpy()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(splits) != 0)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows] if batch.num_rows else []
        for start, end in zip(bounds, bounds[1:], strict=False):
            key = (files.dictionary[int(codes[start])].as_py(), int(splits[start]))
            if current is None or current.key != key:
                if current is not None:
                    yield from (current.rows(*found) for found in current.rest())
                current = _Split(key, key in inside)
            yield from (current.rows(*found) for found in current.cut(batch.column("value").slice(start, end - start)))
    if current is not None:
        yield from (current.rows(*found) for found in current.rest())


def first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task's input; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, place, record) of every record but the first of each file and blank ones.

    ``place`` counts the records that begin in a split.  Run it where the
    splits of two scans are the same (``extract.pinned_splits``).  A quoted
    field that never ends takes the rest of its file into its record.
    """
    lines = _lines(spark, path)
    # One entry for each split that begins inside a quoted field.
    inside = {(row["file"], row["split"]) for row in splits_inside(lines).collect()}
    shared = spark.sparkContext.broadcast(inside)
    pieces = lines.mapInArrow(lambda batches: cut_pieces(batches, shared.value), _PIECES)
    whole = pieces
    if inside:
        pieces = written(pieces, "quoted-pieces")
        torn = pieces.where(f"part <> {WHOLE}")
        # A tail belongs to the last beginning before it in its file.
        order = Window.partitionBy("file").orderBy("split", F.col("part") == HEAD).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        begun = F.last(F.when(F.col("part") == HEAD, F.struct("split", "place")), ignorenulls=True).over(order)
        owned = torn.withColumn("owner", begun).groupBy("file", "owner").agg(
            F.array_sort(F.collect_list(F.struct("split", F.col("part") != TAIL, "piece"))).alias("parts")
        )
        joined = owned.select("file", "owner.*", F.array_join(F.col("parts.piece"), "\n").alias("piece"))
        whole = pieces.where(f"part = {WHOLE}").select("file", "split", "place", "piece").unionByName(joined)
    record = F.regexp_replace("piece", "\r$", "")
    return whole.select("file", "split", "place", record.alias("record"))
