"""What several operators share: written tables, text measures, stable hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import lumenlake
from lumenlake.plans.workspace import shared_folder

_shipped: set[str] = set()

# ASCII blanks, and everything else; the contracts fix these classes.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 21
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the one that all executors share."""
    return f"{shared_folder(spark)}/lumenlake-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and bound what they get at a time.

    A batch of ten thousand rows has no size of its own; where the session says
    nothing else, batches end at ``BATCH_BYTES``.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context, package = spark.sparkContext, Path(lumenlake.__file__).parent
    if context.applicationId in _shipped or not package.is_dir():  # within an archive it was shipped by the user
        return
    archive = Path(tempfile.mkdtemp(prefix="lumenlake-code-")) / "lumenlake-code.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written and read back: lineage ends here and a lost executor costs a re-read."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z only: the full lower() would change other letters too."""
    return F.translate(text, _UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def remainder(identifier: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % parts


def seeded_hash(seed: str, identifier: Column) -> Column:
    """32 hex digits, the same in every engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))).cast("binary"))


def give_back() -> None:
    """Return freed memory of a Python worker to the system: workers stay, and the next stage needs it elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text, the same in every scan."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of about ``most`` bytes; a longer text is a part of its own."""
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1)
        yield texts.slice(start, end - start)
        start = end
