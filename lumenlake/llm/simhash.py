"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; bit i is set if over half of the shingles' hashes
have it.  Two fingerprints within ``max_bits`` agree in some segment up to
``max_bits // segments`` bits.  So every fingerprint is entered in one table
per segment, and looks up, in each, the Hamming ball of that radius around its
own segment.  Matches are verified on all 64 bits inside the join, so only
links come out of it.  Of two fingerprints the one with the highest differing
bit of the segment set does the looking up, which halves the probes.

Equal fingerprints are one node, however many documents share them.  A table
entry with over ``dense`` fingerprints would compare all its pairs; there the
fingerprints are first tied together through shared neighbours one bit away
(sharing one means at most two bits apart: a link), at a cost that grows with
their number alone, and only fingerprints not tied yet are compared.  The
result is the same with and without.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; texts shorter than a shingle count as one shingle; rows with
a null id are linked, and never name a component unless all its ids are null;
repeated rows share everything.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lumenlake.llm.common import give_back, ship, text_key, written
from lumenlake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 2
DENSE = 2000
BITS = 64
_SEED = 42  # fixed by the contract of the fingerprint
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 bits as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(row, fp): the fingerprint as a signed long."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.array(found.view(np.int64))
            give_back()

    return docs.select(F.struct("*").alias("row"), signed(F.col("text").cast("string")).alias("fp"))


def _segment(fp: Column, place: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, place * width).bitwiseAND((1 << width) - 1)


def _entry(place: int, width: int, value: Column) -> Column:
    """One number for table and segment value."""
    return value + (place << width)


def _tables(fps: DataFrame, segments: int, width: int) -> DataFrame:
    own = [_entry(s, width, _segment(F.col("fp"), s, width)) for s in range(segments)]
    return fps.select("fp", "tie", F.explode(F.array(*own)).alias("entry"))


def _ball(fp: Column, place: int, width: int, radius: int) -> Column:
    """Entries around the segment: masks of up to ``radius`` bits whose highest bit is set in it."""
    masks = [0] + [sum(1 << b for b in bits) for n in range(1, radius + 1) for bits in combinations(range(width), n)]
    pairs = [F.struct(F.lit(m).cast("long").alias("mask"), F.lit((1 << m.bit_length()) >> 1).cast("long").alias("high")) for m in masks]
    own = _segment(fp, place, width)
    usable = F.filter(F.array(*pairs), lambda m: (m["mask"] == 0) | (own.bitwiseAND(m["high"]) != 0))
    entry = lambda m: _entry(place, width, own.bitwiseXOR(m["mask"]))
    return F.transform(usable, lambda m: F.struct(entry(m).alias("entry"), (m["mask"] == 0).alias("same")))


def _probes(fps: DataFrame, segments: int, width: int, radius: int) -> DataFrame:
    balls = F.concat(*(_ball(F.col("fp"), s, width, radius) for s in range(segments)))
    ball = fps.select("fp", "tie", F.explode(balls).alias("ball"))
    return ball.select(
        F.col("fp").alias("p_fp"), F.col("tie").alias("p_tie"), F.col("ball.entry").alias("p_entry"), F.col("ball.same").alias("same")
    )


def _tied(fps: DataFrame) -> DataFrame:
    """(fp, tie): fingerprints one shared neighbour apart, tied over any number of steps."""
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)]
    near = fps.select("fp", F.explode(F.array(*flips)).alias("near"))
    least = near.groupBy("near").agg(F.min("fp").alias("least"))
    stars = near.join(least, "near").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    found = components(stars).select(F.col("node").alias("fp"), F.col("component").alias("tie"))
    return fps.join(found, "fp", "left").select("fp", F.coalesce("tie", "fp").alias("tie"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """(a, b) that connect all of the distinct ``fps`` (fp) that are ``max_bits`` apart or nearer.

    Every pair is a link; pairs already tied through dense entries are left out.
    """
    width, radius = BITS // segments, max_bits // segments
    free = fps.select("fp", F.col("fp").alias("tie"))
    hot = _tables(free, segments, width).groupBy("entry").agg(F.count("*").alias("n")).where(F.col("n") > dense)
    ties = None
    if max_bits >= 2 and not (hot := written(hot, "dense-entries")).isEmpty():
        inside = _tables(free, segments, width).join(hot, "entry", "left_semi").select("fp").distinct()
        ties = written(_tied(inside), "ties")
        free = fps.join(ties, "fp", "left").select("fp", F.coalesce("tie", "fp").alias("tie"))
    tables = _tables(free, segments, width)
    probes = _probes(free, segments, width, radius)
    if ties is not None:
        # An entry whose fingerprints are all tied has nothing for one of them.
        alone = tables.join(hot, "entry", "left_semi").groupBy("entry").agg(F.min("tie").alias("lo"), F.max("tie").alias("hi"))
        alone = alone.where("lo = hi").select(F.col("entry").alias("p_entry"), F.col("lo").alias("p_tie"))
        probes = probes.join(written(alone, "tied-entries"), ["p_entry", "p_tie"], "left_anti")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("p_fp")))
    match = (
        (F.col("entry") == F.col("p_entry")) & (F.col("fp") != F.col("p_fp")) & (F.col("tie") != F.col("p_tie"))
        & (apart <= max_bits) & (~F.col("same") | (F.col("p_fp") < F.col("fp")))
    )
    # Spark sizes the probes by the table they are exploded from and might broadcast them.
    found = probes.join(tables.hint("merge"), match).select(F.col("p_fp").alias("a"), F.col("fp").alias("b"))
    if ties is not None:
        found = found.unionByName(ties.where("fp <> tie").select(F.col("fp").alias("a"), F.col("tie").alias("b")))
    return found


def _grouped(docs: DataFrame, shingle: int, max_bits: int, **settings) -> DataFrame:
    """(doc_id, t1, t2, fp, component_id) for every row; t1 and t2 stand for the text."""
    rows = with_fingerprints(docs, shingle).select("row.doc_id", *text_key(F.col("row.text").cast("string")), "fp")
    rows = written(rows, "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(nodes.select("fp"), max_bits, **settings))
    found = written(found.select(F.col("node").alias("fp"), "component"), "fingerprint-groups")
    # Fingerprints without links are their own component.
    grouped = nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    grouped = written(grouped, "fingerprint-nodes")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = grouped.join(least, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "t1", "t2", "fp", "component_id")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **settings) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the least doc_id reachable by links."""
    return _grouped(docs, shingle, max_bits, **settings).select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **settings) -> DataFrame:
    """The rows of ``docs`` with the least id of their group.

    Rows that are not the least go by id and fingerprint, so an id that was
    given to two texts loses only the one that repeats another.  Of rows that
    share id and group one stays.  Fingerprints are made once; the rows to
    drop are found again by id and text.
    """
    groups = written(_grouped(docs, shingle, max_bits, **settings), "near-groups")
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("component_id").agg(F.min("fp").alias("first_fp"))
    first = first.withColumnRenamed("component_id", "first_id")
    stays = groups["component_id"].eqNullSafe(first["first_id"]) & groups["doc_id"].eqNullSafe(first["first_id"])
    marked = groups.join(first, stays & (groups["fp"] == first["first_fp"]), "left")
    marked = marked.groupBy("doc_id", "fp").agg(F.count("first_fp").alias("n_kept"))
    # Rows to drop, and rows that are there more than once, by id and fingerprint, then by id and text.
    odd = marked.where("n_kept <> 1").select(F.col("doc_id").alias("o_id"), F.col("fp").alias("o_fp"), "n_kept")
    texts = groups.join(odd, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("fp") == F.col("o_fp")))
    texts = texts.groupBy("o_id", "o_fp", "n_kept", F.col("t1").alias("o_t1"), F.col("t2").alias("o_t2")).count().drop("count")
    odd = written(texts, "near-odd")
    rows = docs.select(F.struct("*").alias("row"), *text_key(F.col("text").cast("string")))
    same = F.col("row.doc_id").eqNullSafe(F.col("o_id")) & (F.col("t1") == F.col("o_t1")) & (F.col("t2") == F.col("o_t2"))
    single = rows.join(odd, same, "left_anti").select("row.*")
    again = odd.where("n_kept > 1")
    if again.isEmpty():
        return single
    columns = single.columns
    again = rows.join(again, same).withColumns({"_id": F.col("o_id"), "_fp": F.col("o_fp")}).dropDuplicates(["_id", "_fp"])
    return single.unionByName(again.select("row.*").toDF(*columns))
