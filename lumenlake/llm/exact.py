"""Exact deduplication by skew-safe combining; DataFrame functions only.

Texts are equal when identical after every run of ASCII blanks became one
space.  Each map task first merges equal texts among its own rows (the partial
aggregation on digest and content).  What is left of a digest is merged per
salt, the salt being the number of the map task modulo ``salts``, so that a
digest which occurs in every task is spread over ``salts`` reducers.  The
winners of the salts are then combined per digest.  Every stage groups by the
full content beside the digest: two texts are never merged on a digest alone.
Rows then learn their winner by a narrow join on the digest; should a digest
stand for several contents, those rows are matched by content.

Defined results: null counts as empty; the least id of a group stays and null
ids come last; of repeated rows with the least id exactly one is kept; an
empty table stays empty; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenlake.llm.common import BLANKS, text_or_empty, written

SALTS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    texts = docs.select("doc_id", normalised(text_or_empty()).alias("content"))
    return texts.select("doc_id", "content", digest(F.col("content")).alias("digest"))


def winners(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(digest, content, keep_id, group_size), one row per distinct content."""
    salted = (
        _keyed(docs, digest).withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "content", "salt").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    )
    return (
        salted.repartition("digest")
        .groupBy("digest", "content").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    )


def groups(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of ``docs``."""
    # Partitioned by digest already: counting contents moves nothing.
    per_digest = written(
        winners(docs, salts, digest).groupBy("digest").agg(
            F.count("*").alias("contents"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
        "exact-winners",
    )
    rows = _keyed(docs, digest)
    found = rows.join(per_digest.where("contents = 1"), "digest").select("doc_id", "keep_id", "group_size", "digest")
    shared = per_digest.where("contents > 1").select("digest")
    if not shared.isEmpty():
        inside = winners(docs.select("doc_id", "text"), salts, digest).join(shared, "digest", "left_semi")
        apart = rows.join(inside, ["digest", "content"]).select("doc_id", "keep_id", "group_size", "digest")
        found = found.unionByName(apart)
    found = written(found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))), "exact-groups")
    n_classes = per_digest.agg(F.sum("contents")).first()[0] or 0
    if found.where("kept").count() == n_classes:
        return found
    return _one_kept(found)


def _one_kept(found: DataFrame) -> DataFrame:
    """Of repeated rows with the least id the first stays; only such groups are numbered."""
    by_group = ["digest", "keep_id", "group_size"]
    tied = written(found.where("kept").groupBy(*by_group).agg(F.count("*").alias("n")).where("n > 1"), "exact-ties")
    on = (
        (found["digest"] == tied["digest"]) & found["keep_id"].eqNullSafe(tied["keep_id"])
        & (found["group_size"] == tied["group_size"]) & found["kept"]
    )
    free = found.join(tied, on, "left_anti")
    among = found.join(tied, on, "left_semi")
    place = F.row_number().over(Window.partitionBy(*by_group).orderBy("doc_id"))
    return free.unionByName(among.withColumn("kept", place == 1))


def unique_rows(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = groups(docs, salts)
    kept = found.where("kept").select(F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest"))
    # Rows that share id and content with a kept one: more than one only if rows are repeated.
    copies = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy(
        F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest")
    ).agg(F.count("*").alias("copies")).where("copies > 1")
    rows = docs.select(F.struct("*").alias("row"), sha256(normalised(text_or_empty())).alias("digest"))
    same = F.col("row.doc_id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_digest"))
    staying = rows.join(kept, same, "left_semi")
    copies = written(copies, "exact-copies")
    if copies.isEmpty():
        return staying.select("row.*")
    single = staying.join(copies, same, "left_anti").select("row.*")
    again = staying.join(copies, same, "left_semi").withColumn("_id", F.col("row.doc_id"))
    return single.unionByName(again.dropDuplicates(["_id", "digest"]).select("row.*"))
