"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the wanted amount in proportion to its weight.
A source whose share exceeds ``max_epochs`` times its size is clamped there,
and what it leaves is shared by the others, until no source is above.  The
rounds run on one row per source and bring two numbers to the driver.

Documents are then repeated as a whole: the whole part of target / size for
every document of a source, and one more time for those whose seeded hash, of
id and text, is below the source's cut.  The cut lies where the running total of sizes in
hash order meets the fraction wanted, so taken words differ from the target
by half of one document at most.  It is found in two steps: totals by the
first hash digits, then the documents of the one chunk the cut falls into.

Defined results: a null source is a source of its own; a null or empty text
has size 0 and adds nothing; a null or negative weight counts as 0; a null id
counts as empty text in the hash; rows that share id and text are taken
together, others with the same id are not; an empty table stays empty; extra
columns, whatever their names, travel untouched inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenlake.llm.common import seeded_hash, text_or_empty, word_count, written

SHARE = 1.5
MAX_EPOCHS = 2
CYCLE = (5, 2, 1)
SEED = "mix-1"
CHUNK_DIGITS = 3


def source_sizes(docs: DataFrame) -> DataFrame:
    """(source, source_size): one row per source, null included."""
    return docs.select("source", word_count(text_or_empty()).alias("size")).groupBy("source").agg(
        F.sum("size").alias("source_size")
    )


def cycled_weights(sources: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """Weights in turn by the code point order of the sources, null last.

    The window has no key: its input is one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    return sources.withColumn("weight", F.element_at(weights, (place % len(cycle) + 1).cast("int")))


def water_fill(sources: DataFrame, amount: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    The level num / den is kept as two exact numbers, so one division is the
    only rounding.  If all sources together hold less than the amount, each
    ends at its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    num, den = float(amount), float(sources.agg(F.sum(weight)).first()[0] or 0.0)
    while den > 0:
        over = weight * num > cap * den
        clamped, rest = sources.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, weight))).first()
        level = (float(amount) - (clamped or 0.0), rest or 0.0)
        if level == (num, den):
            break
        num, den = level
    if den == 0:
        return sources.withColumn("target", F.when(weight > 0, cap).otherwise(0.0))
    return sources.withColumn("target", F.when(weight * num > cap * den, cap).otherwise(weight * num / den))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(
        F.struct("*").alias("row"),
        "source",
        seeded_hash(seed, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_or_empty())).alias("place"),
        word_count(text_or_empty()).alias("size"),
    )


def _cuts(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cut): the last hash that gets the extra repetition, or what lies just below the first."""
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    chunk = F.substring("place", 1, CHUNK_DIGITS)
    totals = sizes.groupBy("source", chunk.alias("chunk")).agg(F.sum("size").alias("size"))
    running = Window.partitionBy("source").orderBy("chunk")
    totals = totals.withColumn("above", F.sum("size").over(running)).withColumn("below", F.col("above") - F.col("size"))
    wanted = sources.select("source", "extra").alias("s")
    edge = (
        totals.alias("t").join(wanted, same(totals, sources), "inner")
        .where("t.below < s.extra and s.extra <= t.above")
        .select("t.source", "t.chunk", "t.below", "s.extra")
    )
    edge = written(edge, "mix-edges")
    e = edge.select(F.col("source").alias("e_source"), F.col("chunk").alias("e_chunk"), "below", "extra")
    inside = sizes.join(e, sizes["source"].eqNullSafe(e["e_source"]) & (chunk == F.col("e_chunk")), "inner")
    inside = inside.groupBy("source", "place", "below", "extra").agg(F.sum("size").alias("size"))
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("place"))
    inside = inside.withColumn("middle", F.col("below") + so_far - F.col("size") / 2.0)
    last = inside.where("middle < extra").groupBy("source").agg(F.max("place").alias("last"))
    return edge.join(last, edge["source"].eqNullSafe(last["source"]), "left").select(
        edge["source"], F.coalesce("last", edge["chunk"]).alias("cut")
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(row, size, source_size, target, repeats, taken) for every row of ``docs``.

    ``weights`` (source, weight) defaults to the cycled weights; sources it
    does not name get nothing.
    """
    sizes = written(_sized(docs, seed).drop("row"), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycled_weights(sources)
    else:
        named = weights.groupBy(F.col("source").alias("w_source")).agg(F.max("weight").alias("weight"))
        sources = sources.join(named, sources["source"].eqNullSafe(named["w_source"]), "left").drop("w_source")
    sources = written(sources, "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = water_fill(sources, share * total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole.cast("long"))
    sources = sources.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = written(sources, "mix-targets")
    cuts = _cuts(sizes, sources)
    per_source = written(
        sources.join(cuts, sources["source"].eqNullSafe(cuts["source"]), "left").select(
            sources["source"].alias("s_source"), "source_size", "target", "whole", "cut"
        ),
        "mix-cuts",
    )
    rows = _sized(docs, seed)
    repeats: Column = F.col("whole") + F.coalesce((F.col("place") <= F.col("cut")).cast("long"), F.lit(0))
    return rows.join(per_source, rows["source"].eqNullSafe(per_source["s_source"]), "left").select(
        "row", "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken")
    )


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("_copy")
    return mix(docs, **settings).where("repeats > 0").select("row", copies).select("row.*")
