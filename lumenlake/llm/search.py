"""Ranked lexical search: MaxScore with bounds of term pairs.

A query set is taken in blocks of bounded size; each block is searched in all
documents.  Documents become rows of (term, count) for the block's terms, which
are written.  From those come the statistics of the corpus, the weight of each
term, and shards: pieces of the collection of bounded size with a posting list
per term, its maximum impact, and for each pair of terms that stand next to
each other in the weight order of some item the greatest joint impact over
their intersection list.  The best documents of these lists are scored whole,
so a tenth best score over all shards is known for every item before the search.

In a shard the terms of an item are ordered by weight.  Documents that hold
only its first k terms score at most B(k), where

    B(k) = min(B(k-1) + max(k), B(k-2) + joint(k-1, k)),

so a pair that is never strong together counts for less than two independent
maxima.  Lists of the longest prefix with a bound below the tenth score cannot
add a document; they are only looked up for documents found in the other lists
that can still reach it.  The threshold rises with what a shard finds itself.

Scores: N documents have at least one term, L terms in all; n is a document's
length, df the documents with a term, tf its count in one.  The weight is
floor(1000 ln((2N+2)/(2df+1))) and a document's score the sum over terms of
weight * (10^9 tf div (1000 tf + 8 m)), m = 10 + (90 n N div L).

Defined results: a term is a maximal string of ASCII letters, digits and
characters beyond ASCII, A-Z lower-cased; null and termless texts count neither
for N nor as results, termless items have none; rows that share an item's id
are one item with the terms of all; every document row is ranked by itself;
equal scores go by id, null last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lumenlake.llm.common import lower_ascii, ship, slices, written

TOP = 10
BLOCK_TERMS = 100_000
SHARD_POSTINGS = 1 << 18
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes as they count: letters of both cases alike, what separates terms as a space.
_FOLDED = np.full(256, 32, dtype=np.uint8)
_FOLDED[128:] = range(128, 256)
for _low, _high, _shift in ((48, 57, 0), (65, 90, 32), (97, 122, 0)):
    _FOLDED[_low : _high + 1] = np.arange(_low, _high + 1) + _shift


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts, and where each text's terms end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    folded = _FOLDED[np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]]
    clean = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(folded))
    split = pc.ascii_split_whitespace(clean)
    flat, edges = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    filled = pc.not_equal(pc.binary_length(flat), 0)
    counted = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return flat.filter(filled), counted[edges[1:] - edges[0]]


def _counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Per text: number of terms, numbers of its vocabulary terms in ascending order, and their counts."""
    flat, ends = terms_of(texts)
    sizes = np.diff(np.concatenate([[0], ends]))
    found = pc.index_in(flat, vocabulary)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(sizes)), sizes)[known]
    keys = text * max(1, len(vocabulary)) + found.drop_null().to_numpy().astype(np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    held = np.bincount(keys // max(1, len(vocabulary)), minlength=len(sizes))
    offsets = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
    terms = pa.ListArray.from_arrays(offsets, pa.array((keys % max(1, len(vocabulary))).astype(np.int32)))
    return pa.array(sizes), terms, pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))


class Block:
    """Some items of the query set: their terms in weight order, and the pairs of neighbours."""

    def __init__(self, items: list[tuple[Any, list[str]]]):
        self.ids = [item for item, _ in items]
        self.vocabulary = sorted({term for _, terms in items for term in terms})
        number = {term: i for i, term in enumerate(self.vocabulary)}
        self.items = [sorted(number[t] for t in terms) for _, terms in items]
        self.pairs: dict[tuple[int, int], int] = {}

    def weigh(self, n_docs: int, total: int, df: dict[int, int]) -> None:
        self.n_docs, self.total = n_docs, total
        weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) if t in df else 0
        self.weights = np.array([weight(t) for t in range(len(self.vocabulary))], dtype=np.int64)
        # Terms that no document holds, or that weigh nothing, add to no score.
        self.items = [sorted((t for t in terms if self.weights[t] > 0), key=lambda t: (self.weights[t], t)) for terms in self.items]
        for terms in self.items:
            for pair in zip(terms, terms[1:], strict=False):
                self.pairs.setdefault(pair, len(self.pairs))


class Shard:
    """Posting lists of some documents."""

    def __init__(self, terms: np.ndarray, ends: np.ndarray, places: np.ndarray, impacts: np.ndarray):
        starts = np.concatenate([[0], ends[:-1]])
        self.lists = {
            t: (places[a:b], impacts[a:b]) for t, a, b in zip(terms.tolist(), starts.tolist(), ends.tolist(), strict=True)
        }

    def joint(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The intersection list of two terms: places and summed impacts."""
        if a not in self.lists or b not in self.lists:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        (few, one), (many, other) = sorted((self.lists[a], self.lists[b]), key=lambda x: len(x[0]))
        at = np.minimum(np.searchsorted(many, few), len(many) - 1)
        both = many[at] == few
        return few[both], one[both] + other[at[both]]

    def scores(self, terms: list[int], places: np.ndarray) -> np.ndarray:
        """Whole scores of the documents at some places, in ascending order."""
        found = np.zeros(len(places), dtype=np.int64)
        for t in terms:
            if t in self.lists:
                held, impacts = self.lists[t]
                at = np.minimum(np.searchsorted(held, places), len(held) - 1)
                found += np.where(held[at] == places, impacts[at], 0)
        return found

    def bounds(self, terms: list[int], maxima: dict[int, int], joint: list[int]) -> list[int]:
        """The most that a document can score with the first k terms, for every k."""
        found = [0]
        for k, t in enumerate(terms):
            bound = found[-1] + maxima.get(t, 0)
            if k:
                before = maxima.get(terms[k - 1], 0)
                bound = min(bound, found[-2] + max(joint[k - 1], before, maxima.get(t, 0)))
            found.append(bound)
        return found

    def best(self, terms: list[int], bounds: list[int], n_docs: int, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that score ``least`` or more; at least the ``top`` best of those."""
        least = max(1, least)
        optional = max(k for k, bound in enumerate(bounds) if bound < least)
        total = np.zeros(n_docs, dtype=np.int64)
        for t in terms[optional:]:
            if t in self.lists:
                places, impacts = self.lists[t]
                total[places] += impacts
        places = np.flatnonzero(total)
        scores = total[places]
        for k in range(optional, -1, -1):
            if len(scores) > top:
                least = max(least, int(np.partition(scores, -top)[-top]))
            able = scores + bounds[k] >= least
            places, scores = places[able], scores[able]
            if k and terms[k - 1] in self.lists and len(places):
                scores = scores + self.scores([terms[k - 1]], places)
        return places, scores


_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_ROWS = "doc_id {}, n bigint, terms array<int>, counts array<int>"
_SHARD = (
    "doc_ids array<{}>, terms array<int>, ends array<int>, places array<int>, impacts array<bigint>, "
    "joint array<bigint>, seed_items array<int>, seed_scores array<bigint>"
)


def _extracted(docs: DataFrame, vocabulary: list[str], kind: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a block's terms: bounded

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_string())
        for batch in batches:
            at = 0
            for texts in slices(pc.fill_null(batch.column("text"), "")):
                sizes, terms, counts = _counts(texts, known)
                ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([ids, sizes, terms, counts], names=["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows, _ROWS.format(kind))


def _inverted(block: Block, ids: pa.Array, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, held: np.ndarray, top: int) -> list:
    """The columns of a shard."""
    places = np.repeat(np.arange(len(n)), held)
    m = 10 + 90 * n * block.n_docs // block.total
    impacts = block.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[places]))
    order = np.argsort(terms, kind="stable")
    terms, places, impacts = terms[order], places[order], impacts[order]
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, dtype=np.int64)
    ends = np.concatenate([starts[1:], [len(terms)]]) if len(starts) else starts
    shard = Shard(terms[starts], ends, places, impacts)
    lists = {pair: shard.joint(*pair) for pair in block.pairs}
    joint = [int(lists[pair][1].max(initial=0)) for pair in block.pairs]
    seed_items, seed_scores = [], []
    for item, wanted in enumerate(block.items):
        # Documents at the head of the item's intersection lists, or of its strongest list.
        near = [lists[pair] for pair in zip(wanted, wanted[1:], strict=False) if len(lists[pair][0])]
        near = near or [shard.lists[t] for t in wanted[-1:] if t in shard.lists]
        if near:
            heads = [p if len(p) <= top else p[np.argpartition(s, -top)[-top:]] for p, s in near]
            scores = np.sort(shard.scores(wanted, np.unique(np.concatenate(heads))))[-top:]
            seed_items += [item] * len(scores)
            seed_scores += scores.tolist()
    rows = [ids.to_pylist(), terms[starts], ends, places, impacts, joint, seed_items, seed_scores]
    kinds = [pa.list_(ids.type), _INTS, _INTS, _INTS, _LONGS, _LONGS, _INTS, _LONGS]
    return [pa.array([r], kind) for r, kind in zip(rows, kinds, strict=True)]


def _shards(rows: DataFrame, shared, kind: str, top: int, postings: int) -> DataFrame:
    """One row per shard, written."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        names = [c.split()[0] for c in _SHARD.split(", ")]
        for batch in batches:
            n = batch.column("n").to_numpy().astype(np.int64)
            terms, counts = batch.column("terms"), batch.column("counts")
            ends = np.cumsum(pc.list_value_length(terms).to_numpy().astype(np.int64))
            start = 0
            while start < len(n):
                before = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, before + postings, side="right")))
                part = slice(start, end)
                held = np.diff(ends[part], prepend=before)
                flat = [c.slice(start, end - start).flatten().to_numpy().astype(np.int64) for c in (terms, counts)]
                columns = _inverted(block, batch.column("doc_id").slice(start, end - start), n[part], *flat, held, top)
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start = end

    return written(rows.where(F.size("terms") > 0).mapInArrow(built, _SHARD.format(kind)), "search-shards")


def _top(rows: DataFrame, top: int, *order) -> DataFrame:
    """The first ``top`` rows of each item with their rank; cut down in every task before the exchange."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def _found(shards: DataFrame, shared, floors: dict[int, int], kind: str, top: int) -> DataFrame:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                column = lambda name: batch.column(name).slice(at, 1).flatten()  # noqa: E731, B023
                ids, joint = column("doc_ids"), column("joint").to_numpy()
                terms, ends, places, impacts = (column(c).to_numpy() for c in ("terms", "ends", "places", "impacts"))
                shard = Shard(terms, ends, places, impacts)
                heads = np.concatenate([[0], ends[:-1]])
                maxima = dict(zip(terms.tolist(), np.maximum.reduceat(impacts, heads).tolist(), strict=True)) if len(terms) else {}
                items, kept, scores = [], [], []
                for item, wanted in enumerate(block.items):
                    pairs = [int(joint[block.pairs[pair]]) for pair in zip(wanted, wanted[1:], strict=False)]
                    bounds = shard.bounds(wanted, maxima, pairs)
                    if bounds[-1] < max(1, floors.get(item, 1)):
                        continue
                    found, score = shard.best(wanted, bounds, len(ids), floors.get(item, 1), top)
                    items += [item] * len(found)
                    kept.append(found)
                    scores.append(score)
                if items:
                    chosen = ids.take(pa.array(np.concatenate(kept)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(items, pa.int32()), chosen, pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"]
                    )

    return shards.drop("seed_items", "seed_scores").mapInArrow(searched, f"item int, doc_id {kind}, score bigint")


def _search_block(docs: DataFrame, block: Block, top: int, postings: int) -> DataFrame | None:
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = written(_extracted(docs, block.vocabulary, kind), "search-terms")
    size = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    if not size["n"]:
        return None
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count()  # a row per term of the block
    block.weigh(size["n"], size["total"], {r["term"]: r["count"] for r in held.collect()})
    shared = spark.sparkContext.broadcast(block)
    shards = _shards(rows, shared, kind, top, postings)
    seeds = shards.select(F.explode(F.arrays_zip("seed_items", "seed_scores")).alias("s"))
    seeds = _top(seeds.select(F.col("s.seed_items").alias("item"), F.col("s.seed_scores").alias("score")), top, F.desc("score"))
    floors = {r["item"]: r["score"] for r in seeds.where(F.col("rank") == top).collect()}  # one row per item
    return _top(_found(shards, shared, floors, kind, top), top, F.desc("score"), F.asc_nulls_last("doc_id"))


def _blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Items in blocks of at most ``most`` terms; a longer item is a block of its own."""
    terms = F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(f"({TERM})"), F.lit(1))
    single = items.select("item_id", F.explode(F.array_distinct(terms)).alias("term"))
    whole = single.groupBy("item_id").agg(F.collect_set("term").alias("terms"))
    gathered, size = [], 0
    for row in whole.toLocalIterator():
        if gathered and size + len(row["terms"]) > most:
            yield Block(gathered)
            gathered, size = [], 0
        gathered.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
    if gathered:
        yield Block(gathered)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, shard_postings: int = SHARD_POSTINGS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    id_field = T.StructField("item_id", items.schema["item_id"].dataType)
    shape = T.StructType([T.StructField("item", T.IntegerType()), id_field])
    empty = T.StructType([
        id_field, T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("score", T.LongType()),
    ])
    result = spark.createDataFrame([], empty)
    for block in _blocks(items, block_terms):
        found = _search_block(docs, block, top, shard_postings)
        if found is not None:
            names = spark.createDataFrame(list(enumerate(block.ids)), shape)
            result = result.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return result
