"""Embedding near-duplicates by iterative quantisation.

A rotation is learned that turns principal components into balanced bits: the
signs of the rotated vectors, with the rotation fitted so that vectors lie near
the corners they are rounded to.  Several rotations, from different seeds, give
the tables.  Vectors meet in a table if their codes there differ in at most
``radius`` bits (each vector looks up the ball around its code; of two vectors
the one with the highest differing bit looks up).  Pairs whose codes over all
tables are too far apart are dropped inside that join, and the rest are
reranked: a link needs a cosine of at least ``threshold`` from the original
vectors in double precision.

Tables are as wide as the corpus needs for a bounded number of chance
meetings; their number is measured.  Pairs at the threshold (found in the
sample, and made from it) are coded, and tables are added until the share of
them that meets is ``recall``.  How far apart codes may be is taken from the
same pairs.  The angle of the raw vectors does not tell either: codes are signs
around a centre, and around the mean of vectors with a common direction a pair
stands at a wider angle.  Centre is the mean or the origin, whichever is
expected to need fewer probes and meetings.

The rotations are fitted on a bounded sample of ``fit_rows`` vectors; every
vector is indexed.  Equal vectors are one node; their number enters the counts.

Defined results: vectors that are null, empty, all zero or hold null or
non-finite components link with nothing; vectors of different lengths never
link, each length has its own tables; rows with a null vec_id are linked and
counted, and name no component unless all its ids are null; rows that repeat
a vec_id are vectors of their own; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import ship, written
from lumenlake.llm.components import components

THRESHOLD = 0.95
RECALL = 0.98
RADIUS = 2
FIT_ROWS = 8192
ROUNDS = 40
MEETINGS = 64
PROBES = 2048
LEAST_FOUND = 200
_SEED = 20


def learn_rotation(
    sample: np.ndarray, bits: int, seed: int, centre: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projection): signs of (x - centre) @ projection are the code.

    Components are taken in a random basis of the leading ones, so that every
    bit carries about the same variance, then quantised iteratively.
    """
    rng = np.random.default_rng(seed)
    centred = sample - centre
    dims = centred.shape[1]
    _, axes = np.linalg.eigh(centred.T @ centred)  # dims x dims; a factorisation of the rows would not be
    basis = np.linalg.qr(rng.standard_normal((dims, dims)))[0] if bits < dims else np.eye(dims)
    axes = axes @ basis  # all components, mixed: tables with fewer bits than dimensions see different ones
    axes = np.tile(axes, (1, -(-bits // dims)))[:, :bits]
    reduced = centred @ axes
    turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        corners = np.where(reduced @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(reduced.T @ corners)
        turn = left @ right
    return centre, axes @ turn


def plan(n: int, threshold: float, recall: float, radius: int) -> tuple[int, int]:
    """(bits per table, least number of tables) for ``n`` vectors."""
    ball = lambda bits: sum(math.comb(bits, r) for r in range(radius + 1))
    bits = 12
    while bits < 30 and n * ball(bits) > MEETINGS << bits:
        bits += 1
    flip = math.acos(threshold) / math.pi
    met = sum(math.comb(bits, r) * flip**r * (1 - flip) ** (bits - r) for r in range(radius + 1))
    return bits, max(2, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def encode(x: np.ndarray, rotation: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Codes of unit vectors in one table."""
    centre, axes = rotation
    return ((x - centre) @ axes >= 0) @ (1 << np.arange(axes.shape[1], dtype=np.int64))


def threshold_pairs(sample: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors (x, y), by kind: turned to the threshold in any direction, turned the way two
    vectors of the sample differ, and, if there are enough, the sample's own in the lower half of the links."""
    rng = np.random.default_rng(_SEED)
    x = sample[rng.permutation(np.resize(np.arange(len(sample)), PROBES))]
    kinds = []
    one, other = rng.integers(len(sample), size=(2, PROBES))
    for way in (rng.standard_normal(x.shape), sample[one] - sample[other]):
        across = way - (way * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(across, axis=1, keepdims=True)
        some = size[:, 0] > 1e-6
        y = threshold * x[some] + math.sqrt(1 - threshold**2) * across[some] / size[some]
        kinds.append((x[some], y))
    own, step = [], 256
    share = -(-PROBES * step // len(sample))
    for start in range(0, len(sample), step):
        cosine = sample[start : start + step] @ sample[start:].T
        a, b = np.nonzero(np.triu((cosine >= threshold) & (cosine <= (1 + threshold) / 2), 1))
        some = rng.permutation(len(a))[:share]
        own.append(np.stack([a[some], b[some]], axis=1) + start)
    own = np.concatenate(own)
    if len(own) >= LEAST_FOUND:
        kinds.append((sample[own[:, 0]], sample[own[:, 1]]))
    return [kind for kind in kinds if len(kind[0])]


class Tables:
    """Rotations around one centre, and what they do to pairs at the threshold."""

    def __init__(self, sample: np.ndarray, centre: np.ndarray, bits: int, radius: int, pairs: list[tuple[np.ndarray, np.ndarray]]):
        self.sample, self.centre, self.bits, self.radius, self.pairs = sample, centre, bits, radius, pairs
        self.rotations: list[tuple[np.ndarray, np.ndarray]] = []
        self.met = [np.zeros(len(x), dtype=bool) for x, _ in pairs]
        self.apart = [np.zeros(len(x), dtype=np.int64) for x, _ in pairs]
        self.single = [0.0] * len(pairs)  # tables a pair meets in, on average

    def add(self, rounds: int = ROUNDS) -> None:
        rotation = learn_rotation(self.sample, self.bits, _SEED + len(self.rotations), self.centre, rounds)
        self.rotations.append(rotation)
        for k, (x, y) in enumerate(self.pairs):
            differing = np.bitwise_count(encode(x, rotation) ^ encode(y, rotation)).astype(np.int64)
            self.met[k] |= differing <= self.radius
            self.apart[k] += differing
            self.single[k] += (differing <= self.radius).mean()

    def recall(self) -> float:
        return min((met.mean() for met in self.met), default=1.0)

    def needed(self, recall: float) -> float:
        """Number of tables the recall is expected to need."""
        met = min(self.single, default=1.0) / len(self.rotations)
        return math.inf if met <= 0 else max(1.0, math.log(1 - recall) / math.log(1 - min(met, recall)))

    def work(self, n: int, recall: float) -> float:
        """Expected probes and meetings of a vector among ``n``."""
        rng = np.random.default_rng(_SEED)
        a, b = rng.integers(len(self.sample), size=(2, 1 << 19))
        a, b = a[a != b], b[a != b]
        ball = sum(math.comb(self.bits, r) for r in range(self.radius + 1))
        chance = 0.0
        for rotation in self.rotations:
            codes = encode(self.sample, rotation)
            chance += (np.bitwise_count(codes[a] ^ codes[b]) <= self.radius).mean() if len(a) else 0.0
        return self.needed(recall) * (ball + n * chance / len(self.rotations))

    def furthest(self) -> int:
        """Differing bits over all tables that no pair at the threshold goes past."""
        ends = [max(apart.max(), apart.mean() + 5 * apart.std()) for apart in self.apart]
        return math.ceil(max(ends, default=self.bits * len(self.rotations)))


def learn_tables(sample: np.ndarray, n: int, threshold: float, recall: float, radius: int) -> Tables:
    """Tables for ``n`` vectors in which pairs at the threshold meet with the recall."""
    bits, least = plan(n, threshold, recall, radius)
    pairs = threshold_pairs(sample, threshold)
    ways = []
    for centre in (sample.mean(axis=0), np.zeros(sample.shape[1])):
        tables = Tables(sample, centre, bits, radius, pairs)
        for _ in range(least):
            tables.add()
        ways.append(tables)
    best = min(ways, key=lambda tables: tables.work(n, recall))
    # Past four times the expected number, rotations are drawn: those differ for sure, learned ones may not.
    learned = 4 * best.needed(recall)
    while best.recall() < recall:
        best.add(ROUNDS if len(best.rotations) < learned else 0)
    return best


def usable(vector) -> F.Column:
    """Non-empty, finite throughout and not zero; null otherwise false."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _codes(nodes: DataFrame, rotations: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(node, codes): one integer per table."""
    shared = nodes.sparkSession.sparkContext.broadcast(rotations)  # tables x dims x bits numbers

    @F.pandas_udf("array<long>")
    def coded(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = np.stack(vectors.to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return pd.Series(list(np.stack([encode(x, rotation) for rotation in shared.value], axis=1)))

    return nodes.select("node", coded("vector").alias("codes"))


def _candidates(codes: DataFrame, bits: int, tables: int, radius: int, furthest: int) -> DataFrame:
    """Distinct (a, b) that meet in a table and are near over all of them."""
    masks = [0] + [sum(1 << i for i in some) for r in range(1, radius + 1) for some in combinations(range(bits), r)]
    ball = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit((1 << m.bit_length()) >> 1).cast("long").alias("high")) for m in masks))
    entries = codes.select("node", "codes", F.posexplode("codes").alias("t", "code"))
    probes = entries.withColumn("m", F.explode(F.filter(ball, lambda m: (m["mask"] == 0) | (F.col("code").bitwiseAND(m["high"]) != 0))))
    probes = probes.select(
        F.col("node").alias("p_node"), F.col("codes").alias("p_codes"), F.col("t").alias("p_t"),
        F.col("code").bitwiseXOR(F.col("m.mask")).alias("p_code"), (F.col("m.mask") == 0).alias("same"),
    )
    apart = sum((F.bit_count(F.col("codes")[i].bitwiseXOR(F.col("p_codes")[i])) for i in range(tables)), F.lit(0))
    met = (
        (F.col("t") == F.col("p_t")) & (F.col("code") == F.col("p_code"))
        & (~F.col("same") | (F.col("p_node") < F.col("node"))) & (apart <= furthest)
    )
    # Spark sizes the probes by the table they are exploded from and would broadcast them.
    pairs = probes.join(entries.hint("merge"), met).select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"))
    return pairs.distinct()


def _rerank(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose vectors have the cosine."""
    left = nodes.select(F.col("node").alias("a"), F.col("vector").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("vector").alias("y"))

    def near(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.stack(batch[c].to_numpy()).astype(np.float64) for c in "xy")
                cosine = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                yield batch.loc[cosine >= threshold, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(near, "a long, b long")


def _links_of_length(
    nodes: DataFrame, threshold: float, recall: float, radius: int, fit_rows: int
) -> DataFrame:
    n = nodes.count()
    sample = nodes.orderBy(F.xxhash64("vector")).limit(fit_rows).select("vector").toPandas()["vector"]
    sample = np.stack(sample.to_numpy()).astype(np.float64)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    tables = learn_tables(sample, n, threshold, recall, radius)
    codes = written(_codes(nodes, tables.rotations), "itq-codes")
    pairs = _candidates(codes, tables.bits, len(tables.rotations), radius, tables.furthest())
    pairs = written(pairs, "itq-pairs")
    return _rerank(pairs, nodes, threshold)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    radius: int = RADIUS,
    fit_rows: int = FIT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, n_links, component_id, kept) and links (a, b) between the nodes' least ids."""
    ship(vectors.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", vector.alias("vector"))
    rows = rows.withColumn("good", usable(F.col("vector")))
    # 128 bits name a distinct vector.
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit("second"), "vector")})
    good = rows.where("good")
    nodes = good.groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "itq-nodes")
    lengths = [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]
    spark = vectors.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    for length in sorted(lengths):
        part = nodes.where(F.size("vector") == length)
        links = links.unionByName(_links_of_length(part, threshold, recall, radius, fit_rows))
    links = written(links, "itq-links")

    copies = nodes.select("node", "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(copies.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.sum("copies").alias("near"))
    found = components(links)
    facts = (
        nodes.select("node", "h1", "h2", "least", "copies")
        .join(degree.withColumnRenamed("a", "node"), "node", "left")
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    facts = written(facts, "itq-facts")
    names = facts.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = facts.join(names, "component").select(
        "h1", "h2", "component_id", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(True).alias("good")
    )
    out = rows.join(facts, ["h1", "h2", "good"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long").alias("component_id"),
    )
    out = out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    least = nodes.select("node", "least")
    named = (
        links.join(least.withColumnRenamed("node", "a"), "a").withColumnRenamed("least", "id_a")
        .join(least.withColumnRenamed("node", "b"), "b").select(F.col("id_a").alias("a"), F.col("least").alias("b"))
    )
    return out, named
