"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A feature is the presence of an n-gram of 3 to 6 characters in the lower-cased
text.  Its value is the log-count ratio: the logarithm of how much likelier
the n-gram is in toxic texts than in others, from smoothed document counts.
Logistic regression is fitted on these values, both classes weighing the same.

The fit uses a bounded sample of labelled rows: at most about ``sample_rows``
whole texts of each class, chosen by the hash of the id; rows that share id
and text count once, and where ids repeat with ever other texts the sample is
cut again by a hash of both.  N-grams are counted
as 64-bit hashes where the rows are; those in ``min_docs`` texts or more whose
ratio is at least ``min_ratio`` are the features.  All documents are scored, whole.

Defined results: null and empty texts have no features and score what the
intercept says; labels other than 0 and 1 and null labels are ignored; a
document with labels of both kinds counts as toxic; without rows of both
classes every score is the share of toxic rows (0 without any).  Repeated
rows score alike, and null ids count as empty text in hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import give_back, remainder, seeded_hash, ship, text_or_empty, written

SAMPLE_ROWS = 2500
SIZES = (3, 4, 5, 6)
MIN_DOCS = 5
MIN_RATIO = 1.5
PENALTY = 0.002
ROUNDS = 300
REJECT = 0.7
_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """One array per size: the hash of the n-gram that starts at each place."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    rolled = codes
    for size in range(2, SIZES[-1] + 1):
        if len(codes) < size:
            return
        rolled = rolled[:-1] * _STEP + codes[size - 1 :]
        if size in SIZES:
            mixed = (rolled ^ (rolled >> np.uint64(29)) ^ np.uint64(size)) * _MIX
            yield mixed ^ (mixed >> np.uint64(32))


@dataclass
class ToxicityModel:
    """Features by ascending hash, each with ratio times weight."""

    hashes: np.ndarray
    values: np.ndarray
    intercept: float

    def __post_init__(self):
        # A bitmap of leading bits spares most n-grams the search.
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[self.hashes >> np.uint64(64 - _BITS)] = True

    def features(self, text: str) -> np.ndarray:
        """The places of the features that occur in the text."""
        found = []
        for hashes in gram_hashes(text) if len(self.hashes) else ():
            hits = np.unique(hashes[self.maybe[hashes >> np.uint64(64 - _BITS)]])
            at = np.searchsorted(self.hashes, hits)
            at[at == len(self.hashes)] = 0
            found.append(at[self.hashes[at] == hits])
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def score(self, text: str) -> float:
        margin = self.intercept + float(self.values[self.features(text)].sum())
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, margin))))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample_rows: int, parts: int, held_out: int
) -> DataFrame:
    """(toxic, text) of about ``sample_rows`` rows of each class, outside the held-out part."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(remainder(F.col("doc_id"), parts) != held_out)
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    steps = 16**8
    place = F.conv(F.substring(seeded_hash("toxicity", F.col("doc_id")), 1, 8), 16, 10).cast("long")
    cut = F.lit(0)
    for toxic, n in counts.items():
        cut = F.when(F.col("toxic") == toxic, F.lit(math.ceil(steps * min(1.0, sample_rows / n)))).otherwise(cut)
    # About 2 x sample_rows ids, whatever the input: a proven bound for the broadcast.
    chosen = known.where(place < cut).select(F.col("doc_id").alias("chosen_id"), "toxic")
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("toxic", "chosen_id", "text")
    found = written(found.dropDuplicates(["chosen_id", "text"]), "toxicity-rows")
    again = F.lit(steps)
    for toxic, n in found.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        if n > 2 * sample_rows:  # ids that many texts share; with an id for each, the first cut leaves about half of that
            again = F.when(F.col("toxic") == toxic, F.lit(math.ceil(steps * sample_rows / n))).otherwise(again)
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("chosen_id").cast("string"), "text")), 1, 8), 16, 10).cast("long")
    return found.where(place < again).select("toxic", "text")


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: in how many texts of each class an n-gram occurs."""
    for batch in batches:
        classes = batch.column("toxic").to_numpy()
        for toxic in (0, 1):
            texts = batch.column("text").filter(pa.array(classes == toxic))
            per_text = [np.unique(h) for text in texts for h in gram_hashes(text.as_py())]
            if per_text:
                hashes, n = np.unique(np.concatenate(per_text), return_counts=True)
                columns = [pa.array(hashes.view(np.int64)), pa.array(np.full(len(n), toxic, dtype=np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "toxic", "n"])
        give_back()


def _ratios(counts: DataFrame, totals: dict[int, int], min_docs: int, min_ratio: float) -> pa.Table:
    """(hash, ratio) of the n-grams worth a feature."""
    by_hash = counts.groupBy("hash").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    ratio = F.log((F.col("bad") + 1) / float(totals[1] + 2)) - F.log((F.col("good") + 1) / float(totals[0] + 2))
    kept = by_hash.where(F.col("bad") + F.col("good") >= min_docs).select("hash", ratio.alias("ratio"))
    return kept.where(F.abs("ratio") >= min_ratio).toArrow()


def _regress(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, penalty: float, rounds: int):
    """Weights and intercept of a logistic regression; accelerated descent on sparse rows."""
    columns = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = ratios[columns]
    # The largest curvature is at most a quarter of the largest squared row.
    squares = np.bincount(owner, x * x, minlength=len(rows))
    weights, intercept = np.zeros(len(ratios)), 0.0
    ahead, ahead_0, pace = weights.copy(), 0.0, 1.0
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    rate = 1 / (0.25 * (squares.mean() * 4 + 1) + penalty)
    for _ in range(rounds):
        margin = np.bincount(owner, x * ahead[columns], minlength=len(rows)) + ahead_0
        miss = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * share
        slope = np.bincount(columns, x * miss[owner], minlength=len(ratios)) + penalty * ahead
        new, new_0 = ahead - rate * slope, ahead_0 - 4 * rate * miss.sum()
        step = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, ahead_0 = new + (pace - 1) / step * (new - weights), new_0 + (pace - 1) / step * (new_0 - intercept)
        weights, intercept, pace = new, new_0, step
    return weights, intercept


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    min_docs: int = MIN_DOCS,
    min_ratio: float = MIN_RATIO,
    penalty: float = PENALTY,
    parts: int = 3,
    held_out: int = 1,
) -> ToxicityModel:
    ship(docs.sparkSession)
    sample = written(labelled_sample(docs, labels, sample_rows, parts, held_out), "toxicity-sample")
    totals = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = np.zeros(0)
    if not totals[0] or not totals[1]:
        share = totals[1] / max(1, sum(totals.values()))
        return ToxicityModel(none.astype(np.uint64), none, math.log((share + 1e-9) / (1 - share + 1e-9)))
    counts = sample.mapInArrow(_hashed, "hash long, toxic int, n long")
    chosen = _ratios(counts, totals, min_docs, min_ratio)
    order = np.argsort(hashes := chosen["hash"].to_numpy().view(np.uint64))
    bare = ToxicityModel(hashes[order], np.zeros(len(hashes)), 0.0)
    ratios = chosen["ratio"].to_numpy()[order]
    shared = sample.sparkSession.sparkContext.broadcast(bare)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array([shared.value.features(t.as_py()) for t in batch.column("text")], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), at], names=["toxic", "at"])
            give_back()

    found = sample.mapInArrow(placed, "toxic int, at array<long>").toArrow()
    rows = [np.asarray(at.as_py(), dtype=np.int64) for at in found["at"]]
    weights, intercept = _regress(rows, found["toxic"].to_numpy().astype(float), ratios, penalty, ROUNDS)
    return ToxicityModel(bare.hashes, weights * ratios, float(intercept))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(row, score) for every row of ``docs``; ``row`` holds all its columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())
            give_back()

    return docs.select(F.struct("*").alias("row"), scored(text_or_empty()).alias("score"))


def clean_rows(docs: DataFrame, labels: DataFrame, reject: float = REJECT, **settings) -> DataFrame:
    """The rows of ``docs`` that score below ``reject``, with their columns."""
    return score(docs, fit(docs, labels, **settings)).where(F.col("score") < reject).select("row.*")
