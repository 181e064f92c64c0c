"""Language identification by words first, character n-grams where words fail.

A word the model knows scores its relative frequency in each language, as a
negative logarithm; a language that lacks it scores a fixed penalty.  A word
no language knows falls back to its n-grams with the marks of its ends, the
longest length first, and to shorter ones until some n-gram is known; its
score is the mean over those.  A text scores the mean over its words, and the
lowest mean wins; equal means go to the smaller language by code point.

The model is fitted on a bounded sample of labelled rows: ``sample_rows`` whole
texts per language, chosen by the hash of id and text.  Words and n-grams are
counted where the rows are and added up by Spark; those seen ``min_count``
times or more go to the driver and are broadcast, so its size is bounded by
the sample, whatever the input.  Every row is predicted, from its text alone.

Defined results: null text, empty text and text without letters give ``und``
with score 0, as does a model without languages; rows without a language are
not learned from; null ids count as empty text in hashes; repeated rows are
predicted alike.  Texts are read whole; a word of any length costs time in
proportion to its length.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import remainder, seeded_hash, ship, slices, text_or_empty

SAMPLE_ROWS = 1500
MIN_COUNT = 3
LONGEST = 4
UNKNOWN = "und"
SLICE = 1 << 22
_RUN = re.compile(r"[^\W\d_]+")
_BETWEEN = r"[^\p{L}\p{Nl}\p{No}]+"  # the same runs, as what lies between them
_COUNTED = "lang string, size int, gram string, n long"


def words_of(text: str) -> Counter:
    """Lower-cased runs of letters, with their counts."""
    found = Counter(_RUN.findall(text.lower()))
    odd = [w for w in found if not w.isalpha()]
    for w in odd:
        if letters := "".join(filter(str.isalpha, w)):
            found[letters] += found[w]
        del found[w]
    return found


def grams_of(word: str, size: int) -> list[str]:
    marked = f" {word} " if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _count_grams(batches: Iterable[pd.DataFrame], longest: int) -> Iterator[pd.DataFrame]:
    """Counts per batch; size 0 stands for whole words."""
    for batch in batches:
        counts: dict[tuple[str, int], Counter] = defaultdict(Counter)
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            for word, n in words_of(text).items():
                counts[lang, 0][word] += n
                for size in range(1, longest + 1):
                    for gram in grams_of(word, size):
                        counts[lang, size][gram] += n
        rows = [(*key, gram, n) for key, found in counts.items() for gram, n in found.items()]
        yield pd.DataFrame(rows, columns=["lang", "size", "gram", "n"])


@dataclass
class LanguageModel:
    """Per size, each known gram's row in a matrix of scores by language."""

    languages: list[str]
    rows: list[dict[str, int]]
    scores: list[np.ndarray]

    def word_scores(self, word: str) -> np.ndarray | None:
        if (row := self.rows[0].get(word)) is not None:
            return self.scores[0][row]
        for size in range(len(self.rows) - 1, 0, -1):
            known = self.rows[size]
            if found := [known[g] for g in grams_of(word, size) if g in known]:
                return self.scores[size][found].mean(axis=0)
        return None

    def table(self, words: list[str], seen: dict[str, np.ndarray | None]) -> np.ndarray:
        """Scores of distinct words, a row each; nan where no n-gram is known.  ``seen`` keeps those of unknown words."""
        known = self.rows[0]
        found = np.full((len(words), len(self.languages)), np.nan)
        rows = np.fromiter((known.get(word, -1) for word in words), dtype=np.int64, count=len(words))
        found[rows >= 0] = self.scores[0][rows[rows >= 0]]
        for i in np.flatnonzero(rows < 0).tolist():
            word = words[i]
            if word not in seen:
                seen[word] = self.word_scores(word)
            if seen[word] is not None:
                found[i] = seen[word]
        return found

    def predict(self, texts: list[str], seen: dict[str, np.ndarray | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores of some texts: each distinct word is scored once, texts sum the rows of their words."""
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        split = pc.split_pattern_regex(pa.array([t.lower() for t in texts], pa.large_string()), _BETWEEN)
        flat = split.flatten().dictionary_encode()
        ends = split.offsets.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(n), np.diff(ends))
        words = flat.dictionary.to_pylist()
        words = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in words]
        filled = np.fromiter(map(bool, words), dtype=bool, count=len(words))
        scores = self.table(words, seen)
        places = flat.indices.to_numpy()
        has_letters = np.bincount(text, filled[places], minlength=n) > 0
        counted = filled[places] & ~np.isnan(scores[places, 0])
        places, text = places[counted], text[counted]
        n_words = np.bincount(text, minlength=n)
        totals = np.stack([np.bincount(text, scores[places, i], minlength=n) for i in range(len(self.languages))], axis=1)
        mean = totals / np.maximum(n_words, 1)[:, None]
        best = mean.argmin(axis=1)  # all alike, so the first, where the letters were never seen
        share = 1 / np.exp(mean.min(axis=1)[:, None] - mean).sum(axis=1)
        return [self.languages[b] if some else UNKNOWN for b, some in zip(best, has_letters)], np.where(has_letters, share, 0.0)


def labelled_sample(docs: DataFrame, sample_rows: int, parts: int, held_out: int) -> DataFrame:
    """About ``sample_rows`` distinct texts of each language, outside the held-out part.

    The place of a row comes from its id and text, so rows without an id or
    with the same one are chosen apart; of equal rows one stays.
    """
    steps = 16**8
    hashed = seeded_hash("language", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")))
    rows = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), parts) != held_out)
    ).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), hashed.alias("hash"))
    per_language = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    cut = F.lit(0)
    for lang, n in per_language:
        cut = F.when(F.col("lang") == lang, F.lit(math.ceil(steps * min(1.0, sample_rows / n)))).otherwise(cut)
    return rows.where(place < cut).dropDuplicates(["lang", "hash"]).select("lang", "text")


def fit(
    docs: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    parts: int = 4,
    held_out: int = 2,
) -> LanguageModel:
    ship(docs.sparkSession)
    sample = labelled_sample(docs, sample_rows, parts, held_out)
    counted = sample.mapInPandas(lambda batches: _count_grams(batches, longest), _COUNTED)
    counted = counted.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    by_gram = counted.groupBy("size", "gram").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")
    )
    frequent = by_gram.where(F.col("total") >= min_count).select("size", "gram", "by_lang").toPandas()
    return _model(frequent, longest)


def _model(frequent: pd.DataFrame, longest: int) -> LanguageModel:
    frequent = frequent.sort_values(["size", "gram"])
    languages = sorted({lang for found in frequent["by_lang"] for lang in dict(found)})
    column = {lang: i for i, lang in enumerate(languages)}
    rows, scores = [], []
    for size in range(longest + 1):
        part = frequent[frequent["size"] == size]
        counts = np.zeros((len(part), len(languages)))
        for i, found in enumerate(part["by_lang"]):
            for lang, n in dict(found).items():
                counts[i, column[lang]] = n
        totals = np.maximum(counts.sum(axis=0), 1)
        # A missing gram costs more than the rarest one of any language.
        penalty = math.log(totals.max(initial=1)) + 1
        with np.errstate(divide="ignore"):
            table = np.where(counts > 0, -np.log(counts / totals), penalty)
        rows.append({gram: i for i, gram in enumerate(part["gram"])})
        scores.append(table.astype("float32"))
    return LanguageModel(languages, rows, scores)


def predict(docs: DataFrame, model: LanguageModel, seen_words: int = 50_000) -> DataFrame:
    """(row, lang_pred, score) for every row of ``docs``; ``row`` holds all its columns.

    ``seen_words`` bounds the scores a task keeps of unknown words; when it is
    reached they are forgotten and computed anew.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, seen = shared.value, {}
        for batch in batches:
            languages, scores = [], []
            for part in slices(batch, SLICE):
                found, score = model.predict(part.to_pylist(), seen)
                languages += found
                scores.append(score)
                if len(seen) > seen_words:
                    seen.clear()
            scores = np.concatenate([np.zeros(0), *scores])
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    found = docs.select(F.struct("*").alias("row"), predicted(text_or_empty()).alias("found"))
    return found.select("row", "found.lang_pred", "found.score")
