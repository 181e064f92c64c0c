"""Token counts under a byte-level BPE vocabulary, huge texts in overlapping chunks.

Texts of up to ``chunk`` characters are encoded as they are.  A longer one is
cut into chunks, each of which repeats the last ``overlap`` characters of the
chunk before it; chunks are dealt out over the cluster and encoded with the
byte offsets of their tokens.  Neighbours are spliced at the first place of
their overlap where both have a token start and where one is proven to be
stable; the count of the text is what the chunks hold between splices.  Texts
with an overlap that has no such place are encoded again with wider overlaps
and longer chunks, until the text is a single chunk.

Stable places: every alternative of the splitting pattern takes characters of
one class (letters, numbers, blanks, others), save for one leading space and
for an apostrophe before letters.  So between a character that is neither
blank nor an apostrophe and one of another class a word ends and the next
begins, whatever stands around them, and no token crosses from word to word.
Special strings are found before the pattern applies: places nearer to the
border of the overlap than the longest of them, or inside one, are left out.

The vocabulary is read from a ``tokenizers`` file, which is refused unless it
is plain byte-level BPE with that pattern; special strings inside texts become
their ids, as that library does by default.

Defined results: null counts as empty, and an empty text has no tokens; texts
are counted whole, a word of any length included; repeated rows count alike;
extra columns travel in ``row``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from lumenlake.llm.common import ship, text_or_empty, written

CHUNK = 1 << 15
OVERLAP = 256
WIDEN = 4
# The splitting pattern of byte-level BPE, and the bytes that stand for themselves in its vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# A letter before no letter, a number before no number, another character but an apostrophe before a blank, letter or number.
_STABLE = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])")
_PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _byte_of() -> dict[str, int]:
    """Bytes by the character that stands for them: printed ones for themselves, the rest from 256 on."""
    rest = [b for b in range(256) if b not in set(_PRINTED)]
    return {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Encoder of one vocabulary file, with the byte length of each token."""

    def __init__(self, model: bytes):
        told = json.loads(model)
        core, split = told["model"], told.get("pre_tokenizer") or {}
        plain = core.get("type", "BPE") == "BPE" and not any(
            core.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        if not plain or told.get("normalizer") or {k: split.get(k) for k in _PLAIN} != _PLAIN:
            raise ValueError("not a plain byte-level BPE vocabulary: chunks cannot be spliced")
        added = told.get("added_tokens", [])
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special strings that depend on what stands around them are not supported")
        self.special = {t["content"]: t["id"] for t in added}
        if any(a != b and a in b or a[i:] == b[: len(a) - i] for a in self.special for b in self.special for i in range(1, len(a))):
            raise ValueError("special strings that overlap are not supported")
        byte_of, ids = _byte_of(), core["vocab"]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in ids.items() if token not in self.special}
        merges = (m if isinstance(m, list) else m.split(" ") for m in core["merges"])
        order = [ids["".join(pair)] for pair in merges]
        if order != sorted(order):
            raise ValueError("merges are not in the order of their ids")
        name = hashlib.sha256(model).hexdigest()
        self.encoding = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        sizes = {i: len(token) for token, i in ranks.items()} | {i: len(s.encode()) for s, i in self.special.items()}
        self.sizes = np.zeros(max(sizes, default=0) + 1, dtype=np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self.margin = max(map(len, self.special), default=0) + 1
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._model = model

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the pattern's stack is bounded, and so are the blanks in a row that it can take
            return np.array(_library(self._model).encode(text, add_special_tokens=False).ids, dtype=np.int64)

    def stable_places(self, overlap: str) -> np.ndarray:
        """Byte offsets in an overlap at which a word starts whatever stands around it."""
        found = {m.start() for m in _STABLE.finditer(overlap, self.margin, max(self.margin, len(overlap) - self.margin))}
        for m in self._special.finditer(overlap) if self._special else ():
            found.difference_update(range(m.start() + 1, m.end()))
        places = sorted(found)
        sizes = np.cumsum([0, *(len(overlap[a:b].encode()) for a, b in zip([0, *places], places))])
        return sizes[1:].astype(np.int64)

    def chunk(self, text: str, before: int, behind: int) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
        """Tokens of a chunk, and (place, tokens before it) at the stable places of its first and last characters."""
        ids = self.encode(text)
        starts = np.concatenate([[0], np.cumsum(self.sizes[ids])])

        def marks(overlap: str, offset: int) -> list[tuple[int, int]]:
            places = self.stable_places(overlap)
            at = np.searchsorted(starts, places + offset)
            here = starts[np.minimum(at, len(starts) - 1)] == places + offset
            return list(zip(places[here].tolist(), at[here].tolist(), strict=True))

        tail = text[len(text) - behind :] if behind else ""
        return len(ids), marks(text[:before], 0), marks(tail, int(starts[-1]) - len(tail.encode()))


@lru_cache(maxsize=2)
def _library(model: bytes) -> Tokenizer:
    return Tokenizer.from_buffer(model)


@lru_cache(maxsize=4)
def load(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """Chunks of a text, each with the end of the one before."""
    return [text[max(0, at - overlap) : at + chunk] for at in range(0, max(1, len(text)), chunk)]


_MARKS = "array<struct<place: bigint, tokens: bigint>>"
_MARK = pa.list_(pa.struct([("place", pa.int64()), ("tokens", pa.int64())]))


def _spliced(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of texts (key, text); null where some overlap has no common stable place."""

    @F.arrow_udf("array<string>")
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([cut(t.as_py(), chunk, overlap) for t in batch], pa.list_(pa.string()))

    @F.arrow_udf(f"tokens bigint, head {_MARKS}, tail {_MARKS}")
    def coded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        vocabulary = load(shared.value)
        for texts, last in batches:
            found = []
            for text, nothing_behind in zip(texts, last.to_pylist(), strict=True):
                tokens, head, tail = vocabulary.chunk(text.as_py(), overlap, 0 if nothing_behind else overlap)
                as_rows = lambda marks: [{"place": p, "tokens": n} for p, n in marks]
                found.append((tokens, as_rows(head), as_rows(tail)))
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), _MARK, _MARK))]
            yield pa.StructArray.from_arrays(columns, names=["tokens", "head", "tail"])

    cuts = texts.select("key", chunks("text").alias("chunks"))
    cuts = cuts.select("key", F.size("chunks").alias("n"), F.posexplode("chunks").alias("k", "chunk"))
    # One text may be most of the input: its chunks are dealt out one by one.
    dealt = cuts.repartition("key", "k")
    parts = dealt.select("key", "k", "n", coded("chunk", F.col("k") == F.col("n") - 1).alias("c")).select("key", "k", "n", "c.*")
    parts = written(parts, "token-chunks")
    after = parts.select("key", (F.col("k") - 1).alias("k"), F.col("head").alias("next_head"))
    places = F.array_intersect("tail.place", "next_head.place")
    place = F.array_min(places)  # the overlaps of a text do not meet, so any common place will do
    tokens = lambda marks: F.element_at(F.col(marks)["tokens"], F.array_position(F.col(marks)["place"], place).cast("int"))
    joined = parts.join(after, ["key", "k"], "left")
    kept = joined.select(
        "key",
        F.when(F.col("k") == F.col("n") - 1, F.col("tokens"))
        .when(F.size(places) > 0, tokens("tail") - tokens("next_head"))
        .alias("tokens"),
    )
    whole = F.when(F.count("*") == F.count("tokens"), F.sum("tokens"))
    return kept.groupBy("key").agg(whole.alias("n_tokens"))


def count_tokens(docs: DataFrame, model_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, n_bytes, n_tokens) for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    model = Path(model_path).read_bytes()
    if overlap <= 2 * load(model).margin or chunk < overlap:
        raise ValueError("an overlap must be longer than two special strings and no longer than a chunk")
    shared = spark.sparkContext.broadcast(model)  # one fixed file

    @F.arrow_udf("bigint")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = load(shared.value)
        for texts in batches:
            yield pa.array([len(vocabulary.encode(t.as_py())) for t in texts], pa.int64())

    rows = docs.select(F.struct("*").alias("row"), text_or_empty().alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    huge = F.char_length("text") > chunk
    short = rows.where(~huge).select("row", n_bytes, whole("text").alias("n_tokens"))
    # The key is given once, in a written table, as rows have none of their own.
    long = written(rows.where(huge).withColumn("key", F.monotonically_increasing_id()), "huge-texts")
    found, todo = [], long.select("key", "text")
    while not todo.isEmpty():
        counted = written(_spliced(todo, shared, chunk, overlap), "huge-counts")
        found.append(counted.where(F.col("n_tokens").isNotNull()))
        todo = todo.join(counted.where(F.col("n_tokens").isNull()), "key", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    for counted in found:
        short = short.unionByName(long.join(counted, "key").select("row", n_bytes, "n_tokens"))
    return short
