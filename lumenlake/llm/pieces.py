"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of the vocabulary crosses from a letter to a whitespace mark, a
text falls into marked words that are segmented independently.  Texts are taken
in slices of bounded size; all marked words of a slice are dictionary-encoded,
each distinct one is segmented and decoded once, and ids and strings are
joined back by position.  The table of a slice is dropped with it, so it is
bounded by the slice and nothing is shuffled.

The vocabulary is checked first: a model with pieces that cross, or one that
changes text before segmenting beyond the leading mark, is refused.

Defined results: null counts as empty, and an empty text is the end id alone;
texts are encoded whole, a word of any length included; repeated rows are
encoded alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import give_back, ship, slices, text_or_empty

MARK = "▁"
SLICE_BYTES = 1 << 21
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_PROBE = f" a  b\t ﬁ　\n c{MARK}d "


@lru_cache(maxsize=2)
def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    """The processor of a model that chunks cannot change."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = map(processor.id_to_piece, range(processor.vocab_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece crosses a whitespace mark: words cannot be segmented apart")
    if processor.normalize(_PROBE) != MARK + _PROBE.replace(" ", MARK):
        raise ValueError("the model changes text before segmenting it: words cannot be segmented apart")
    return processor


def chunks(text: str) -> list[str]:
    """Marked words of any text, each without its first mark."""
    return [c[1:] for c in _CHUNK.findall(MARK + text.replace(" ", MARK))] if text else []


def _cut(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
    """Chunks of all texts, and the place of each text in that order.

    Where single spaces alone make the marks, a chunk is what they separate.
    """
    marked = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
    odd = pc.or_(marked, pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")))
    others = pa.array([chunks(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string()))
    found = pa.concat_arrays([pc.split_pattern(texts.filter(pc.invert(odd)), " "), others])
    is_odd = odd.to_numpy(zero_copy_only=False)
    return found, np.argsort(np.concatenate([np.flatnonzero(~is_odd), np.flatnonzero(is_odd)]))


def encode_slice(processor: sentencepiece.SentencePieceProcessor, texts: pa.Array) -> pa.StructArray:
    """(ids, decoded) of each text, with the end id."""
    lists, order = _cut(texts)
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_pylist()
    found = processor.encode(distinct, add_bos=False, add_eos=False, num_threads=1)
    alone = [processor.piece_to_id(MARK)]  # an empty chunk is a mark without a word
    found = [ids if word else alone for word, ids in zip(distinct, found, strict=True)]
    decoded = pa.array(processor.decode(found, num_threads=1) if found else [], pa.string())
    # The end id is one more entry of the table, behind the last chunk of every text.
    sizes = np.fromiter(chain(map(len, found), [1]), dtype=np.int64, count=len(found) + 1)
    flat = np.fromiter(chain(chain.from_iterable(found), [processor.eos_id()]), dtype=np.int32, count=int(sizes.sum()))
    table = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(flat))
    places = words.indices.to_numpy().astype(np.int64)
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends = ends[1:] - ends[0]
    entries = np.insert(places, ends, len(found))
    upto = np.concatenate([[0], np.cumsum(sizes[entries])])[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
    ids = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), table.take(pa.array(entries)).flatten())
    strings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), decoded.take(pa.array(places)))
    columns = [ids, pc.binary_join(strings, " ")]
    return pa.StructArray.from_arrays([c.take(pa.array(order)) for c in columns], names=["ids", "decoded"])


def encode(docs: DataFrame, model_path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(row, ids, decoded) for every row of ``docs``: all ids with the end id, and what they decode to."""
    ship(docs.sparkSession)
    model = Path(model_path).read_bytes()
    load(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one fixed file

    @F.arrow_udf("ids array<int>, decoded string")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = load(shared.value)
        for batch in batches:
            parts = [encode_slice(processor, part) for part in slices(batch, slice_bytes)]
            yield pa.concat_arrays(parts) if parts else encode_slice(processor, batch)
            del parts
            give_back()

    found = docs.select(F.struct("*").alias("row"), coded(text_or_empty()).alias("coded"))
    return found.select("row", "coded.ids", "coded.decoded")
