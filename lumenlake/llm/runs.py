"""Periodic runs of words by maximal-pair enumeration.

A run is a stretch of words with smallest period q, at least ``least_periods``
periods and ``least_length`` words long, that no neighbouring word extends.
With three periods or more, a run from s to e is the pair of equal word
strings at s and s + q of length e - s - q that differ in the words before
and behind: a maximal pair whose length is at least twice its distance.  So
all runs come from listing the maximal pairs under that constraint, and
nothing is extended afterwards.

Texts are taken in slices of bounded size.  Words become numbers; texts in
which no window of words occurs twice have no run (a hash finds those; it can
only let through too many).  The others get a suffix array by prefix
doubling, common prefix lengths from their irreducible values, and the tree of
LCP intervals is walked bottom-up.  An interval holds the places of its word
string in text order, each in the class of the word to its left; while all
are of one class, children are united without a search.  Otherwise pairs are
formed across children and across classes only.  Places of a string that lie
at most half its length apart form one arithmetic progression, and all but the
first of it have the same word to the left, so a pair that meets the
constraint at the smallest period is a pair of neighbours; children are united
small to large.  Larger multiples of a period span the same stretch and
the least period of each stretch is kept.

Defined results: words are what ASCII blanks separate; null, empty and blank
texts have no words and no runs; texts are read whole, one longer than a
slice by itself; repeated rows have the same runs; extra columns travel in
``row``.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import ship, slices, text_or_empty

LEAST_LENGTH = 24
LEAST_PERIODS = 3
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def _window(least_length: int, least_periods: int) -> int:
    """Length that the pair of any run has at least: length - period, where period <= length / periods."""
    return least_length - least_length // least_periods


def _repeating_texts(codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the texts in which some window of words may occur twice."""
    if len(codes) < window:
        return np.empty(0, dtype=np.int64)
    words = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    words ^= words >> np.uint64(29)
    # Windows of 1, 2, 4, ... words, added up to the wanted length.
    power, size, at = words, 1, 0
    whole = np.zeros(len(words), dtype=np.uint64)
    factor = np.array([0xD1342543DE82EF95], dtype=np.uint64)
    while True:
        if window & size:
            part = np.zeros(len(words), dtype=np.uint64)
            part[: len(words) - at] = power[at:] if at else power
            whole = whole * factor + part
            at += size
        if 2 * size > window:
            break
        doubled = power * factor
        doubled[: len(words) - size] += power[size:]
        power, factor, size = doubled, factor * factor, 2 * size
    inside = np.flatnonzero(np.arange(len(codes)) + window <= ends[text_of])
    keys = whole[inside] ^ (text_of[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(keys)
    equal = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    return np.unique(text_of[inside[order[equal]]])


def _ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair as the number of lesser pairs, and whether it occurs once."""
    keys = first * (int(second.max()) + 1) + second
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    least = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    single = fresh & np.concatenate([fresh[1:], [True]])
    ranks, once = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=bool)
    ranks[order], once[order] = least, single
    return ranks, once


def _suffix_order(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose window occurs again, in suffix order, and the rank that tells their windows apart.

    Every text in ``words`` ends in a word of its own, so no string is shared
    by two texts or reaches beyond one.
    """
    n = len(words)
    ranks, size = words, 1
    while 2 * size <= window:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - size] = ranks[size:]
        ranks, once = _ranked(ranks, behind)
        size *= 2
    open_ = np.flatnonzero(~once)
    places, windows = open_, ranks.copy()
    while len(open_):
        behind = ranks[open_ + size]
        keys = ranks[open_] * n + behind
        order = np.argsort(keys, kind="stable")
        open_, keys = open_[order], keys[order]
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        old = keys // n
        group = np.concatenate([[True], old[1:] != old[:-1]])
        here = np.arange(len(keys))
        least = np.maximum.accumulate(np.where(fresh, here, 0))
        ranks[open_] = old + least - np.maximum.accumulate(np.where(group, here, 0))
        open_ = open_[~(fresh & np.concatenate([fresh[1:], [True]]))]
        size *= 2
    return places[np.argsort(ranks[places])], windows


def _common_length(words: np.ndarray, a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """Number of equal words from each a and b on; ``known`` are equal for certain."""
    length = np.full(len(a), known, dtype=np.int64)
    todo, block = np.arange(len(a)), 16
    while len(todo) and block <= 256:
        steps = np.arange(block)
        left, right = a[todo] + length[todo], b[todo] + length[todo]
        last = len(words) - 1  # words end differently, so what lies beyond is not looked at
        same = words[np.minimum(left[:, None] + steps, last)] == words[np.minimum(right[:, None] + steps, last)]
        whole = same.all(axis=1)
        length[todo] += np.where(whole, block, same.argmin(axis=1))
        todo, block = todo[whole], 2 * block
    for k in todo.tolist():
        i, j, size = int(a[k] + length[k]), int(b[k] + length[k]), 4096
        while True:
            x, y = words[i : i + size], words[j : j + size]
            m = min(len(x), len(y))
            differ = x[:m] != y[:m]
            at = int(differ.argmax())
            if differ[at]:
                length[k] = i + at - int(a[k])
                break
            i, j, size = i + m, j + m, 2 * size
    return length


def _lcp(words: np.ndarray, order: np.ndarray, windows: np.ndarray, known: int) -> np.ndarray:
    """Common prefix of each place with the one before it in ``order``; 0 where the windows differ.

    Computed for pairs with different words to the left; the others follow
    from the place before in the text, one less each step.
    """
    before = np.full(len(words), -1, dtype=np.int64)
    alike = windows[order[1:]] == windows[order[:-1]]
    before[order[1:][alike]] = order[:-1][alike]
    places = np.flatnonzero(before >= 0)
    source = places[words[places - 1] != words[before[places] - 1]]
    length = np.zeros(len(words), dtype=np.int64)
    length[source] = _common_length(words, source, before[source], known)
    origin = np.zeros(len(words), dtype=np.int64)
    origin[source] = source
    origin = np.maximum.accumulate(origin)
    length[places] = length[origin[places]] - (places - origin[places])
    found = np.zeros(len(order), dtype=np.int64)
    found[1:][alike] = length[order[1:][alike]]
    return found


class _Pairs:
    """Maximal pairs whose distance meets the constraints, found while intervals are united."""

    def __init__(self, words: np.ndarray, least_length: int, least_periods: int):
        self.left = memoryview(np.ascontiguousarray(words))
        self.least_length = least_length
        self.factor = least_periods - 1
        self.found: dict[tuple[int, int], int] = {}

    def _offer(self, i: int, j: int, length: int) -> None:
        distance = j - i
        if distance * self.factor <= length and length + distance >= self.least_length and self.left[i - 1] != self.left[j - 1]:
            stretch = (i, j + length)
            if distance < self.found.get(stretch, distance + 1):
                self.found[stretch] = distance

    def unite(self, a: tuple[list[int], int], b: tuple[list[int], int], length: int) -> tuple[list[int], int]:
        """Two children of an interval: places in text order and their left-word class, -1 for several."""
        (many, one), (few, other) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
        if one < 0 or other < 0 or one != other:
            for place in few:
                at = bisect_left(many, place)
                if at:
                    self._offer(many[at - 1], place, length)
                if at < len(many):
                    self._offer(place, many[at], length)
            one = -1
        if len(few) == 1:
            insort(many, few[0])
        else:
            many += few
            many.sort()
        return many, one

    def walk(self, order: list[int], lcp: list[int]) -> dict[tuple[int, int], int]:
        """Intervals bottom-up: those open on the stack have ever longer prefixes."""
        stack: list[list] = []
        for place, following in zip(order, [*lcp[1:], 0], strict=True):
            here = ([place], self.left[place - 1])
            while stack and stack[-1][0] > following:
                length, kept = stack.pop()
                here = self.unite(kept, here, length)
            if not following:
                continue
            if stack and stack[-1][0] == following:
                stack[-1][1] = self.unite(stack[-1][1], here, following)
            else:
                stack.append([following, here])
        return self.found


def runs_of(
    codes: np.ndarray, ends: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> dict[int, list[Run]]:
    """Runs by text number; text t has the word numbers up to ``ends[t]``."""
    if least_periods < 3:
        raise ValueError("with fewer than three periods a run is not always a pair of neighbours")
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    text_of = np.repeat(np.arange(len(ends)), ends - starts)
    window = _window(least_length, least_periods)
    chosen = _repeating_texts(codes, text_of, ends, window)
    if not len(chosen):
        return {}
    sizes = (ends - starts)[chosen]
    n_codes = int(codes.max()) + 1
    # A word of one text equals none of another; each text ends in a word of its own, and one stands before all.
    words = np.empty(int(sizes.sum()) + len(chosen) + 1, dtype=np.int64)
    words[0] = len(chosen) * n_codes + len(chosen)
    first, owner = [], []
    at = 1
    for k, text in enumerate(chosen.tolist()):
        size = int(sizes[k])
        words[at : at + size] = codes[starts[text] : starts[text] + size] + k * n_codes
        words[at + size] = len(chosen) * n_codes + k
        first.append(at)
        at += size + 1
    doubled = 1 << (window.bit_length() - 1)
    order, windows = _suffix_order(words, doubled)
    if not len(order):
        return {}
    lcp = _lcp(words, order, windows, doubled)
    stretches = _Pairs(words, least_length, least_periods).walk(order.tolist(), lcp.tolist())
    found: dict[int, list[Run]] = {}
    for (start, end), period in sorted(stretches.items()):
        k = int(np.searchsorted(first, start, side="right")) - 1
        found.setdefault(int(chosen[k]), []).append((start - first[k], end - start, period))
    return found


def strongest(runs: list[Run]) -> Run | None:
    """The greatest length in periods, compared exactly; ties by start, then period."""
    best = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _dropped(runs: list[Run], size: int) -> np.ndarray:
    """Words that some run holds beyond its first period."""
    steps = np.zeros(size + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SHAPE = "struct<start: bigint, length: bigint, period: bigint>"


def _slice(texts: pa.Array, least_length: int, least_periods: int) -> pa.StructArray:
    split = pc.ascii_split_whitespace(texts)
    flat, edges = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    filled = pc.not_equal(pc.binary_length(flat), 0)
    counted = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    flat, ends = flat.filter(filled), counted[edges[1:]]
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    found = runs_of(codes, ends, least_length, least_periods) if len(codes) else {}
    kept = np.ones(len(codes), dtype=bool)
    starts = counted[edges[:-1]]
    for text, runs in found.items():
        kept[starts[text] : ends[text]] = ~_dropped(runs, int(ends[text] - starts[text]))
    left = np.concatenate([[0], np.cumsum(kept)])
    offsets = pa.array(left[np.concatenate([[0], ends])].astype(np.int32))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(pa.array(kept))), " ")
    listed = [found.get(text, []) for text in range(len(texts))]
    tops = [strongest(runs) for runs in listed]
    as_dict = lambda run: run and dict(zip(("start", "length", "period"), run, strict=True))
    return pa.StructArray.from_arrays(
        [
            pa.array(ends - starts, pa.int64()),
            pa.array([[as_dict(r) for r in runs] for runs in listed], pa.list_(_RUN)),
            pa.array([as_dict(r) for r in tops], _RUN),
            collapsed,
        ],
        names=["n_words", "runs", "strongest", "collapsed"],
    )


def find_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(row, n_words, runs, strongest, collapsed) for every row of ``docs``.

    ``runs`` are (start, length, period) in words, by start and period;
    ``strongest`` is null without any; ``collapsed`` has the words that no run
    holds beyond its first period, one space apart.
    """
    ship(docs.sparkSession)

    @F.arrow_udf(f"n_words bigint, runs array<{_SHAPE}>, strongest {_SHAPE}, collapsed string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [_slice(part, least_length, least_periods) for part in slices(texts)]
            yield pa.concat_arrays(parts) if parts else _slice(texts, least_length, least_periods)

    rows = docs.select(F.struct("*").alias("row"), found(text_or_empty()).alias("found"))
    return rows.select("row", "found.n_words", "found.runs", "found.strongest", "found.collapsed")
