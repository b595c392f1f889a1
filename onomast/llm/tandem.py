"""Periodic runs of words: maximal stretches that repeat one block of words, found with an enhanced suffix array.

Words become numbers and the suffixes of a batch of texts are sorted by doubling. For each interval of suffixes with a common
prefix (an LCP interval; its length is the depth), the suffixes of all but its largest child look up whether the suffix
a depth further on, or back, lies in the same interval but in another child: then a square, a block twice in a row, starts
there that no next word continues. Each run ends in one such square. Squares are rotated to the left as far as they go
and merged into runs. No tree is built: intervals are limits in the array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

#: Words worked on at a time, in whole texts; a longer text is worked on alone.
TOGETHER = 1 << 18
#: Suffixes that look up their neighbours at a time.
LOOKUPS = 1 << 20
RESULT = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "run_start array<long>, run_length array<long>, run_period array<long>, runs_sha256 string, collapsed_sha256 string"
)


def suffix_ranks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, its inverse, and for each k the ranks by the first 2^k codes; a rank is the place of the first suffix that has it.

    Suffixes told apart are left alone by later rounds. The last code must stand nowhere else.
    """
    size = len(codes)
    array = np.argsort(codes)
    new = np.concatenate([[True], codes[array[1:]] != codes[array[:-1]]])
    places = np.arange(size)
    rank = np.empty(size, np.int64)
    rank[array] = np.maximum.accumulate(np.where(new, places, 0))
    levels, width = [rank.astype(np.int32)], 1
    while True:
        # Places whose group has more than one suffix.
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, size))
        open_ = np.repeat(sizes > 1, sizes)
        if not open_.any():
            break
        at = places[open_]
        suffixes = array[at]
        own, after = rank[suffixes], rank[np.minimum(suffixes + width, size - 1)]
        order = np.argsort(own * size + after)
        suffixes, own, after = suffixes[order], own[order], after[order]
        array[at] = suffixes
        new[at] = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        rank[suffixes] = np.maximum.accumulate(np.where(new[at], at, 0))
        levels.append(rank.astype(np.int32))
        width *= 2
    return array, rank, levels


def common_prefix(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Codes that pairs of different suffixes have in common, from the ranks of each level."""
    size, found = len(levels[0]), np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + found, right + found
        inside = (a < size) & (b < size)
        found += np.where(inside & (levels[k][np.minimum(a, size - 1)] == levels[k][np.minimum(b, size - 1)]), 1 << k, 0)
    return found


def common_suffix(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Codes that stand alike before pairs of places, backwards from each."""
    found = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left - found - (1 << k), right - found - (1 << k)
        inside = (a >= 0) & (b >= 0)
        found += np.where(inside & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)]), 1 << k, 0)
    return found


def nearest_smaller(values: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place with a value above 0 the last place before it with a smaller value (or an equal one); the first value is -1."""
    found = np.arange(len(values)) - 1
    found[0] = 0
    active = np.flatnonzero(values > 0)
    while len(active):
        here, there = values[active], values[found[active]]
        active = active[(there > here) if or_equal else (there >= here)]
        found[active] = found[found[active]]
    return found


def branching_squares(array: np.ndarray, inverse: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of the squares that lie in different children of an LCP interval; lcp[i] belongs to places i - 1 and i.

    ``lcp`` starts with -1 and ends with a -1 behind the last place.
    """
    size = len(array)
    before, same = nearest_smaller(lcp, False), nearest_smaller(lcp, True)
    after = len(lcp) - 1 - nearest_smaller(lcp[::-1], False)[::-1]
    limits = np.flatnonzero(lcp[:-1] > 0)
    if not len(limits):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # An interval holds places before[k] to after[k] - 1 for each limit k of its depth; the children end at these limits.
    last = np.ones(len(lcp), bool)
    inner = limits[lcp[same[limits]] == lcp[limits]]
    last[same[inner]] = False
    last = limits[last[limits]]
    low, high = np.concatenate([same[limits], last]), np.concatenate([limits, after[last]])
    of = np.concatenate([limits, last])
    interval, end, depth = before[of], after[of], lcp[of]
    # Children by interval, the largest of each first, which is left out.
    order = np.lexsort((low - high, depth, interval))
    low, high, interval, end, depth = low[order], high[order], interval[order], end[order], depth[order]
    small = np.concatenate([[False], (interval[1:] == interval[:-1]) & (depth[1:] == depth[:-1])])
    low, high, interval, end, depth = low[small], high[small], interval[small], end[small], depth[small]

    starts, depths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends = np.cumsum(high - low)
    cuts = np.searchsorted(ends, np.arange(LOOKUPS, ends[-1], LOOKUPS)) + 1 if len(ends) else []
    cuts = np.unique([0, *cuts, len(low)])
    for a, b in zip(cuts[:-1], cuts[1:]):
        sizes = high[a:b] - low[a:b]
        child = np.repeat(np.arange(a, b), sizes)
        suffix = array[np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[child]]
        for step, first in ((depth[child], suffix), (-depth[child], suffix - depth[child])):
            other = suffix + step
            place = inverse[np.clip(other, 0, size - 1)]
            met = (other >= 0) & (other < size) & (place >= interval[child]) & (place < end[child])
            met &= (place < low[child]) | (place >= high[child])
            starts.append(first[met])
            depths.append(depth[child][met])
    return np.concatenate(starts), np.concatenate(depths)


def runs_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal stretches of at least two periods, by start, then period; periods are the smallest.

    ``codes`` may be several texts, each of which ends with a code that stands nowhere else.
    """
    nothing = np.empty(0, np.int64)
    if len(codes) < 2:
        return nothing, nothing, nothing
    array, inverse, levels = suffix_ranks(codes)
    lcp = np.full(len(array) + 1, -1, np.int64)
    lcp[1:-1] = common_prefix(levels, array[:-1], array[1:])
    start, period = branching_squares(array, inverse, lcp)
    # Squares with the same start and period were met from both sides; rotated to the left, they are runs.
    low = start - common_suffix(levels, start, start + period)
    high = start + 2 * period
    order = np.lexsort((period, high, low))
    low, high, period = low[order], high[order], period[order]
    # A multiple of a run's period gives the same stretch.
    first = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])[: len(low)]
    low, high, period = low[first], high[first], period[first]
    order = np.lexsort((period, low))
    return low[order], (high - low)[order], period[order]


def plant(words: list[bytes], number: int | None) -> list[bytes]:
    """The words with the repeats that a document's number asks for: one in ten repeats a block of its words up to the end."""
    size = len(words)
    if number is None or number % 10 or not size:
        return words
    turn = number // 10
    begin = turn % size
    block = 1 + (size - begin) // (3 + turn % 8)
    return words[:begin] + [words[begin + i % block] for i in range(size - begin)]


def texts_runs(texts: list[list[bytes]], least: int, periods: int) -> list[tuple]:
    """The result's fields for some texts as lists of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    numbers, known = pd.factorize(np.array(flat, dtype=object)) if flat else (np.empty(0, np.int64), [])
    # Texts end to end, each with an end of its own; the same word of two texts is two codes.
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    codes = np.empty(offsets[-1], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    codes[np.arange(len(flat)) + owner] = owner * (len(known) + 1) + numbers
    codes[offsets[1:] - 1] = np.arange(len(texts)) * (len(known) + 1) + len(known)
    start, length, period = runs_of(codes)
    kept = length >= np.maximum(least, periods * period)
    start, length, period = start[kept], length[kept], period[kept]
    limits = np.searchsorted(start, offsets)

    # Words after the first period of a run, by a running sum of begins and ends.
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    stays = np.cumsum(change) == 0
    out = []
    for i, words in enumerate(texts):
        a, b = limits[i], limits[i + 1]
        s, n, q = (start[a:b] - offsets[i]).tolist(), length[a:b].tolist(), period[a:b].tolist()
        left = words if a == b else [w for w, stay in zip(words, stays[offsets[i] : offsets[i] + len(words)].tolist()) if stay]
        listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s, n, q))
        best = min(range(b - a), key=lambda k: (-n[k], s[k], q[k]), default=None)
        top = (None,) * 4 if best is None else (s[best], n[best], q[best], 1000 * n[best] // q[best])
        digests = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(left))]
        out.append((len(words), b - a, *top, s, n, q, *digests))
    return out


def runs_column(text: Column, number: Column | None = None, least: int = 6, periods: int = 4) -> Column:
    """Struct of the periodic runs of a text's words (``RESULT``).

    A run repeats its ``period`` words at least ``periods`` times, has ``least`` words or more and is continued by no
    neighbouring word. ``start``, ``length``, ``period`` and ``exponent_milli`` describe the longest run (ties: smallest start,
    then period), null without one; ``run_…`` list all by start, then period. ``collapsed_sha256`` is that of the words outside
    the repeats, joined by blanks: of each run, its first period stays. A null or blank text has no words and no runs.
    With ``number``, texts whose number is a multiple of ten first have repeats planted (``plant``); a null number plants none.
    Equal rows have equal results. Work is n log n in the words of a text, which a task holds together with some 20 numbers a word.
    """

    @F.pandas_udf(RESULT)
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RESULT.split(", ")]
        for batch in batches:
            rows, some, held = [], [], 0
            for body, planted in zip(batch["text"], batch["number"]):
                some.append(plant((body or "").encode("utf-8").split(), None if pd.isna(planted) else int(planted)))
                held += len(some[-1]) + 1
                if held >= TOGETHER:
                    rows += texts_runs(some, least, periods)
                    some, held = [], 0
            rows += texts_runs(some, least, periods) if some else []
            yield pd.DataFrame({name: pd.Series([r[k] for r in rows], dtype=object) for k, name in enumerate(names)})

    number = F.lit(None) if number is None else number
    return find(F.struct(text.alias("text"), number.cast("bigint").alias("number")))
