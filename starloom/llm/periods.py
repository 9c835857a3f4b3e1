"""Periodic stretches of words: every run, from Lyndon roots under both word orders.

A run is a stretch of words with smallest period q that repeats at least
``EXPONENT`` times, is at least ``LENGTH`` words long and cannot be extended.
Each run contains a Lyndon word of length q that is the longest one starting
at its place, under one order of the words or its reverse. So per order:

1. Baier's first phase groups the suffixes, highest group first: the suffixes
   of a group pull the nearest lower suffix before them into a new group just
   above its old one. A suffix's last group has its longest Lyndon word as
   context, so the group's width is the Lyndon array, in linear time.
2. Each Lyndon word is a possible root with its length as the period. How far
   the period reaches to both sides are longest common extensions, read from
   names of blocks of 1, 2, 4, … words (equal blocks, equal names).

Four words in a row of a run of this exponent occur twice or more in it, but
for its last three places. So words where no such window repeats lie in no run
and cut a text into stretches; a stretch holds its runs whole. The cut is
exact and leaves little of ordinary prose.

Each text is worked on by itself in one task, nothing is shuffled. The driver
holds nothing. Memory is that of a batch of texts (2 MB, or one longer text),
and about 4 bytes a word and block size.

Defined results: a null or empty text has no words and no runs; repeated rows
are treated each by itself; an empty table gives no rows; other columns stay,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from starloom.llm.common import free_name, frugal, small_batches

EXPONENT = 4
LENGTH = 6
WINDOW = 4
ROUNDS = 3

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


def lyndon_array(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place; the end counts as lowest."""
    n = len(codes)
    ranks = {code: g for g, code in enumerate(sorted(set(codes)))}
    group = [ranks[code] for code in codes]
    members: list[list[int]] = [[] for _ in ranks]
    for i, g in enumerate(group):
        members[g].append(i)
    current = len(ranks) - 1
    width = [1] * len(ranks)  # words of a group's context
    below = list(range(-1, current))  # the next lower group, and the next higher one
    over = list(range(1, current + 2))
    done = [False] * len(ranks)
    before = [-1] * n  # the nearest place to the left in a lower group
    while current >= 0:
        done[current] = True
        pulled: list[tuple[int, int]] = []  # (place, how often the context stands behind it)
        last = -1
        for i in members[current]:
            if group[i] != current:  # has moved up since
                continue
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = before[j]
            before[i] = j
            if j < 0:
                continue
            if j == last:
                pulled[-1] = (j, pulled[-1][1] + 1)
            else:
                pulled.append((j, 1))
                last = j
        own = width[current]
        # More repeats are higher; each new group goes just above its old one.
        for count in sorted({c for _, c in pulled}, reverse=True):
            fresh: dict[int, int] = {}
            for j, c in pulled:
                if c != count:
                    continue
                old = group[j]
                new = fresh.get(old)
                if new is None:
                    new = fresh[old] = len(members)
                    members.append([])
                    width.append(width[old] + count * own)
                    done.append(False)
                    upper = over[old]
                    below.append(old)
                    over.append(upper)
                    below[upper] = over[old] = new
                members[new].append(j)
                group[j] = new
        current = below[current]
    return [width[g] for g in group]


def repeated_windows(codes: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether the window of words at each place occurs twice or more in its part.

    Compared by 64-bit keys: a collision only marks a place too many.
    """
    n = len(codes) - WINDOW + 1
    marked = np.zeros(len(codes), bool)
    if n <= 0:
        return marked
    key = part[:n].astype(np.uint64)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64)
    whole = np.flatnonzero(part[:n] == part[WINDOW - 1 :])
    found = pd.factorize(key[whole])[0]
    marked[whole] = np.bincount(found)[found] > 1 if len(whole) else False
    return marked


def stretches(codes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the stretches that can hold runs; every run lies in one of them."""
    least = LENGTH - WINDOW + 1  # windows of the shortest run
    places, inner = np.arange(len(codes)), part
    start = length = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        marked = np.concatenate(([0], repeated_windows(codes[places], inner), [0])).astype(np.int8)
        # Marks of two parts never touch: the last places of a part start no window.
        edge = np.diff(marked)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = last - first >= least
        first, last = first[long], last[long]
        start, length = places[first], last - first + WINDOW - 1
        places = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
        inner = np.repeat(np.arange(len(start)), length)
    return start, length


def block_names(codes: np.ndarray) -> list[np.ndarray]:
    """Per size 1, 2, 4, … a name for the block at each place; blocks are equal where names are.

    Ends with the largest size that any two places share.
    """
    names, size = [codes.astype(np.int64)], 1
    while len(names[-1]) > size:
        last = names[-1]
        found, distinct = pd.factorize(last[:-size] * (int(last.max()) + 1) + last[size:])
        if len(distinct) == len(found):
            break
        names.append(found.astype(np.int64))
        size *= 2
    return names


def common_extension(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from ``a`` on (``back``: before ``a``) equal those from (before) ``b`` > ``a``."""
    total = np.zeros(len(a), np.int64)
    for level in range(len(names) - 1, -1, -1):
        size, name = 1 << level, names[level]
        x, y = (a - total - size, b - total - size) if back else (a + total, b + total)
        inside = np.flatnonzero((x >= 0) & (y < len(name)))
        equal = inside[name[x[inside]] == name[y[inside]]]
        total[equal] += size
    return total


def find_runs(codes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run of a batch of texts, by start and period.

    ``part`` numbers the text of each word; starts count over the batch.
    """
    start, length = stretches(codes, part)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none, none
    # The stretches end to end, each closed by a word of its own.
    ends = np.cumsum(length + 1)
    offset = ends - length - 1
    line = np.full(ends[-1], -1, np.int64)
    at = np.repeat(offset - (np.cumsum(length) - length), length) + np.arange(length.sum())
    line[at] = codes[np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())]
    line[ends - 1] = codes.max() + 1 + np.arange(len(start))
    names = block_names(line)
    begin, extent, period = [], [], []
    for sign in (1, -1):
        width = np.zeros(len(line), np.int64)
        for o, n in zip(offset.tolist(), length.tolist()):
            width[o : o + n] = lyndon_array((sign * line[o : o + n]).tolist())
        # A run holds its root at least twice more behind the first one.
        root = np.flatnonzero(width)
        root = root[line[root] == line[root + width[root]]]
        q = width[root]
        left = common_extension(names, root, root + q, back=True)
        total = left + q + common_extension(names, root, root + q)
        enough = total >= np.maximum(LENGTH, EXPONENT * q)
        begin.append((root - left)[enough])
        extent.append(total[enough])
        period.append(q[enough])
    begin, extent, period = map(np.concatenate, (begin, extent, period))
    order = np.lexsort((period, begin))
    begin, extent, period = begin[order], extent[order], period[order]
    new = np.ones(len(begin), bool)
    new[1:] = (np.diff(begin) != 0) | (np.diff(period) != 0)
    begin, extent, period = begin[new], extent[new], period[new]
    home = np.searchsorted(offset, begin, side="right") - 1
    return begin - offset[home] + start[home], extent, period


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text among the words of a batch, and the words."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bounds = split.offsets.to_numpy().astype(np.int64)
    values = split.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    real = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    if not real.all():  # white space at either end of a text gives an empty word
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
        values = values.filter(pa.array(real))
    return bounds, values


def collapse(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs, and words kept (joined by blanks) of each text of a batch."""
    bounds, values = _words(texts)
    counts = np.diff(bounds)
    codes = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = find_runs(codes, np.repeat(np.arange(len(counts)), counts))
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    places = np.concatenate(([0], np.cumsum(kept)))[bounds].astype(np.int32)
    left = pa.ListArray.from_arrays(pa.array(places), values.filter(pa.array(kept)))
    home = np.searchsorted(bounds, start, side="right") - 1  # the last text that begins here is the one with words
    fields = {"start": start - bounds[home], "length": length, "period": period}
    each = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, bounds).astype(np.int32)), each)
    return counts, runs, pc.binary_join(left, " ")


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (start, length, period by start and period) and collapsed.

    ``collapsed`` is the text without the words that a run repeats: those after
    its first period. Names that ``docs`` has already get underscores in front.
    """
    schema = StructType([*docs.schema.fields])
    for name, kind in (("n_words", LongType()), ("runs", ArrayType(RUN)), ("collapsed", StringType())):
        schema.add(free_name(docs, name), kind)
    place = [c.lower() for c in docs.columns].index(text.lower())
    docs_text = docs.columns[place]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, docs_text):
            counts, found, collapsed = collapse(batch.column(place))
            yield pa.record_batch([*batch.columns, pa.array(counts), found, collapsed], names=schema.names)

    return docs.mapInArrow(frugal(work), schema)
