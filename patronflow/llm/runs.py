"""Operator 12: periodic runs of words, by an enhanced suffix array.

A run is a stretch of words of smallest period q that no neighbouring word
extends. Its last square (two equal halves of q words) is *branching*: the word
after it breaks the period. Such a square joins two suffixes q words apart whose
common prefix is q words long exactly, that is two children of one interval of
the suffix array with LCP q. So for each LCP interval the suffixes of all
children but the largest are tested: is the suffix q words ahead, or behind, in
the interval too (its place in the suffix array, ISA, is between the interval's
ends) but in another child? That is O(n log n) tests over plain arrays; no tree is
built. Each square found is then rotated to the left as far as the words allow,
which gives the run, and squares of one stretch are merged under their smallest
period.

Many texts are handled at once: the text's number is the first sort key, so
suffixes of different texts never share an interval. Words are compared by
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_texts

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BATCH = 1 << 20


def _heads(change: np.ndarray) -> np.ndarray:
    """Index of the first entry of each entry's group."""
    return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))


def suffix_array(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling, and the ranks after each doubling:
    entry l tells which places start with the same 2**l words of one text. One
    entry more than there are words is kept as a sentinel. Each doubling sorts only
    the places that are not yet told apart."""
    n = len(values)
    sa = np.lexsort((values, doc))
    change = np.ones(n, bool)
    change[1:] = (values[sa[1:]] != values[sa[:-1]]) | (doc[sa[1:]] != doc[sa[:-1]])
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = _heads(change)
    levels, step = [rank], 1
    last = np.searchsorted(doc, doc, "right")
    while True:
        alone = change & np.append(change[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            return sa, levels
        place = sa[at]
        after = np.where(place + step < last[place], rank[np.minimum(place + step, n)], -1)
        key = rank[place] * (n + 2) + after + 1
        order = np.argsort(key)
        place, key = place[order], key[order]
        sa[at] = place
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        change[at] = new
        rank = rank.copy()
        rank[place] = at[_heads(new)]
        levels.append(rank)
        step *= 2


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the suffix array."""
    out = np.zeros(len(sa), np.int64)
    pair = 1 + np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    a, b = sa[pair - 1], sa[pair]
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        a, b = a + (same << k), b + (same << k)
    out[pair] = b - sa[pair]
    return out


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry with a shared prefix: its index, and the first and last place
    of the widest interval in which no prefix is shorter."""
    n, at = len(lcp), np.flatnonzero(lcp)
    if not len(at):
        return at, at, at
    zeros = np.flatnonzero(np.append(lcp, 0) == 0)
    table = [lcp]
    while 2 << (len(table) - 1) <= np.diff(zeros).max():
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    depth, low, high = lcp[at], at.copy(), at + 1
    for k in range(len(table) - 1, -1, -1):
        low_ = np.maximum(low - (1 << k), 0)
        low -= (table[k][low_] >= depth) << k       # lcp[0] = 0 stops at the left end
        inside = high + (1 << k) <= n
        high += (inside & (table[k][np.where(inside, high, 0)] >= depth)) << k
    return at, low - 1, high - 1


def branching_squares(sa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that the next word does not continue."""
    at, low, high = intervals(lcp)
    if not len(at):
        return at, at
    n = len(sa)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    order = np.lexsort((at, high, low))
    at, low, high = at[order], low[order], high[order]
    first = np.ones(len(at), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    group = np.cumsum(first) - 1
    # children of an interval: from its start to the first cut, then from cut to cut
    begin = np.concatenate([low[first], at])
    end = np.concatenate([at[first], np.where(np.append(first[1:], True), high + 1, np.append(at[1:], 0))])
    owner = np.concatenate([group[first], group])
    order = np.lexsort((begin - end, owner))           # the largest child comes first
    begin, end, owner = begin[order], end[order], owner[order]
    small = np.append(False, owner[1:] == owner[:-1])
    begin, end, owner = begin[small], end[small], owner[small]
    size = end - begin
    child = np.repeat(np.arange(len(size)), size)
    place = sa[np.arange(len(child)) + (begin - (np.cumsum(size) - size))[child]]
    low, high, depth = (x[first][owner][child] for x in (low, high, lcp[at]))
    begin, end = begin[child], end[child]
    starts, periods = [], []
    for other, start in ((place + depth, place), (place - depth, place - depth)):
        there = isa[np.clip(other, 0, n - 1)]
        hit = ((other >= 0) & (other < n) & (there >= low) & (there <= high)
               & ((there < begin) | (there >= end)))
        starts.append(start[hit])
        periods.append(depth[hit])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(values: np.ndarray, doc: np.ndarray, least: int, repeats: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs with length >= max(least, repeats * period),
    by start and period."""
    if not len(values):
        return (np.zeros(0, np.int64),) * 3
    sa, levels = suffix_array(values, doc)
    start, period = branching_squares(sa, common_prefixes(sa, levels))
    end = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        turned = np.maximum(start - (1 << k), 0)
        same = (start >= 1 << k) & (levels[k][turned] == levels[k][turned + period])
        start = np.where(same, turned, start)
    long = end - start >= np.maximum(least, repeats * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _kept_text(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    which = np.flatnonzero(kept)
    doc = words.doc()[which]
    gap = np.zeros(len(which), np.int64)
    gap[1:] = doc[1:] == doc[:-1]
    size = words.length[which] + gap
    ends = np.cumsum(size)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.start[which] - gap - ends + size, size)
    out = words.data[source] if len(source) else np.zeros(0, np.uint8)
    out[(ends - size)[gap == 1]] = 32
    cuts = np.append(0, ends)[np.searchsorted(doc, np.arange(len(words.first)))]
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64).tobytes()),
                                            pa.py_buffer(out.tobytes())).cast(pa.string())


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6,
                  repeats: int = 4) -> DataFrame:
    """Runs of each text, and the text without their repetitions: ``doc_id, runs,
    collapsed``.

    ``runs`` (start and length in words, smallest period) holds the runs with
    length >= max(least, repeats * period), by start and period; ``repeats`` is 2
    at least. ``collapsed`` is the words, joined by one space, without those that
    some run contains after its first period.

    * NULL, empty or blank text: no runs, empty ``collapsed``.
    * Repeated rows are handled one by one; other columns are ignored. Empty
      table: no rows.
    * Every text is one piece of work of O(n log n) time and memory (about 200
      bytes a word); texts are handled about 1 MB at a time.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period twice at least")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch["text"], lower=False)
        doc = words.doc()
        start, length, period = find_runs(words.hash, doc, least, repeats)
        edge = np.zeros(len(doc) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        kept = np.cumsum(edge)[:-1] == 0
        owner = doc[start]
        cuts = np.searchsorted(owner, np.arange(len(words.first))).astype(np.int32)
        rows = pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start - words.first[owner], length, period)],
            ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.ListArray.from_arrays(cuts, rows), _kept_text(words, kept)],
            ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {kind}, runs {RUNS}, collapsed string", run, _BATCH)
