"""Periodic runs: stretches of a text in which the same few words come again and again.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is at
least ``max(6, 4 * q)`` words long and that no neighbouring word extends. They are found by Kruskal's
algorithm over suffixes. Suffixes are sorted, and classes of them are united by decreasing length of
what neighbours in that order have in common (their LCP). A union-find holds the word positions of each class as an
ordered set. When two classes are united at L, positions that become neighbours in the set at a distance d
within L lie in a stretch of period d, and d is its smallest: a smaller one would have put a position
between them before. The stretch ends d + L words after the first of the two; the leftmost pair with the same d
and end is where the run begins. Only pairs with 3 * d <= L can be of a run.

Before that, two plain array steps leave out what cannot matter, and lose nothing: every five words that begin
in a run, but for its last four, come again within q words. So a run lies in one chain of positions whose five words
come again in the same text, and that chain is long against the distance to the next equal five words. Words are compared by
64-bit hashes. Arrow functions see a few megabytes of text at a time, a very long text alone; Spark
shuffles nothing.

A null, empty or blank text has no words and no runs. Runs that overlap are all found. Each row is
handled by itself, so repeated rows, ids and other columns make no difference.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.llm.common import NOT_BLANK, Words, grams, mixed, slices

BATCH_BYTES = 2 << 20
#: A run has at least so many words and, at least so many times, its period.
LEAST, TIMES = 6, 4
_GRAM = LEAST - 1


def _chains(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of the chains of words in which a run may lie."""
    n = len(hashes)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keys = np.flatnonzero(np.arange(n) + _GRAM <= bounds[1:][text]) if n else np.zeros(0, np.int64)
    if not len(keys):
        return keys, keys
    with np.errstate(over="ignore"):
        tagged = mixed(grams(hashes, _GRAM)[keys] + mixed(text[keys].astype(np.uint64)))
    order = np.argsort(tagged, kind="stable")
    same = np.flatnonzero(tagged[order[1:]] == tagged[order[:-1]])
    first, second = keys[order[same]], keys[order[same + 1]]
    repeated = np.zeros(n + 1, bool)
    repeated[first] = repeated[second] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], repeated)).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return begins, ends
    chain = np.searchsorted(begins, first, "right") - 1
    possible = ends[chain] - first >= np.maximum(TIMES * (second - first) - _GRAM + 1, LEAST - _GRAM + 1)
    some = np.unique(chain[possible])
    return begins[some], ends[some] + _GRAM - 2


def _ranks(words: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """For 1, 2, 4, ... words: the rank of what begins at each position; ``left`` words are to the chain's end."""
    n, step = len(words), 1
    levels = [words]
    while True:
        now = levels[-1]
        if step >= int(left.max()) or int(now.max()) + 1 == n:
            return levels
        after = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > step)
        after[inside] = now[inside + step] + 1
        key = now.astype(np.int64) * (n + 1) + after
        levels.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
        step *= 2


def _neighbours(words: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and how many words each has in common with the next."""
    levels = _ranks(words, left)
    order = np.argsort(levels[-1], kind="stable")
    one, two = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(one), np.int64)
    end = np.arange(len(words)) + left
    stop_one, stop_two = end[one], end[two]
    for k in range(len(levels) - 1, -1, -1):
        going = np.flatnonzero((one < stop_one) & (two < stop_two))
        equal = going[levels[k][one[going]] == levels[k][two[going]]]
        for place in (common, one, two):
            place[equal] += 1 << k
    return order, common


def _seeds(order: np.ndarray, common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(position, distance, LCP) of positions that become neighbours near enough for a run."""
    joins = np.flatnonzero(common >= _GRAM)
    joins = joins[np.argsort(-common[joins], kind="stable")]
    sets: list[list[int]] = [[p] for p in order.tolist()]
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, length in zip(joins.tolist(), common[joins].tolist()):
        a, b = root(i), root(i + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        parent[b], sets[b] = a, []
        most = length // (TIMES - 1)
        if large[-1] < small[0]:
            if small[0] - large[-1] <= most:
                yield large[-1], small[0] - large[-1], length
            large += small
            continue
        if len(small) * 8 < len(large):
            at = 0
            for k, p in enumerate(small):
                at = bisect_left(large, p, at)
                if at and p - large[at - 1] <= most:
                    yield large[at - 1], p - large[at - 1], length
                after = large[at] if at < len(large) else None
                if after is not None and after - p <= most and (k + 1 == len(small) or small[k + 1] > after):
                    yield p, after - p, length
                large.insert(at, p)
            continue
        own = set(small)
        large += small
        large.sort()  # two sorted runs, merged
        for p, q in zip(large, large[1:]):
            if q - p <= most and (p in own) != (q in own):
                yield p, q - p, length


def find_runs(hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in the order of start and period; the words of text i are ``bounds[i]`` to ``bounds[i + 1]``."""
    begins, ends = _chains(hashes, bounds)
    if not len(begins):
        return []
    sizes = ends - begins + 1
    chain = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(chain)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    where = begins[chain] + place
    words = np.unique(hashes[where], return_inverse=True)[1]
    words = np.unique(chain * np.int64(len(where) + 1) + words, return_inverse=True)[1].astype(np.int32)
    order, common = _neighbours(words, sizes[chain] - place)
    found: dict[tuple[int, int], int] = {}
    for p, d, length in _seeds(order, common):
        key = (d, p + d + length)
        found[key] = min(p, found.get(key, p))
    runs = [(int(where[p]), end - p, d) for (d, end), p in found.items()]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _collapsed(text: bytes, starts: np.ndarray, ends: np.ndarray, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of one text but those that a run repeats, joined by one space; word i is ``text[starts[i]:ends[i]]``."""
    kept, done = [], 0
    for first, stop in sorted((s + q, s + n) for s, n, q in runs):
        if first > done:
            kept += text[starts[done] : ends[first - 1]].split()
        done = max(done, stop)
    if done < len(starts):
        kept += text[starts[done] :].split()
    return b" ".join(kept)


def _batch(texts: pa.Array) -> pa.StructArray:
    words = Words(texts, NOT_BLANK, fold=False)
    bounds, runs = words.bounds, find_runs(words.hashes, words.bounds)
    text_of = np.searchsorted(bounds, [run[0] for run in runs], "right") - 1
    cuts = np.searchsorted(text_of, np.arange(len(texts) + 1))
    listed = np.array(runs, np.int64).reshape(-1, 3)
    listed[:, 0] -= bounds[text_of]
    fields = [pa.array(np.ascontiguousarray(column), pa.int64()) for column in listed.T]
    base, collapsed = 0, []
    for i, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        text, own = text or b"", listed[cuts[i] : cuts[i + 1]].tolist()
        if own:
            place = slice(int(bounds[i]), int(bounds[i + 1]))
            collapsed.append(_collapsed(text, words.starts[place] - base, words.ends[place] - base, own))
        else:
            collapsed.append(b" ".join(text.split()))
        base += len(text)
    arrays = [
        pa.array(np.diff(bounds), pa.int64()),
        pa.ListArray.from_arrays(
            pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        ),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]
    return pa.StructArray.from_arrays(arrays, ["n_words", "runs", "collapsed"])


def periodic_runs(text: str | Column) -> Column:
    """A struct for each whole text: ``n_words``, its ``runs`` (start, length and period in words, by start

    and period) and ``collapsed``: its words joined by one space, without those that a run holds after
    its first period. Words are parted by ASCII blanks.
    """

    @F.arrow_udf("n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in slices(iter([pa.record_batch({"text": texts})]), "text", BATCH_BYTES):
                yield _batch(part.column("text"))

    return found(text)
