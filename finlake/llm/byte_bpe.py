"""Byte-level BPE by a rank file: texts to token ids, and ids back to bytes.

Each match of the pattern is a piece and is merged by itself. All pieces that a batch of rows brings
for the first time are laid into one doubly linked list of tokens. A queue holds, for each merge rank,
a bucket of list positions; a bitmap of three levels says which buckets hold any, so find-first-set
gives the next rank. A popped position whose pair has changed since is stale and skipped. One pop works
on a whole bucket, over all pieces at once, so the cost of a piece grows with its length, not with its
square, however long it is.

Null texts are empty; they have no ids. Any text comes back exactly: decoded bytes are its UTF-8.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.llm.common import slices

NONE = 0xFFFFFFFF
CHUNK_BYTES = 1 << 19
BATCH_BYTES = 2 << 20
#: Pieces remembered from batch to batch: so many, of so many characters in all.
CACHED, CACHED_SIZE = 300_000, 16 << 20


class RankQueue:
    """Buckets of positions by rank, and a bitmap tree of 64-bit words over the ranks."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = defaultdict(list)
        self.levels = []
        while not self.levels or len(self.levels[-1]) > 1:
            ranks = (ranks + 63) // 64
            self.levels.append([0] * ranks)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Adds positions to the buckets of their ranks, keeping their order."""
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist()]
        for rank, begin, end in zip(ranks[begins].tolist(), begins, [*begins[1:], len(ranks)]):
            self.buckets[rank].append(positions[begin:end])
            for level in self.levels:
                rank, bit = rank >> 6, 1 << (rank & 63)
                if level[rank] & bit:
                    break
                level[rank] |= bit

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank with its bucket, which is emptied."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | ((word & -word).bit_length() - 1)
        at = rank
        for level in self.levels:
            at, bit = at >> 6, 1 << (at & 63)
            level[at] &= ~bit
            if level[at]:
                break
        held = self.buckets.pop(rank)
        return rank, held[0] if len(held) == 1 else np.concatenate(held)


class BytePairs:
    """The merges of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pieces = regex.compile(pattern).findall
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, unsafe = {}, np.zeros(len(self.token), bool)
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
                    unsafe[[x for x in (left, right) if x > rank]] = True
        # A rank is unsafe if its token is part of one of lower rank: then one merge at a time.
        self.unsafe = unsafe
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; NONE where they don't merge or one is missing (-1)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        if not n:
            return [b""] * len(pieces)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        token = np.append(self.byte[raw], -1)  # the last entry stands for no neighbour
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends[sizes > 0] - 1] = n
        before[(ends - sizes)[sizes > 0]] = n
        alive = np.ones(n + 1, bool)
        pair = self.rank(token, token[np.minimum(after, n)])
        queue = RankQueue(len(self.token))
        live = np.flatnonzero(pair[:n] != NONE)
        queue.push(pair[live], live)
        while (popped := queue.pop()) is not None:
            rank, found = popped
            found = np.sort(found[pair[found] == rank])  # the others are stale
            if len(found) > 1:
                if self.unsafe[rank]:
                    first = np.concatenate(([True], owner[found[1:]] != owner[found[:-1]]))
                    queue.push(pair[found[~first]], found[~first])
                    found = found[first]
                else:  # of pairs that overlap, from the left: every other one
                    chained = np.concatenate(([False], after[found[:-1]] == found[1:]))
                    if chained.any():
                        begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(found))))
                        found = found[(np.arange(len(found)) - begin) % 2 == 0]
            if not len(found):
                continue
            gone = after[found]
            beyond = after[gone]
            token[found], after[found], before[beyond] = rank, beyond, found
            alive[gone], pair[gone] = False, NONE
            left = before[found]
            changed = np.unique(np.concatenate((found, left[left < n])))
            changed = changed[alive[changed]]
            pair[changed] = fresh = self.rank(token[changed], token[after[changed]])
            live = fresh != NONE
            queue.push(fresh[live], changed[live])
        kept = np.flatnonzero(alive[:n])
        ids = token[kept].astype("<u4").tobytes()
        stops = (np.cumsum(np.bincount(owner[kept], minlength=len(pieces))) * 4).tolist()
        return [ids[begin:stop] for begin, stop in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, as little-endian unsigned 32-bit integers."""
        split = [self.pieces(text) for text in texts]
        new = list(set().union(*split).difference(self.known))
        chunk, held = [], 0
        for piece in [*new, None]:
            if chunk and (piece is None or held > CHUNK_BYTES):
                self.known.update(zip(chunk, self.merge([x.encode() for x in chunk])))
                chunk, held = [], 0
            if piece is not None:
                chunk.append(piece)
                held += len(piece)
        ids = [b"".join(map(self.known.__getitem__, parts)) for parts in split]
        self.held += sum(map(len, new))
        if len(self.known) > CACHED or self.held > CACHED_SIZE:
            self.known.clear()
            self.held = 0
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def merges(path: str, pattern: str) -> BytePairs:
    """Loaded once in a Python worker."""
    return BytePairs(path, pattern)


def _encoded(texts: pa.Array, pairs: BytePairs) -> Iterator[list[bytes]]:
    """The ids of some texts after others, a bounded number of bytes at a time."""
    for run in slices(iter([pa.record_batch({"text": texts})]), "text", BATCH_BYTES):
        yield pairs.encode([text or "" for text in run.column("text").to_pylist()])


def encode_ids(text: str | Column, path: str, pattern: str) -> Column:
    """The token ids of each whole text as binary: little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = merges(path, pattern)
        for texts in batches:
            for ids in _encoded(texts, pairs):
                yield pa.array(ids, pa.binary())
        pairs.known.clear()  # the worker lives on

    return encode(text)


def round_trip(text: str | Column, path: str, pattern: str) -> Column:
    """A struct for each whole text: packed ``ids``, and ``decoded``, the bytes that these ids stand for."""

    @F.arrow_udf("ids binary, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = merges(path, pattern)
        for texts in batches:
            for ids in _encoded(texts, pairs):
                decoded = pa.array(map(pairs.decode, ids), pa.binary())
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), decoded], ["ids", "decoded"])
        pairs.known.clear()

    return both(text)


def decode_ids(ids: str | Column, path: str, pattern: str) -> Column:
    """The bytes that packed token ids stand for; null for null. An unknown id is an error."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = merges(path, pattern)
        for packed in batches:
            yield pa.array([None if x is None else pairs.decode(x) for x in packed.to_pylist()], pa.binary())

    return decode(ids)


def unpacked(ids: str | Column) -> Column:
    """Packed ids as an array of integers."""

    @F.arrow_udf("array<int>")
    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for packed in batches:
            lists = [None if x is None else np.frombuffer(x, "<u4").astype(np.int32) for x in packed.to_pylist()]
            yield pa.array(lists, pa.list_(pa.int32()))

    return unpack(ids)
