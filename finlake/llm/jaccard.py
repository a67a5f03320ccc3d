"""Exact Jaccard join of word n-grams with a token-group matrix.

A document is the set of its distinct ``size``-word shingles (64-bit hashes); fewer words make one
shingle. Documents link when ``100 * |intersection| >= percent * |union|``. The result names the
connected component of each document; links inside a group of copies are not listed one by one.

1. Equal sets become one node. Only nodes travel from there on.
2. All nodes share one order of tokens: those of rarely used words come first, those that very many
   documents hold last. So the first tokens of unlike texts stay different ones, however many texts there are.
   Of two linked sets, the first ``n - ceil(percent n) + k`` tokens share ``k`` or more, where ``k``
   grows with ``n`` (``_extra``). Nodes with fewer of these tokens in common with others link with nothing.
   Of those left, tokens that no other of them holds are counted: the others bound a node's overlap with
   any, ``s``, and those whose ``s`` is too small go too.
3. The others are partitioned into groups of similar nodes: by a token that they share with most others,
   in blocks of at most about ``BLOCK`` nodes. Within a block the matrix has a row of bits over the
   tokens for each group of linked nodes: the union of its members' tokens. A node's overlap with that
   union bounds its overlap with each member, so only groups that reach ``percent`` of the node are opened
   and compared. The first node of each group then goes through the same again under another token.
4. What may still link across blocks: first tokens whose holders are not yet all in one group. They are
   united by block of step 3 and joined; pairs of blocks with enough common tokens, and with bounds
   ``s`` that allow a link, are opened in the same way, but only nodes of different groups are compared.
   So no pair is lost, and copies of one text are never paired.

Null, empty and blank texts are empty sets and link with nothing. Rows with a null id take part only if
another row has the same set; else their component is null. Rows may repeat; different
texts under one id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import NOT_BLANK, Words, Workspace, by_key, grams, mixed, slices
from finlake.llm.components import components
from finlake.llm.winnow import bitmap

BLOCK = 128
#: A token counts as very frequent from so many documents on, of those met in slices where it has a few.
FREQUENT, FEW = 64, 4
#: How often words are used is kept by 2 ** SLOTS places; a task counts words until it holds HELD different ones.
SLOTS, HELD = 20, 1 << 20
_SECOND = np.uint64(0x5851F42D4C957F2D)


def _sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    shingles = grams(words.hashes, size)
    out = []
    for begin, end in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if end - begin >= size:
            out.append(np.unique(shingles[begin : end - size + 1]))
        else:
            out.append(grams(words.hashes[begin:end], end - begin) if end > begin else shingles[:0])
    return out


def _ranked_sets(words: Words, size: int, levels: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The sorted distinct shingles of each text; for each shingle the sum of its words' levels."""
    shingles = grams(words.hashes, size)
    of_word = levels[(words.hashes & np.uint64(len(levels) - 1)).astype(np.int64)]
    upto = np.concatenate(([0], np.cumsum(of_word, dtype=np.int64)))
    sets, ranks = [], []
    for begin, end in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if end - begin >= size:
            tokens, at = np.unique(shingles[begin : end - size + 1], return_index=True)
            sets.append(tokens)
            ranks.append(upto[begin + at + size] - upto[begin + at])
        else:
            sets.append(grams(words.hashes[begin:end], end - begin) if end > begin else shingles[:0])
            ranks.append(upto[end : end + len(sets[-1])] - upto[begin])
    return sets, ranks


def _needed(n, percent: int):
    """The least overlap of a set of n with any set that it links with."""
    return (percent * n + 99) // 100


@lru_cache
def _least_size(percent: int) -> int:
    """The smallest size of a set that can link with another set."""
    if percent >= 100:
        return 1 << 60
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _extra(n: int) -> int:
    """By how many tokens more than needed the first tokens of a set of n go on; so many are then shared."""
    return 1 if n < 9 else 3 + n // 32


def _shared_by_all(n: int, percent: int) -> int:
    """How many of its first tokens a set of n shares at least with each set that it links with."""
    smallest = _needed(n, percent)  # of sets that it can link with
    return min(_extra(smallest), _needed(smallest, percent))


class Order(NamedTuple):
    """The order that tokens have in all sets: by their words' levels, those of ``last`` after all others, then by hash."""

    last: np.ndarray  # a bitmap of tokens that very many documents hold
    levels: np.ndarray  # by a word's hash: four times the binary logarithm of how often it is used


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)


def token_order(docs: DataFrame, text: str, size: int, work: Workspace) -> Order:
    """An order that puts tokens first which few documents hold; with any order the result is right."""

    def rows(keys: np.ndarray, counts: np.ndarray, word: bool) -> pa.RecordBatch:
        often = counts >= FEW
        n = int(often.sum())
        return pa.record_batch({"word": pa.array([word] * n, pa.bool_()), "key": keys[often].view(np.int64), "n": counts[often]})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), NOT_BLANK)
            yield rows(*np.unique(np.concatenate(_sets(words, size)), return_counts=True), word=False)
            held.append(np.unique(words.hashes, return_counts=True))
            if sum(len(keys) for keys, _ in held) > HELD:
                held = [_summed(held)]
                if len(held[0][0]) > HELD // 2:
                    yield rows(*held.pop(), word=True)
        if held:
            yield rows(*_summed(held), word=True)

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "word boolean, key long, n long")
    counted = work.save(counted.groupBy("word", "key").agg(F.sum("n").alias("n")))
    last = bitmap(counted.where(~F.col("word") & (F.col("n") >= FREQUENT)), "key")
    slots = counted.where("word").groupBy(F.col("key").bitwiseAND((1 << SLOTS) - 1).cast("int").alias("slot"))
    used = slots.agg((4 * F.log2(F.sum("n"))).cast("short").alias("level")).toArrow()
    levels = np.zeros(1 << SLOTS, np.uint8)
    levels[used["slot"].to_numpy()] = used["level"].to_numpy()
    work.drop(counted)
    return Order(last, levels)


#: Of ranks, which are sorted as numbers of 16 bits.
_LAST = 1 << 15


def _first(tokens: np.ndarray, ranks: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set, in the order that all sets share."""
    n = len(tokens)
    if n < _least_size(percent):
        return tokens[:0]
    late = last[(tokens & np.uint64(len(last) - 1)).astype(np.int64)]
    key = np.minimum(ranks, _LAST - 1).astype(np.uint16) | late.astype(np.uint16) * np.uint16(_LAST)
    return tokens[np.argsort(key, kind="stable")[: min(n, n - _needed(n, percent) + min(_extra(n), _needed(n, percent)))]]


def described(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, order: Order) -> DataFrame:
    """For each document: its id, the size of its set, the set's signature and its first tokens.

    ``need``: how many of the first tokens a set shares at least with any that it links with.
    """
    packed, levels = np.packbits(order.last), order.levels

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = np.unpackbits(packed).view(bool)
        for batch in slices(batches, "text"):
            sets, ranks = _ranked_sets(Words(batch.column("text"), NOT_BLANK), size, levels)
            counts = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets)
            sums = [np.zeros(len(sets), np.uint64) for _ in range(2)]
            full = np.flatnonzero(counts)
            if len(full):
                begins = (np.cumsum(counts) - counts)[full]
                for total, salt in zip(sums, (MIXED_A, MIXED_B)):
                    total[full] = np.add.reduceat(mixed(flat ^ salt), begins)
            first = [_first(tokens, rank, late, percent).view(np.int64) for tokens, rank in zip(sets, ranks)]
            need = [_shared_by_all(n, percent) for n in counts.tolist()]
            yield pa.record_batch(
                {
                    "id": batch.column("id"),
                    "n": counts,
                    "need": pa.array(need, pa.int32()),
                    "sig1": sums[0].view(np.int64),
                    "sig2": sums[1].view(np.int64),
                    "first": pa.array(first, pa.list_(pa.int64())),
                }
            )

    schema = "id long, n long, need int, sig1 long, sig2 long, first array<long>"
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(describe, schema)


MIXED_A, MIXED_B = mixed(np.array([_SECOND, ~_SECOND]))


def token_sets(docs: DataFrame, doc_id: str, text: str, size: int, wanted: np.ndarray) -> DataFrame:
    """(node, tokens) of the documents whose id is marked in a bitmap (and perhaps of some others)."""
    packed = np.packbits(wanted)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(packed).view(bool)
        for batch in slices(batches, "text"):
            batch = batch.filter(batch.column("id").is_valid())
            at = mixed(batch.column("id").to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(len(marks) - 1)
            batch = batch.filter(pa.array(marks[at.astype(np.int64)]))
            if batch.num_rows:
                sets = [tokens.view(np.int64) for tokens in _sets(Words(batch.column("text"), NOT_BLANK), size)]
                yield pa.record_batch({"node": batch.column("id"), "tokens": pa.array(sets, pa.list_(pa.int64()))})

    chosen = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(build, "node long, tokens array<long>")


def _marked_ids(nodes: DataFrame, column: str) -> np.ndarray:
    @F.arrow_udf("long")
    def place(ids: pa.Array) -> pa.Array:
        return pa.array(mixed(ids.to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64))

    return bitmap(nodes.select(place(column).alias("at")), "at")


class Matrix:
    """Groups of linked nodes, and for each a row of bits over the tokens that any of its nodes holds."""

    def __init__(self, percent: int, sets: list[np.ndarray]):
        self.percent = percent
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        _, place = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(place, np.cumsum(self.size)[:-1])
        self.width = int(place.max()) // 8 + 1 if len(place) else 1
        self.bits = np.zeros((0, self.width), np.uint8)
        self.groups: list[list[int]] = []
        self.marks = np.zeros(self.width * 8, bool)

    def links(self, i: int, groups: Iterable[int]) -> list[int]:
        """Those of the groups that hold a node that links with node i."""
        mine = self.sets[i]
        self.marks[mine] = True
        found = []
        for g in groups:
            for j in self.groups[g]:
                small, large = sorted((self.size[i], self.size[j]))
                if 100 * small < self.percent * large:
                    continue
                common = np.count_nonzero(self.marks[self.sets[j]])
                if (100 + self.percent) * common >= self.percent * (small + large):
                    found.append(g)
                    break
        self.marks[mine] = False
        return found

    def qualifying(self, i: int) -> np.ndarray:
        """The groups whose union holds enough of node i's tokens."""
        if not len(self.groups):
            return np.zeros(0, np.int64)
        mine = self.sets[i]
        held = (self.bits[: len(self.groups), mine >> 3] >> (mine & 7).astype(np.uint8)) & 1
        alive = np.fromiter(map(len, self.groups), np.int64, len(self.groups)) > 0
        return np.flatnonzero((held.sum(axis=1) >= _needed(self.size[i], self.percent)) & alive)

    def add(self, i: int, linked: list[int]) -> None:
        """Puts node i into the groups that it links with, which become one, or into a new group."""
        if linked:
            home = linked[0]
            for g in linked[1:]:
                self.groups[home] += self.groups[g]
                self.groups[g] = []
                self.bits[home] |= self.bits[g]
        else:
            home = len(self.groups)
            self.groups.append([])
            if home == len(self.bits):
                more = np.zeros((max(8, home), self.width), np.uint8)
                self.bits = np.concatenate((self.bits, more))
        self.groups[home].append(i)
        np.bitwise_or.at(self.bits[home], self.sets[i] >> 3, (1 << (self.sets[i] & 7)).astype(np.uint8))


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1])


def linked_blocks(members: DataFrame, block: str, percent: int) -> DataFrame:
    """Each node of a block with the first node of its group: (a, b, other, tokens).

    First nodes keep their ``tokens`` and their ``other`` block, for another pass.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_key(batches, ["block"]):
            nodes, other = part.column("node").to_pylist(), part.column("other").to_pylist()
            sets = _arrays(part.column("tokens"))
            matrix = Matrix(percent, sets)
            for i in range(len(nodes)):
                matrix.add(i, matrix.links(i, matrix.qualifying(i)))
            firsts = [(i, group[0]) for group in matrix.groups for i in group]
            yield pa.record_batch(
                {
                    "a": pa.array([nodes[i] for i, _ in firsts], pa.int64()),
                    "b": pa.array([nodes[j] for _, j in firsts], pa.int64()),
                    "other": pa.array([other[i] for i, _ in firsts], pa.int64()),
                    "tokens": pa.array([sets[i] if i == j else None for i, j in firsts], pa.list_(pa.int64())),
                }
            )

    dealt = members.repartition(block).sortWithinPartitions(block)
    rows = dealt.select(F.col(block).alias("block"), "node", "other", "tokens")
    return rows.mapInArrow(link, "a long, b long, other long, tokens array<long>")


def linked_pairs(sides: DataFrame, percent: int) -> DataFrame:
    """(a, b): links across pairs of blocks, for (one, two, side, node, component, tokens)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in by_key(batches, ["one", "two"]):
            nodes, side, component = (pair.column(c).to_pylist() for c in ("node", "side", "component"))
            matrix, home, same = Matrix(percent, _arrays(pair.column("tokens"))), {}, {c: c for c in component}

            def root(c: int) -> int:
                while same[c] != c:
                    c = same[c]
                return c

            for i in (i for i, s in enumerate(side) if s == 0):
                group = home.setdefault(component[i], len(matrix.groups))
                matrix.add(i, [group] if group < len(matrix.groups) else [])
            names, found = list(home), []
            for i in (i for i, s in enumerate(side) if s == 1):
                for g in matrix.qualifying(i).tolist():
                    if root(names[g]) != root(component[i]) and matrix.links(i, [g]):
                        same[root(names[g])] = root(component[i])
                        found.append((nodes[i], nodes[matrix.groups[g][0]]))
            if found:
                a, b = zip(*found)
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = sides.repartition("one", "two").sortWithinPartitions("one", "two")
    return dealt.select("one", "two", "side", "node", "component", "tokens").mapInArrow(link, "a long, b long")


def _blocks(keys: DataFrame, key: str, salt: int, inner: Workspace) -> DataFrame:
    """The rows with a ``block_<key>``: those of one key, cut by a hash into parts of about BLOCK rows."""
    sizes = inner.save(keys.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).alias("parts")))
    part = F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts"))
    return keys.join(sizes, key).withColumn(f"block_{key}", F.xxhash64(key, part, F.lit(salt))).drop(key, "parts")


def _allows(s, n, m, percent: int):
    """Whether sets of n and m with an overlap of s at most may link."""
    return (100 + percent) * s >= percent * (n + m)


def _bounded(enough: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """With ``s``, how many tokens of a node others hold too; nodes that can't link for that go."""
    single = (
        sets.select("node", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("df"), F.min("node").alias("node"))
        .where("df = 1")
        .groupBy("node")
        .agg(F.count("*").alias("single"))
    )
    bound = enough.join(single, "node", "left").withColumn("s", F.col("n") - F.coalesce("single", F.lit(0))).drop("single")
    return bound.where(_allows(F.col("s"), F.col("n"), F.ceil(F.col("n") * percent / 100), percent))


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90
) -> DataFrame:
    """Per document row: ``id``, ``n`` (shingles) and ``component`` (the smallest id reachable by links)."""
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    # What the result is read from, and what goes once the components are written.
    work, inner = Workspace(docs.sparkSession), Workspace(docs.sparkSession)
    order = token_order(docs, text, size, inner)
    whole = inner.save(described(docs, doc_id, text, size, percent, order))
    rows = work.save(whole.select("id", "n", "sig1", "sig2"))
    nodes = inner.save(
        whole.where("n > 0 and id is not null")
        .groupBy("sig1", "sig2", "n", "need")
        .agg(F.min("id").alias("node"), F.first("first").alias("first"))
    )
    named = work.save(nodes.select("sig1", "sig2", "node"))
    inner.drop(whole)
    # Tokens among the first of two nodes or more. Counts are written before they are joined to what they
    # count, so that Spark splits the partitions of a token that very many nodes hold.
    held = nodes.select("node", F.explode("first").alias("token"))
    often = inner.save(held.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"))
    shared = inner.save(held.join(often.hint("merge"), "token"))
    found = shared.groupBy("node").agg(
        F.count("*").alias("common"), F.max(F.struct("df", "token"))["token"].alias("key1"), F.min("token").alias("key2")
    )
    enough = found.join(nodes.select("node", "n", "need"), "node").where("common >= need").drop("common")
    enough = inner.save(enough)
    inner.drop(nodes, often)
    # Whole sets are large: those that only the bounds need are not written.
    bounded = inner.save(_bounded(enough, token_sets(docs, doc_id, text, size, _marked_ids(enough, "node")), percent))
    inner.drop(enough)
    keys = inner.save(_blocks(inner.save(_blocks(bounded, "key1", 1, inner)), "key2", 2, inner))
    # Joined in one way at every size of the table, not only from where the smaller side is too large to be broadcast.
    placed = keys.select("node", "block_key1", F.col("block_key2").alias("other")).hint("merge")
    sets = token_sets(docs, doc_id, text, size, _marked_ids(bounded, "node"))
    sets = inner.save(sets.join(placed, "node"))
    inner.drop(bounded)
    groups = inner.save(linked_blocks(sets, "block_key1", percent))
    leaders = groups.where("tokens is not null").select(F.col("a").alias("node"), "other", "tokens")
    second = inner.save(linked_blocks(leaders, "other", percent).select("a", "b"))
    links = groups.select("a", "b").unionByName(second)
    linked = inner.save(components(links, inner))
    stars = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = work.save(components(stars.unionByName(_across(shared, keys, sets, linked, inner, percent)), inner))
    inner.drop_all()
    by_set = named.join(final.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left").select(
        "sig1", "sig2", F.coalesce("component", "node").alias("component")
    )
    return rows.join(by_set, ["sig1", "sig2"], "left").select(
        F.col("id"), "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component")
    )


def _across(shared: DataFrame, keys: DataFrame, sets: DataFrame, linked: DataFrame, work: Workspace, percent: int) -> DataFrame:
    """Links between nodes of different groups."""
    grouped = keys.select("node", "need", "n", "s", F.col("block_key1").alias("block")).join(linked, "node", "left")
    placed = grouped.withColumn("component", F.coalesce("component", "node"))
    holders = work.save(shared.select("token", "node").join(placed, "node"))
    tokens = holders.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least")
    )
    tokens = work.save(tokens.where("low <> high").select("token", "least"))
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    bridging = holders.join(tokens.hint("merge"), "token")
    bridging = work.save(bridging.where(_allows(F.col("s"), F.col("n"), partner, percent)).drop("least"))
    matrix = work.save(
        bridging.groupBy("token", "block").agg(
            F.min("need").alias("need"),
            F.min("n").alias("n"),
            F.max("s").alias("s"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
    )
    one, two = matrix.alias("one"), matrix.alias("two")
    several = (F.col("one.low") != F.col("two.high")) | (F.col("one.high") != F.col("two.low"))
    pairs = (
        one.join(
            two,
            (F.col("one.token") == F.col("two.token"))
            & (F.col("one.block") < F.col("two.block"))
            & several
            & _allows(F.least("one.s", "two.s"), F.col("one.n"), F.col("two.n"), percent),
        )
        .groupBy(F.col("one.block").alias("one"), F.col("two.block").alias("two"))
        .agg(F.count("*").alias("common"), F.greatest(F.min("one.need"), F.min("two.need")).alias("need"))
        .where("common >= need")
        .select("one", "two")
    )
    pairs = work.save(pairs)
    opened = pairs.select("one", "two", F.lit(0).alias("side"), F.col("one").alias("block")).unionByName(
        pairs.select("one", "two", F.lit(1).alias("side"), F.col("two").alias("block"))
    )
    active = bridging.select("node", "block", "component").distinct()
    sides = opened.join(active, "block").join(sets.select("node", "tokens"), "node")
    return linked_pairs(sides, percent)
