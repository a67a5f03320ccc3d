"""Toxicity by a weighted finite-state grammar over clauses.

Words are classed as insults, threats, targets, negations, reports of speech, or others. Clauses end at
punctuation, also that of other scripts, and line ends. A clause that holds an insult or a threat is walked through one machine that
composes transducers for negation, reported speech, targets and series of insults (``grammar.py``). The
clause scores of a text, not its single words, decide: their sum, the highest, how many there are and
how dense they are go into a logistic function.

Insults come from a seed list and from labelled rows: whole words of up to 64 letters, and beginnings of 4 to 8 letters for
words that are built on a stem, weighted by their log-odds where these are significant. Lexicon and
logistic are fitted on a sample of about ``sample`` labelled rows drawn by a hash of the id (a
documented bound), which also bounds the lexicon. All rows are scored, over their whole text.

A null or empty text, or one without a matched clause, gets the score the logistic gives to no match.
Without labels of both kinds only the seeds count. Labels other than 0 and 1 are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import mixed, slices
from finlake.llm.grammar import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, toxicity_grammar
from finlake.llm.language import sampled
from finlake.llm.letters import LetterWords

SAMPLE = 20_000
SEED_WEIGHT = 4.0
#: Letters of a beginning that may be learned, and of a whole word.
SHORTEST, LONGEST, WHOLE = 4, 8, 64
#: Marks that end a clause.
MARKS = ".,;:!?\n\r…‚„—;·،؛؟।॥。、！，．：；？｡､"
#: The seed lexicon. Labelled rows may add insults and change their weights.
SEEDS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown vermin",
    THREAT: "kill hurt destroy beat stab shoot burn punish crush hunt",
    TARGET: "you your yours yourself he she they him her them these those people",
    NEGATION: "not no never nobody neither nor without isn aren wasn don doesn didn",
    REPORT: "said says say told claimed claims wrote quoted reported alleges alleged called",
}


@dataclass(frozen=True)
class Model:
    words: dict[str, tuple[str, float]]  # whole words: class and weight
    stems: dict[str, float]  # beginnings of words: weight as an insult
    logistic: np.ndarray  # bias and a factor for each feature


def _hashes(words: LetterWords, sizes: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size: which words have that many letters or more, and a hash of their beginnings."""
    lengths = words.ends - words.starts
    hashed = np.zeros(len(lengths), np.uint64)
    at = np.arange(len(lengths))
    with np.errstate(over="ignore"):
        for size in range(1, sizes.stop):
            at = at[lengths[at] >= size]
            letter = words.points[words.starts[at] + size - 1].astype(np.uint64)
            hashed[at] = mixed(hashed[at] * np.uint64(31) + letter + np.uint64(1))
            if size in sizes:
                yield size, at, hashed[at]


def _one(word: str) -> int:
    """The hash of a whole word or beginning, as _hashes gives it."""
    words = LetterWords([word])
    return [int(h[0]) for size, at, h in _hashes(words, range(len(word), len(word) + 1)) if len(at)][-1]


class Scanner:
    """Finds classed words in many texts at once."""

    def __init__(self, model: Model):
        self.model, self.grammar = model, toxicity_grammar()
        self.tables = []
        for size in range(1, max([LONGEST, *map(len, model.words)]) + 1):
            whole = {_one(w): (True, w) for w in model.words if len(w) == size}
            stems = {_one(w): (False, w) for w in model.stems if len(w) == size}
            self.tables.append((whole, stems))

    def classed(self, words: LetterWords) -> dict[int, tuple[str, float]]:
        """Word number: class and weight, of the words that are not OTHER."""
        lengths = words.ends - words.starts
        found: dict[int, tuple[str, float]] = {}
        for size, at, hashed in _hashes(words, range(1, len(self.tables) + 1)):
            whole, stems = self.tables[size - 1]
            if stems:
                hit = np.isin(hashed, np.fromiter(stems, np.uint64, len(stems)))
                for i, h in zip(at[hit].tolist(), hashed[hit].tolist()):
                    found[i] = max(found.get(i, (INSULT, 0.0)), (INSULT, self.model.stems[stems[h][1]]))
            if whole:
                hit = (lengths[at] == size) & np.isin(hashed, np.fromiter(whole, np.uint64, len(whole)))
                for i, h in zip(at[hit].tolist(), hashed[hit].tolist()):
                    found[i] = self.model.words[whole[h][1]]
        return found

    def features(self, texts: list[str | None]) -> np.ndarray:
        """By text: the sum of its clause scores, the highest, how many, the sum by the square root of its words."""
        words = LetterWords(texts)
        out = np.zeros((len(texts), 4))
        found = self.classed(words)
        scored = np.array(sorted(i for i, (kind, _) in found.items() if kind in (INSULT, THREAT)), np.int64)
        if not len(scored):
            return out
        ends = np.isin(words.points, np.frombuffer(MARKS.encode("utf-32-le"), np.uint32))
        clause = np.concatenate(([0], np.cumsum(ends)))[words.starts]
        begin, end = np.searchsorted(clause, clause[scored]), np.searchsorted(clause, clause[scored], "right")
        owner = np.searchsorted(words.bounds, scored, "right") - 1
        for i, (a, b) in dict(zip(begin.tolist(), zip(owner.tolist(), end.tolist()))).items():
            score = self.grammar.clause(found.get(j, (OTHER, 0.0)) for j in range(i, b))
            out[a, 0] += score
            out[a, 1] = max(out[a, 1], score)
            out[a, 2] += 1
        out[:, 3] = out[:, 0] / np.sqrt(np.maximum(1, np.diff(words.bounds)))
        return np.column_stack((np.log1p(np.maximum(out[:, 0], 0)), out[:, 1], np.log1p(out[:, 2]), np.log1p(np.maximum(out[:, 3], 0))))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.model.logistic[0] + self.features(texts) @ self.model.logistic[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(some: DataFrame) -> DataFrame:
    """In how many rows of each label a word or a beginning occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            toxic = np.array(batch.column("toxic").to_pylist())
            words = LetterWords(batch.column("text").to_pylist())
            owner = np.repeat(np.arange(batch.num_rows), np.diff(words.bounds))
            lengths = words.ends - words.starts
            for size, at, hashed in _hashes(words, range(1, WHOLE + 1)):
                if not SHORTEST <= size <= LONGEST:  # only whole words
                    at, hashed = at[lengths[at] == size], hashed[lengths[at] == size]
                for whole in (False, True):
                    take = (lengths[at] == size) if whole else np.full(len(at), SHORTEST <= size <= LONGEST)
                    mine, keys = at[take], hashed[take]
                    _, first = np.unique(np.column_stack((owner[mine].astype(np.uint64), keys)), axis=0, return_index=True)
                    if not len(first):
                        continue
                    mine, keys = mine[first], keys[first]
                    _, one, back = np.unique(keys, return_index=True, return_inverse=True)
                    bad = np.bincount(back, toxic[owner[mine]], len(one)).astype(np.int64)
                    names = [words.word(i)[:size] for i in mine[one].tolist()]
                    yield pa.record_batch(
                        {"term": names, "whole": [whole] * len(names), "bad": bad, "n": np.bincount(back, minlength=len(one))}
                    )

    counted = some.select("text", "toxic").mapInArrow(count, "term string, whole boolean, bad long, n long")
    return counted.groupBy("term", "whole").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))


def _significance(bad: float, good: float, bads: float, goods: float) -> float:
    """The G statistic of a term against the label."""
    n, total = bads + goods, 0.0
    for seen, row, column in (
        (bad, bads, bad + good),
        (good, goods, bad + good),
        (bads - bad, bads, n - bad - good),
        (goods - good, goods, n - bad - good),
    ):
        if seen > 0:
            total += 2 * seen * math.log(seen * n / (row * column))
    return total


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """A logistic regression by Newton steps, lightly held to zero."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learns insults and the logistic from a bounded sample of labelled rows."""
    seeds = {word: (kind, SEED_WEIGHT) for kind, listed in SEEDS.items() for word in listed.split()}
    known = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(toxic).cast("int").alias("toxic"))
    some = sampled(known.where("toxic in (0, 1)"), "key", sample)
    sizes = {row["toxic"]: row["count"] for row in some.groupBy("toxic").count().collect()}
    bads, goods = sizes.get(1, 0), sizes.get(0, 0)
    plain = Model(seeds, {}, np.array([-3.0, 1.5, 0.5, 0.0, 0.0]))
    if not bads or not goods:
        return plain
    # A term in few of the toxic rows, or no likelier in them, can't be significant.
    likely = _terms(some).where(F.col("bad") >= 3).where(F.col("bad") * goods > (F.col("n") - F.col("bad")) * bads * 4)
    words, stems = dict(seeds), {}
    for row in likely.toLocalIterator():
        good = row["n"] - row["bad"]
        if _significance(row["bad"], good, bads, goods) < 12:
            continue
        weight = math.log((row["bad"] + 0.5) / (bads + 1)) - math.log((good + 0.5) / (goods + 1))
        if row["whole"]:
            if seeds.get(row["term"], (INSULT,))[0] == INSULT:
                words[row["term"]] = (INSULT, weight)
        else:
            stems[row["term"]] = weight
    model = Model(words, stems, plain.logistic)
    names = ["a", "b", "c", "d"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for batch in slices(batches, "text", 1 << 20):
            found = scanner.features(batch.column("text").to_pylist())
            yield pa.record_batch({"toxic": batch.column("toxic"), **dict(zip(names, found.T))})

    schema = "toxic int, " + ", ".join(f"{name} double" for name in names)
    measured = some.select("text", "toxic").mapInArrow(measure, schema).toArrow()
    x = np.column_stack([measured[name].to_numpy() for name in names])
    return Model(words, stems, _logistic(x, measured["toxic"].to_numpy().astype(float)))


def score(text: str | Column, model: Model, df: DataFrame) -> Column:
    """How toxic each whole text is, from 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(shared.value)
        for texts in batches:
            runs = slices(iter([pa.record_batch({"text": texts})]), "text", 1 << 20)
            found = [scanner.scores(run.column("text").to_pylist()) for run in runs]
            yield pa.array(np.concatenate(found) if found else [], pa.float64())

    return apply(text)
