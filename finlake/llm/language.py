"""Language identification with spans for texts that mix languages.

Each word is scored for every language by the letters in it with their neighbours (hashed into
``2 ** BITS`` buckets, add-one smoothed). The writing system of its first letter leaves only the
languages that use it. A Viterbi path over the words, with a penalty for each switch, labels them;
neighbours of one label form a span, and the language with the most letters is the text's. Any number of
languages may be learned.

The model is fitted on a sample of labelled rows, of about ``sample`` rows drawn by a hash of the id
(a documented bound); its size is buckets times languages. All rows are labelled, over their whole text.

``evidence`` says whether the text is any of the languages at all, however many it mixes: the mean over its
letters of how much likelier, in bits, each is in its span's language than in letters drawn at random. Letter soup has less
than 0.

A null text, or one without a letter, is ``und`` with score and evidence 0 and no spans. Rows without a label are not
learned from. With nothing to learn from, all is ``und``. The score is the share of letters in spans of
the text's language; of equal languages the first by name wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import slices
from finlake.llm.letters import SCRIPT_NAMES, LetterWords

BITS = 16
SAMPLE = 20_000
#: Scores of a word are held this close to its best language, so that no single word decides a text.
CLIP = 8.0
SWITCH = 12.0
UNKNOWN = "und"
RESULT = "lang_pred string, score double, evidence double, spans array<struct<begin:int,end:int,lang:string>>"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket, language: log-probability
    uses: np.ndarray  # script, language: whether the language is written in it


def sampled(labelled: DataFrame, key: str, rows: int) -> DataFrame:
    """About so many rows, or all if there are fewer, by a hash of the key (nulls are hashed too)."""
    share = min(1.0, rows / max(1, labelled.count()))
    return labelled.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_003)) < F.lit(int(share * 1_000_003)))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learns the languages of a bounded sample of labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            names, owner = np.unique(batch.column("lang").to_pylist(), return_inverse=True)
            words = LetterWords(batch.column("text").to_pylist())
            language = np.repeat(owner, np.diff(words.bounds))
            sizes = words.ends - words.starts
            size = (1 << BITS) + len(SCRIPT_NAMES)
            places = np.concatenate(
                (np.repeat(language * size, sizes) + words.grams(BITS), language * size + (1 << BITS) + words.scripts())
            )
            found, counts = np.unique(places, return_counts=True)
            yield pa.record_batch(
                {
                    "lang": pa.array(names[found // size].tolist(), pa.string()),
                    "bucket": pa.array(found % size, pa.int32()),
                    "n": pa.array(counts, pa.int64()),
                }
            )

    known = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    some = sampled(known.where("text is not null and lang is not null"), "key", sample)
    counted = (
        some.select("lang", "text")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(counted["lang"].to_pylist()))
    table = np.zeros(((1 << BITS) + len(SCRIPT_NAMES), len(languages)))
    at = np.searchsorted(languages, counted["lang"].to_pylist()) if languages else []
    table[counted["bucket"].to_numpy(), at] = counted["n"].to_numpy()
    grams, scripts = table[: 1 << BITS] + 0.1, table[1 << BITS :]
    scores = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    uses = scripts > 0.02 * np.maximum(1, scripts.sum(axis=0))
    uses[~uses.any(axis=1)] = True
    return Model(languages, scores, uses)


def word_scores(words: LetterWords, model: Model) -> np.ndarray:
    """Word, language: log-probability of a candidate, clipped below the best of them; minus infinity for the others.

    The candidates of a word are the languages that use its script, or all where none does.
    """
    if not len(words.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    sizes = words.ends - words.starts
    first = np.cumsum(sizes) - sizes
    scores = np.add.reduceat(model.scores[words.grams(BITS)], first, axis=0)
    candidate = model.uses[words.scripts()]
    best = np.where(candidate, scores, -np.inf).max(axis=1, keepdims=True)
    return np.where(candidate, np.maximum(scores, best - CLIP), -np.inf).astype(np.float32)


def best_path(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The label of each word: the best path of each text, all texts a word at a time."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    kind = np.min_scalar_type(max(1, scores.shape[1]))  # holds any number of languages
    came = np.zeros(scores.shape, kind)
    own = np.arange(scores.shape[1], dtype=kind)
    value = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        now = value[:n]
        best = now.argmax(axis=1)
        moved = now[np.arange(n), best][:, None] - np.float32(switch)
        stays = now >= moved
        came[at] = np.where(stays, own, best[:, None])
        value[:n] = np.where(stays, now, moved) + scores[at]
    labels = np.zeros(len(scores), np.int64)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return labels


def _label(texts: pa.Array, model: Model, switch: float) -> pa.Array:
    """The result of each text of an Arrow column."""
    words_of, scores, begin = [], [], 0
    batch = pa.record_batch({"text": texts})
    for some in slices(iter([batch]), "text", 1 << 19):
        words = LetterWords(some.column("text").to_pylist())
        scores.append(word_scores(words, model))
        words_of.append((words.bounds, words.texts, words.starts, words.ends))
    base = np.cumsum([0] + [len(x[2]) for x in words_of])
    bounds = np.concatenate([[0]] + [b[0][1:] + n for b, n in zip(words_of, base)])
    offset = [s - np.repeat(t[:-1], np.diff(b)) for b, t, s, _ in words_of]
    starts = np.concatenate([[]] + offset).astype(np.int64)
    sizes = np.concatenate([[]] + [e - s for _, _, s, e in words_of]).astype(np.int64)
    scored = np.concatenate(scores or [np.zeros((0, len(model.languages)))])
    labels = best_path(scored, bounds, switch)
    likely = np.concatenate(([0.0], np.cumsum(scored[np.arange(len(labels)), labels], dtype=np.float64)))
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    letters = np.zeros((len(texts), len(model.languages)), np.int64)
    np.add.at(letters, (owner, labels), sizes)
    best, total = letters.argmax(axis=1), letters.sum(axis=1)
    share = np.where(total > 0, letters[np.arange(len(texts)), best] / np.maximum(total, 1), 0.0)
    evidence = (likely[bounds[1:]] - likely[bounds[:-1]]) / np.maximum(total, 1) / np.log(2) + np.where(total > 0, BITS, 0)
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels)) - 1 if len(first) else first
    names = pa.array(model.languages, pa.string())
    spans = pa.StructArray.from_arrays(
        [
            pa.array(starts[first], pa.int32()),
            pa.array(starts[last] + sizes[last], pa.int32()),
            names.take(pa.array(labels[first], pa.int32())),
        ],
        ["begin", "end", "lang"],
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(first, bounds), pa.int32()), spans)
    named = pa.array(np.where(total > 0, best, -1), pa.int32(), mask=total == 0)
    return pa.StructArray.from_arrays(
        [names.take(named).fill_null(UNKNOWN), pa.array(share), pa.array(evidence), lists],
        ["lang_pred", "score", "evidence", "spans"],
    )


def label(text: str | Column, model: Model, df: DataFrame, switch: float = SWITCH) -> Column:
    """A struct for each text: ``lang_pred``, ``score``, ``evidence``, ``spans`` (code points ``begin`` to ``end``, ``lang``)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            if shared.value.languages and len(texts):
                runs = slices(iter([pa.record_batch({"text": texts})]), "text", 4 << 20)
                yield pa.concat_arrays([_label(run.column("text"), shared.value, switch) for run in runs])
            else:
                nothing = {"lang_pred": UNKNOWN, "score": 0.0, "evidence": 0.0, "spans": []}
                kind = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
                numbers = [("score", pa.float64()), ("evidence", pa.float64())]
                whole = pa.struct([("lang_pred", pa.string()), *numbers, ("spans", pa.list_(kind))])
                yield pa.array([nothing] * len(texts), whole)

    return apply(text)
