"""Token counts of texts by a public tokenizer file, without keeping the tokens.

Inside an Arrow function, rows are taken in batches of about the same number of bytes, whatever their
lengths. A text, however long, is split at ASCII blanks: the tokenizer's normalizer turns blanks into
one space, its pattern never matches across them, no blank composes with a neighbour and no special
string holds one. So the counts of the parts add up to that of the text, and each different part is
encoded once. A text without such a blank is one part, for no other boundary is safe for every tokenizer file.

A null or empty text has 0 tokens. Special strings inside a text count as the library counts them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
#: Parts remembered from batch to batch: so many, of so many bytes in all.
CACHED, CACHED_BYTES = 400_000, 32 << 20


class Counter:
    """Counts tokens of whole texts; remembers the counts of parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}
        self.held = 0

    def counts(self, texts: list[bytes]) -> list[int]:
        split = [text.split() for text in texts]  # bytes split at ASCII blanks only
        new = list(set().union(*split).difference(self.known))
        encoded = self.tokenizer.encode_batch_fast([x.decode() for x in new], add_special_tokens=False)
        self.known.update(zip(new, map(len, encoded)))
        counts = [sum(map(self.known.__getitem__, parts)) for parts in split]
        self.held += sum(map(len, new))
        if len(self.known) > CACHED or self.held > CACHED_BYTES:
            self.known.clear()
            self.held = 0
        return counts


def n_tokens(text: str | Column, tokenizer: str) -> Column:
    """The number of tokens of each whole text, as a long; ``tokenizer`` is a .json file's path on every executor."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(tokenizer)
        for texts in batches:
            raw = [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]
            counted: list[int] = []
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            begin = 0
            while begin < len(raw):
                end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), BATCH_BYTES, "right")))
                counted += counter.counts(raw[begin:end])
                begin = end
            yield pa.array(counted, pa.int64())

    return count(text)


def token_counts(df: DataFrame, tokenizer: str, text: str = "text", out: str = "n_tokens", limit: int | None = None) -> DataFrame:
    """The frame with a count column, and ``over_limit`` if there is a limit; columns of these names are replaced."""
    counted = df.withColumn(out, n_tokens(text, tokenizer))
    return counted if limit is None else counted.withColumn("over_limit", F.col(out) > limit)
