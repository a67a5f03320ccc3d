import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finlake.llm import byte_bpe, token_counts
from finlake.llm.byte_bpe import BytePairs, RankQueue

WORDS = public_tokenizers.path("word_bpe_49k.json")
RULE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice("aàbcé d's1\n!日😀") for _ in range(rnd.randint(0, 200))) for _ in range(60)]
    made += ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    long = ["a" * 20000, "ab" * 15000, "\n" * 500 + "x", "".join(rnd.choice("aeinrst") for _ in range(20000)), " " * 777]
    return [*made, *long, "", "<|endoftext|> and <|startoftext|>", "x\x85y\xa0z\x1cw İΑΣ e ́", "I'll've 'S"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RULE[0], "rb"))}
    return tiktoken.Encoding("own", pat_str=RULE[1], mergeable_ranks=ranks, special_tokens={})


def test_counts_are_the_librarys(spark):
    rows = [(i, text) for i, text in enumerate([*texts(), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = token_counts.token_counts(docs, WORDS, limit=100).collect()
    plain = Tokenizer.from_file(WORDS)
    expected = {i: len(plain.encode(text or "", add_special_tokens=False).ids) for i, text in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in got} == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert token_counts.token_counts(docs.limit(0), WORDS).collect() == []


def test_small_caches_and_batches_change_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 5)
    monkeypatch.setattr(byte_bpe, "CACHED", 5)
    monkeypatch.setattr(byte_bpe, "CHUNK_BYTES", 16)
    raw = texts()
    assert token_counts.Counter(WORDS).counts([t.encode() for t in raw[:50]]) == [
        c for t in raw[:50] for c in token_counts.Counter(WORDS).counts([t.encode()])
    ]
    small, large = BytePairs(*RULE), BytePairs(*RULE)
    assert [x for t in raw[:50] for x in small.encode([t])] == large.encode(raw[:50])


def test_ids_are_the_librarys_and_come_back(spark, library):
    rows = [(i, text) for i, text in enumerate([*texts(), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    coded = docs.select("doc_id", byte_bpe.round_trip("text", *RULE).alias("c"), byte_bpe.encode_ids("text", *RULE).alias("ids"))
    coded = coded.withColumn("again", byte_bpe.decode_ids("ids", *RULE)).withColumn("list", byte_bpe.unpacked("ids"))
    for row in coded.collect():
        text = rows[row["doc_id"]][1] or ""
        expected = library.encode_ordinary(text)
        assert np.frombuffer(row["ids"], "<u4").tolist() == row["list"] == expected
        assert row["c"]["ids"] == row["ids"]
        assert bytes(row["c"]["decoded"]) == bytes(row["again"]) == text.encode()
    assert coded.limit(0).collect() == []


def test_queue_gives_ranks_in_order():
    rnd, queue = random.Random(1), RankQueue(70_000)
    held = {}
    for i in range(500):
        rank = rnd.randrange(70_000) if i % 5 else 64 * 64 * 3
        held.setdefault(rank, []).append(i)
        queue.push(np.array([rank]), np.array([i]))
    popped = []
    while (found := queue.pop()) is not None:
        popped.append((found[0], found[1].tolist()))
    assert popped == sorted(held.items())
