import re

import numpy as np
import pyarrow as pa

from finlake.llm.common import ALPHANUMERIC, NOT_BLANK, Words, grams, slices
from finlake.llm.letters import LetterWords

TEXTS = ["", None, "A b  a", "Straße x　y", "\tone\x0btwo\x1cthree\n", "x" * 3000, "no-dash_here 12a", "é" * 700_000, " "]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def check(table, pattern):
    words = Words(pa.array(TEXTS), table)
    names = {}
    for i, text in enumerate(TEXTS):
        expected = re.findall(pattern, lowered(text))
        got = range(words.bounds[i], words.bounds[i + 1])
        assert [words.text(j) for j in got] == expected
        for j, word in zip(got, expected):
            assert names.setdefault(word, words.hashes[j]) == words.hashes[j]
    assert len(set(names.values())) == len(names)


def test_words():
    check(NOT_BLANK, r"[^\x20\x09-\x0D]+")
    check(ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_words_of_a_slice_with_nulls():
    column = pa.array(["zero", None, "one two", "three"]).slice(1, 2)
    words = Words(column, NOT_BLANK)
    assert words.bounds.tolist() == [0, 0, 2] and words.text(1) == "two"


def test_grams_tell_order():
    a = Words(pa.array(["a b c", "c b a", "a b c"]), NOT_BLANK).hashes
    g = grams(a, 3)
    assert g[0] == g[6] != g[3] and len(grams(a, 10)) == 0


def test_slices_cover_all_rows():
    texts = ["x" * n for n in (5, 0, 50, 7, 3)] + [None]
    batch = pa.record_batch({"text": pa.array(texts)})
    runs = list(slices(iter([batch]), "text", 12))
    assert [r for run in runs for r in run.column("text").to_pylist()] == texts
    assert len(runs) > 2


def test_letter_words():
    words = LetterWords(["Ein Wort, zwei!", None, "", "d'été 5 é́x"])
    assert [words.word(i) for i in range(len(words.starts))] == ["ein", "wort", "zwei", "d", "été", "é́x"]
    assert words.bounds.tolist() == [0, 3, 3, 3, 6]
    assert np.all(words.scripts() == words.scripts()[0])
