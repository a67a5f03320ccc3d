"""Queries without SQL against plain versions, over whole tables."""

import math
import os
import re
import unicodedata
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from finlake.llm import html_text, language, toxicity
from finlake.llm.common import held_out
from finlake.llm.grammar import INSULT, OTHER, THREAT, negation, reported, series, target
from finlake.llm.letters import SCRIPT_NAMES, SCRIPTS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(name, columns="*"):
    return duckdb.sql(f"select {columns} from '{SF_DIR}/{name}.parquet'").fetchall()


def words(text):
    """(begin, word) of each run of letters and marks, every code point lower-cased by itself."""
    found, begin = [], None
    for i, c in enumerate((text or "") + "\n"):
        inside = c.isalpha() or unicodedata.category(c)[0] == "M"
        if inside and begin is None:
            begin = i
        if not inside and begin is not None:
            found.append((begin, "".join(x.lower() if len(x.lower()) == 1 else x for x in text[begin:i])))
            begin = None
    return found


def bucket(word, i):
    before = ord(word[i - 1]) if i else 0
    after = ord(word[i + 1]) if i + 1 < len(word) else 0
    x = (before * 0x9E3779B1 ^ ord(word[i]) * 0x85EBCA77 ^ after * 0xC2B2AE3D) & 0xFFFFFFFF
    x = (x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
    return x >> (32 - language.BITS)


def spoken(text, model):
    """The language with the most letters on the best path over words, and its share of letters."""
    path, value = [], np.zeros(len(model.languages))
    found = words(text)
    for _, word in found:
        script = [name for first, name in SCRIPTS if ord(word[0]) >= first][-1]
        allowed = model.uses[SCRIPT_NAMES.index(script)]
        score = sum(model.scores[bucket(word, i)].astype(float) for i in range(len(word)))
        score = np.maximum(score, score[allowed].max() - language.CLIP)
        score[~allowed] = -np.inf
        moved = value.max() - language.SWITCH
        path.append(np.where(value >= moved, np.arange(len(value)), value.argmax()))
        value = np.maximum(value, moved) + score
    letters, state = np.zeros(len(model.languages), int), int(value.argmax())
    for (_, word), came in zip(reversed(found), reversed(path)):
        letters[state] += len(word)
        state = int(came[state])
    if not found:
        return "und", 0.0
    return model.languages[int(letters.argmax())], letters.max() / letters.sum()


def test_language_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in contract.queries()["op2_language"](spark, SF_DIR).collect()}
    texts = rows("documents", "doc_id, text")
    assert len(found) == len(texts)
    for doc_id, text in texts:
        lang, share = spoken(text, model)
        assert found[doc_id][0] == lang and found[doc_id][1] == pytest.approx(share), doc_id


def classed(word, model):
    if word in model.words:
        return model.words[word]
    stems = [w for stem, w in model.stems.items() if word.startswith(stem)]
    return (INSULT, max([0.0, *stems])) if stems else (OTHER, 0.0)


def clause_score(clause):
    """The four transducers one after the other, word by word."""
    machines, total = [[m, 0] for m in (negation(), reported(), target(), series())], 0.0
    for put, weight in clause:
        factor = 1.0
        for machine in machines:
            machine[1], put, by = machine[0].step(machine[1], put)
            factor *= by
        if put not in (OTHER, "target", "negation", "report"):
            total += weight * factor
    return total


def toxic(text, model):
    parts = re.split("[" + re.escape(toxicity.MARKS) + "]", text)
    clauses = [[classed(word, model) for _, word in words(part)] for part in parts]
    scores = [clause_score(c) for c in clauses if any(kind in (INSULT, THREAT) for kind, _ in c)]
    total, n = max(sum(scores), 0), max(1, sum(map(len, clauses)))
    x = [math.log1p(total), max([0.0, *scores]), math.log1p(len(scores)), math.log1p(total / math.sqrt(n))]
    z = model.logistic[0] + np.dot(x, model.logistic[1:])
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def test_toxicity_query(spark):
    fold = held_out("doc_id", 5, 0)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic").where(~fold)
    model = toxicity.fit(docs.where(~fold).join(labels, "doc_id"))
    found = {r["doc_id"]: r for r in contract.queries()["op1_toxicity"](spark, SF_DIR).collect()}
    texts = rows("documents", "doc_id, text")
    assert len(found) == len(texts)
    several = 0
    for doc_id, text in texts:
        want = toxic(text or "", model)
        assert found[doc_id]["score"] == pytest.approx(want, abs=1e-6), doc_id
        assert found[doc_id]["predicted"] == int(found[doc_id]["score"] >= 0.5)
        several += want >= 0.5
    assert several


class Article(HTMLParser):
    """The text of articles by the standard library's parser."""

    DROPPED = html_text.HIDDEN | html_text.CHROME | {"form"}

    def __init__(self):
        super().__init__()
        self.stack, self.lines, self.line = [], [], ""

    def flush(self):
        line = " ".join(self.line.split())
        self.lines += [line] if line else []
        self.line = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.line += " "
        if tag in html_text.VOID:
            return
        if tag not in html_text.INLINE:
            self.flush()
            solid = [name for name, _ in self.stack if name not in html_text.INLINE]
            if solid and solid[-1] == "p":
                self.handle_endtag("p")
        state = self.stack[-1][1] if self.stack else "out"
        names = {w for key, value in attrs if key in ("class", "id", "role") for w in re.split(r"[\s_-]+", (value or "").lower())}
        if tag in self.DROPPED or (names & html_text.NAMED and state == "in"):
            state = "gone"
        elif tag in ("article", "main") and state == "out":
            state = "in"
        self.stack.append((tag, state))

    def handle_endtag(self, tag):
        if tag not in html_text.INLINE:
            self.flush()
        places = [i for i, (name, _) in enumerate(self.stack) if name == tag]
        if places:
            del self.stack[places[-1] :]

    def handle_data(self, data):
        if self.stack and self.stack[-1][1] == "in":
            self.line += data


def test_html_query(spark):
    pages = rows("pages", "page_id, url, html")
    found = {r["page_id"]: r for r in contract.queries()["op5_html_text"](spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for page_id, url, page in pages:
        parser = Article()
        parser.feed(page or "")
        parser.close()
        parser.flush()
        assert found[page_id]["text"] == "\n".join(parser.lines), page_id
        assert found[page_id]["n_chars"] == len(found[page_id]["text"]) and found[page_id]["url"] == url
