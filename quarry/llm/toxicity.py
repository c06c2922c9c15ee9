"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first: compatibility forms, accents on Latin letters,
look-alike Cyrillic and Greek letters and digit or sign substitutions all
become plain Latin letters, and everything else separates words.  The
lexicon holds whole words and word beginnings with their log odds, learned
from labelled documents; an exception phrase (two adjacent words that occur
in clean documents only) cancels the term inside it.  The weighted hits of a
document are normalised by its length and a logistic curve over the
normalised and the total weight gives the score.

Only labelled rows outside the held-out fold are learned from, a bounded
number of them (``labelled.FIT_ROWS``).  The scoring pass reads each whole
text once and shuffles nothing; the automaton (bounded by ``MAX_TERMS``) is
built once per Python worker.

Empty and null texts have no hits and get the score of a clean text.
Repeated rows get equal scores; further columns are not read.  Without both
classes in the sample the lexicon is empty and every score is the base rate.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.llm.labelled import FIT_ROWS, fit_sample, held_out
from quarry.session import materialize

#: Terms and exception phrases kept at most, by log odds times support.
MAX_TERMS = 4096
MIN_DOCS = 6
MIN_ODDS = 4.0
BEGINNINGS = range(4, 8)

# Letters that look like Latin letters, and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ß": "ss",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_ZERO_WIDTH = re.compile("[­​-‏⁠﻿]")
_WORDS = re.compile(r"[a-z0-9]+")
_SIGNED = re.compile(r"(?=[0-9@$!]*[a-z])(?=[a-z!]*[0-9@$!])[a-z0-9@$!]+")
_SIGNS = str.maketrans(SUBSTITUTES)


def _letter(ch: str) -> str:
    """What a non-ASCII character becomes: plain letters or a space."""
    out = ""
    for c in unicodedata.normalize("NFKD", ch.lower()):
        c = HOMOGLYPHS.get(c, c)
        if c.isascii():
            out += c
        elif not unicodedata.combining(c):
            out += " "
    return out


class _Letters(dict):
    def __missing__(self, code: int):
        self[code] = code if code < 128 else _letter(chr(code))
        return self[code]


_LETTERS = _Letters()


def _unsign(match: re.Match) -> str:
    word = match[0].rstrip("!")
    return word.translate(_SIGNS)


def fold(text: str) -> str:
    """The words of a text, folded and with one space around each."""
    text = text.lower()
    if not text.isascii():
        text = _ZERO_WIDTH.sub("", text).translate(_LETTERS)
    text = _SIGNED.sub(_unsign, text)
    return " " + " ".join(_WORDS.findall(text)) + " "


@dataclass
class Lexicon:
    terms: dict[str, float] = field(default_factory=dict)       # " word " or " begin" -> weight
    exceptions: dict[str, str] = field(default_factory=dict)    # phrase -> term that it cancels
    curve: tuple[float, float, float] = (0.0, 0.0, -3.0)        # normalised, total, offset


def _term_counts(sample: DataFrame) -> dict[str, tuple[int, int]]:
    """Documents with each word and word beginning, by label (of the bounded sample)."""
    def counted(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch, texts in tc.chunks(batches):
            for text, label in zip(texts.to_pylist(), batch.column(batch.schema.get_field_index("label")).to_pylist(), strict=True):
                seen = set(fold(text).split())
                terms = {f" {w} " for w in seen if len(w) >= 3}
                terms.update(" " + w[:n] for w in seen for n in BEGINNINGS if len(w) > n)
                counts[1 if label == 1 else 0].update(terms)
        for label, c in counts.items():
            if c:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c)), pa.array([label] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                    names=["term", "label", "n"])

    toxic, clean = F.sum(F.expr("if(label = 1, n, 0)")), F.sum(F.expr("if(label = 1, 0, n)"))
    rows = (sample.mapInArrow(counted, "term string, label int, n long")
            .groupBy("term").agg(toxic.alias("toxic"), clean.alias("clean"))
            .where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") > F.col("clean")))
            .collect())
    return {r.term: (r.toxic, r.clean) for r in rows}


def one_of_each(sample: DataFrame) -> DataFrame:
    """One text of each group of copies in the sample, so that a copied text is evidence once.

    The key is the smallest hash of a text's three-word runs (of its words,
    if there are fewer), which copies and near copies share.
    """
    def keyed(batches):
        for batch, texts in tc.chunks(batches):
            _, _, document, word = tc.words(*tc.text_bytes(texts))
            key = np.zeros(batch.num_rows, np.uint64)
            for values, owner in ((word, document), (lambda h, at: (h, document[at]))(*tc.windows(word, document, 3))):
                first = tc.runs(owner)
                if len(first):
                    key[owner[first]] = np.minimum.reduceat(values, first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("text")),
                 batch.column(batch.schema.get_field_index("label")).cast(pa.int32()),
                 pa.array(key.astype(np.int64))], names=["text", "label", "key"])

    return (sample.select("text", "label").mapInArrow(keyed, "text string, label int, key long")
            .groupBy("key", "label").agg(F.min("text").alias("text")).select("text", "label"))


def learn(sample: DataFrame) -> Lexicon:
    """Lexicon, exceptions and curve from (text, label)."""
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(v for k, v in sizes.items() if k != 1)
    if not n1 or not n0:
        share = (n1 + 0.5) / (n1 + n0 + 1.0)
        return Lexicon(curve=(0.0, 0.0, float(np.log(share / (1 - share)))))
    odds = {}
    for term, (toxic, clean) in _term_counts(sample).items():
        value = np.log((toxic + 0.5) / (n1 + 1.0)) - np.log((clean + 0.5) / (n0 + 1.0))
        if value >= MIN_ODDS:
            odds[term] = (float(value), float(value * (toxic + clean)))
    kept: dict[str, float] = {}
    spoken: dict[str, float] = {}
    for term in sorted(odds, key=lambda t: (-odds[t][1], -len(t), t)):
        # a kept beginning speaks for the words under it, and a kept word for its
        # beginnings unless they occur in clearly more documents
        if (len(kept) < MAX_TERMS and not any(term[:k] in kept for k in range(5, len(term)))
                and odds[term][1] > 1.1 * spoken.get(term, 0.0)):
            kept[term] = odds[term][0]
            for k in range(5, len(term)):
                spoken[term[:k]] = max(spoken.get(term[:k], 0.0), odds[term][1])
    lexicon = Lexicon(kept, {})
    lexicon.exceptions = _exceptions(sample, lexicon)
    lexicon.curve = _curve(sample, lexicon)
    return lexicon


def _automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term, weight in lexicon.terms.items():
        machine.add_word(term, (weight, len(term)))
    for phrase, term in lexicon.exceptions.items():
        machine.add_word(phrase, (-lexicon.terms[term], len(phrase)))
    if len(machine):
        machine.make_automaton()
    return machine


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> dict[str, str]:
    """Two-word phrases around a term that at least MIN_DOCS clean and no toxic documents have."""
    terms = dict(lexicon.terms)

    def phrases(batches):
        machine = _automaton(Lexicon(terms))
        for batch, texts in tc.chunks(batches):
            found = []
            labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
            for text, label in zip(texts.to_pylist(), labels, strict=True):
                folded, seen = fold(text), set()
                for end, (_, size) in (machine.iter(folded) if len(machine) else ()):
                    at = end - size + 1
                    term = folded[at:end + 1]
                    word_end = folded.find(" ", at + 1)
                    left = folded.rfind(" ", 0, at)
                    right = folded.find(" ", word_end + 1)
                    if left >= 0:
                        seen.add((folded[left:word_end + 1], term))
                    if right > 0:
                        seen.add((folded[at:right + 1], term))
                found += [(p, t, int(label == 1)) for p, t in seen]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*found, strict=True), (pa.string(), pa.string(), pa.int32()), strict=True)],
                    names=["phrase", "term", "toxic"])

    rows = (sample.mapInArrow(phrases, "phrase string, term string, toxic int")
            .groupBy("phrase", "term").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
            .where((F.col("toxic") == 0) & (F.col("n") >= MIN_DOCS))
            .orderBy(F.desc("n"), "phrase").limit(MAX_TERMS).collect())
    return {r.phrase: r.term for r in rows}


def _hits(batches, lexicon: Lexicon, column: str, kind: pa.DataType):
    """(column, hits) of each row: total weight and weight by the square root of the length."""
    machine = _automaton(lexicon)
    for batch, texts in tc.chunks(batches):
        total, words = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for i, text in enumerate(texts.to_pylist()):
            folded = fold(text)
            words[i] = folded.count(" ") - 1
            if len(machine):
                total[i] = sum(weight for _, (weight, _) in machine.iter(folded))
        total = np.maximum(total, 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(column)).cast(kind), pa.array(total / np.sqrt(words + 10.0)), pa.array(total)],
            names=[column, "rate", "total"])


def _curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Ridge logistic curve over log(1 + rate) and log(1 + total)."""
    got = sample.mapInArrow(lambda b: _hits(b, lexicon, "label", pa.int32()), "label int, rate double, total double").toPandas()
    got = got.sort_values(["total", "rate", "label"])
    x = np.column_stack([np.log1p(got["rate"]), np.log1p(got["total"]), np.ones(len(got))])
    y = (got["label"].to_numpy() == 1).astype(float)
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.1, 0.1, 0.01])
        step = np.linalg.solve(hessian, x.T @ (y - p) - np.array([0.1, 0.1, 0.01]) * beta)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``."""
    field_type = docs.schema["doc_id"].dataType
    a, b, c = lexicon.curve

    def scored(batches):
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for out in _hits(iter([batch]), lexicon, "doc_id", kind):
                z = a * np.log1p(out.column(1).to_numpy()) + b * np.log1p(out.column(2).to_numpy()) + c
                value = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([out.column(0), pa.array(value)], names=["doc_id", "score"])

    return (docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {field_type.simpleString()}, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    lexicon = learn(materialize(one_of_each(fit_sample(docs, labels, "toxic", rows)), "toxic-sample"))
    return score(docs, lexicon).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
