"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a reject condition over a text and its words.  ``plan`` runs every
rule over a bounded sample of documents, takes its share of rejections and
the time that its condition adds, and orders the rules by rejections per
cost.  ``cascade`` evaluates them in that order inside one CASE expression:
a rule is computed only for documents that the rules before it let pass.

The order changes what is computed, never the verdict: a document is kept if
no rule rejects it.  Null and empty texts have no words and are rejected by
``few_words``.  Repeated rows are judged alike; further columns pass through
untouched.  Words are runs of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

#: Documents that costs and selectivities are estimated on, at most.
SAMPLE_ROWS = 2048
WINDOW = 5

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_SYMBOL)).cast("long")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def lines_of(text: Column) -> Column:
    """Lines with a word in them."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _let(lines_of(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _covered(starts: Column) -> Column:
    """Words under the windows that begin at these ascending positions."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, zero, lambda a, at: F.struct(
        (a["total"] + F.least(F.lit(WINDOW), at - a["last"])).alias("total"), at.alias("last")), lambda a: a["total"])


def _repeated(windows: Column) -> Column:
    """Words under windows whose value occurs again: neighbours in sorted order are equal."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(pairs, lambda s: _covered(F.sort_array(F.transform(
        F.filter(F.transform(s, lambda x, j: F.struct(
            x["i"].alias("i"),
            (F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
             | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]),
        lambda x: x["i"]))))


def n_repeat_words(words: Column) -> Column:
    """Words inside a five-word window that occurs twice or more in the text, the first included."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    counted = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_repeated(w)))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(counted).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is true for documents that the rule throws out."""

    name: str
    rejects: Callable[[Column, Column], Column]


#: Reject conditions of the production rule set.
RULES = (
    Rule("few_words", lambda text, words: F.size(words) < 10),
    Rule("repeated_words", lambda text, words: 100 * n_repeat_words(words) > 20 * F.size(words)),
    Rule("symbols", lambda text, words: 100 * n_symbols(text) > 15 * F.size(words)),
    Rule("repeated_lines", lambda text, words: _let(
        lines_of(text), lambda lines: 100 * (F.size(lines) - F.size(F.array_distinct(lines))) > 50 * F.size(lines))),
    Rule("word_length", lambda text, words: (word_chars(words) < 2 * F.size(words)) | (word_chars(words) > 20 * F.size(words))),
    Rule("shouting", lambda text, words: 2 * F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{Lu}]", ""))
         > F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]", ""))),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejected: float   # share of the sample
    seconds: float    # time that the condition adds on the sample


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Rules in the order of rejections per cost, estimated on the first ``rows`` ids in hash order."""
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).distinct()
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").limit(rows), "rule-sample")

    def timed(condition: Column) -> tuple[float, float]:
        began = time.perf_counter()
        row = (sample.select("text", words_of(F.col("text")).alias("words"))
               .agg(F.count_if(condition).alias("rejected"), F.count("*").alias("n"), F.sum(F.size("words"))).first())
        return (row.rejected / row.n if row.n else 0.0), time.perf_counter() - began

    timed(F.lit(False))
    _, floor = timed(F.lit(False))
    found = []
    for rule in rules:
        rejected, seconds = timed(rule.rejects(F.col("text"), F.col("words")))
        found.append(Estimate(rule, rejected, max(seconds - floor, 1e-3)))
    return sorted(found, key=lambda e: (-e.rejected / e.seconds, e.seconds, e.rule.name))


def cascade(ordered: list[Estimate], text: Column, words: Column) -> Column:
    """Name of the first rule that rejects, in the given order; null for kept documents."""
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for e in ordered:
        case = case.when(F.coalesce(e.rule.rejects(text, words), F.lit(False)), F.lit(e.rule.name))
    return case


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``rejected_by``: the rule that rejects each document, or null."""
    ordered = plan(docs, rules, rows)
    # the words are bound inside the expression: a filter on the verdict that Catalyst
    # pushes below a projection of them would split the text anew for every use
    return docs.withColumn("rejected_by", _let(words_of(F.col("text")), lambda words: cascade(ordered, F.col("text"), words)))


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Word, symbol, line and repeat counts of every document, the base verdict and the cascade's."""
    ordered = plan(docs, rules, rows)
    counted = (docs.select("doc_id", "text", words_of(F.col("text")).alias("words"))
               .select("doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
                       word_chars(F.col("words")).alias("word_chars"), n_symbols(F.col("text")).alias("n_symbols"),
                       n_dup_lines(F.col("text")).alias("n_dup_lines"), n_repeat_words(F.col("words")).alias("n_repeat_words")))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    later = [e for e in ordered if e.rule.name not in ("few_words", "repeated_words")]  # the base has judged these
    return (counted.withColumn("base_failed", base)
            .withColumn("kept", F.when(F.col("base_failed"), F.lit(False))
                        .otherwise(cascade(later, F.col("text"), F.col("words")).isNull()))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
