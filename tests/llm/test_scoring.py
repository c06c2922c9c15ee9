"""Quality classifier, toxicity lexicon, class-based language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np

import brute
from odd_rows import ODD
from quarry.llm import brown, quality, toxicity

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split()


def held(d, remainder=0):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == remainder


def prose(rng, n, words=None):
    words = words or ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    return " ".join(rng.choice(words) for _ in range(n))


def labelled(spark, column, bad, n=300):
    rng = random.Random(5)
    docs, labels = [], []
    for d in range(n):
        text = prose(rng, rng.randint(20, 200))
        if d % 3 == 0:
            text = bad(rng, text)
        docs.append((d, text))
        labels.append((d, int((d % 3 == 0) == (column == "toxic"))))
    labels += [(None, 1), (3, None), (7, labels[7][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, f"doc_id long, {column} int"), dict(labels[:n])


def check(scored, truth, threshold):
    got = {r.doc_id: r for r in scored.collect()}
    assert set(got) == set(truth)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == held(d) for d, r in got.items())
    out = [d for d in got if held(d)]
    assert sum(got[d].predicted == truth[d] for d in out) >= 0.97 * len(out)


def test_quality_held_out(spark):
    docs, labels, truth = labelled(spark, "quality", lambda rng, t: " ".join(w + "***" for w in t.split()))
    check(quality.quality_scores(docs, labels), truth, 0.3)


def test_toxicity_held_out(spark):
    def bad(rng, t):
        w = t.split()
        for _ in range(2):
            w.insert(rng.randrange(len(w)), rng.choice(["grobble", "GR0BBLE", "zurkish", "zurkolo"]))
        return " ".join(w)
    docs, labels, truth = labelled(spark, "toxic", bad)
    check(toxicity.toxicity_scores(docs, labels), truth, 0.5)


def test_fold():
    assert toxicity.fold("ѕtu​píd $tupid 1D10T! b2") == " stupid stupid idiot b2 "
    assert toxicity.fold("") == "  "


def test_exception_phrase_cancels(spark):
    lexicon = toxicity.Lexicon({" grob ": 5.0}, {" old grob ": " grob "}, (1.0, 1.0, -3.0))
    df = spark.createDataFrame([(1, "a grob here"), (2, "an old grob here"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, lexicon).collect()}
    assert got[1] > got[2] == got[3]


def test_classifiers_on_odd_rows(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (6, 1, 0), (10, 0, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        for lab in (empty, labels):
            got = scores(odd, lab).collect()
            assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in ODD)
            assert all(0 <= r.score <= 1 for r in got)
            assert len({r.score for r in got if r.doc_id == 5}) == 1
        assert scores(none, labels).count() == 0


def test_exchange_separates_two_languages():
    rng = np.random.default_rng(1)
    k = 22                                   # 10 + 10 words, the end token, all others
    counts = np.zeros((k, k))
    for _ in range(4000):
        side = rng.integers(2) * 10
        run = np.concatenate([[20], side + rng.integers(0, 10, 8), [20]])
        np.add.at(counts, (run[:-1], run[1:]), 1)
    label = brown.exchange(counts, 20, classes=3)
    assert len(set(label[:10])) == 1 and len(set(label[10:20])) == 1 and label[0] != label[10]
    assert label[20] == 0 and label[21] == 3


def test_class_scores(spark, odd, none, as_table):
    rng = random.Random(2)
    lex = [["a" + "".join(rng.choice(SYLLABLES) for _ in range(2)) for _ in range(60)],
           ["z" + "".join(rng.choice(SYLLABLES) for _ in range(2)) for _ in range(60)]]
    rows = [(100 + i, prose(rng, rng.randint(5, 60), lex[i % 2])) for i in range(200)] + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = brown.corpus_scores(df, frequent=40, classes=6).collect()
    tokens = [(d, brute.words((t or "").translate(brute.FOLD)) + ["\n"]) for d, t in rows]
    c = Counter(w for d, ws in tokens if not held(d, 1) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d, 1), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for d, ws in tokens)
    assert want == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    out = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 100]
    assert all(r.score < 0 for r in got) and sum(r.score for r in out) > sum(r.base_score for r in out)
    assert brown.corpus_scores(none).count() == 0
