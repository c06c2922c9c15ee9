"""Near duplicates, repeated strings, rules, decontamination, against plain versions."""

import random

import numpy as np
import pytest

import brute
from odd_rows import ODD, rows
from quarry.llm import blocks as bl
from quarry.llm import decontaminate, minhash, rules, suffixdedup


def _group(rng, base, edits, n):
    """Copies of a text with some words replaced."""
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(len(w)), edits if isinstance(edits, int) else rng.choice(edits)):
            w[at] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def _corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    texts = []
    for edits, n in (([0, 1, 2, 3, 4], 60), ([3], 25), ([0], 5)):   # far copies link through near ones
        texts += _group(rng, [word() for _ in range(150)], edits, n)
    long = [word() for _ in range(200)]
    texts += [" ".join(long[:200 - 6 * k]) for k in range(8)]        # a chain of shorter and shorter texts
    texts += [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100)) + ODD


def test_near_duplicates(spark, odd, none):
    docs = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = rows(minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id"))
    assert got == sorted(brute.components(docs), key=repr)
    # no pivots and blocks of a few classes: the same links
    assert rows(minhash.near_duplicates(df, rounds=0, block=3).select("doc_id", "n_shingles", "component_id")) == got
    kept = minhash.near_duplicates(odd).where("kept").select("doc_id")
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, 9, 10, None}
    assert minhash.near_duplicates(none).count() == 0


def test_block_links():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.unique(np.append(rng.choice(base, rng.integers(230, 300), replace=False), rng.integers(0, 2**63, 8).astype(np.uint64))) for _ in range(40)]
    comp = np.arange(40) % 29
    for threshold in (60, 80, 85):
        i, j = minhash.block_links(sets[:15], comp[:15], sets[15:], comp[15:], threshold)
        near = {(a, comp[b]) for a in range(15) for b in range(15, 40) if comp[a] != comp[b] and
                100 * len(np.intersect1d(sets[a], sets[b])) >= threshold * len(np.union1d(sets[a], sets[b]))}
        assert {(a, comp[15 + b]) for a, b in zip(i, j)} == near and len(near) == len(i)
        assert all(100 * len(np.intersect1d(sets[a], sets[15 + b])) >= threshold * len(np.union1d(sets[a], sets[15 + b])) for a, b in zip(i, j))
    assert [len(x) for x in minhash.block_links([], np.zeros(0, int), [], np.zeros(0, int), 85)] == [0, 0]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    both = np.concatenate([a[:1800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    owner = np.repeat([0, 1], 2000)
    s = minhash.signatures(owner, np.concatenate([a, both]), 400)
    assert abs((s[0] == s[1]).mean() - 1800 / 2200) < 0.08


@pytest.mark.parametrize("hot", [0, 1024])
def test_repeated_strings(spark, odd, none, as_table, hot):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(12, 60))) for _ in range(6)] + ["ab" * 60, "z" * 140]
    docs = []
    for d in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 3))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            parts.insert(rng.randrange(len(parts) + 1), p[rng.randrange(0, 30):])
        docs.append((d + 100, "".join(parts)))
    docs += ODD
    df = as_table(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    got = rows(suffixdedup.repeated_bytes(df, hot))
    want = sorted((brute.repeat_row(*x) for x in brute.repeats(docs)), key=repr)
    assert got == want and sum(x[2] for x in want) > 1000
    cut = suffixdedup.deduplicate(as_table(odd), hot)
    assert cut.columns == odd.columns and cut.count() == len(ODD)
    assert suffixdedup.repeated_bytes(as_table(none), hot).count() == 0


def test_segments_cover_every_window_once():
    texts = ["a" * 300, "ab" * 100 + "x" + "ab" * 90, "", "short", ("0123456789" * 3 + "z") * 9, "é" * 49, "q" * 50, "a" * 131]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    document, anchor, first, windows = suffixdedup.segments(data, offsets)
    assert windows.max() <= suffixdedup.MOST
    got = [(d, f + k) for d, f, w in zip(document, first, windows) for k in range(w)]
    assert got == [(d, i) for d in range(len(texts)) for i in range(offsets[d], offsets[d + 1] - 49)]
    by_content = {}
    for a, f, w in zip(anchor, first, windows):
        for k in range(w):
            by_content.setdefault(data[f + k:f + k + 50].tobytes(), set()).add(int(a))
    assert all(len(a) == 1 for a in by_content.values())    # equal windows have equal anchors


def test_periodic_texts(spark, as_table):
    rng = random.Random(11)
    docs = [(d, "".join(rng.choice(["ab", "abc", "a", "xyz" * 20]) * rng.randrange(1, 60) for _ in range(4))) for d in range(60)]
    df = as_table(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(suffixdedup.repeated_bytes(df)) == sorted((brute.repeat_row(*x) for x in brute.repeats(docs)), key=repr)


def test_messages_of_a_large_corpus(spark, as_table, monkeypatch):
    """Buckets for 10 GB of text: a block sends few messages, small beside what is in them, and the rows are the same."""
    real, seen = bl.buckets_for, []
    monkeypatch.setattr(bl, "buckets_for", lambda total, *size: real(10 << 30, *size))
    answer = bl.answer
    monkeypatch.setattr(bl, "answer", lambda asked, reply: seen.append(rows(asked)) or answer(asked, reply))
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdefg ") for _ in range(3000)) for _ in range(3)]
    docs = [(d, "".join(rng.choice("hijklmn ") for _ in range(1500)) + passages[d % 3][rng.randrange(0, 900):]) for d in range(12)]
    df = as_table(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    assert rows(suffixdedup.repeated_bytes(df)) == sorted((brute.repeat_row(*x) for x in brute.repeats(docs)), key=repr)
    for messages in seen:
        n = len({m[0] for m in messages})
        assert n == 2 and len({m[:2] for m in messages}) == len(messages) <= n * (10 << 30) // (32 << 20)
    assert len(seen) == 2 and sum(len(m[2]) for m in seen[1]) < 500 * len(seen[1])   # 50 to 80 bytes of each string


@pytest.mark.parametrize("hot", [0, 1, 1024])
def test_parts_of_a_bucket(spark, as_table, monkeypatch, hot):
    """However the strings are dealt out over buckets and parts, each is judged with all that have its windows."""
    rng = random.Random(5)
    passages = ["".join(rng.choice("abc é") for _ in range(rng.randrange(60, 300))) for _ in range(8)]
    docs = [(rng.choice([d, d, 3, None]), "".join(rng.choice("xyz ") for _ in range(40)) + rng.choice(passages)[rng.randrange(9):] + rng.choice(passages)) for d in range(80)]
    df = as_table(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    want = sorted((brute.repeat_row(*x) for x in brute.repeats(docs)), key=repr)
    for dealt in ((1, 1), (1, 7), (3, 5), (40, 2)):
        monkeypatch.setattr(suffixdedup, "layout", lambda total, dealt=dealt: dealt)
        assert rows(suffixdedup.repeated_bytes(df, hot)) == want


def test_layout():
    assert [suffixdedup.layout(n << 20) for n in (0, 31, 200, 256, 512, 2048, 10240, 10241)] == [
        (8, 1), (8, 1), (50, 1), (64, 1), (64, 2), (64, 8), (320, 8), (320, 8)]
    for n in range(0, 60000, 137):
        count, parts = suffixdedup.layout(n << 20)
        assert (n << 20) / (count * parts) < 5 << 20 and (parts <= 9 or count == 8)


def test_suffix_order():
    rng = np.random.default_rng(2)
    data, start, end = [], [], []
    for _ in range(20):
        start.append(len(data))
        data += list(rng.integers(97, 100, rng.integers(0, 12)))
        end.append(len(data))
        data.append(0)
    raw = bytes(int(x) for x in data)
    order = suffixdedup.suffix_order(np.frombuffer(raw, np.uint8), np.array(start), np.array(end))
    string = np.searchsorted(start, order, "right") - 1
    found = [raw[a:end[s]] for a, s in zip(order, string)]
    assert found == sorted(found) and len(found) == sum(e - s + 1 for s, e in zip(start, end))


def test_rules(spark, odd, none):
    rng = random.Random(6)
    docs = [(d, " ".join(rng.choice(["ab", "CD", "e*f", "ghi\n", "jk"]) for _ in range(rng.randint(0, 40)))) for d in range(100, 200)] + ODD
    got = rows(rules.quality_report(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted(((d, *brute.rules(t)) for d, t in docs), key=repr)
    judged = rules.judge(odd)
    assert judged.columns == [*odd.columns, "rejected_by"]
    verdict = {(r.doc_id, r.text): r.rejected_by is None for r in judged.collect()}
    assert verdict == {(d, t): brute.rules(t)[-1] for d, t in ODD}
    assert rules.quality_report(none).count() == 0 and rules.judge(none).count() == 0


def test_rule_order_does_not_change_the_verdict(spark, odd):
    from pyspark.sql import functions as F
    estimates = rules.plan(odd)
    assert sorted(e.rule.name for e in estimates) == sorted(r.name for r in rules.RULES)

    def verdicts(order):
        kept = rules._let(rules.words_of(F.col("text")), lambda words: rules.cascade(order, F.col("text"), words)).isNull()
        return rows(odd.select("doc_id", kept.alias("kept")))

    assert verdicts(estimates) == verdicts(estimates[::-1])


def test_decontamination(spark, odd, none):
    rng = random.Random(7)
    word = lambda: rng.choice(["the", "of", "and", "é", "x9", *(f"w{i}" for i in range(300))])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 3, 9, 10, 11, 30])))) for i in range(25)]
    items += [(3, "common words the of and"), (90, items[5][1]), (91, None), (None, "one two three"), (92, "one two, THREE four")]
    docs = []
    for d in range(150):
        w = [word() for _ in range(rng.randint(0, 80))]
        if d % 3 == 0:
            p = (rng.choice(items)[1] or "").split()
            w[rng.randrange(len(w) + 1):0] = p[rng.randrange(0, 4):]
        docs.append((d + 100, "; ".join(w).title()))
    docs += ODD
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'w' as words", "'k' as key", "1 as n")
    want = sorted(brute.contamination(docs, items), key=repr)
    assert sum(x[-1] for x in want) > 20
    assert rows(decontaminate.contamination(df, bench)) == want
    assert rows(decontaminate.contamination(df, bench, broadcast_bytes=-1)) == want    # joined by a shuffle
    kept = decontaminate.clean(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {x[0] for x in brute.contamination(ODD, items) if not x[-1]}
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).where("contaminated").count() == 0
