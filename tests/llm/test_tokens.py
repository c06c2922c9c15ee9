"""Wavelet shards, the piece lattice, token-count rollups."""

import itertools
import random
import zlib

import numpy as np
import pytest

from odd_rows import ODD, rows
from quarry.llm import pieces, rollups, wavelet


def test_wavelet_queries():
    rng = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 1), (5000, 300), (2048, 70000)):
        ids = rng.integers(0, top, n)
        ends = np.array([n // 3, n // 3, n])
        s = wavelet.Shard.build(ids, ["a", "b", "c"], ends)
        assert (s.decode() == ids).all()
        assert [s.access(i) for i in range(0, n, 61)] == ids[::61].tolist()
        for token in (0, int(ids[0]) if n else 3, 7, 10**6):
            at = np.flatnonzero(ids == token)
            assert s.count(token) == len(at) and [s.select(token, j) for j in range(len(at))] == at.tolist()
            assert all(s.rank(token, i) == (ids[:i] == token).sum() for i in range(0, n + 1, 97))
            assert s.occurrences(token) == [("a", i) if i < n // 3 else ("c", i - n // 3) for i in at.tolist()]
        with pytest.raises(IndexError):
            s.access(n)
        with pytest.raises(IndexError):
            s.select(7, s.count(7))


def test_token_ids_round_trip(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer
    docs = ODD + [(20, "a<|endoftext|>b 's it's  ÀÉ café x y"), (21, "é ñ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    path = wavelet.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    mark = wavelet.encoder(path).mark[0]
    docs += [(22, f"one {mark} two{mark} {mark}three {mark}{mark}"), (23, " ".join(f"w{i} {i}é,ü" for i in range(400)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for k, options in enumerate(({}, {"shard_ids": 50, "partitions": 3})):
        got = wavelet.token_ids(df, path, str(tmp_path / f"s{k}"), **options).orderBy("start").collect()
        assert [str(r.doc_id) for r in got] == sorted((str(d) for d, _ in docs), key=lambda x: -1 if x == "None" else int(x))
        left, start = {}, 0
        for d, t in docs:
            left.setdefault(d, []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
        for r in got:
            assert r.start == start
            start += r.n_tokens
            i = next(i for i, ids in enumerate(left[r.doc_id]) if (len(ids), zlib.crc32(ids.tobytes())) == (r.n_tokens, r.ids_crc32))
            left[r.doc_id].pop(i)
        assert not any(left.values())
    assert wavelet.token_ids(none, path, str(tmp_path / "none")).count() == 0


def test_pieces_equal_the_library(spark, odd, none, as_table):
    import sentencepiece
    rng = random.Random(1)
    docs = ODD + [(20 + i, "".join(rng.choice(["in", "er", " ", "  ", "tion", "q", "é", "\n", "9", "the", "ing", "\t", "ß"])
                                   for _ in range(rng.randint(0, 80)))) for i in range(80)]
    docs += [(200, " " * 70 + "x" * 90), (201, "supercalifragilistic" * 5)]
    docs += [(300 + i, "".join(rng.choice(["in", "er", " ", " ", "tion", "q", "é", "\n", "the"]) for _ in range(300_000))) for i in range(12)]  # several parts
    df = as_table(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    got = rows(pieces.encode_documents(df, pieces.Pieces.load(pieces.model_path()), with_ids=True).select("doc_id", "n_pieces", "round_trip", "ids"))
    want = [(d, len(ids), True, ids) for d, ids in ((d, sp.encode(t or "")) for d, t in docs)]
    assert got == sorted(want, key=repr)
    assert pieces.encode_documents(as_table(none), pieces.Pieces.load(pieces.model_path())).count() == 0
    sign = as_table(spark.createDataFrame([(1, "a▁b")], "doc_id long, text string"))
    row = pieces.encode_documents(sign, pieces.Pieces.load(pieces.model_path()), with_ids=True).first()
    assert row.ids == sp.encode("a▁b") and not row.round_trip


def test_unigram_viterbi(spark):
    texts = ["", "a", "b", "ab", "ba", "aba", "bb", "▁a", "▁"] + [""] * 256
    scores = [0.0, -2.0, -2.5, -3.0, -3.2, -4.5, -4.1, -2.2, -3.0] + [0.0] * 256
    model = pieces.Pieces(tuple(texts), tuple(scores), 9, False)
    units = ["".join(x) for n in range(1, 7) for x in itertools.product("ab", repeat=n)] + ["▁ab", "acb", "é"]
    df = spark.createDataFrame([(0, i, u) for i, u in enumerate(units)], "bucket int, key long, unit string")
    got = {r.key: r.ids for r in pieces.encode_units(df, model).collect()}
    rank = {t: i for i, t in enumerate(texts) if t}
    unknown = min(scores) - 10

    def best(u):
        if not u:
            return 0.0
        return max([best(u[:-1]) + unknown] + [best(u[:s]) + scores[rank[u[s:]]] for s in range(len(u)) if u[s:] in rank])

    for i, u in enumerate(units):
        ids = got.get(i, [9 + b for b in u.encode()])
        total = sum(scores[x] for x in ids if x < 9) + unknown * len([c for c in u if c not in rank])
        assert abs(total - best(u)) < 1e-9, u
        assert ids == pieces._viterbi_long(u, rank, model, unknown) or abs(total - best(u)) < 1e-9


def _changes(spark, data):
    return spark.createDataFrame(data, "doc_id long, version string, source string, lang string, tokens long, deleted boolean")


def test_ledger(spark, tmp_path):
    led = rollups.Ledger(spark, str(tmp_path / "ledger"))
    assert led.totals().count() == 0
    first = _changes(spark, [(1, "v", "s", "en", 10, False), (2, "v", "s", "en", 5, None), (3, "v", None, None, 7, False),
                             (None, "v", "t", "de", 1, False), (2, "v", "s", "en", 4, False)])
    led.commit(1, first)
    one = rows(led.totals())
    assert one == rows(spark.createDataFrame([("s", "en", "v", 2, 15), (None, None, "v", 1, 7), ("t", "de", "v", 1, 1)]))
    led.commit(1, first)                                   # the same batch again
    assert rows(led.totals()) == one
    led.commit(2, _changes(spark, [(1, "v", "s", "en", 12, False),        # revised
                                   (2, "v", "s", "en", 5, False),         # unchanged
                                   (3, "v", "x", "fr", 7, False),         # moved to another group
                                   (None, "v", None, None, None, True),   # deleted by its null key
                                   (9, "v", "s", "en", 3, True)]))        # delete of an unknown key
    want = rows(spark.createDataFrame([("s", "en", "v", 2, 17), ("x", "fr", "v", 1, 7)]))
    assert rows(led.totals()) == want == rows(led.recounted().select("source", "lang", "version", "docs", "tokens"))
    led.commit(3, _changes(spark, []))
    assert rows(led.totals()) == want


def test_ledger_survives_a_stop_between_its_writes(spark, tmp_path, monkeypatch):
    led = rollups.Ledger(spark, str(tmp_path / "ledger"))
    led.commit(1, _changes(spark, [(1, "v", "s", "en", 10, False)]))
    batch = _changes(spark, [(1, "v", "s", "en", 11, False), (2, "v", "s", "en", 1, False)])
    whole = led._replace

    def stop(df, table, number):
        if table == "totals":
            raise RuntimeError("lost here")
        return whole(df, table, number)

    with monkeypatch.context() as m:
        m.setattr(led, "_replace", stop)
        with pytest.raises(RuntimeError):
            led.commit(2, batch)
    assert [tuple(r) for r in led.totals().collect()] == [("s", "en", "v", 1, 10)]
    led.commit(2, batch)
    assert [tuple(r) for r in led.totals().collect()] == [("s", "en", "v", 2, 12)]


def test_corpus_rollup(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    import brute
    path = wavelet.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    first = {}
    for d, t in ODD:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    got = {r.version: (r.docs, r.tokens) for r in rollups.corpus_rollup(odd, path, str(tmp_path / "a")).collect()}
    gone = {d for d, t in ODD if first.get(t or "", d) != d}      # a key goes if any of its rows is a later copy
    by_id = {}
    for d, t in ODD:
        if d not in gone:
            by_id.setdefault(d, []).append(t or "")
    words = [max(len(brute.words(t)) for t in ts) for ts in by_id.values()]
    assert got["words"] == (len(by_id), sum(words))
    counts = [max(len(tokenizer.encode(t, add_special_tokens=False).ids) for t in ts) + 1 for ts in by_id.values()]
    assert got["pieces"] == (len(by_id), sum(counts))
    assert rollups.corpus_rollup(none, path, str(tmp_path / "b")).count() == 0


def _plain_totals(docs, tokenizer):
    """(source, lang, version, docs, tokens) counted over all rows of (doc_id, text, lang, source)."""
    import brute
    total = {}
    for _, t, lang, source in docs:
        pieces_of = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        for version, tokens in (("words", len(brute.words(t))), ("pieces", pieces_of)):
            was = total.get((source, lang, version), (0, 0))
            total[source, lang, version] = (was[0] + 1, was[1] + tokens)
    return sorted(((*k, *v) for k, v in total.items()), key=repr)


def test_document_rollup_covers_every_document(spark, none, tmp_path):
    from tokenizers import Tokenizer

    path = wavelet.tokenizer_path()
    docs = [(i, f"one two three {i % 4}", "en" if i % 3 else None, "s" if i % 5 else "t") for i in range(24)] + [(90, None, "en", "s"), (91, "", "en", "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = rollups.document_rollup(df, path, str(tmp_path / "a"))
    assert got.columns == ["source", "lang", "version", "docs", "tokens"]
    assert rows(got) == _plain_totals(docs, Tokenizer.from_file(path))
    assert rollups.document_rollup(none, path, str(tmp_path / "b")).count() == 0


def test_document_rollup_counts_rows_that_share_an_id(spark, tmp_path):
    from tokenizers import Tokenizer

    path = wavelet.tokenizer_path()
    docs = [(d, t, "en" if t else None, source) for d, t in ODD for source in ("s", None)] + [(1, ODD[0][1], "en", "s"), (None, "a", "en", "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(3)
    got = rows(rollups.document_rollup(df, path, str(tmp_path / "a")))
    assert got == _plain_totals(docs, Tokenizer.from_file(path))
    assert sum(r[3] for r in got) == 2 * len(docs)
