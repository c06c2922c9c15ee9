"""The corpus pipeline against the plain versions of its stages, and the queries' oracles."""

import zlib

import duckdb
import numpy as np
import pytest

import brute
import corpus_pipeline
from quarry.llm import pieces, queries

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    import sentencepiece
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(d, t) for d, t in docs if brute.rules(t)[-1]]
    low = {d: c for d, _, c in _plain_components(docs, 80)}
    docs = [(d, t) for d, t in docs if low[d] == d]
    docs = [(d, bytes(x for x, y in zip(b, gone) if not y).decode("utf-8", "ignore")) for d, b, gone in brute.repeats(docs)]
    docs = [(d, t) for (d, t), row in zip(docs, brute.contamination(docs, items)) if not row[-1]]
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = sorted((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True, ids) for d, ids in ((d, sp.encode(t)) for d, t in docs))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and 50 < len(got) < 200


def _plain_components(docs, threshold):
    """(id, set size, smallest id of the group) of each row, linked from this threshold on."""
    sets = [brute.shingles(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min(d for (d, _), h in zip(docs, group) if h == g) for g in set(group)}
    return [(d, len(x), low[g]) for (d, _), x, g in zip(docs, sets, group)]


def _plain_near_dedup(docs, threshold):
    return sorted(d for d, _, low in _plain_components(docs, threshold) if d == low)


def test_near_dedup_links_from_080_on(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    base = [f"w{i}" for i in range(200)]
    for k, edits in enumerate(([20, 60, 100, 140], [20, 60, 100], [20, 60, 100, 140, 180])):   # similarity 0.81, 0.86, 0.77
        docs.append((10_000 + k, " ".join(f"e{k}x{i}" if i in edits else w for i, w in enumerate(base))))
    docs.append((9_999, " ".join(base)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, table, SF).collect())
    assert got == _plain_near_dedup(docs, 80) != _plain_near_dedup(docs, 85)
    assert 10_000 not in got and 10_002 in got


def test_near_dedup_names_rows_by_id_and_text(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(20)) for x in "abcde")
    docs = [(1, a), (1, a), (1, b), (2, b), (2, c), (None, c), (None, d), (None, d), (None, e), (3, e), (4, ""), (5, None)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), SF)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, a), (1, b), (2, c), (None, d), (3, e), (4, ""), (5, None)], key=repr)


def test_stages_on_odd_rows(spark, odd, as_table):
    docs = as_table(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == odd.columns, name
        out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_stages_keep_columns_named_like_inner_ones(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "a", "b", "c"), (2, text, "d", "e", "f"), (3, "", "g", "h", "i")],
                                 "doc_id long, text string, rejected_by string, kept_row string, _kept_row string")
    assert [tuple(r) for r in corpus_pipeline.quality_rules(spark, docs, SF).orderBy("doc_id").collect()] == [
        (1, text, "a", "b", "c"), (2, text, "d", "e", "f")]
    assert [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF).orderBy("doc_id").collect()] == [
        (1, text, "a", "b", "c"), (3, "", "g", "h", "i")]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    want = sorted(map(repr, want.fetchall()))
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want
