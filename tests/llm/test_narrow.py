"""Narrow keys and bounded blocks."""

import re
import tracemalloc
from types import SimpleNamespace
from unittest import mock

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import types as T

from odd_rows import rows
from quarry.llm import blocks as bl
from quarry.llm import pieces, rollups, suffixdedup, wavelet


def test_text_hash_is_kept_as_bytes(odd):
    counts = rollups.token_counts(odd, wavelet.tokenizer_path())
    assert isinstance(counts.schema["copy"].dataType, T.BinaryType)
    assert {len(r.copy) for r in counts.select("copy").collect()} == {32}


def test_blocks_with_ids_may_be_smaller(odd, as_table, monkeypatch):
    model = pieces.Pieces.load(pieces.model_path())
    docs = as_table(odd)
    plain = rows(pieces.encode_documents(docs, model, with_ids=True))
    assert pieces.IDS_BLOCK_BYTES < pieces.BLOCK_BYTES
    monkeypatch.setattr(pieces, "IDS_BLOCK_BYTES", 1 << 10)
    assert rows(pieces.encode_documents(docs, model, with_ids=True)) == plain
    assert rows(pieces.encode_documents(docs, model)) == sorted((r[:4] for r in plain), key=repr)


def test_decoding_takes_little_more_than_its_result():
    model = pieces.Pieces.load(pieces.model_path())
    ids = np.random.default_rng(0).integers(300, 20_000, 500_000).astype(np.uint32)
    model.decode(ids[:10])
    tracemalloc.start()
    try:
        back = model.decode(ids)[0]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert back.tobytes() == b"".join(model.texts[i].replace(pieces.SPACE, " ").encode() for i in ids.tolist())
    assert peak < 4 * len(back)


def test_a_block_of_documents_is_handled_part_by_part(monkeypatch):
    """What a worker holds beside a block, its ids and its answers is a part's, not the block's."""
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    model, count = pieces.Pieces.load(pieces.model_path()), 4
    rng = np.random.default_rng(0)
    said = [f"word{i}" for i in range(3000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(800)), "text": [" ".join(said[i] for i in rng.integers(0, 3000, 1000)) for _ in range(800)]})
    size = sum(map(len, docs["text"].to_pylist()))
    assert 6 << 20 < size < pieces.IDS_BLOCK_BYTES
    rank = {t: i for i, t in enumerate(model.texts) if t}
    left = pa.Table.from_batches(pieces._packed(pieces.IDS_BLOCK_BYTES)(iter([docs])))
    blocks, buckets, payloads = [], [], []
    for asked in pieces._units_asked(count, pieces.IDS_BLOCK_BYTES)(iter([docs])):
        text, first, width, _ = pieces._asked_units(asked["payload"][0].as_buffer())
        lists = [pieces._merge_long(text[a:a + n].tobytes().decode().replace(" ", pieces.SPACE), rank, model)
                 for a, n in zip(first.tolist(), width.tolist(), strict=True)]
        blocks.append(asked["block"][0].as_py())
        buckets.append(asked["bucket"][0].as_py())
        payloads.append(bl.pack_arrays(n=np.array([len(x) for x in lists], np.uint32), ids=np.array(sum(lists, []), np.uint32)))
    right = pa.table({"block": blocks, "bucket": buckets, "payload": pa.array(payloads, pa.binary())})
    use = pieces._documents_of(count, model, True)
    use(left, right)                                            # what is loaded once
    tracemalloc.start()
    try:
        got = use(left, right)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.num_rows == 800 and all(got["round_trip"].to_pylist()) and got["doc_id"].to_pylist() == list(range(800))
    assert got["ids"][799].as_py() == sum((pieces._merge_long(pieces.SPACE + w, rank, model) for w in docs["text"][799].as_py().split()), [])
    assert len(got.to_batches()) == left.num_rows >= size / pieces.PART_BYTES
    assert peak < 5 * size


def test_units_asked_in_many_parts_are_distinct(monkeypatch):
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(pieces, "PART_BYTES", 64)
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(12)) for i in range(200)] + [None, ""]
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    found = []
    for asked in pieces._units_asked(3, 1 << 20)(iter([docs])):
        text, first, width, key = pieces._asked_units(asked["payload"][0].as_buffer())
        assert (np.diff(key.astype(object)) > 0).all()          # by key, as the answers are
        found += [text[a:a + n].tobytes().decode() for a, n in zip(first.tolist(), width.tolist(), strict=True)]
    assert sorted(found) == sorted({" " + w for t in texts if t for w in t.split()})


def _python_steps(df):
    """Python operators between the exchanges of a plan, at most."""
    most = now = 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():  # from the result down to the scan, as no join is in it
        now = 0 if "Exchange" in line else now + bool(re.search("InArrow|InPandas|EvalPython", line))
        most = max(most, now)
    return most


def test_documents_are_asked_by_one_python_worker_a_task(odd, as_table):
    docs = as_table(odd)

    def question(table):
        yield table.num_rows % 3, bl.pack_table(table.select(["doc_id", "text"]))

    once = bl.ask_documents(docs, question, 1 << 10)
    assert _python_steps(once) == 1
    twice = bl.ask(bl.blocks_of(docs, 1 << 10), question)
    got, want = (sorted((r.block, r.bucket, bl.unpack_table(r.payload).to_pylist()) for r in df.collect()) for df in (once, twice))
    assert len(got) > 1 and got == want
    asked = []
    with mock.patch.object(bl, "answer", lambda x, reply: asked.append(x) or x):
        suffixdedup.deduplicate(docs)
    assert _python_steps(asked[0]) == 1


def test_the_piece_table_needs_no_python_in_executors(spark):
    model = pieces.Pieces.load(pieces.model_path())
    table = model.table(spark)
    assert table.dtypes == [("piece", "string"), ("id", "int"), ("score", "double"), ("place", "bigint")]
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r.piece, r.score) for r in table.collect()}
    assert got == {i: (t, float(model.scores[i])) for i, t in enumerate(model.texts) if t}
