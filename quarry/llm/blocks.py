"""Documents in blocks: bounded groups that ask hash buckets a question and get answers.

Several operators need, for every string in a document, something that only
the whole corpus knows.  Shuffling one row per occurrence costs several times
the input; here each block of documents first reduces its strings to distinct
ones, sends them to buckets as packed arrays, and the buckets answer in kind.

A block is about ``BLOCK_BYTES`` of texts that one scan task read together,
written once as a compressed row in the shared folder, so that later steps
see the same blocks whatever is recomputed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.session import materialize

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20


def pack_table(table: pa.Table | pa.RecordBatch) -> bytes:
    """The table as compressed bytes."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def unpack_table(raw) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(raw)).read_all()


def pack_arrays(**arrays: np.ndarray) -> bytes:
    """Named arrays of any lengths as compressed bytes."""
    names = list(arrays)
    sizes = pa.array([len(arrays[n]) for n in names], pa.int64())
    columns = [pa.array([arrays[n].tobytes()], pa.large_binary()) for n in names]
    return pack_table(pa.RecordBatch.from_arrays([pa.array([sizes.to_pylist()]), *columns], names=["__n", *names]))


def unpack_arrays(raw, **kinds) -> list[np.ndarray]:
    """The arrays written by :func:`pack_arrays`, by name and dtype."""
    table = unpack_table(raw)
    return [np.frombuffer(table.column(n)[0].as_buffer(), k) for n, k in kinds.items()]


def make_blocks(docs: DataFrame, name: str, size: int = BLOCK_BYTES) -> DataFrame:
    """(block, n_bytes, docs): all columns of ``docs``, packed, as a written table."""
    return materialize(blocks_of(docs, size), name)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, int, pa.Table]]:
    """(block, n_bytes, documents) of a task's documents, block by block."""
    from pyspark import TaskContext

    part, seq, held, bulk = TaskContext.get().partitionId(), 0, [], 0

    def flush():
        nonlocal held, bulk, seq
        table = pa.Table.from_batches(held).combine_chunks()
        # the number tells blocks apart and changes with their content
        number = int(tc.mix64(np.array([part << 32 | seq], np.uint64), zlib.crc32(repr((table.slice(0, 1).to_pydict(), table.num_rows, bulk)).encode()))[0] >> np.uint64(1))
        block = number, bulk, table
        held, bulk, seq = [], 0, seq + 1
        return block

    for batch, texts in tc.chunks(batches, limit=size):
        bytes_in = int(tc.text_bytes(texts)[1][-1])
        if held and bulk + bytes_in > size:
            yield flush()
        held.append(batch)
        bulk += bytes_in
    if held:
        yield flush()


def blocks_of(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """(block, n_bytes, docs) that is not written: the same blocks again only if ``docs`` reads alike."""
    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, bulk, table in _blocks(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([bulk], pa.int64()), pa.array([pack_table(table)], pa.binary())],
                names=["block", "n_bytes", "docs"])

    return docs.mapInArrow(grouped, "block long, n_bytes long, docs binary")


def buckets_for(total: int, size: int = BUCKET_BYTES) -> int:
    """Buckets so that each gets the strings of about ``size`` bytes of text."""
    return int(max(8, total // size))


def bucket_count(blocks: DataFrame, size: int = BUCKET_BYTES) -> int:
    return buckets_for(blocks.agg(F.sum("n_bytes").alias("n")).first().n or 0, size)


def by_bucket(bucket: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of rows by bucket, and where each bucket begins in it (and the last ends)."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(count + 1))


def _message(block: int, bucket: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([payload], pa.binary())],
        names=["block", "bucket", "payload"])


def ask(blocks: DataFrame, question: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(block, bucket, payload) that ``question`` yields for each block's table."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                for bucket, payload in question(unpack_table(batch.column(1)[i].as_buffer())):
                    yield _message(block, bucket, payload)

    return blocks.select("block", "docs").mapInArrow(run, "block long, bucket int, payload binary")


def ask_documents(docs: DataFrame, question: Callable[[pa.Table], Iterator[tuple[int, bytes]]], size: int = BLOCK_BYTES) -> DataFrame:
    """``ask(blocks_of(docs, size), question)`` in one Python worker a task: two would both stay in an executor's memory."""
    def run(batches):
        for block, _, table in _blocks(batches, size):
            if asked := list(question(table)):  # a batch of its own for each message costs more than a small message
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(asked), pa.int64()), pa.array([b for b, _ in asked], pa.int32()), pa.array([p for _, p in asked], pa.binary())],
                    names=["block", "bucket", "payload"])

    return docs.mapInArrow(run, "block long, bucket int, payload binary")


def answer(asked: DataFrame, reply: Callable[[list[int], list[pa.Buffer]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(block, bucket, payload): ``reply`` sees all payloads of a bucket, in block order, and yields (block, payload)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        payloads = [x.as_buffer() for x in table.column("payload")]
        got = list(reply(table.column("block").to_pylist(), payloads))
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([b for b, _ in got], pa.int64()),
                         "bucket": pa.array([bucket] * len(got), pa.int32()),
                         "payload": pa.array([p for _, p in got], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, payload binary")


def check_block(left: pa.Table) -> None:
    """Answers without their block mean that the documents were read differently the second time."""
    if not left.num_rows:
        raise RuntimeError("the documents changed between two reads: write them to a table first")


def with_answers(blocks: DataFrame, answers: DataFrame, use: Callable[[pa.Table, dict[int, pa.Buffer]], pa.Table],
                 schema: str) -> DataFrame:
    """``use(documents, {bucket: payload})`` for every block, with or without answers."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        check_block(left)
        found = {b.as_py(): p.as_buffer() for b, p in zip(right.column("bucket"), right.column("payload"), strict=True)}
        return use(unpack_table(left.column("docs")[0].as_buffer()), found)

    return (blocks.select("block", "docs").groupBy("block")
            .cogroup(answers.select("block", "bucket", "payload").groupBy("block"))
            .applyInArrow(run, schema))
