"""Exact duplicates by content-defined chunk recipes.

*Chunks*.  A text, as UTF-8 with A-Z folded, is cut where a rolling hash of the
last 16 bytes has ``CUT_BITS`` zero bits, but not before ``MIN_CHUNK`` bytes
and at the latest after ``MAX_CHUNK``.  The cuts depend on the content alone,
so equal texts are cut alike, and passages that texts share become shared
chunks.

*Identifiers*.  A chunk's identifier is its 128-bit digest, once verified: Spark
groups the chunks by digest and content, and a task sends each different chunk
once, however many of its texts have it.  If a digest has two contents it is
no identifier, and all is digested anew under another salt with twice the bits
(512 at most); so in the result equal identifiers mean equal bytes, without a
probability.

*Recipes*.  A text's recipe is the ordered list of its chunks' identifiers.
From here on only recipes move, never texts: rows are grouped by recipe, and
each row finds its group again by a join in which a recipe of very many rows
is split over ``SALTS`` tasks.

Rows that equal the one that stays in text and id (repeated rows) are all
marked ``kept``; a null id is smaller than any other and stays only if no row
of the group has one.  Null texts count as empty, and empty texts (an empty
recipe) are equal to each other.  No rows, no result.  Further columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.session import materialize

MIN_CHUNK, MAX_CHUNK = 512, 16384
#: One position in 2^11 is a cut, so a chunk has about 2.5 KB.
CUT_BITS = 11
#: Bits of a chunk's digest.
DIGEST_BITS = 128
#: Recipes of more rows than this are joined in as many pieces as SALTS says.
HOT_ROWS, SALTS = 4096, 64

_U = np.uint32
#: A random word per byte value, from a rule.
_GEAR = (tc.mix64(np.arange(256, dtype=np.uint64), 77) >> np.uint64(32)).astype(_U)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ends of the chunks of each text, as positions in ``data``."""
    h = _GEAR[data]
    with np.errstate(over="ignore"):
        for step in (1, 2, 4, 8):          # after this, h covers 16 bytes
            h[step:] = h[step:] + (h[:-step] << _U(step))
    at = np.flatnonzero((h >> _U(32 - CUT_BITS)) == 0) + 1
    out = []
    first = np.searchsorted(at, offsets[:-1], "right")
    for begin, end, k in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first.tolist()):
        found = []
        while end - begin > MIN_CHUNK:
            k = int(np.searchsorted(at, begin + MIN_CHUNK, "left"))
            stop = min(int(at[k]) if k < len(at) else end, begin + MAX_CHUNK, end)
            if stop == end:
                break
            found.append(stop)
            begin = stop
        if end > begin:
            found.append(end)
        out.append(np.array(found, np.int64))
    return out


def chunked(batches: Iterator[pa.RecordBatch], salt: int, bits: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, list]]]]:
    """Batches with (folded text, [(digest, chunk)]) of each row."""
    for batch, texts in tc.chunks(batches):
        data, offsets = tc.text_bytes(texts)
        raw = data.tobytes().translate(_FOLD)
        rows = []
        for begin, end, stops in zip(offsets[:-1].tolist(), offsets[1:].tolist(), cuts(np.frombuffer(raw, np.uint8), offsets)):
            at, pieces = begin, []
            for stop in stops.tolist():
                piece = raw[at:stop]
                pieces.append((hashlib.blake2b(piece, digest_size=bits // 8, salt=salt.to_bytes(8, "little")).digest(), piece))
                at = stop
            rows.append((raw[begin:end], pieces))
        yield batch, rows


def chunk_table(docs: DataFrame, salt: int, bits: int) -> DataFrame:
    """(digest, chunk): the chunks of every text, each once a batch; the grouping combines them before the shuffle."""
    def run(batches):
        for _, rows in chunked(batches, salt, bits):
            fresh = {pair for _, pieces in rows for pair in pieces}
            if fresh:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in fresh], pa.binary()), pa.array([p for _, p in fresh], pa.binary())], names=["digest", "chunk"])

    return docs.select("text").mapInArrow(run, "digest binary, chunk binary")


def ambiguous(chunks: DataFrame) -> DataFrame:
    """Digests under which two different chunks meet."""
    return chunks.groupBy("digest", "chunk").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")


def recipe_table(docs: DataFrame, salt: int, bits: int) -> DataFrame:
    """(doc_id, text_sha256, recipe, salt) of every row; no texts.  Salts are dealt out in turn."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        seen = 0
        for batch, rows in chunked(batches, salt, bits):
            turn = np.arange(seen, seen + len(rows)) % SALTS
            seen += len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.sha256(t).hexdigest() for t, _ in rows], pa.string()),
                 pa.array([b"".join(d for d, _ in pieces) for _, pieces in rows], pa.binary()), pa.array(turn, pa.int32())],
                names=["doc_id", "text_sha256", "recipe", "salt"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text_sha256 string, recipe binary, salt int")


def verified_recipes(docs: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """(doc_id, text_sha256, recipe, salt) in which equal identifiers stand for equal chunks."""
    salt = 0
    while not ambiguous(chunk_table(docs, salt, bits)).isEmpty():
        salt, bits = salt + 1, min(2 * bits, 512)
    return materialize(recipe_table(docs, salt, bits), "recipes")


def exact_duplicates(docs: DataFrame, bits: int = DIGEST_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``."""
    rows = verified_recipes(docs, bits)
    groups = materialize(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                         .where("group_size > 1"), "recipe-groups")
    # the rows of a hot recipe meet their group in several tasks
    hot = (groups.where(F.col("group_size") > hot_rows)
           .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    found = rows.join(hot, ["recipe", "salt"], "left").drop("salt")
    rest = found.where("group_size is null").drop("keep_id", "group_size")
    rest = rest.join(groups.where(F.col("group_size") <= hot_rows), "recipe", "left")
    out = found.where("group_size is not null").unionByName(rest)
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
