"""Near-duplicate documents by circulant MinHash, banding and exact verification.

*Signature*: two permutations of the 64-bit integers.  The first spreads the
shingle hashes; the second, shifted by k, gives coordinate k: the minimum of
``pi(sigma(x) - k)`` over the document's shingles.  All coordinates come from
these two.

*Classes*: documents with the same shingle set are one class from the start,
so copies cost one row each and are never paired.

*Banding*: classes whose ``ROWS`` coordinates of a band agree share a bucket.
There are as many bands as it takes for a pair at the threshold to share none
of the buckets with probability under ``MISSED``: 24 at 0.85, 35 at 0.80.

*Verification* on the full sets.  In each bucket every class is compared with
one pivot, the class that shares buckets with the most others, and the links
found are contracted to components; buckets that are one component are done,
and the others do this again without their pivot, ``ROUNDS`` times.  That is
linear in the entries and links the groups of near copies.  In a bucket that
still has several components, all classes outside its largest component are
compared with all others: both are dealt out to blocks of about ``BLOCK``
classes, and a task gets the sets of two blocks and returns links only.  So
each set moves once for each opposite block, the pairs of a bucket are never
listed, and no candidate pair across components is left out.

The result has one row per document; a component's id is its smallest doc_id.
Documents without words have no shingles and are alone.  Rows that repeat an
id are judged by their own texts; ``survivors`` names one row of a component
by id and text hash, where ``kept`` marks every row with the component's id.  A null id is the component's id only if no
other row of the component has one.  Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.llm.components import connected
from quarry.session import materialize

SHINGLE = 5
ROWS = 5
#: Largest probability that a pair at the threshold shares no bucket.
MISSED = 1e-6
#: Similarity in hundredths.
THRESHOLD = 85
#: Rounds of pivots before the rest is compared block by block.
ROUNDS = 3
#: Classes, about, of a block whose sets are in one task together with another block's.
BLOCK = 256

_U = np.uint64
_PI1, _PI2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def bands_for(threshold: int) -> int:
    """Bands of ``ROWS`` coordinates that a threshold in hundredths takes."""
    agree = (threshold / 100) ** ROWS
    return 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of each document, sorted by both.

    A document of fewer words than a shingle has its whole sequence as its one shingle.
    """
    _, _, document, word = tc.words(data, offsets)
    value, first = tc.windows(word, document, SHINGLE)
    owner = document[first]
    begin = tc.runs(document)
    size = np.diff(np.append(begin, len(document)))
    short = begin[size < SHINGLE]
    for n in range(1, SHINGLE):
        whole = begin[size == n]
        if len(whole):
            with np.errstate(over="ignore"):
                total = np.zeros(len(whole), _U)
                for k in range(n):
                    total = total * _U(0xD6E8FEB86659FD93) + word[whole + k]
            value = np.concatenate([value, tc.mix64(total, n)])
            owner = np.concatenate([owner, document[whole]])
    if len(value):
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        keep = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        value, owner = value[keep], owner[keep]
    return owner, value


def signatures(owner: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """The k circulant coordinates of each run of ``owner``."""
    begin = tc.runs(owner)
    out = np.empty((len(begin), k), _U)
    if not len(begin):
        return out
    sigma = tc.mix64(value, 21)
    work, shift = np.empty_like(sigma), np.empty_like(sigma)
    with np.errstate(over="ignore"):
        for j in range(k):
            np.subtract(sigma, _U(j), out=work)
            np.multiply(work, _PI1, out=work)
            np.right_shift(work, _U(29), out=shift)
            np.bitwise_xor(work, shift, out=work)
            np.multiply(work, _PI2, out=work)
            out[:, j] = np.minimum.reduceat(work, begin)
    return out


def _packed(parts: list[np.ndarray], width: int) -> pa.Array:
    """Rows of a 2-d array as binaries of ``width`` bytes."""
    raw = np.ascontiguousarray(np.column_stack(parts)).tobytes()
    n = len(parts[0])
    return pa.Array.from_buffers(pa.binary(width), n, [None, pa.py_buffer(raw)]).cast(pa.binary())


def sketches(docs: DataFrame, n_bands: int) -> DataFrame:
    """doc_id, n_shingles, cid (digest of the set), bands of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        for batch, texts in tc.chunks(batches):
            owner, value = shingle_sets(*tc.text_bytes(texts))
            n = batch.num_rows
            begin = tc.runs(owner)
            size = np.bincount(owner, minlength=n)
            has = np.flatnonzero(size)
            digest = np.zeros((n, 2), _U)
            bands = np.zeros((n, n_bands), _U)
            if len(has):
                with np.errstate(over="ignore"):
                    digest[has, 0] = tc.mix64(np.add.reduceat(tc.mix64(value, 31), begin) + size[has].astype(_U))
                    digest[has, 1] = np.add.reduceat(tc.mix64(value, 37), begin)
                    mins = signatures(owner, value, n_bands * ROWS).reshape(len(has), n_bands, ROWS)
                    total = np.zeros((len(has), n_bands), _U)
                    for r in range(ROWS):
                        total = tc.mix64(total ^ mins[:, :, r], 41)
                    bands[has] = total
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * n_bands), pa.array(bands.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(size.astype(np.int64)),
                 _packed([digest], 16), lists], names=["doc_id", "n_shingles", "cid", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id {kind}, n_shingles long, cid binary, bands array<long>")


def class_sets(docs: DataFrame) -> DataFrame:
    """(cid, shingles): the sorted set of each of the given documents, as packed 64-bit integers."""
    def sets(batches):
        for batch, texts in tc.chunks(batches):
            owner, value = shingle_sets(*tc.text_bytes(texts))
            cut = np.searchsorted(owner, np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("cid")),
                 pa.array([v.tobytes() for v in np.split(value, cut)], pa.binary())], names=["cid", "shingles"])

    return docs.select("cid", "text").mapInArrow(sets, "cid binary, shingles binary")


def _both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, x, y): pairs with their sets."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, na, nb): sizes of the intersection and of the two sets, on the full sets."""
    def check(batches):
        for batch in batches:
            both = np.zeros(batch.num_rows, np.int64)
            sizes = np.zeros((2, batch.num_rows), np.int64)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                u, v = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both[i], sizes[0, i], sizes[1, i] = len(np.intersect1d(u, v, assume_unique=True)), len(u), len(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both), pa.array(sizes[0]), pa.array(sizes[1])],
                                             names=["a", "b", "both", "na", "nb"])

    return _both_sets(pairs, sets).mapInArrow(check, "a binary, b binary, both long, na long, nb long")


def linked(threshold: int) -> Column:
    return F.expr(f"100 * both >= {threshold} * (na + nb - both)")


def _several(entries: DataFrame, value: str) -> DataFrame:
    """(band, key, low) of the buckets with more than one value of this column."""
    return (entries.groupBy("band", "key").agg(F.min(value).alias("low"), F.max(value).alias("high"))
            .where("low <> high").select("band", "key", "low"))


def _text_of_classes(docs: DataFrame, sketch: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, text): one document's text for each wanted class."""
    picked = (sketch.join(wanted, "cid", "left_semi").groupBy("cid").agg(F.min("row").alias("row")))
    rows = docs.select(row_key().alias("row"), "text")
    return rows.join(picked, "row").select("cid", "text")


def _contracted(now: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, comp) after the links (a, b) between classes."""
    owner = now.select("cid", "comp")
    pairs = (links.select("a", "b").join(owner.select(F.col("cid").alias("a"), F.col("comp").alias("u")), "a")
             .join(owner.select(F.col("cid").alias("b"), F.col("comp").alias("v")), "b")
             .where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b")).distinct())
    merged = connected(pairs).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return materialize(now.join(merged, "comp", "left").select("cid", F.coalesce("root", "comp").alias("comp")), "components")


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries, with components, of the buckets that hold more than one component."""
    entries = buckets.join(labels, "cid")
    several = (entries.groupBy("b1", "b2").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
               .where("low <> high").select("b1", "b2"))
    return materialize(entries.join(several, ["b1", "b2"]).select("b1", "b2", "cid", "comp"), "open-entries")


def block_links(x_sets: list[np.ndarray], x_comp: np.ndarray, y_sets: list[np.ndarray], y_comp: np.ndarray,
                threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with sets x_i and y_j of different components similar; one j for each i and component of j."""
    size = np.array([len(v) for v in y_sets], np.int64)
    token = np.concatenate([*y_sets, np.zeros(0, _U)])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], np.repeat(np.arange(len(size)), size)[order]
    left, right = [], []
    for i, v in enumerate(x_sets):
        lo, hi = np.searchsorted(token, v, "left"), np.searchsorted(token, v, "right")
        count = hi - lo
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        both = np.bincount(owner[at], minlength=len(size))
        near = np.flatnonzero((100 * both >= threshold * (len(v) + size - both)) & (y_comp != x_comp[i]))
        near = near[np.unique(y_comp[near], return_index=True)[1]]
        left.append(np.full(len(near), i))
        right.append(near)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left + none), np.concatenate(right + none)


def _block_pairs(now: DataFrame, sets: DataFrame, threshold: int, block: int) -> DataFrame:
    """Links (a, b) within buckets that hold several components, compared block by block."""
    per = now.groupBy("b1", "b2", "comp").agg(F.count("*").alias("k"))
    plan = per.groupBy("b1", "b2").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("n")).select(
        "b1", "b2", F.col("top.comp").alias("main"), F.ceil(F.col("n") / block).cast("int").alias("g"),
        F.ceil((F.col("n") - F.col("top.k")) / block).cast("int").alias("gm"))
    rows = now.join(plan, ["b1", "b2"])
    spot = F.xxhash64("cid")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["b1", "b2", "i", "j"]
    left = rows.where("comp <> main").select("b1", "b2", F.pmod(spot, F.col("gm")).cast("int").alias("i"), every("g").alias("j"), "cid", "comp", F.lit(True).alias("x"))
    right = rows.select("b1", "b2", every("gm").alias("i"), F.pmod(spot, F.col("g")).cast("int").alias("j"), "cid", "comp", F.lit(False).alias("x"))
    dealt = left.unionByName(right).join(sets, "cid").select(*keys, "cid", "comp", "x", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        cids, comps = group.column("cid").to_pylist(), group.column("comp").to_pylist()
        number = {c: k for k, c in enumerate(dict.fromkeys(comps))}
        comp = np.array([number[c] for c in comps], np.int64)
        is_x = np.array(group.column("x").to_pylist(), bool)
        every_set = [np.frombuffer(v.as_buffer(), _U) for v in group.column("shingles")]
        xs, ys = np.flatnonzero(is_x), np.flatnonzero(~is_x)
        i, j = block_links([every_set[k] for k in xs], comp[xs], [every_set[k] for k in ys], comp[ys], threshold)
        return pa.table({"a": pa.array([cids[xs[k]] for k in i], pa.binary()), "b": pa.array([cids[ys[k]] for k in j], pa.binary())})

    return dealt.groupBy(*keys).applyInArrow(compare, "a binary, b binary").distinct()


def row_key() -> Column:
    """What names a row: its id and the hash of its text."""
    return F.struct(F.col("doc_id"), F.xxhash64("text"))


def grouped(docs: DataFrame, threshold: int, rounds: int, block: int = BLOCK) -> DataFrame:
    """row, n_shingles, comp of every row of ``docs``; rows without words have no comp."""
    docs = docs.select("doc_id", "text")
    keyed = docs.select(row_key().alias("doc_id"), "text")
    sketch = materialize(sketches(keyed, bands_for(threshold)).withColumnRenamed("doc_id", "row"), "sketches")
    classes = (sketch.where("n_shingles > 0").groupBy("cid")
               .agg(F.first("bands").alias("bands")))
    spread = materialize(classes.select("cid", F.posexplode("bands").alias("band", "key")), "band-entries")
    shared = _several(spread, "cid")
    buckets = materialize(spread.join(shared.select("band", "key"), ["band", "key"])
                          .select(F.col("band").alias("b1"), F.col("key").alias("b2"), "cid"), "buckets")
    sets = materialize(
        class_sets(_text_of_classes(docs, sketch, buckets.select("cid").distinct())).dropDuplicates(["cid"]), "class-sets")

    labels = materialize(buckets.select("cid").distinct().withColumn("comp", F.col("cid")), "components")
    now = _open(buckets, labels)
    for _ in range(rounds):
        size = now.groupBy("b1", "b2").agg(F.count("*").alias("n"))
        weight = now.join(size, ["b1", "b2"]).groupBy("cid").agg(F.sum("n").alias("w"))
        pivot = (now.join(weight, "cid").groupBy("b1", "b2")
                 .agg(F.max(F.struct("w", "cid")).alias("p")).select("b1", "b2", F.col("p.cid").alias("pivot")))
        held = materialize(now.join(pivot, ["b1", "b2"]).where("cid <> pivot"), "pivoted-entries")
        tested = materialize(compared(held.select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct(), sets), "compared")
        labels = _contracted(labels, tested.where(linked(threshold)))
        # the pivot has met all of its bucket; the others go on where they are still apart
        now = _open(held.select("b1", "b2", "cid"), labels)
    labels = _contracted(labels, materialize(_block_pairs(now, sets, threshold, block), "links-within"))

    whole = sketch.where("n_shingles > 0").join(labels, "cid", "left").select("row", "n_shingles", F.coalesce("comp", "cid").alias("comp"))
    return whole.unionByName(sketch.where("n_shingles = 0").select("row", "n_shingles", F.lit(None).cast("binary").alias("comp")))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    rows = grouped(docs, threshold, rounds, block).select(F.col("row.doc_id").alias("doc_id"), "n_shingles", "comp")
    whole = rows.where("comp is not null")
    low = whole.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    kept: Column = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return (whole.join(low, "comp").select("doc_id", "n_shingles", "component_id")
            .unionByName(rows.where("comp is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
            .withColumn("kept", kept))


def survivors(docs: DataFrame, threshold: int = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """row: the key of one row of each component, smallest id first and null last, and of every row without words."""
    rows = grouped(docs, threshold, rounds)
    first = F.min(F.struct(F.col("row.doc_id").isNull(), F.col("row"))).alias("first")
    return (rows.where("comp is not null").groupBy("comp").agg(first).select("first.row")
            .union(rows.where("comp is null").select("row").distinct()))
