"""SentencePiece encoding and decoding as a relational lattice.

A text is cut into units that no piece crosses: a run of spaces with the
word behind it, or a line break.  The distinct units of the corpus are the
rows of a table; each is exploded into its substrings of at most the longest
piece's length, these are joined to the piece table, the edges found are
grouped by unit, and a higher-order ``aggregate`` folds them into the unit's
pieces:

* a unigram model: Viterbi over the unit's positions, the best score first;
* a merge (BPE) model, as ``piece_bpe_32k.model`` is: the best path by score
  sums is not what such a model means (its scores are merge ranks), so the
  fold goes over the edges in rank order (equal ranks from the left) and merges an edge whose two parts
  are the present neighbours.  The state is a bit mask of boundaries.  An
  edge passed over while it spans more than two parts could come up again
  out of order; units with such an edge are folded once more, taking the
  first edge in rank order that can merge until none can.  The ids equal the
  library's.

Characters without a piece become byte pieces.  Decoding maps ids to piece
bytes, drops the leading space and must give back the text, byte by byte.

Blocks of documents send their distinct units to hash buckets, so that a unit
is encoded once however often it occurs, and get the ids back.  A block is at
most ``BLOCK_BYTES`` of what one scan task reads; its texts are handled part by
part.  Questions, units and lattice are partitioned by bucket alike, so that
what a bucket was asked, its edges and its answers stay in one task.  The piece
table is broadcast: its size is the model's, not the data's.  Units of more
symbols than the bit mask holds are encoded by the bucket itself, in Python.

Null and empty texts have no pieces and decode to the empty text.  The space
sign of the piece table is read as a space, as in the library, so a text that
holds it comes back with spaces and ``round_trip`` is false.  Repeated
rows are encoded one by one; further columns are not read.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import blocks as bl
from quarry.llm import textcore as tc

SPACE = "▁"
#: Bytes of corpus text whose distinct units make a bucket.
BUCKET_BYTES = 2 << 20
#: Bytes of text that ask together, and that are handled at once: a part's index arrays are many times its size,
#: and a packed part of more than half a heap region would be an allocation of its own.
BLOCK_BYTES, PART_BYTES = 32 << 20, 512 << 10
#: The same where the result holds the ids themselves, which stay in memory for a whole block.
IDS_BLOCK_BYTES = 8 << 20
#: Symbols of a unit that fit the bit mask of boundaries.
MASK_SYMBOLS = 61

_U = np.uint64


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model."""

    texts: tuple[str, ...]          # by id; "" for control pieces
    scores: tuple[float, ...]
    bytes_at: int                   # id of the byte piece of 0x00
    merges: bool                    # merge (BPE) model; else unigram

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal = 1
        if any(p.type == normal and re.search(f"[^{SPACE}]{SPACE}|\n.|.\n", p.piece) for p in model.pieces):
            raise ValueError("a piece of this model crosses the units that texts are cut into")
        return cls(tuple(p.piece if p.type == normal else "" for p in model.pieces), tuple(p.score for p in model.pieces),
                   next(i for i, p in enumerate(model.pieces) if p.piece == "<0x00>"), model.trainer_spec.model_type == 2)

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, id, score, place): equal scores share a place, the best is 0."""
        places = {s: k for k, s in enumerate(sorted(set(self.scores), reverse=True))}
        at = [i for i, t in enumerate(self.texts) if t]
        # as an Arrow table: rows would be converted by further Python workers in the executors
        return spark.createDataFrame(pa.table({
            "piece": pa.array([self.texts[i] for i in at], pa.string()), "id": pa.array(at, pa.int32()),
            "score": pa.array([float(self.scores[i]) for i in at], pa.float64()),
            "place": pa.array([places[self.scores[i]] for i in at], pa.int64())}))

    @property
    def longest(self) -> int:
        return max(map(len, self.texts))

    @cached_property
    def _raw(self) -> pa.Array:
        """Bytes of every piece, by id."""
        raw = [t.replace(SPACE, " ").encode() for t in self.texts]
        for b in range(256):
            raw[self.bytes_at + b] = bytes([b])
        return pa.array(raw, pa.large_binary())

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces on end, and where each piece begins in them (and the last ends)."""
        return tc.text_bytes(self._raw.take(pa.array(ids)))


# ---- units of a block ------------------------------------------------------

def _units(table: pa.Table):
    """The block's texts with one space before each, as bytes, and their units.

    Returns (bytes, document offsets, document, first, size, key) with one
    entry per unit in text order.
    """
    texts = tc.text_array(table.column("text"))
    data, offsets = tc.text_bytes(pc.replace_substring(texts, SPACE, " "))
    has = np.diff(offsets) > 0
    spaced = np.insert(data, offsets[:-1][has], 0x20)
    offsets = offsets + np.concatenate(([0], np.cumsum(has)))
    if not len(spaced):
        none = np.zeros(0, np.int64)
        return spaced, offsets, none, none, none, np.zeros(0, _U)
    space, line = spaced == 0x20, spaced == 0x0A
    begin = np.zeros(len(spaced), bool)
    begin[offsets[:-1][has]] = True
    before_space = np.concatenate(([False], space[:-1])) & ~begin
    before_line = np.concatenate(([False], line[:-1])) | begin
    start = np.flatnonzero(line | (space & ~before_space) | (~space & before_line))
    size = np.diff(np.append(start, len(spaced)))
    document = np.searchsorted(offsets, start, "right") - 1
    return spaced, offsets, document, start, size, tc.piece_hash(tc.loads(spaced), start, size)


def _bucket(key: np.ndarray, count: int) -> np.ndarray:
    return (tc.mix64(key, 23) % _U(count)).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, pa.Table]]:
    """(block, documents): the scan task's documents in parts, and the number of the block that each belongs to."""
    from pyspark import TaskContext

    task, seq, block, bulk, held, size = TaskContext.get().partitionId(), 0, None, 0, [], 0
    for batch, texts in tc.chunks(batches, limit=PART_BYTES):
        n = int(tc.text_bytes(texts)[1][-1])
        full = block is None or bulk + n > block_bytes
        if held and (full or size + n > PART_BYTES):
            yield block, pa.Table.from_batches(held)
            held, size = [], 0
        if full:  # the number tells blocks apart and changes with their first row
            first = zlib.crc32(repr(batch.slice(0, 1).to_pydict()).encode())
            block = int(tc.mix64(np.array([task << 32 | seq], _U), first)[0] >> _U(1))
            seq, bulk = seq + 1, 0
        held.append(batch)
        size, bulk = size + n, bulk + n
    if held:
        yield block, pa.Table.from_batches(held)


def _gather(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` entries from each start, on end."""
    total = np.cumsum(n)
    return data[np.repeat(start - (total - n), n) + np.arange(int(total[-1]) if len(total) else 0)]


def _one_each(key: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray):
    """(keys, size, text) of the distinct units, by key."""
    keys, sample = np.unique(key, return_index=True)
    return keys, size[sample], _gather(data, start[sample], size[sample])


def _merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct units of several (keys, size, text)."""
    if len(held) == 1:
        return held[0]
    keys, size, text = (np.concatenate(x) for x in zip(*held, strict=True))
    return _one_each(keys, text, np.cumsum(size) - size, size)


def _units_asked(count: int, block_bytes: int):
    """Batches of documents -> (block, bucket, payload): the distinct units of every block, by (bucket, key)."""
    def run(batches):
        for block, parts in itertools.groupby(_parts(batches, block_bytes), lambda x: x[0]):
            held, new = [(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.uint8))], 0
            for _, table in parts:
                data, _, _, start, n, key = _units(table)
                held.append(_one_each(key, data, start, n))
                new += len(held[-1][0])
                if new > len(held[0][0]):                  # merged when they are as many as those merged before
                    held, new = [_merged(held)], 0
            keys, size, text = _merged(held)
            order, cut = bl.by_bucket(_bucket(keys, count), count)
            start = np.cumsum(size) - size
            for b in np.flatnonzero(np.diff(cut)).tolist():
                mine = order[cut[b]:cut[b + 1]]
                payload = bl.pack_arrays(size=size[mine].astype(np.uint32), text=_gather(text, start[mine], size[mine]))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([b], pa.int32()), pa.array([payload], pa.binary())],
                                                 names=["block", "bucket", "payload"])

    return run


def _asked_units(raw) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size, text = bl.unpack_arrays(raw, size=np.uint32, text=np.uint8)
    size = size.astype(np.int64)
    first = np.cumsum(size) - size
    return text, first, size, tc.piece_hash(tc.loads(text), first, size)


def distinct_units(asked: DataFrame, partitions: int) -> DataFrame:
    """(bucket, key, unit): every distinct unit once, with spaces written as the piece table writes them."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_asked_units(p.as_buffer()) for p in table.column("payload")]
        key = np.concatenate([k for *_, k in parts])
        whole = np.concatenate([t for t, *_ in parts]).tobytes()
        base = np.cumsum([0] + [len(t) for t, *_ in parts[:-1]])
        first = np.concatenate([f + b for (_, f, _, _), b in zip(parts, base, strict=True)])
        size = np.concatenate([s for _, _, s, _ in parts])
        keys, sample = np.unique(key, return_index=True)
        units = [whole[a:a + n].decode().replace(" ", SPACE) for a, n in zip(first[sample].tolist(), size[sample].tolist(), strict=True)]
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()] * len(keys), pa.int32()),
                         "key": pa.array(keys.view(np.int64)), "unit": pa.array(units, pa.string())})

    # partitioned like the questions: the lattice and the answers then need no exchange
    return asked.groupBy("bucket").applyInArrow(run, "bucket int, key long, unit string").repartition(partitions, "bucket")


# ---- the lattice -----------------------------------------------------------

def edges(units: DataFrame, pieces: DataFrame, longest: int, merges: bool = True) -> DataFrame:
    """(bucket, key, unit, edges) of every unit that has an edge, the best score first, then from the left.

    In a merge model an edge is one integer: place of the score << 32 |
    start << 26 | end << 20 | id; in a unigram model a struct (s, e, id, score).
    """
    n = F.length("unit")
    spread = (units.select("bucket", "key", "unit", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
              .select("bucket", "key", "unit", "s",
                      F.explode(F.sequence(F.col("s") + 1, F.least(F.col("s") + longest, F.length("unit")))).alias("e"))
              .select("bucket", "key", "unit", "s", "e", F.expr("substring(unit, s + 1, e - s)").alias("piece")))
    packed = F.expr("shiftleft(place, 32) | shiftleft(cast(s as long), 26) | shiftleft(cast(e as long), 20) | id")
    edge = packed if merges else F.struct("s", "e", "id", "score")
    return (spread.join(F.broadcast(pieces), "piece").select("bucket", "key", "unit", edge.alias("edge"))
            .groupBy("bucket", "key", "unit").agg(F.sort_array(F.collect_list("edge")).alias("edges")))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _field(x: Column, shift: int, mask: int) -> Column:
    return F.call_function("shiftright", x, F.lit(shift)).bitwiseAND(F.lit(mask)).cast("int")


def _spread(packed: Column) -> Column:
    """The packed edges as structs (s, e, id)."""
    return F.transform(packed, lambda x: F.struct(
        _field(x, 26, 63).alias("s"), _field(x, 20, 63).alias("e"), _field(x, 0, (1 << 20) - 1).alias("id")))


def _ends(x: Column) -> Column:
    return _bit(x["s"]).bitwiseOR(_bit(x["e"]))


def _inner(x: Column) -> Column:
    return (_bit(x["e"]) - 1).bitwiseAND(F.bitwise_not(_bit(x["s"] + 1) - 1))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merge_fold(edge_list: Column, unit: Column) -> Column:
    """Boundaries of the unit's pieces in a merge model, as a bit mask."""
    pending = F.lit(1 << 62).cast("long")
    longer = F.transform(F.filter(edge_list, lambda x: x["e"] - x["s"] > 1),
                         lambda x: F.struct(_ends(x).alias("ends"), _inner(x).alias("inner")))
    whole = _bit(F.length(unit) + 1) - 1

    def parts(m: Column, x: Column) -> Column:
        """Boundaries inside the edge if its ends are boundaries, else 0."""
        return F.when(m.bitwiseAND(x["ends"]) == x["ends"], F.bit_count(m.bitwiseAND(x["inner"]))).otherwise(0)

    def once(ordered: Column) -> Column:
        return F.aggregate(ordered, whole, lambda m, x: _let(parts(m, x), lambda k: (
            F.when(k == 1, m.bitwiseAND(F.bitwise_not(x["inner"])))
            .when(k > 1, m.bitwiseOR(pending)).otherwise(m))))

    def again(ordered: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(unit)), whole, lambda m, _: _let(
            F.get(F.filter(ordered, lambda x: parts(m, x) == 1), F.lit(0)),
            lambda x: F.when(x.isNull(), m).otherwise(m.bitwiseAND(F.bitwise_not(x["inner"])))))

    return _let(longer, lambda ordered: _let(once(ordered), lambda m: F.when(m >= pending, again(ordered)).otherwise(m)))


def viterbi_fold(edge_list: Column, unit: Column, unknown: float) -> Column:
    """Boundaries of the best path in a unigram model, as a bit mask.

    Position by position: the best score of a path that ends there and its
    boundaries.  A single symbol without a piece costs ``unknown``.
    """
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("mask")))

    def best(state: Column, e: Column) -> Column:
        into = F.transform(F.filter(edge_list, lambda x: x["e"] == e), lambda x: F.struct(
            (F.get(state, x["s"])["score"] + x["score"]).alias("score"),
            F.get(state, x["s"])["mask"].bitwiseOR(_bit(e)).alias("mask")))
        alone = F.struct((F.get(state, e - 1)["score"] + F.lit(float(unknown))).alias("score"),
                         F.get(state, e - 1)["mask"].bitwiseOR(_bit(e)).alias("mask"))
        return F.array_max(F.array_append(into, alone))

    ends = F.sequence(F.lit(1), F.length(unit))
    return F.element_at(F.aggregate(ends, start, lambda state, e: F.array_append(state, best(state, e))), -1)["mask"]


def ids_on(edge_list: Column, unit: Column, mask: Column, bytes_at: int) -> Column:
    """Ids of the pieces between neighbouring boundaries; bytes where there is none."""
    def chosen(m: Column) -> Column:
        return F.filter(edge_list, lambda x: (m.bitwiseAND(_ends(x)) == _ends(x)) & (m.bitwiseAND(_inner(x)) == 0))

    def by_start(found: Column) -> Column:
        return F.transform(F.sort_array(F.transform(found, lambda x: F.struct(x["s"], x["id"]))), lambda x: x["id"])

    def raw(at: Column) -> Column:
        digits = F.hex(F.encode(F.substring(unit, at + 1, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
                           lambda k: F.conv(F.substring(digits, 2 * k + 1, F.lit(2)), 16, 10).cast("int") + bytes_at)

    def filled(found: Column, m: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.length(unit) - 1), lambda s: m.bitwiseAND(_bit(s)) != 0)
        return F.flatten(F.transform(starts, lambda s: _let(
            F.filter(found, lambda x: x["s"] == s),
            lambda own: F.when(F.size(own) > 0, F.transform(own, lambda x: x["id"])).otherwise(raw(s)))))

    return _let(mask, lambda m: _let(chosen(m), lambda found: F.when(
        F.size(found) == F.bit_count(m) - 1, by_start(found)).otherwise(filled(found, m))))


def _merge_long(unit: str, rank: dict[str, int], pieces: Pieces) -> list[int]:
    """Pieces of a unit that is too long for the mask, merging the best neighbours first."""
    n = len(unit)
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    end = list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        j = right[i]
        if j < n and (k := rank.get(unit[i:end[j]])) is not None:
            heapq.heappush(heap, (-pieces.scores[k], i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, e = heapq.heappop(heap)
        if not alive[i] or right[i] >= n or end[right[i]] != e:
            continue
        j = right[i]
        alive[j], end[i], right[i] = False, e, right[j]
        if right[i] < n:
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out: list[int] = []
    i = 0
    while i < n:
        t = unit[i:end[i]]
        out += [rank[t]] if t in rank else [pieces.bytes_at + b for b in t.encode()]
        i = end[i]
    return out


def _viterbi_long(unit: str, rank: dict[str, int], pieces: Pieces, unknown: float) -> list[int]:
    best = [(0.0, 0)] + [(-1e300, 0)] * len(unit)
    for e in range(1, len(unit) + 1):
        best[e] = (best[e - 1][0] + unknown, e - 1)
        for s in range(max(0, e - pieces.longest), e):
            if unit[s:e] in rank:
                best[e] = max(best[e], (best[s][0] + pieces.scores[rank[unit[s:e]]], s))
    out: list[int] = []
    e = len(unit)
    while e:
        t = unit[best[e][1]:e]
        out[:0] = [rank[t]] if t in rank else [pieces.bytes_at + b for b in t.encode()]
        e = best[e][1]
    return out


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(bucket, key, ids) of every unit that the bit mask holds and that has an edge."""
    lattice = edges(units.where(F.length("unit") <= MASK_SYMBOLS), pieces.table(units.sparkSession), pieces.longest, pieces.merges)
    u = F.col("unit")

    def fold(e: Column) -> Column:
        mask = merge_fold(e, u) if pieces.merges else viterbi_fold(e, u, min(pieces.scores) - 10.0)
        return ids_on(e, u, mask, pieces.bytes_at)

    return lattice.select("bucket", "key", _let(_spread(F.col("edges")) if pieces.merges else F.col("edges"), fold).alias("ids"))


def encode_alone(unit: str, rank: dict[str, int], pieces: Pieces) -> list[int]:
    """Ids of a unit that the lattice has no answer for: it is too long for the mask, or bytes alone."""
    if len(unit) <= MASK_SYMBOLS:
        return [pieces.bytes_at + b for b in unit.encode()]
    return _merge_long(unit, rank, pieces) if pieces.merges else _viterbi_long(unit, rank, pieces, min(pieces.scores) - 10.0)


# ---- documents -------------------------------------------------------------

def _ids_answered(asked: DataFrame, encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """(block, bucket, payload): the ids of the units that each block asked for, in its order."""
    rank = {t: i for i, t in enumerate(pieces.texts) if t}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = tc.flat(right.column("key")).to_numpy().view(_U)
        lists = tc.flat(right.column("ids"))
        flat = lists.flatten().to_numpy().astype(np.uint32)
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        order = np.argsort(key)
        key, size, start = key[order], size[order], (np.cumsum(size) - size)[order]
        alone: dict[int, np.ndarray] = {}
        blocks, payloads = [], []
        for block, raw in zip(left.column("block").to_pylist(), left.column("payload"), strict=True):
            text, first, width, mine = _asked_units(raw.as_buffer())
            at = np.minimum(np.searchsorted(key, mine), max(len(key) - 1, 0))
            has = key[at] == mine if len(key) else np.zeros(len(mine), bool)
            for i in np.flatnonzero(~has).tolist():
                if int(mine[i]) not in alone:
                    unit = text[first[i]:first[i] + width[i]].tobytes().decode().replace(" ", SPACE)
                    alone[int(mine[i])] = np.array(encode_alone(unit, rank, pieces), np.uint32)
            other = [alone[k] for k in mine[~has].tolist()]
            n = np.empty(len(mine), np.int64)
            n[has], n[~has] = size[at[has]] if len(key) else 0, [len(x) for x in other]
            out, known = np.empty(int(n.sum()), np.uint32), np.repeat(has, n)
            out[known] = _gather(flat, start[at[has]], n[has]) if len(key) else 0
            out[~known] = np.concatenate(other) if other else 0
            blocks.append(block)
            payloads.append(bl.pack_arrays(n=n.astype(np.uint32), ids=out))
        bucket = left.column("bucket")[0].as_py() if left.num_rows else 0
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([bucket] * len(blocks), pa.int32()),
                         "payload": pa.array(payloads, pa.binary())})

    return (asked.groupBy("bucket").cogroup(encoded.groupBy("bucket"))
            .applyInArrow(run, "block long, bucket int, payload binary"))


def _packed(block_bytes: int):
    """Batches of documents -> (block, part, docs), the documents packed."""
    def run(batches):
        for block, parts in itertools.groupby(_parts(batches, block_bytes), lambda x: x[0]):
            for i, (_, table) in enumerate(parts):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([i], pa.int32()), pa.array([bl.pack_table(table.combine_chunks())], pa.binary())],
                                                 names=["block", "part", "docs"])

    return run


def _encoded(table: pa.Table, ids: np.ndarray, n: np.ndarray, pieces: Pieces, with_ids: bool) -> pa.Table:
    """The result's rows of a part, from its ids on end and the number of ids of each document."""
    back, first = pieces.decode(ids)
    ends = np.concatenate(([0], np.cumsum(n)))
    made = first[ends]
    raw, back = ids.astype("<u4"), back.tobytes()
    plain, at = tc.text_bytes(tc.text_array(table.column("text")))
    text = plain.tobytes()
    out = {
        "doc_id": table.column("doc_id"), "n_pieces": pa.array(n),
        "ids_crc32": pa.array([zlib.crc32(raw[a:b].data) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.int64()),
        "round_trip": pa.array([back[a + 1:b] == text[c:d] for a, b, c, d in zip(  # without the leading space
            made[:-1].tolist(), made[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)])}
    if with_ids:
        out["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
    return pa.table(out)


def _documents_of(count: int, pieces: Pieces, with_ids: bool):
    """(parts of a block, its answers) -> the result's rows, a chunk for each part."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        bl.check_block(left)
        left = left.sort_by("part")
        tables, seen = [], []                     # of each part: its units' keys, their numbers, units of each document
        for packed in left.column("docs"):
            table = bl.unpack_table(packed.as_buffer())
            _, _, document, _, _, key = _units(table)
            keys, number = np.unique(key, return_inverse=True)
            tables.append(packed)
            seen.append((keys, number.astype(np.int32), np.bincount(document, minlength=table.num_rows)))
        keys = np.unique(np.concatenate([k for k, *_ in seen]))
        order, cut = bl.by_bucket(_bucket(keys, count), count)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        found = {b.as_py(): p.as_buffer() for b, p in zip(right.column("bucket"), right.column("payload"), strict=True)}
        if set(found) != set(np.flatnonzero(np.diff(cut)).tolist()):
            raise RuntimeError("a block got other answers than it asked for: its documents were read differently the second time")
        got = [bl.unpack_arrays(found[b], n=np.uint32, ids=np.uint32) for b in sorted(found)]
        size = np.concatenate([np.zeros(0, np.int64)] + [n.astype(np.int64) for n, _ in got])
        flat = np.concatenate([np.zeros(0, np.uint32)] + [x for _, x in got])
        start = np.cumsum(size) - size
        out = []
        for packed, (mine, number, units) in zip(tables, seen, strict=True):
            at = place[np.searchsorted(keys, mine)][number]
            n = size[at]
            ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(units)))]
            out.append(_encoded(bl.unpack_table(packed.as_buffer()), _gather(flat, start[at], n), np.diff(ends), pieces, with_ids))
        return pa.concat_tables(out)  # chunks, not one array: they are sent to the JVM one by one

    return run


def encode_documents(docs: DataFrame, pieces: Pieces, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, round_trip of every document, and its ids if asked for.

    The documents are read twice rather than kept, so ``docs`` must give the
    same rows each time, as a table does; else the run stops.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", "text")
    block_bytes = IDS_BLOCK_BYTES if with_ids else BLOCK_BYTES
    count = bl.buckets_for(source.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0, BUCKET_BYTES)
    asked = source.mapInArrow(_units_asked(count, block_bytes), "block long, bucket int, payload binary").repartition(count, "bucket")
    encoded = encode_units(distinct_units(asked, count), pieces)
    answers = _ids_answered(asked, encoded, pieces)
    blocks = source.mapInArrow(_packed(block_bytes), "block long, part int, docs binary")

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_documents_of(count, pieces, with_ids), f"doc_id {kind}, n_pieces long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")))
