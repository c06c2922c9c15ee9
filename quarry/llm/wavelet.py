"""Token-id output: one wavelet matrix per shard.

``encode`` turns whole texts into ids with a public tokenizer, ``write_shards``
writes them in ascending document order as shards, and ``Shard`` answers
questions from one shard: the token at a position, how often a token occurs
before a position, where its k-th occurrence is.

A shard is one row of a Parquet table (the file container that every Spark
store can write and read), with these fields:

    shard       number of the shard, ascending in document order
    doc_ids     list of the documents' ids
    ends        list: ids up to the end of each document, inside the shard
    n           ids in the shard
    width       bit planes, from the highest bit
    zeros       list: zero bits of each plane
    planes      bytes: each plane padded to whole 64-byte blocks
    ranks       bytes: unsigned 32-bit counts of one bits before each block

The planes hold ``width`` bits per id, the directory adds 1/16 of that, and
the table is written with zstd.  A rank costs one directory entry and the
bits of one block per plane; nothing is unpacked for a single access.

Order is by (doc_id, hash of the text), nulls first, so rows that share an id
may be split over shards.  Null and empty texts are documents of the end id
alone; repeated rows are documents of their own.  Further columns are not
read.  An empty table gives no shards and an empty result.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import textcore as tc

END_ID = 2
BLOCK_BITS = 512
#: Ids in a shard, unless a single document has more.
SHARD_IDS = 1 << 22
#: Words that a worker remembers the ids of (about 30 bytes each).
CACHE_WORDS = 1 << 21
#: Words that go through the tokenizer as one text.
TOGETHER = 128


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and never joins across it.

    Each distinct run of non-space bytes goes through the tokenizer once per
    worker (as far as the bounded memory reaches) and its ids are laid out
    wherever it occurs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._separator()
        self._forget()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _separator(self) -> tuple[str, int] | None:
        """A sign of one id that may stand between words without changing their ids, and its id."""
        for sign in map(chr, range(0xA1, 0x3000)):
            ids = self._plain(sign)
            if len(ids) == 1 and self._plain(f"a {sign} {sign} b") == [*self._plain("a"), *ids, *ids, *self._plain("b")]:
                return sign, ids[0]
        return None

    def _ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words on end, and the number of ids of each; many words go through the library as one text.

        A text in which the separator's id comes up inside a word as well has
        more of them than words: its words are encoded one by one.
        """
        groups = [texts[a:a + TOGETHER] for a in range(0, len(texts), TOGETHER)]
        joined = ([] if self.mark is None else
                  self.tokenizer.encode_batch_fast([f" {self.mark[0]} ".join([*g, ""]) for g in groups], add_special_tokens=False))
        flat, length = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k, group in enumerate(groups):
            if joined:
                ids = np.array(joined[k].ids, np.uint32)
                ends = np.flatnonzero(ids == self.mark[1])
                if len(ends) == len(group):
                    flat.append(np.delete(ids, ends))
                    length.append(np.diff(ends, prepend=-1) - 1)
                    continue
            alone = [e.ids for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
            flat += [np.array(x, np.uint32) for x in alone]
            length.append(np.array([len(x) for x in alone], np.int64))
        return np.concatenate(flat), np.concatenate(length)

    def _forget(self) -> None:
        self.hashes, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        flat, length = self._ids_of(texts)
        start = len(self.ids) + np.cumsum(length) - length
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.start = np.insert(self.hashes, at, hashes), np.insert(self.start, at, start)
        self.length, self.ids = np.insert(self.length, at, length), np.concatenate([self.ids, flat])

    def encode(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and the number of ids of each text."""
        data, offsets = tc.text_bytes(texts)
        start, end, document, value = tc.words(data, offsets, lower=False)
        distinct, sample, which = np.unique(value, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE_WORDS:
            self._forget()
        known = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = known < len(self.hashes)
        new[inside] = self.hashes[known[inside]] != distinct[inside]
        if new.any():
            raw, picked = data.tobytes(), sample[new]
            self._learn(distinct[new], [raw[a:b].decode() for a, b in zip(start[picked].tolist(), end[picked].tolist(), strict=True)])
            known = np.searchsorted(self.hashes, distinct)
        source, size = self.start[known][which], self.length[known][which]
        if end_id is not None:  # one more piece at the end of each document
            last = np.searchsorted(document, np.arange(len(texts)), "right")
            ids = np.concatenate([self.ids, np.array([end_id], np.uint32)])
            source, size = np.insert(source, last, len(ids) - 1), np.insert(size, last, 1)
            document = np.insert(document, last, np.arange(len(texts)))
        else:
            ids = self.ids
        total = np.cumsum(size)
        step = np.repeat(source - (total - size), size)
        out = ids[step + np.arange(len(step))]
        return out, np.bincount(document, size, len(texts)).astype(np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _popcount(packed: np.ndarray) -> np.ndarray:
    return np.bitwise_count(packed)


@dataclass
class Shard:
    """A wavelet matrix and the documents in it."""

    n: int
    width: int
    zeros: np.ndarray
    planes: np.ndarray   # width x bytes
    ranks: np.ndarray    # width x (blocks + 1)
    doc_ids: list
    ends: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: list, ends: np.ndarray, width: int | None = None) -> Shard:
        n = len(ids)
        width = width or max(1, int(ids.max()).bit_length() if n else 1)
        size = -(-max(n, 1) // BLOCK_BITS) * (BLOCK_BITS // 8)
        planes = np.zeros((width, size), np.uint8)
        zeros = np.zeros(width, np.int64)
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for k in range(width):
            bit = (now >> now.dtype.type(width - 1 - k) & now.dtype.type(1)).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            planes[k, :len(packed)] = packed
            now = np.concatenate([now[~bit], now[bit]])
            zeros[k] = n - np.count_nonzero(bit)
        return cls(n, width, zeros, planes, cls._directory(planes), doc_ids, ends)

    @staticmethod
    def _directory(planes: np.ndarray) -> np.ndarray:
        blocks = _popcount(planes).reshape(len(planes), -1, BLOCK_BITS // 8).sum(2, dtype=np.uint32)
        return np.concatenate([np.zeros((len(planes), 1), np.uint32), np.cumsum(blocks, 1, dtype=np.uint32)], 1)

    @classmethod
    def from_row(cls, row) -> Shard:
        width = row["width"]
        return cls(row["n"], width, np.asarray(row["zeros"], np.int64),
                   np.frombuffer(row["planes"], np.uint8).reshape(width, -1),
                   np.frombuffer(row["ranks"], np.uint32).reshape(width, -1),
                   list(row["doc_ids"]), np.asarray(row["ends"], np.int64))

    def _rank1(self, k: int, at: int) -> int:
        """One bits of plane ``k`` before position ``at``."""
        block, rest = divmod(at, BLOCK_BITS)
        count = int(self.ranks[k, block])
        if rest:
            part = self.planes[k, block * 64: block * 64 + (rest + 7) // 8].copy()
            if rest % 8:
                part[-1] &= (1 << rest % 8) - 1
            count += int(_popcount(part).sum())
        return count

    def _bit(self, k: int, at: int) -> int:
        return int(self.planes[k, at >> 3]) >> (at & 7) & 1

    def access(self, at: int) -> int:
        """The id at position ``at``."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for k in range(self.width):
            ones = self._rank1(k, at)
            bit = self._bit(k, at)
            at = int(self.zeros[k]) + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _bounds(self, token: int, at: int) -> tuple[int, int]:
        """Where the token's run begins under the last plane, and its end for the prefix before ``at``."""
        low, high = 0, at
        for k in range(self.width):
            a, b = self._rank1(k, low), self._rank1(k, high)
            low, high = (int(self.zeros[k]) + a, int(self.zeros[k]) + b) if token >> (self.width - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, at: int) -> int:
        """Occurrences of the token before position ``at``."""
        if token >> self.width:
            return 0
        low, high = self._bounds(token, min(max(at, 0), self.n))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, k: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) bit of this kind in plane ``k``."""
        blocks = np.arange(self.ranks.shape[1]) * BLOCK_BITS - self.ranks[k] if not bit else self.ranks[k]
        block = int(np.searchsorted(blocks, j, "right")) - 1
        bits = np.unpackbits(self.planes[k, block * 64: block * 64 + 64], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[j - int(blocks[block])])

    def select(self, token: int, j: int) -> int:
        """Position of the j-th occurrence (from 0) of the token; IndexError if it has fewer."""
        if not 0 <= j < self.count(token):
            raise IndexError(j)
        at = self._bounds(token, 0)[0] + j
        for k in reversed(range(self.width)):
            bit = token >> (self.width - 1 - k) & 1
            at = self._select_bit(k, bit, at - int(self.zeros[k]) if bit else at)
        return at

    def occurrences(self, token: int) -> list[tuple[object, int]]:
        """(doc_id, position inside the document) of every occurrence."""
        out = []
        for j in range(self.count(token)):
            at = self.select(token, j)
            d = int(np.searchsorted(self.ends, at, "right"))
            out.append((self.doc_ids[d], at - (int(self.ends[d - 1]) if d else 0)))
        return out

    def decode(self) -> np.ndarray:
        """All ids in order, rebuilt from the lowest plane upwards."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for k in reversed(range(self.width)):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            out = np.empty(self.n, kind)
            out[~bit] = now[:self.zeros[k]]
            out[bit] = now[self.zeros[k]:] | kind(1 << (self.width - 1 - k))
            now = out
        return now


def _shard_schema(doc_id: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_ids", pa.list_(doc_id)), ("ends", pa.list_(pa.int64())), ("n", pa.int64()),
                      ("width", pa.int32()), ("zeros", pa.list_(pa.int64())), ("planes", pa.binary()),
                      ("ranks", pa.binary()), ("part", pa.int32()), ("place", pa.int32())])


def encode_shards(docs: DataFrame, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                  partitions: int | None = None) -> DataFrame:
    """Shards of the documents' ids; (part, place) orders them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches):
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush(schema):
            nonlocal held, size, place
            lengths = np.concatenate([x for _, x, _ in held])
            names = [i for x, _, _ in held for i in x]
            ids = np.concatenate([x for _, _, x in held])
            s = Shard.build(ids, names, np.cumsum(lengths))
            row = [[names], [s.ends.tolist()], [s.n], [s.width], [s.zeros.tolist()], [s.planes.tobytes()], [s.ranks.tobytes()], [part], [place]]
            held, size, place = [], 0, place + 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch, texts in tc.chunks(batches):
            schema = _shard_schema(batch.schema.field("doc_id").type)
            ids, lengths = encoder(path).encode(texts, end_id)
            names = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            ends = np.cumsum(lengths)
            a = 0
            while a < len(names):  # documents that still fit, or else one
                base = int(ends[a - 1]) if a else 0
                b = int(np.searchsorted(ends, base + shard_ids - size, "right"))
                if b <= a:
                    if size:
                        yield flush(schema)
                        continue
                    b = a + 1
                held.append((names[a:b], lengths[a:b], ids[base:int(ends[b - 1])]))
                size += int(ends[b - 1]) - base
                a = b
                if size >= shard_ids:
                    yield flush(schema)
        if held:
            yield flush(schema)

    out = (f"doc_ids array<{kind}>, ends array<long>, n long, width int, zeros array<long>, "
           "planes binary, ranks binary, part int, place int")
    order = ["doc_id", F.xxhash64("text")]
    spread = docs.select("doc_id", "text")
    spread = spread.repartitionByRange(partitions, *order) if partitions else spread.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).mapInArrow(build, out)


def write_shards(docs: DataFrame, path: str, target: str, end_id: int = END_ID,
                 shard_ids: int = SHARD_IDS, partitions: int | None = None) -> None:
    """Write the shards as a Parquet table at ``target`` (zstd; one row group per few shards)."""
    (encode_shards(docs, path, end_id, shard_ids, partitions).write.option("compression", "zstd")
     .option("parquet.block.size", 32 << 20).parquet(target))


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    The one thing gathered on the driver is a row of three numbers per shard,
    to place the shards' first ids on the whole sequence.
    """
    shards = spark.read.parquet(target)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = sorted((r.part, r.place, r.n) for r in shards.select("part", "place", "n").collect())
    first, total = {}, 0
    for part, place, n in sizes:
        first[part, place] = total
        total += n

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one shard in memory at a time
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard.from_row(row)
                ids = shard.decode().astype("<u4")
                begin = np.concatenate([[0], shard.ends[:-1]])
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(begin.tolist(), shard.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, batch.schema.field("doc_ids").type.value_type),
                     pa.array(begin + first[row["part"], row["place"]]),
                     pa.array(shard.ends - begin), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, path: str, target: str, **options) -> DataFrame:
    """Encode, write the shards at ``target``, and read them back."""
    write_shards(docs, path, target, **options)
    return read_documents(docs.sparkSession, target)
