"""Periodic runs of words, found with a recompression grammar.

*Grammar*.  The words of a batch of texts are numbered (exactly, by Arrow's
dictionary), each text closed by a mark of its own.  Rounds alternate: block
compression replaces a stretch of one symbol by a symbol for (symbol, count);
pair compression splits the symbols in left and right ones by a hash and
replaces each left symbol followed by a right one by a symbol for the pair (of
eight splits the one that replaces most).  Equal stretches of words are thus
written alike but for a few symbols at their ends, and a text shrinks to a few
symbols in a logarithmic number of rounds.

*Longest common extension* of two positions: climb, as long as both positions
begin a symbol of the next level, comparing at most one symbol (or stretch) per
level on the way; where symbols differ, descend, again comparing one per level.
All queries of a batch climb and descend together, as arrays.  The same levels
read from right to left answer extensions to the left.

*Candidates*.  For each period p the positions 0, p, 2p, ... of a text: a run of
period p is at least 2p long, so it holds two neighbours of this grid, which
carry the same word.  Their extensions to both sides give the whole run, and
the smallest p of a stretch is its period (two periods of a stretch that is
long enough have their divisor as a period).  That is n log n candidates, each
answered in logarithmic time.

Each text is worked on whole, in one task, in memory proportional to the text;
nothing is shuffled.  A null text has no words, a null id counts as an empty
decimal.  Rows that repeat an id, empty texts (no runs, the hashes of nothing)
and ties are as the query says; no rows, no result.  Further columns are not
read.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm import textcore as tc

#: Shortest run, in words.
LEAST = 12
#: Bytes of text whose words share a grammar; a longer text has one of its own.
BATCH_BYTES = 1 << 20
#: Candidates that are tested at once.
AT_ONCE = 1 << 20
#: Symbols per text at which the grammar ends.
TOP = 8


@dataclass
class Level:
    """Symbols of one level; ``starts`` are the first children of the next level's symbols, and the end."""

    symbols: np.ndarray
    starts: np.ndarray | None = None
    parents: np.ndarray | None = None
    block: bool = False

    def mirrored(self) -> Level:
        """The same level read from right to left."""
        if self.starts is None:
            return Level(self.symbols[::-1].copy())
        count = len(self.starts) - 1
        return Level(self.symbols[::-1].copy(), (len(self.symbols) - self.starts[::-1]).astype(np.int32),
                     (count - 1 - self.parents[::-1]).astype(np.int32), self.block)


def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """A new symbol for each different key, and the next free symbol."""
    different, name = np.unique(keys, return_inverse=True)
    return (name + fresh).astype(np.int32), fresh + len(different)


def grammar(words: np.ndarray, marks: tuple[int, int]) -> list[Level]:
    """Levels over a sequence of symbols below ``marks[1]``; those from ``marks[0]`` on occur once and never combine."""
    now, fresh, levels, salt = words.astype(np.int32), marks[1], [], 0
    while True:
        closes = np.flatnonzero((now >= marks[0]) & (now < marks[1]))
        if len(closes) < 2 or np.diff(closes).max() <= TOP + 1:
            levels.append(Level(now))
            return levels
        # blocks
        begins = np.concatenate(([True], now[1:] != now[:-1]))
        if not begins.all():
            starts = np.flatnonzero(begins)
            count = np.diff(np.append(starts, len(now)))
            new = now[starts]
            many = np.flatnonzero(count > 1)
            new[many], fresh = _named(new[many].astype(np.int64) << 32 | count[many], fresh)
            levels.append(Level(now, np.append(starts, len(now)).astype(np.int32), (np.cumsum(begins) - 1).astype(np.int32), True))
            now = new
        # pairs
        salt += 1
        hashed = tc.mix64(now.astype(np.uint64), salt)
        free = (now < marks[0]) | (now >= marks[1])
        both = free[:-1] & free[1:]
        best, most = None, 0
        for bit in range(4):
            left = (hashed >> np.uint64(7 * bit) & np.uint64(1)).astype(bool)
            for one in (left, ~left):
                paired = one[:-1] & ~one[1:] & both
                if (k := int(np.count_nonzero(paired))) > most:
                    best, most = paired, k
        if most:
            begins = np.concatenate(([True], ~best))
            starts = np.flatnonzero(begins)
            new = now[starts]
            first = np.flatnonzero(best)
            place = np.cumsum(begins) - 1
            new[place[first]], fresh = _named(now[first].astype(np.int64) << 32 | now[first + 1], fresh)
            levels.append(Level(now, np.append(starts, len(now)).astype(np.int32), place.astype(np.int32)))
            now = new


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common stretch from positions ``i`` and ``j`` (different positions of one text)."""
    a, b, who = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
    stuck = []                          # per level, the queries whose symbols differ there
    for level in levels[:-1]:
        up_a, up_b = level.parents[a].astype(np.int64), level.parents[b].astype(np.int64)
        left_a, left_b = level.starts[up_a + 1] - a, level.starts[up_b + 1] - b
        first = (level.starts[up_a] == a) & (level.starts[up_b] == b)
        same = level.symbols[a] == level.symbols[b]
        step = np.where(same & ~first, np.minimum(left_a, left_b), 0) if level.block else (same & ~first).astype(np.int64)
        climbs = first | (same & (left_a == left_b) if level.block else same)
        a, b = a + step, b + step
        stay = ~climbs
        stuck.append((a[stay], b[stay], who[stay]))
        more = ~first[climbs]
        a, b, who = up_a[climbs] + more, up_b[climbs] + more, who[climbs]
    top = levels[-1].symbols
    while (same := top[a] == top[b]).any():
        a, b = a + same, b + same
    out = np.zeros(len(i), np.int64)
    for level, (c, d, k) in zip(levels[-2::-1], stuck[::-1]):
        up_a, up_b = a, b
        a, b = level.starts[up_a].astype(np.int64), level.starts[up_b].astype(np.int64)
        same = level.symbols[a] == level.symbols[b]
        step = same * np.minimum(level.starts[up_a + 1] - a, level.starts[up_b + 1] - b) if level.block else same.astype(np.int64)
        a, b, who = np.concatenate([a + step, c]), np.concatenate([b + step, d]), np.concatenate([who, k])
    out[who] = a
    return out - i


def _candidates(begin: np.ndarray, size: np.ndarray, symbols: np.ndarray):
    """(position, period) of grid neighbours that carry the same symbol, a bounded number at a time."""
    half = np.where(size >= LEAST, size // 2, 0)
    text = np.repeat(np.arange(len(size)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    count = (size[text] - 1) // period
    ends = np.cumsum(count)
    at = 0
    while at < len(text):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + AT_ONCE, "right")))
        p = np.repeat(period[at:stop], count[at:stop])
        k = np.arange(len(p)) - np.repeat(ends[at:stop] - count[at:stop] - done, count[at:stop])
        i = np.repeat(begin[text[at:stop]], count[at:stop]) + k * p
        same = symbols[i] == symbols[i + p]
        yield i[same], p[same]
        at = stop


def runs(words: np.ndarray, size: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs, by text, start and period; ``size`` words, below ``kinds``, belong to each text."""
    # a mark before the first text and after each one
    begin = np.cumsum(size) - size + np.arange(1, len(size) + 1)
    whole = np.empty(int(size.sum()) + len(size) + 1, np.int32)
    marks = np.append(0, begin + size)
    whole[marks] = kinds + np.arange(len(marks))
    inner = np.ones(len(whole), bool)
    inner[marks] = False
    whole[inner] = words
    found = [np.zeros((0, 3), np.int64)]
    levels = mirrored = None
    for i, p in _candidates(begin, size, whole):
        if not len(i):
            continue
        if levels is None:
            levels = grammar(whole, (kinds, kinds + len(marks)))
            mirrored = [x.mirrored() for x in levels]
        ahead = extensions(levels, i, i + p)
        back = extensions(mirrored, len(whole) - i, len(whole) - i - p)
        length = back + p + ahead
        good = length >= np.maximum(LEAST, 2 * p)
        # the smallest period of each stretch
        start, end, period = (i - back)[good], (i + p + ahead)[good], p[good]
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1]))) if len(start) else np.zeros(0, bool)
        found.append(np.column_stack([start[new], end[new], period[new]]))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(begin, rows[:, 0], "right") - 1
    return text, rows[:, 0] - begin[text], rows[:, 1] - rows[:, 0], rows[:, 2]


def word_arrays(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as one array, and how many each text has."""
    data, offsets = tc.text_bytes(texts)
    start, end, document, _ = tc.words(data, offsets, lower=False)
    letters = data[np.frombuffer(data.tobytes().translate(tc.NON_SPACE), bool)]
    ends = np.append(0, np.cumsum(end - start)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(letters.tobytes())])
    return array, np.bincount(document, minlength=len(texts)).astype(np.int64)


def made_periodic(ids: list, size: np.ndarray) -> np.ndarray:
    """For each word the number of the one it becomes: a tenth of the texts repeat a stretch of their own."""
    source = np.arange(int(size.sum()))
    at = 0
    for doc_id, n in zip(ids, size.tolist()):
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[at + a:at + n] = at + a + np.arange(n - a) % p
        at += n
    return source


def periodic_runs(docs: DataFrame, rewrite=made_periodic) -> DataFrame:
    """doc_id, n_runs, the greatest run, hashes of all runs and of the text without repeats, of every row.

    ``rewrite`` (ids, word counts) says which word stands at each place; None leaves the texts as they are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")

    def find(batches):
        for batch, texts in tc.chunks(batches, limit=BATCH_BYTES):
            words, size = word_arrays(texts)
            ids = batch.column(0).to_pylist()
            source = np.arange(len(words)) if rewrite is None else rewrite(ids, size)
            encoded = words.dictionary_encode()
            symbols = encoded.indices.to_numpy(zero_copy_only=False)[source]
            text, start, length, period = runs(symbols, size, len(encoded.dictionary))
            first = np.cumsum(size) - size
            # words that a run holds after its first period
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, first[text] + start + period, 1)
            np.add.at(edge, first[text] + start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            left = np.add.reduceat(np.append(kept, 0), np.minimum(first, len(words))) * (size > 0) if len(size) else size
            lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(left)), pa.int64()), words.take(pa.array(source[kept])))
            collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
            bounds = np.searchsorted(text, np.arange(len(size) + 1))
            rows = []
            for d in range(len(size)):
                lo, hi = int(bounds[d]), int(bounds[d + 1])
                hashed = hashlib.sha256(collapsed[d].as_buffer()).hexdigest()
                if lo == hi:
                    rows.append((0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashed))
                    continue
                each = list(zip(start[lo:hi].tolist(), length[lo:hi].tolist(), period[lo:hi].tolist()))
                s, n, q = min(each, key=lambda r: (-r[1], r[0], r[2]))
                listed = "".join(f"{x},{y},{z}\n" for x, y, z in each).encode()
                rows.append((len(each), s, n, q, 1000 * n // q, hashlib.sha256(listed).hexdigest(), hashed))
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.select("doc_id", "text").mapInArrow(find, schema)
