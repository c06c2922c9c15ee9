"""Class-based n-gram scoring: exchange clustering, class transitions, word emissions.

The model is p(word | previous word) = p(class | previous class) p(word | class).

*Counts.*  Blocks of documents send their distinct words, as 64-bit hashes
with counts, to hash buckets; every word of the corpus is counted.

*Clustering.*  The ``FREQUENT`` most frequent words are clustered by the
exchange algorithm on their bigram counts over the whole corpus: each word in
turn moves to the class that raises the class-bigram likelihood most.  Every
other word is then assigned by one exchange step against these classes: from
the classes of its neighbours, over all its occurrences, to the class under
which they are likeliest.  These words form a second class beside each class
of frequent words, so rare words do not dilute frequent ones.

*Smoothing.*  Class priors and emissions add 1/2 per word type, and
transitions are drawn towards the priors with weight ``PULL``.  Unknown words
are one type and one class of their own: its share after each class is that
of the words seen once in training (each of which would be unknown without
its one document), and what follows it is what follows those.  The known
words share the rest, so the probabilities after each class sum to one.

Vocabulary and counts grow with the corpus and are never held in one place;
what the driver holds is bounded by ``FREQUENT`` and ``CLASSES``.

Words are runs of bytes other than space and 0x09-0x0D with A-Z folded; each
document ends with an end token, which also stands before its first word.
Null and empty texts are the end token alone.  Repeated rows are scored (and
learned from) one by one; further columns are not read.  Without training
rows every word is unknown.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import blocks as bl
from quarry.llm import textcore as tc
from quarry.llm.labelled import held_out
from quarry.session import materialize

FREQUENT = 1024
CLASSES = 32
SWEEPS = 8
PULL = 5.0

_U = np.uint64
_END = _U(0x5BD1E9955BD1E995)
#: Added to the class of a word that training has once.
_ONCE = 128


def _tokens(table: pa.Table):
    """(word hash, document, first of a document, in training) of the block's tokens, end tokens included."""
    data, offsets = tc.text_bytes(tc.text_array(table.column("text")))
    _, _, document, value = tc.words(data, offsets)
    n = table.num_rows
    last = np.searchsorted(document, np.arange(n), "right")
    value = np.insert(value, last, _END)
    document = np.insert(document, last, np.arange(n))
    first = np.concatenate(([True], document[1:] != document[:-1])) if len(document) else np.zeros(0, bool)
    training = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    return value, document, first, training[document]


def _bucket(value: np.ndarray, count: int) -> np.ndarray:
    return (tc.mix64(value, 19) % _U(count)).astype(np.int64)


def _lookup(sorted_words: np.ndarray, words: np.ndarray, missing: int) -> np.ndarray:
    """Index of each word in a sorted array, ``missing`` where it isn't there."""
    if not len(sorted_words):
        return np.full(len(words), missing)
    at = np.minimum(np.searchsorted(sorted_words, words), len(sorted_words) - 1)
    return np.where(sorted_words[at] == words, at, missing)


def _counts_asked(count: int):
    def question(table: pa.Table):
        value, _, _, training = _tokens(table)
        words, times = np.unique(value[training], return_counts=True)
        order, cut = bl.by_bucket(_bucket(words, count), count)
        for b in range(count):
            mine = order[cut[b]:cut[b + 1]]
            if len(mine):
                yield b, bl.pack_arrays(words=words[mine], times=times[mine].astype(np.uint32))

    return question


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = tc.runs(keys)
    return keys[begin], np.add.reduceat(times[order].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)


def _frequent(blocks: DataFrame, count: int, size: int) -> tuple[np.ndarray, int, int]:
    """The most frequent words (hashes, ascending), the number of training tokens and of distinct words."""
    def top(table: pa.Table) -> pa.Table:
        parts = [bl.unpack_arrays(p.as_buffer(), words=_U, times=np.uint32) for p in table.column("payload")]
        words, times = _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        best = np.lexsort((words, -times))[:size]
        return pa.table({"word": pa.array([None, *words[best].view(np.int64).tolist()], pa.int64()),
                         "n": pa.array([int(times.sum()), *times[best].tolist()], pa.int64()),
                         "types": pa.array([len(words)] + [0] * len(best), pa.int64())})

    found = materialize(bl.ask(blocks, _counts_asked(count)).groupBy("bucket")
                        .applyInArrow(top, "word long, n long, types long"), "frequent-words")
    total = found.where("word is null").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).first()
    rows = found.where("word is not null").orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    words = np.array([r.word for r in rows], np.int64).view(_U)
    return np.union1d(words, np.array([_END], _U)), int(total.n or 0), int(total.types or 0)


def _bigrams(blocks: DataFrame, words: np.ndarray) -> np.ndarray:
    """Counts of adjacent training tokens, frequent words by index and all others as one."""
    k = len(words) + 1
    end = int(np.searchsorted(words, _END))

    def counted(batches):
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                value, _, first, training = _tokens(bl.unpack_table(raw.as_buffer()))
                index = _lookup(words, value, k - 1)
                before = np.where(first, end, np.concatenate(([0], index[:-1])) if len(index) else index)
                total += np.bincount((before * k + index)[training], minlength=k * k)
        rows = total.reshape(k, k)
        some = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([bl.pack_arrays(n=rows[i]) for i in some], pa.binary())], names=["i", "row"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(bl.unpack_arrays(r.as_buffer(), n=np.int64)[0] for r in table.column("row"))
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([bl.pack_arrays(n=total)], pa.binary())})

    out = np.zeros((k, k))
    for r in (blocks.select("docs").mapInArrow(counted, "i int, row binary")
              .groupBy("i").applyInArrow(added, "i int, row binary").collect()):
        out[r.i] = bl.unpack_arrays(r.row, n=np.int64)[0]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, end: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each row of the bigram counts.

    The last row (all other words) is class ``classes``; the end token is
    class 0 alone; the rest start dealt out by frequency and move one by one
    to the class that raises the class-bigram likelihood most.
    """
    k = len(bigrams)
    label = np.zeros(k, np.int64)
    free = [int(w) for w in np.argsort(-bigrams.sum(0), kind="stable") if w not in (end, k - 1)]
    label[free] = 1 + np.arange(len(free)) % (classes - 1)
    label[k - 1] = classes
    member = np.zeros((k, classes + 1))
    member[np.arange(k), label] = 1
    right, left = bigrams @ member, bigrams.T @ member          # word x class
    table = member.T @ right                                     # class x class
    for _ in range(sweeps):
        moved = 0
        for w in free:
            a = label[w]
            self_count = bigrams[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= self_count
            l[a] -= self_count
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= self_count
            rows, columns = table.sum(1), table.sum(0)
            rw, cw = r.sum() + self_count, l.sum() + self_count
            gain = (_xlogx(table + r) - _xlogx(table)).sum(1) + (_xlogx(table + l[:, None]) - _xlogx(table)).sum(0)
            d = np.diag(table)
            gain += _xlogx(d + r + l + self_count) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
            gain -= _xlogx(rows + rw) - _xlogx(rows) + _xlogx(columns + cw) - _xlogx(columns)
            b = 1 + int(np.argmax(gain[1:classes]))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += l
            table[b, b] += self_count
            if b != a:
                label[w] = b
                right[:, a] -= bigrams[:, w]
                right[:, b] += bigrams[:, w]
                left[:, a] -= bigrams[w]
                left[:, b] += bigrams[w]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Clustering:
    words: np.ndarray      # hashes of the frequent words, ascending
    label: np.ndarray      # their classes; the last one is for all other words
    context: np.ndarray    # log probability of a (side, class) next to a word of each class

    @property
    def classes(self) -> int:
        return int(self.context.shape[1])


def _contexts(bigrams: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    """Rows: class to the left, then class to the right; columns: the word's class."""
    member = np.zeros((len(label), classes + 1))
    member[np.arange(len(label)), label] = 1
    table = member.T @ bigrams @ member + 0.5
    before = np.log(table / table.sum(0))[:, :classes]
    after = np.log(table / table.sum(1, keepdims=True)).T[:, :classes]
    out = np.concatenate([before, after]).astype(np.float32)
    out[:, 0] = -1e9  # only the end token is in its class
    return out


def _words_asked(model: Clustering, count: int):
    """Per distinct word of the block: training count, and its neighbours' classes if it isn't frequent."""
    sides = model.classes + 1

    def question(table: pa.Table):
        value, _, first, training = _tokens(table)
        words, which = np.unique(value, return_inverse=True)
        times = np.bincount(which, training, len(words)).astype(np.int64)
        index = _lookup(model.words, words, len(model.words))
        label = model.label[index][which]
        before = np.where(first, 0, np.concatenate(([0], label[:-1])) if len(label) else label)
        after = np.concatenate((label[1:], [0])) if len(label) else label
        rare = training & (index == len(model.words))[which]
        key = np.concatenate([which[rare] * (2 * sides) + before[rare], which[rare] * (2 * sides) + sides + after[rare]])
        key, seen = np.unique(key, return_counts=True)
        entries = np.bincount(key // (2 * sides), minlength=len(words))
        begin = np.cumsum(entries) - entries
        bucket = _bucket(words, count)
        order, cut = bl.by_bucket(bucket, count)
        for b in range(count):
            mine = order[cut[b]:cut[b + 1]]
            if len(mine):
                e = entries[mine]
                at = np.repeat(begin[mine] - (np.cumsum(e) - e), e) + np.arange(int(e.sum()))
                yield b, bl.pack_arrays(words=words[mine], times=times[mine].astype(np.uint32), entries=e.astype(np.uint16),
                                        code=(key[at] % (2 * sides)).astype(np.uint8), seen=seen[at].astype(np.uint32))

    return question


def _words_answered(model: Clustering):
    """Per block: training count and class of each word that it asked for; block -1: totals by class."""
    kinds = dict(words=_U, times=np.uint32, entries=np.uint16, code=np.uint8, seen=np.uint32)

    def reply(block_ids, payloads):
        parts = [bl.unpack_arrays(p, **kinds) for p in payloads]
        words, times, entries, code, seen = (np.concatenate(x) for x in zip(*parts, strict=True))
        distinct, number = np.unique(words, return_inverse=True)
        total = np.bincount(number, times, len(distinct)).astype(np.int64)
        owner = np.repeat(number, entries)
        order = np.argsort(owner, kind="stable")
        owner, code, seen = owner[order], code[order], seen[order].astype(np.float32)
        begin = tc.runs(owner)
        label = np.ones(len(distinct), np.int64)
        step = 1 << 16
        edges = np.append(begin, len(owner))
        at = 0
        while at < len(begin):  # bounded slices of whole words
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + step, "right")) - 1)
            a, b = edges[at], edges[end]
            score = np.add.reduceat(model.context[code[a:b]] * seen[a:b, None], edges[at:end] - a, axis=0)
            label[owner[edges[at:end]]] = score.argmax(1)
            at = end
        label += model.classes
        index = _lookup(model.words, distinct, len(model.words))
        frequent = index < len(model.words)
        label[frequent] = model.label[index[frequent]]
        label[total == 0] = 2 * model.classes
        size = 2 * model.classes + 1
        yield -1, bl.pack_arrays(tokens=np.bincount(label, total, size).astype(np.int64),
                                 types=np.bincount(label[total > 0], minlength=size).astype(np.int64))
        at = 0
        for block, part in zip(block_ids, parts, strict=True):
            mine = number[at:at + len(part[0])]
            at += len(part[0])
            yield block, bl.pack_arrays(times=total[mine].astype(np.uint64), label=label[mine].astype(np.uint8))

    return reply


def _class_totals(answers: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and types of each class."""
    def rows(batches):
        tokens, types = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                n, t = bl.unpack_arrays(raw.as_buffer(), tokens=np.int64, types=np.int64)
                tokens += n
                types += t
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(tokens), pa.array(types)], names=["c", "n", "t"])

    got = (answers.where("block = -1").select("payload").mapInArrow(rows, "c long, n long, t long")
           .groupBy("c").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect())
    tokens, types = np.zeros(size), np.zeros(size)
    for r in got:
        tokens[r.c], types[r.c] = r.n, r.t
    return tokens, types


def _emissions(count: int, tokens: np.ndarray, types: np.ndarray, n: int, v: int):
    """Per document: known words, unigram score, emission score, class sequence."""
    mass = tokens + 0.5 * types
    unknown = len(tokens) - 1

    def use(table: pa.Table, found: dict[int, pa.Buffer]) -> pa.Table:
        value, document, _, _ = _tokens(table)
        words, which = np.unique(value, return_inverse=True)
        order, cut = bl.by_bucket(_bucket(words, count), count)
        times, label = np.zeros(len(words)), np.full(len(words), unknown)
        for b, raw in found.items():
            t, c = bl.unpack_arrays(raw, times=np.uint64, label=np.uint8)
            mine = order[cut[b]:cut[b + 1]]
            times[mine], label[mine] = t, c
        base = np.log10((times + 0.5) / (n + 0.5 * (v + 1)))
        emission = np.where(times > 0, np.log10((times + 0.5) / np.maximum(mass[label], 0.5)), 0.0)
        rows = table.num_rows
        sequence = (label + np.where(times == 1, _ONCE, 0))[which].astype(np.uint8)
        cuts = np.searchsorted(document, np.arange(1, rows))
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": table.column("held_out"),
            "n_tokens": pa.array(np.bincount(document, minlength=rows).astype(np.int64)),
            "n_known": pa.array(np.bincount(document, (times > 0)[which], rows).astype(np.int64)),
            "base_score": pa.array(np.bincount(document, base[which], rows)),
            "emission": pa.array(np.bincount(document, emission[which], rows)),
            "labels": pa.array([s.tobytes() for s in np.split(sequence, cuts)], pa.binary())})

    return use


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences on end, and the document of each entry."""
    sizes = np.array([len(x.as_buffer()) for x in column])
    return (np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in column]).astype(np.int64),
            np.repeat(np.arange(len(column)), sizes))


def _before(flat: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Entry before each token; the end token's class, 0, before a document."""
    first = np.concatenate(([True], document[1:] != document[:-1]))
    return np.where(first, 0, np.concatenate(([0], flat[:-1])))


def _transitions(scored: DataFrame, tokens: np.ndarray, types: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 p(class | class before), rows and columns ending with the unknown words' class."""
    size = len(tokens)
    wide = 2 * _ONCE

    def counted(batches):
        total = np.zeros(wide * wide, np.int64)
        for batch in batches:
            if batch.num_rows:
                flat, document = _flat(batch.column(0))
                total += np.bincount(_before(flat, document) * wide + flat, minlength=wide * wide)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    out = np.zeros(wide * wide)
    for r in (scored.where("not held_out").select("labels").mapInArrow(counted, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")).collect()):
        out[r.pair] = r.n
    counts = out.reshape(2, _ONCE, 2, _ONCE)[:, :size, :, :size]    # once before?, class before, once?, class
    pairs = counts.sum((0, 2))
    pairs[-1] = counts[1].sum((0, 1))                               # after a word seen once
    once = counts[:, :, 1, :].sum((0, 2))
    once[-1] = counts[1, :, 1, :].sum()
    prior = (tokens + 0.5 * types) / (n + 0.5 * (v + 1))
    prior[-1] = 0.0
    prior /= prior.sum() or 1.0
    overall = (tokens.sum() and once[:-1].sum() + 0.5) / (n + 1.0) if n else 0.5
    total = pairs.sum(1)
    known = (pairs + PULL * prior) / (total[:, None] + PULL)
    unknown = (once + PULL * overall) / (total + PULL)
    p = known * (1 - unknown[:, None])
    p[:, -1] = unknown
    return np.log10(np.maximum(p, 1e-300))


def class_scores(docs: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``docs`` has doc_id, text and held_out; the model learns from rows that are not held out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = bl.make_blocks(docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out")), "lm-blocks")
    count = bl.bucket_count(blocks)
    words, n, v = _frequent(blocks, count, frequent)
    bigrams = _bigrams(blocks, words)
    label = exchange(bigrams, int(np.searchsorted(words, _END)), classes)
    model = Clustering(words, label, _contexts(bigrams, label, classes))
    size = 2 * classes + 1
    answers = materialize(bl.answer(bl.ask(blocks, _words_asked(model, count)), _words_answered(model)), "lm-answers")
    tokens, types = _class_totals(answers, size)
    scored = materialize(
        bl.with_answers(blocks, answers.where("block >= 0"), _emissions(count, tokens, types, n, v),
                        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
                        "emission double, labels binary"), "lm-emissions")
    transition = _transitions(scored, tokens, types, n, v)

    def final(batches):
        for batch in batches:
            if batch.num_rows:
                flat, document = _flat(batch.column(batch.schema.get_field_index("labels")))
                flat &= _ONCE - 1
                step = transition[_before(flat, document), flat]
                score = batch.column(batch.schema.get_field_index("emission")).to_numpy() + np.bincount(document, step, batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(4)]
                    + [pa.array(np.full(batch.num_rows, n)), batch.column(4), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return (scored.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "labels")
            .mapInArrow(final, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                               "train_tokens long, base_score double, score double"))


def corpus_scores(docs: DataFrame, remainder: int = 1, **options) -> DataFrame:
    """Class scores with the documents of this crc32 remainder held out."""
    return class_scores(docs.select("doc_id", "text", held_out("doc_id", remainder).alias("held_out")), **options)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of the model and of the unigram base, by fold."""
    def of(column: str):
        return F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(of("score").alias("model"), of("base_score").alias("unigram"))
