"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

Every benchmark item becomes its windows of ``WINDOW`` consecutive words (an
item with fewer words is one window).  A document contains a window when the
window's words occur in it, consecutively and in order.

*Prefix*: containment asks for all words of a window, so its one rarest word
is a sufficient prefix.  Rarity is the frequency in the whole corpus, ties by
the word.  Each window is keyed by its rarest word and that word's offset.
*Length and position*: a document word that equals the key fixes where the
window would begin; it must begin and end inside the document.
*Verification*: the document's slice must equal the window's words.

The document side is scanned, split and exploded in a streaming stage; only
its hits are shuffled.  The windows are broadcast when their words hold at
most ``BROADCAST_BYTES`` (measured on the written windows).  Beyond it a
document sends three numbers per word (its text's hash, the position, the
word's hash) to the key words, where AQE splits skewed ones; the candidate
starts come back to the texts, and the slice there must have the digest that
names the window.  Nothing but the texts' words themselves, once, travels
with a document.

Words are the runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after folding A-Z.  Null or empty texts have no words, hit nothing and offer
no window.  Repeated documents are judged row by row; repeated items each
count under their id; items without id are passed over.  Further columns are
not read.  With an empty benchmark nothing is contaminated.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

WINDOW = 10
#: Bytes of words in all windows up to which they are broadcast.
BROADCAST_BYTES = 8 << 20

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def folded(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(folded(text), _BREAK), "")


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, win) of every window of every item with words."""
    n = F.size("words")
    starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).when(n > 0, F.array(F.lit(0)))
    return (benchmark.where(F.col("item_id").isNotNull())
            .select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
            .select("item_id", "words", F.explode(starts).alias("at"))
            .select("item_id", F.slice("words", F.col("at") + 1, size).alias("win")).distinct())


def word_frequency(docs: DataFrame, vocabulary: DataFrame, small: bool = True) -> DataFrame:
    """(word, n): occurrences in all documents of each word of the vocabulary."""
    every = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    if small:
        return every.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    return every.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word")


def window_id(words: Column) -> Column:
    """The digest that names a window; no word holds a space."""
    return F.sha2(F.array_join(words, " "), 256)


def keyed_windows(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """(win_id, win, key, off): each distinct window with its rarest word and that word's offset."""
    distinct = windows.select("win").distinct().withColumn("win_id", window_id(F.col("win")))
    return (distinct.select("win_id", "win", F.posexplode("win").alias("off", "word"))
            .join(frequency, "word", "left")
            .groupBy("win_id").agg(
                F.first("win").alias("win"),
                F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("rarest"))
            .select("win_id", "win", F.col("rarest.word").alias("key"), F.col("rarest.off").alias("off")))


def hits(docs: DataFrame, keyed: DataFrame) -> DataFrame:
    """(doc_id, h, start, len, win_id) of every occurrence; ``h`` tells rows of one id apart."""
    spread = (docs.select("doc_id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("words"))
              .select("doc_id", "h", "words", F.posexplode("words").alias("pos", "word")))
    start, size = F.col("pos") - F.col("off"), F.size("win")
    return (spread.join(F.broadcast(keyed), spread["word"] == keyed["key"])
            .where((start >= 0) & (start + size <= F.size("words")))
            .where(F.slice("words", F.greatest(start, F.lit(0)) + 1, size) == F.col("win"))
            .select("doc_id", "h", start.alias("start"), size.alias("len"), "win_id"))


def shuffled_hits(docs: DataFrame, keyed: DataFrame) -> DataFrame:
    """What :func:`hits` returns, for windows too many to broadcast."""
    text = docs.select("doc_id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("words"))
    spread = text.select("h", F.posexplode("words").alias("pos", "word")).select("h", "pos", F.xxhash64("word").alias("w"))
    keys = keyed.select("win_id", "off", F.size("win").alias("len"), F.xxhash64("key").alias("w"))
    starts = (spread.join(keys, "w").select("h", (F.col("pos") - F.col("off")).alias("start"), "len", "win_id")
              .where("start >= 0").distinct())
    return (text.join(starts, "h").where(F.col("start") + F.col("len") <= F.size("words"))
            .where(window_id(F.slice("words", F.col("start") + 1, F.col("len"))) == F.col("win_id"))
            .select("doc_id", "h", "start", "len", "win_id"))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int, broadcast_bytes: int) -> tuple[DataFrame, DataFrame, bool]:
    """The written windows, every occurrence of one in a document, and whether the windows are few enough to broadcast."""
    windows = materialize(item_windows(benchmark, size), "item-windows")
    bulk = windows.agg(F.sum(F.octet_length(F.array_join("win", " "))).alias("b")).first().b or 0
    small = bulk <= broadcast_bytes
    vocabulary = windows.select(F.explode("win").alias("word")).distinct()
    keyed = materialize(keyed_windows(windows, word_frequency(docs, vocabulary, small)), "keyed-windows")
    return windows, (hits if small else shuffled_hits)(docs, keyed), small


def _union_length(spans: Column) -> Column:
    """Words covered by (start, len) spans."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(F.sort_array(spans), zero, lambda a, s: F.struct(
        (a["total"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).alias("total"),
        F.greatest(a["end"], s["start"] + s["len"]).alias("end")), lambda a: a["total"])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    windows, found, small = occurrences(docs, benchmark, size, broadcast_bytes)
    found = materialize(found, "window-hits")

    cover = found.groupBy("doc_id", "h").agg(
        _union_length(F.collect_set(F.struct("start", "len"))).cast("long").alias("n_hit"))
    members = windows.select("item_id", window_id(F.col("win")).alias("win_id"))
    items = (found.select("doc_id", "h", "win_id").distinct().join(F.broadcast(members) if small else members, "win_id")
             .groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    key = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["h"].eqNullSafe(b["h"])
    marked = cover.join(items, key(cover, items)).select(cover["doc_id"], cover["h"], "n_hit", "items")
    # counting the matches of a word equals splitting at the breaks, without the array
    base = docs.select("doc_id", F.xxhash64("text").alias("h"),
                       F.regexp_count(folded(F.col("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return (base.join(marked, key(base, marked), "left")
            .select(base["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(listed).cast("long").alias("n_items"),
                    F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns as they are."""
    _, found, _ = occurrences(docs, benchmark, size, broadcast_bytes)
    hit = materialize(found.select("doc_id", "h").distinct(), "hit-documents")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(hit["h"]), "left_anti")
