"""Batch model annotation (survey IDs ANN1-ANN4, ANN8).

An *answerer* turns the texts of a run into answers: a function from a frame
with the key columns and ``text`` (only rows that have one) and the topic to
a frame of the keys and

    response, model_used, error, latency_ms, n_attempts

with a row for each key.  One that looks at keys alone says so
(``reads_text = False``): then no text has to be brought to it, and the frame
may tell by ``text_source`` which rows have one.  There are two:

* ``live``: a chat-completions client through ``mapInPandas``: one client per
  task (built by the injected, picklable ``client_factory``), an optional
  thread pool per task for I/O-bound calls, one retry with a fallback model,
  and per-row error isolation (a failing row keeps a NULL answer and an
  ``error``; the task never raises).  Rows are hash-partitioned on the key
  first, so calls spread over all cores.  Only keys and prompts cross into
  Python, and only keys and answers come back.
* ``recorded``: a table of attempts that a batch service has answered already,
  joined by key: the first attempt that succeeded gives the answer, the last
  failure the error, all attempts the latency.

Model calls are the one non-deterministic, expensive step, so ``annotate``
writes the answers as a table before they are joined back: a lost executor
then re-reads rows instead of re-calling the model.  The answer text is parsed
JVM-side by ``quarry.functions.response``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.response import (DEFAULT_MODEL, FALLBACK_MODEL, SYSTEM_MESSAGE,
                                       TEMPERATURE, parse_response, prompt_text)
from quarry.session import materialize

ANSWER_FIELDS = [
    T.StructField("response", T.StringType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("n_attempts", T.IntegerType()),
]
ANSWER_COLUMNS = [f.name for f in ANSWER_FIELDS]
PARSED_COLUMNS = ["description", "relevant_eo", "full_summary"]
# What a text gets that no recorded attempt is about.
NOT_RECORDED = "no recorded answer"

Answerer = Callable[[DataFrame, "tuple[str, ...]", "str | None"], DataFrame]


def _ask(client, prompt: str, model: str, temperature: float) -> str:
    resp = client.chat.completions.create(
        model=model,
        messages=[{"role": "system", "content": SYSTEM_MESSAGE},
                  {"role": "user", "content": prompt}],
        temperature=temperature,
    )
    return (resp.choices[0].message.content or "").strip()


def _answer(client, prompt: str, model: str, fallback: str | None, temperature: float):
    t0 = time.perf_counter()
    try:
        out = (_ask(client, prompt, model, temperature), model, None)
        tries = 1
    except Exception as first:  # ANN3: one retry with the fallback model
        tries = 1
        out = (None, None, f"{type(first).__name__}: {first}")
        if fallback:
            tries = 2
            try:
                out = (_ask(client, prompt, fallback, temperature), fallback, None)
            except Exception as second:  # ANN4: isolate the row
                out = (None, None, f"{type(second).__name__}: {second}")
    return (*out, (time.perf_counter() - t0) * 1000.0, tries)


def live(client_factory: Callable[[], object], *, model: str = DEFAULT_MODEL,
         fallback_model: str | None = FALLBACK_MODEL, temperature: float = TEMPERATURE,
         partitions: int | None = None, concurrency: int = 1) -> Answerer:
    """Answers from a chat-completions client (ANN2-ANN4, ANN8)."""
    def answers(texts: DataFrame, keys: tuple[str, ...], topic: str | None) -> DataFrame:
        # The prompt is built JVM-side.  Model calls take seconds per row, so
        # spread them over every core whatever the input's file layout; hashing
        # on key and prompt keeps the split deterministic when a task is
        # retried and spreads rows whose key is blank.
        src = texts.select(*keys, prompt_text("text", topic).alias("__prompt"))
        n = partitions or texts.sparkSession.sparkContext.defaultParallelism
        src = src.repartition(n, F.xxhash64(*keys, "__prompt"))
        schema = T.StructType([src.schema[k] for k in keys] + ANSWER_FIELDS)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = None   # built on the first batch: empty partitions make none
            pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
            try:
                for pdf in batches:
                    if client is None:
                        client = client_factory()
                    prompts = pdf["__prompt"].tolist()
                    call = lambda p: _answer(client, p, model, fallback_model, temperature)
                    rows = list(pool.map(call, prompts)) if pool else [call(p) for p in prompts]
                    out = pdf[[*keys]].copy()
                    for k, c in enumerate(ANSWER_COLUMNS):
                        out[c] = [r[k] for r in rows]
                    yield out
            finally:
                if pool:
                    pool.shutdown()

        return src.mapInPandas(run, schema)
    return answers


def reads_text(answerer: Answerer | None) -> bool:
    """Whether texts have to be brought to this answerer."""
    return answerer is not None and getattr(answerer, "reads_text", True)


def recorded(attempts: DataFrame | Callable[[DataFrame], DataFrame], on: tuple[str, ...] = ("url",)) -> Answerer:
    """Answers from a table of attempts (ANN3, ANN4, ANN8 as joins and aggregates).

    ``attempts``: the ``on`` columns, ``attempt`` (order), ``model``,
    ``response`` (NULL if it failed), ``error``, ``latency_ms``; or a function
    that gives those of the distinct ``on`` values in a frame, so that no
    others are put together.  Attempts
    after the first success don't count.  The attempts of a key are brought
    together once, for all steps; a key that they don't know keeps a NULL
    answer and an error.
    """
    def answers(texts: DataFrame, keys: tuple[str, ...], topic: str | None) -> DataFrame:
        # written first: Spark then knows how few they are before it moves any attempts
        wanted = materialize(texts.select(*dict.fromkeys((*keys, *on))), "wanted")
        asked = wanted.select(*on).distinct()
        known = attempts(asked) if callable(attempts) else attempts.join(asked, list(on), "left_semi")
        ok = F.col("response").isNotNull()
        won = F.min(F.when(ok, F.col("attempt"))).over(Window.partitionBy(*on))
        counted = known.withColumn("__won", won).filter(F.col("__won").isNull() | (F.col("attempt") <= F.col("__won")))
        per_key = counted.groupBy(*on).agg(
            F.max_by(F.struct("response", F.when(ok, F.col("model")).alias("model"), F.when(~ok, F.col("error")).alias("error")),
                     F.struct("attempt", "model")).alias("__last"),
            F.sum("latency_ms").alias("latency_ms"), F.count(F.lit(1)).cast("int").alias("n_attempts"))
        out = wanted.join(per_key, list(on), "left")
        return out.select(*keys, F.col("__last.response").alias("response"), F.col("__last.model").alias("model_used"),
                          F.when(F.col("__last").isNull(), F.lit(NOT_RECORDED)).otherwise(F.col("__last.error")).alias("error"),
                          F.col("latency_ms").cast("double").alias("latency_ms"), F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"))
    answers.reads_text = False
    return answers


def annotate(df: DataFrame, answerer: Answerer, *, keys: tuple[str, ...] = ("url",), topic: str | None = None,
             parse: bool = True, whole: bool = True) -> DataFrame:
    """Annotate every row of ``df`` (ANN1-ANN5, ANN8); ``keys`` name a row and ``text`` is its text.

    Returns the rows with ``response, model_used, error, latency_ms,
    n_attempts`` and, with ``parse``, ``description, relevant_eo,
    full_summary`` (NULL when there was no answer).  Without ``whole`` they
    have ``answered`` (whether there was one) in place of ``response``, so no
    answer moves whole.  Rows whose text is NULL or empty pass through without
    a model call (FIL7); rows without a ``text`` column, for an answerer that
    doesn't read it, have one where there is a ``text_source``.  ``df`` is read
    twice: stage it first if it is expensive.
    """
    if "text" not in df.columns and reads_text(answerer):
        raise ValueError("this answerer reads texts")
    readable = df.filter(F.coalesce(F.col("text"), F.lit("")) != "" if "text" in df.columns else F.col("text_source").isNotNull())
    found = stage(answerer(readable, keys, topic), "answers")
    if parse:
        ok = F.col("response").isNotNull()
        found = parse_response(found.withColumn("__r", F.coalesce("response", F.lit(""))), "__r").drop("__r").withColumns(
            {c: F.when(ok, F.col(c)) for c in PARSED_COLUMNS})
    if not whole:
        found = found.withColumn("response", F.col("response").isNotNull()).withColumnRenamed("response", "answered")
    new = [c for c in found.columns if c not in keys]
    same = None
    for k in keys:
        one = df[k].eqNullSafe(F.col(f"__k_{k}"))
        same = one if same is None else same & one
    right = found.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    return df.drop(*[c for c in new if c in df.columns]).join(right, same, "left").select(
        *[c for c in df.columns if c not in new], *new)


def latency_report(answered: DataFrame, by: str = "model_used") -> DataFrame:
    """ANN8: calls, failures and latency quantiles per model, in one aggregate."""
    q = F.percentile_approx("latency_ms", [0.5, 0.9, 0.99])
    return (answered.filter(F.col("n_attempts") > 0).groupBy(F.coalesce(by, F.lit("(none)")).alias(by))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("error").alias("n_failed"),
                 F.sum(F.col("n_attempts") - 1).cast("long").alias("n_retries"), q.alias("__q"))
            .select(by, "n_rows", "n_failed", "n_retries", *[F.col("__q")[i].alias(n) for i, n in enumerate(("p50_ms", "p90_ms", "p99_ms"))]))


def stage(df: DataFrame, name: str = "annotations") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage so downstream reuse (append + metrics) never re-runs the
    model calls, also after an executor loss.
    """
    return materialize(df, name)
