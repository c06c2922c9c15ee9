"""URLs that a stream has seen, as keyed state with a bound (survey IDs STM2, STM4).

The state holds, per URL, the newest event time it was listed with.  A row is

* ``new``: the first of its URL within the window,
* ``repeat``: its URL is remembered (or came earlier in the same batch),
* ``late``: its event time is before the watermark, so the state can't say.

``dropDuplicatesWithinWatermark`` would drop late rows without a trace, and so
would a state with event-time timeouts; here every row comes out with its
status, and the caller decides.  The state is keyed by a hash of the URL, many
URLs to a group, and a group forgets the URLs whose newest listing is a window
before the watermark whenever it is called; so it holds about one window's
listings.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.functions.dates import parse_archive_date

# --- fixed values -----------------------------------------------------------
NEW, REPEAT, LATE = "new", "repeat", "late"
DAY_MS = 86_400_000
GROUPS = 256           # of URLs, by hash
OUT_SCHEMA = "page INT, pos INT, date STRING, title STRING, url STRING, types ARRAY<STRING>, status STRING"
STATE_SCHEMA = "urls ARRAY<STRING>, newest ARRAY<BIGINT>"
# ---------------------------------------------------------------------------


def statuses(rows: list[tuple], remembered: dict[str, int], mark: int) -> list[str]:
    """The status of each (url, event time) in order; ``remembered`` is brought up to date.

    Rows without a URL or an event time have no place in the state: they are
    ``new``, and the archive's own rules decide.
    """
    out = []
    for url, at in rows:
        if not url or at is None:
            out.append(NEW)
        elif at < mark:
            out.append(LATE)
        else:
            out.append(REPEAT if url in remembered else NEW)
            remembered[url] = max(at, remembered.get(url, at))
    return out


def flagged(items: DataFrame, window_days: int, groups: int = GROUPS) -> DataFrame:
    """The items of a stream, each with its ``status``; the event time is the item's date."""
    timed = items.withColumn("at", parse_archive_date("date").cast("timestamp")).withWatermark("at", f"{int(window_days)} days")
    group = F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.when(F.coalesce("url", F.lit("")) == "", F.col("pos"))), F.lit(groups))
    keyed = timed.withColumn("group", group).withColumn("ms", F.unix_millis("at"))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        urls, newest = state.get if state.exists else ([], [])
        remembered = {u: n for u, n in zip(urls, newest) if n >= mark - window_days * DAY_MS}
        rows = pd.concat(list(parts)).sort_values(["page", "pos"], kind="stable")
        times = [None if pd.isna(m) else int(m) for m in rows["ms"]]
        out = rows[["page", "pos", "date", "title", "url", "types"]].copy()
        out["status"] = statuses(list(zip(rows["url"], times)), remembered, mark)
        state.update((list(remembered), list(remembered.values())))
        yield out

    return keyed.groupBy("group").applyInPandasWithState(step, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
