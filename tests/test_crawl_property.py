"""The crawl window equals a plain page-by-page loop (brute force, random cases)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.crawl import crawl_window

AS_OF = dt.datetime(2025, 6, 30, 12)
DAY0 = dt.date(2025, 6, 30)


def loop(pages, start, max_pages, known, lookback):
    """Walk pages from ``start``; stop at a known URL, an old date or an empty page."""
    cutoff = AS_OF - dt.timedelta(days=lookback) if lookback else None
    out, page, done = [], start, 0
    while True:
        items = pages.get(page, [])
        if not items:
            return out
        for pos, (url, age) in enumerate(items):
            if url in known:
                return out
            day = DAY0 - dt.timedelta(days=age)
            if cutoff is not None and dt.datetime.combine(day, dt.time()) < cutoff:
                return out
            out.append(url)
        page += 1
        done += 1
        if max_pages is not None and done >= max(max_pages, 1):
            return out


case = st.fixed_dictionaries({
    "present": st.lists(st.integers(1, 8), min_size=0, max_size=8, unique=True),
    "per_page": st.integers(1, 4),
    "known_every": st.integers(2, 30),
    "start": st.integers(1, 3),
    "max_pages": st.one_of(st.none(), st.integers(0, 4)),
    "lookback": st.one_of(st.none(), st.integers(1, 20)),
})


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(c=case)
def test_prefix_equals_loop(spark, c):
    pages, rows, n = {}, [], 0
    for p in sorted(c["present"]):
        for pos in range(c["per_page"]):
            n += 1
            url, age = f"u{n}", n
            pages.setdefault(p, []).append((url, age))
            day = DAY0 - dt.timedelta(days=age)
            rows.append((p, pos, day.strftime("%B %-d, %Y"), "t", url, ["x"]))
    known = {f"u{i}" for i in range(1, n + 1) if i % c["known_every"] == 0}
    expected = loop(pages, c["start"], c["max_pages"], known, c["lookback"])
    items = spark.createDataFrame(
        rows, "page int, pos int, date string, title string, url string, types array<string>")
    kdf = spark.createDataFrame([(u,) for u in sorted(known)] or [("none",)], "url string")
    got = crawl_window(items, known=kdf, as_of=AS_OF, lookback_days=c["lookback"],
                       start_page=c["start"], max_pages=c["max_pages"])
    assert sorted(r.url for r in got.collect()) == sorted(expected)
