"""Look-up joins and first-per-key (survey IDs JOIN1, JOIN2, JOIN3, SET3).

The big sides here (the archive's known URLs, the content cache, landed
article pages) grow with the data; the small side is what one run touches
(the URLs of newly listed items).  The plans carry no broadcast hints: AQE
sees the measured bytes of the small side after its own stage and turns the
join into a broadcast when they are under the session's threshold, otherwise
it stays a shuffle join in which AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restrict_to(big: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``big`` whose ``on`` occurs in ``keys`` (a semi join).

    If ``big`` is a table bucketed by ``on`` (known URLs, content), its rows
    stay where they are and only the keys are exchanged.
    """
    return big.join(keys.select(on), on, "left_semi")


def first_by(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """SET3: one row per ``key``, the first in ``order``, ties by the other columns.

    The aggregate combines map-side, so a key repeated on a third of all rows
    is reduced inside each task instead of landing whole in one.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("__first")
    return df.groupBy(key).agg(best).select(key, *[F.col("__first")[c].alias(c) for c in (*order, *rest)])
