"""Keep the best rows per key by ROW_NUMBER.

``row_number() <= n`` makes Spark keep n rows per key in every map task before
the shuffle, so a key that holds a third of all rows sends only n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline import schemas

RANK = "row_num"


def arrival_order(events: DataFrame) -> list[Column]:
    """Source position where known; makes equal timestamps deterministic."""
    return [F.col(c).asc() for c in schemas.POSITION if c in events.columns]


def top_rows(
    rows: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    max_rank: int = 1,
) -> DataFrame:
    """Rows ranked ``1..max_rank`` within ``keys``, with the rank as ``row_num``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) <= max_rank)


def dedup_events(events: DataFrame, keep: str = "first") -> DataFrame:
    """One row per ``event_id``: the earliest, or the latest with ``keep="last"``.

    NULL ids count as one id and a NULL time as the smallest time.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    time = F.col("event_time")
    order = [time.asc() if keep == "first" else time.desc(), *arrival_order(events)]
    return top_rows(events, schemas.EVENT_KEY, order).drop(RANK)
