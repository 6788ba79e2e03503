"""The stored clicks: one whole item per visitor and click-id name.

The newest click wins, within a micro-batch and across them, so the result does
not depend on where batches are cut.  Several writes of one click at one click
time are improvements of each other, and the last of them counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.operators.clicks import last_written, unexpired
from touchline.operators.dedup import top_rows
from touchline.schemas import LONG, TEXT, TEXT_MAP, struct
from touchline.sinks.commits import COMMIT, compact, read_commits, write_commit

# Types of the item fields.
ITEM_SCHEMA = struct(
    fingerprint=TEXT,
    click_id_name=TEXT,
    click_time=LONG,
    user_id=TEXT,
    click_id=TEXT,
    utm_json=TEXT_MAP,
    event_id=TEXT,
    updated_at=LONG,
    expire_at=LONG,
)


def put_items(items: DataFrame, path: str, commit: str) -> None:
    """Write whole items, one per key."""
    write_commit(last_written(items), path, commit)


def read_items(spark: SparkSession, *paths: str, now: Column | None = None) -> DataFrame:
    """The stored items that have not expired at ``now``."""
    written = read_commits(spark, paths, ITEM_SCHEMA)
    click = [*schemas.CLICK_KEY, "click_id", "click_time"]
    return unexpired(last_written(top_rows(written, click, [F.desc(COMMIT)])), now)


def compact_items(spark: SparkSession, path: str, target: str, now: Column | None = None) -> None:
    """Fold all commits into one and purge expired items."""
    read = lambda spark, *paths: read_items(spark, *paths, now=now)
    compact(spark, [path], ITEM_SCHEMA, schemas.CLICK_KEY, target, read=read)
