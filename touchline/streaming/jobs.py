"""One streaming query per topic.

The event job scans its topic once and feeds several sinks from one persisted
set of winners.  Every sink write is idempotent for a replayed micro-batch:
clicks first, then the change-log, then the archive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from touchline import schemas
from touchline.operators import clicks, enrich
from touchline.operators.decode import decode
from touchline.session import configure
from touchline.sinks import archive, changelog, click_store, click_table
from touchline.sinks.commits import commit_id, generation, merge_into
from touchline.streaming.best_rows import STATE_TTL_SECONDS, BestRows, batch_clock
from touchline.streaming.health import observed

# Fixed value: time between micro-batches.
TRIGGER = "60 seconds"

COALESCE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"

ARRIVAL = [("partition", "asc"), ("offset", "asc")]
EARLIEST = [("event_time", "asc"), *ARRIVAL]
LATEST = [("event_time", "desc"), *ARRIVAL]
NEWEST_CLICK = [("click_time", "desc"), ("event_time", "asc"), *ARRIVAL]

# What of an event a stored click needs; nothing else is kept per click.
CLICK_FIELDS = [
    "event_id", "user_id", "anonymous_id", "event_time", "utm_params", "clid_params", *schemas.POSITION
]

# Takes the rows, the processing time, and the id of the batch or of its commit.
Write = Callable[[DataFrame, datetime, int], None]
Put = Callable[[DataFrame, datetime, str], None]


def stamped(records: DataFrame, schema) -> DataFrame:
    """Decoded rows with the processing time of their micro-batch.

    The session is put on UTC first, because hours are cut from UTC instants.
    """
    configure(records.sparkSession)
    return observed(enrich.with_processed_time(decode(records, schema)))


def _write_improved(best: BestRows, batch: DataFrame, batch_id: int, now, write: Write) -> None:
    winners = best.winners(batch, batch_id, now).persist()
    try:
        write(best.improved(winners), now, batch_id)
        best.save(winners, batch_id)
    finally:
        winners.unpersist()


def _start(
    rows: DataFrame,
    checkpoint: str,
    process: Callable[[DataFrame, datetime, int], None],
    reused: bool = False,
) -> DataStreamWriter:
    """A query over micro-batches; one that is ``reused`` is decoded only once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # The session of a batch belongs to its query; others are not affected.
        # Without this, a small batch leaves one tiny file per shuffle partition.
        batch.sparkSession.conf.set(COALESCE_CACHED, "true")
        now = batch_clock(batch.sparkSession, checkpoint, batch_id)
        if reused:
            batch = batch.persist()
        try:
            process(batch, now, batch_id)
        finally:
            if reused:
                batch.unpersist()

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=TRIGGER)


def best_rows_job(
    rows: DataFrame,
    keys: list[str],
    order: list[tuple[str, str]],
    checkpoint: str,
    write: Write,
    ttl_seconds: int = STATE_TTL_SECONDS,
) -> DataStreamWriter:
    """New and better rows per key go to ``write``; rows carry ``processed_time``."""
    best = BestRows(f"{checkpoint}/best_rows", keys, order, ttl_seconds)

    def process(batch: DataFrame, now: datetime, batch_id: int) -> None:
        _write_improved(best, batch, batch_id, now, write)

    return _start(rows, checkpoint, process)


def _committed(checkpoint: str, path: str, put: Put) -> Write:
    """Give ``put`` the commit id of a batch instead of its number."""
    known: list[int] = []

    def write(rows: DataFrame, now: datetime, batch_id: int) -> None:
        if not known:
            name = path.rstrip("/").rsplit("/", 1)[-1]
            known.append(generation(rows.sparkSession, f"{checkpoint}/sinks/{name}", [path]))
        put(rows, now, commit_id(known[0], batch_id))

    return write


@dataclass(frozen=True)
class EventSinks:
    """Where the event job writes; a sink left out is not written.

    ``publish`` takes the change-log of a batch, for instance
    :func:`touchline.sinks.changelog.write_kafka`.  ``click_rule`` stores the
    ``"latest"`` sighting of each click id or each click ``"instance"``.
    ``clicks_from`` names the batch from which on clicks are stored, for a store
    that is added to a query that already ran.  ``archive_table`` names a catalog
    table whose format has MERGE; it is upserted in place of commits in ``archive``.
    ``click_table`` names a catalog table of clicks, bucketed by key, in place of ``clicks``.
    """

    archive: str | None = None
    publish: Callable[[DataFrame, int], None] | None = None
    clicks: str | None = None
    click_rule: str = "latest"
    clicks_from: int = 0
    archive_table: str | None = None
    click_table: str | None = None


def event_job(
    records: DataFrame,
    sinks: EventSinks,
    checkpoint: str,
    keep: str = "first",
    archive_all: bool = False,
    ttl_seconds: int = STATE_TTL_SECONDS,
) -> DataStreamWriter:
    """Raw events to the change-log, the archive and the click store.

    With ``archive_all`` the archive takes every event that arrives instead of
    the deduplicated ones, and relies on its key alone.
    """
    if keep not in ("first", "last") or sinks.click_rule not in ("latest", "instance"):
        raise ValueError(f"unknown rule: keep={keep!r}, click_rule={sinks.click_rule!r}")
    order = EARLIEST if keep == "first" else LATEST
    best = BestRows(f"{checkpoint}/best_rows", schemas.EVENT_KEY, order, ttl_seconds)
    latest = sinks.click_rule == "latest"
    click_keys = clicks.LATEST_KEY if latest else clicks.INSTANCE_KEY
    click_order = NEWEST_CLICK if latest else LATEST
    best_clicks = BestRows(
        f"{checkpoint}/best_clicks", click_keys, click_order, ttl_seconds, sinks.clicks_from
    )

    def put_items(rows: DataFrame, now: datetime, commit: str | int) -> None:
        if latest:
            items = clicks.click_items(rows, F.lit(now))
        else:
            items = clicks.instance_items(clicks.instance_rows(rows))
        if sinks.click_table:
            click_table.put_items(items, sinks.click_table, now)
        else:
            click_store.put_items(items, sinks.clicks, commit)

    def put_archive(rows: DataFrame, now: datetime, commit: str) -> None:
        if archive_all:
            rows = archive.last_arrivals(enrich.with_hour_partition(rows))
        archive.upsert_archive(enrich.to_event_archive(rows), sinks.archive, commit)

    put_clicks = put_items if sinks.click_table else _committed(checkpoint, sinks.clicks or "", put_items)
    has_clicks = bool(sinks.clicks or sinks.click_table)
    archived = _committed(checkpoint, sinks.archive or "", put_archive)

    def merge_archive(rows: DataFrame, now: datetime, batch_id: int) -> None:
        if archive_all:
            rows = archive.last_arrivals(enrich.with_hour_partition(rows))
        merge_into(enrich.to_event_archive(rows), sinks.archive_table, schemas.ARCHIVE_KEY)

    archived = merge_archive if sinks.archive_table else archived
    has_archive = bool(sinks.archive or sinks.archive_table)

    def put_events(rows: DataFrame, now: datetime, batch_id: int) -> None:
        if sinks.publish:
            sinks.publish(changelog.to_changelog(enrich.to_processed_events(rows)), batch_id)
        if has_archive and not archive_all:
            archived(rows, now, batch_id)

    def process(batch: DataFrame, now: datetime, batch_id: int) -> None:
        if has_clicks and batch_id >= sinks.clicks_from:
            entries = clicks.explode_clicks(batch.select(*CLICK_FIELDS))
            entries = entries if latest else clicks.with_click_time_text(entries)
            entries = entries.drop("clid_params")  # all that is needed of it is in columns by now
            _write_improved(best_clicks, entries, batch_id, now, put_clicks)
        _write_improved(best, batch, batch_id, now, put_events)
        if has_archive and archive_all:
            archived(batch, now, batch_id)

    reused = bool(has_clicks or archive_all)
    return _start(stamped(records, schemas.RAW_EVENTS), checkpoint, process, reused)


def attributed_job(
    records: DataFrame,
    archive_path: str,
    checkpoint: str,
    ttl_seconds: int = STATE_TTL_SECONDS,
    archive_table: str | None = None,
) -> DataStreamWriter:
    """Attributed events, earliest copy per event, to their archive.

    With ``archive_table`` a catalog table whose format has MERGE is upserted.
    """

    def put(rows: DataFrame, now: datetime, commit: str) -> None:
        archive.upsert_archive(enrich.to_attributed_archive(rows), archive_path, commit)

    def merge(rows: DataFrame, now: datetime, batch_id: int) -> None:
        merge_into(enrich.to_attributed_archive(rows), archive_table, schemas.ARCHIVE_KEY)

    write = merge if archive_table else _committed(checkpoint, archive_path, put)
    rows = stamped(records, schemas.ATTRIBUTED_EVENTS)
    return best_rows_job(rows, schemas.EVENT_KEY, EARLIEST, checkpoint, write, ttl_seconds)


def exposure_job(records: DataFrame, archive_path: str, checkpoint: str) -> DataStreamWriter:
    """Exposure events, unique upstream, to their append archive."""
    rows = enrich.to_exposure_archive(stamped(records, schemas.EXPOSURE_EVENTS))
    writer = archive.append_archive(rows, archive_path, checkpoint)
    return writer.trigger(processingTime=TRIGGER)
