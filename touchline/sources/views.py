"""Topics as SQL views, for users who write their jobs in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from touchline import schemas
from touchline.operators.decode import decode
from touchline.operators.enrich import with_event_timestamp

# View names and the schemas behind them.
TOPIC_VIEWS = {
    "raw_events": schemas.RAW_EVENTS,
    "attributed_events": schemas.ATTRIBUTED_EVENTS,
    "exposure_events": schemas.EXPOSURE_EVENTS,
}


def create_topic_view(
    records: DataFrame, name: str, columns: Sequence[str] | None = None
) -> None:
    """Decode topic records and make them queryable as ``name``.

    The view has the declared columns, or those of them named in ``columns``,
    then ``event_timestamp`` where it has ``event_time``, and the source
    position.  It is streaming if the records are.  Name the columns where a
    job reads few: the others are then not parsed.
    """
    rows = decode(records, TOPIC_VIEWS[name], columns)
    timed = with_event_timestamp(rows) if "event_time" in rows.columns else rows
    timed.createOrReplaceTempView(name)
