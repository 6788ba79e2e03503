"""Helpers that feed literal records to streaming jobs."""

from __future__ import annotations

import json
import os

from touchline import schemas


def add_file(spark, path: str, records: list[dict | str], first_offset: int = 0) -> None:
    """One more file of topic records, partition 0."""
    rows = [
        (r if isinstance(r, str) else json.dumps(r), 0, first_offset + i)
        for i, r in enumerate(records)
    ]
    frame = spark.createDataFrame(rows, schemas.TOPIC_RECORDS).coalesce(1)
    frame.write.mode("append").parquet(path)


def drain(writer) -> None:
    """Run the job over what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert not query.isActive
    if query.exception() is not None:
        raise query.exception()


def event(event_id: str, event_time: int, **fields) -> dict:
    return {"event_id": event_id, "event_time": event_time, "event_type": "view", **fields}


def subfolder(folder: str, name: str) -> str:
    return os.path.join(folder, name)
