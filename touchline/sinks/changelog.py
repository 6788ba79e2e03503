"""The keyed change-log: JSON key, JSON value, overwrite per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline import schemas

def _json_field(field: T.StructField) -> Column:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss[.fff]`` text, all else as it is."""
    value = F.col(field.name)
    return value.cast("string").alias(field.name) if field.dataType == T.TimestampType() else value


def to_changelog(rows: DataFrame, keys: Sequence[str] = schemas.EVENT_KEY) -> DataFrame:
    """``key`` and ``value`` as JSON text; NULL fields stay in the value."""
    keep_nulls = {"ignoreNullFields": "false"}
    return rows.select(
        F.to_json(F.struct(*keys), keep_nulls).alias("key"),
        F.to_json(F.struct(*[_json_field(f) for f in rows.schema.fields]), keep_nulls).alias(
            "value"
        ),
    )


def write_kafka(log: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish a batch of the change-log; give the topic cleanup policy compact."""
    (
        log.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
