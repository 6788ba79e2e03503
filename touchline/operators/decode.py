"""Tolerant JSON decode of topic records.

A record that is not one JSON object is dropped.  Inside an object, a missing
or unusable field becomes NULL and its neighbours survive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline import schemas

_CORRUPT = "_corrupt_record"


def _lenient(schema: T.StructType) -> T.StructType:
    """Scalars as text, maps as they are, plus the malformed-record column."""
    fields = [
        T.StructField(f.name, f.dataType if isinstance(f.dataType, T.MapType) else T.StringType())
        for f in schema.fields
    ]
    return T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.MapType)):
        return text
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        # 1.9 and 1e3 are cut to whole numbers, which only decimals can read.
        cut = text.try_cast("decimal(38,18)").try_cast(field.dataType)
        return F.coalesce(text.try_cast(field.dataType), cut).alias(field.name)
    return text.try_cast(field.dataType).alias(field.name)


def narrowed(schema: T.StructType, columns: Sequence[str]) -> T.StructType:
    """The fields of ``schema`` named in ``columns``, in the order of the schema."""
    unknown = set(columns) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    return T.StructType([f for f in schema.fields if f.name in columns])


def decode(
    records: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``schema`` from the JSON text in ``value``.

    With ``columns`` only these fields are parsed: the parser skips the others
    without building their values, and no map is made that nobody reads.  Which
    records count as objects does not depend on it.

    ``partition``, ``offset`` and ``record_time`` are kept where the source has them.  Each
    record is parsed once; only those flagged as malformed are looked at again,
    to tell broken JSON from an object with one unusable field.
    """
    schema = schema if columns is None else narrowed(schema, columns)
    value = F.col("value").cast("string")
    parsed = F.from_json(value, _lenient(schema), {"columnNameOfCorruptRecord": _CORRUPT})

    def is_object(p: Column) -> Column:
        readable = F.from_json(value, T.MapType(T.StringType(), T.StringType()))
        opens = F.ltrim(value, F.lit(" \t\r\n")).startswith("{")
        return opens & (p[_CORRUPT].isNull() | readable.isNotNull())

    # inline() keeps the filter and the columns on one from_json evaluation.
    position = [c for c in (*schemas.POSITION, schemas.RECORD_TIME) if c in records.columns]
    rows = records.select(*position, F.inline(F.filter(F.array(parsed), is_object)))
    return rows.select(*[_typed(f) for f in schema.fields], *position)
