"""String-map expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what a NULL map key is written as.
NULL_KEY = "null"


def map_with_null_keys(keys: Column | str, values: Column | str) -> Column:
    """A map built from two arrays, with NULL keys replaced by ``NULL_KEY``.

    Among equal keys the last one wins, as it does when JSON is read.
    """
    entries = F.zip_with(
        keys,
        values,
        lambda k, v: F.struct(F.coalesce(k, F.lit(NULL_KEY)).alias("key"), v.alias("value")),
    )
    names = F.transform(keys, lambda k: F.coalesce(k, F.lit(NULL_KEY)))
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]),
    )
    return F.map_from_entries(last)


def clean_text(value: Column) -> Column:
    """NULL for empty text."""
    return F.nullif(value, F.lit(""))


def clean_map(value: Column) -> Column:
    """Drop NULL and empty values; an empty map becomes NULL."""
    kept = F.map_filter(value, lambda _, v: v.isNotNull() & (v != ""))
    return F.when(F.size(kept) > 0, kept)
