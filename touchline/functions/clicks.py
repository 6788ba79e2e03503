"""Click-id expressions over the ``clid_params`` map.

The map holds ``<name> -> click id`` and ``<name>_timestamp -> epoch
milliseconds as text``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline.functions.maps import clean_map, clean_text

# Companion-key suffix, its LIKE pattern (in which ``_`` matches
# any one character) and the lifetime of a stored click in seconds.
TIMESTAMP_SUFFIX = "_timestamp"
TIMESTAMP_PATTERN = "%_timestamp"
CLICK_LIFETIME = 30 * 24 * 60 * 60


def is_click_entry(name: Column, value: Column) -> Column:
    """Keep click ids: not a companion timestamp, not NULL, not empty."""
    return ~name.like(TIMESTAMP_PATTERN) & value.isNotNull() & (value != "")


def click_time_text(params: Column, name: Column) -> Column:
    return params[F.concat(name, F.lit(TIMESTAMP_SUFFIX))]


def click_time(params: Column, name: Column) -> Column:
    """Epoch milliseconds; NULL when the text is no number."""
    return click_time_text(params, name).try_cast("bigint")


def stored_click(
    fingerprint: Column,
    click_ms: Column,
    user_id: Column,
    click_id: Column,
    click_id_name: Column,
    utm_params: Column | None = None,
    event_id: Column | None = None,
    now: Column | None = None,
) -> list[Column]:
    """The fields of a stored click; ``utm_params`` and ``event_id`` may be left out.

    Empty texts and maps become NULL.  A NULL field is a field the item lacks.
    """
    no_utm = F.lit(None).cast("map<string,string>")
    no_event = F.lit(None).cast("string")
    clock = F.current_timestamp() if now is None else now
    return [
        clean_text(fingerprint).alias("fingerprint"),
        clean_text(click_id_name).alias("click_id_name"),
        click_ms.alias("click_time"),
        clean_text(user_id).alias("user_id"),
        clean_text(click_id).alias("click_id"),
        (no_utm if utm_params is None else clean_map(utm_params)).alias("utm_json"),
        (no_event if event_id is None else clean_text(event_id)).alias("event_id"),
        F.unix_millis(clock).alias("updated_at"),
        expire_at(click_ms).alias("expire_at"),
    ]


def expire_at(click_ms: Column) -> Column:
    """Unix seconds after which a click is forgotten; NULL without a click time."""
    return F.call_function("div", click_ms, F.lit(1000).cast("bigint")) + F.lit(CLICK_LIFETIME)
