"""Click extraction, click ranking and stored click items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline import schemas
from touchline.functions import clicks as fx
from touchline.operators.dedup import RANK, arrival_order, top_rows

# By what clicks are deduplicated.
LATEST_KEY = ["anonymous_id", "k", "v"]
INSTANCE_KEY = ["anonymous_id", "user_id", "v", "click_time_text"]


def with_click(events: DataFrame, name: str) -> DataFrame:
    """Events that carry the click id ``name``."""
    return events.where(F.col("clid_params")[name].isNotNull())


def explode_clicks(events: DataFrame) -> DataFrame:
    """One row per click id: the event plus ``k``, ``v`` and ``click_time``.

    Events with a NULL or empty map give no rows.
    """
    entries = events.select("*", F.explode("clid_params").alias("k", "v"))
    kept = entries.where(fx.is_click_entry(F.col("k"), F.col("v")))
    return kept.withColumn("click_time", fx.click_time(F.col("clid_params"), F.col("k")))


def latest_clicks(events: DataFrame, max_rank: int = 1) -> DataFrame:
    """The newest sighting of each click id of each visitor.

    With ``max_rank=2`` the runner-up is kept as well, and ``is_new_click``
    tells it from the winner.  ``stored_for`` names the visitor whose stored
    click a row replaces; a runner-up replaces none.
    """
    clicks = explode_clicks(events)
    order = [F.desc("click_time"), F.asc("event_time"), *arrival_order(events)]
    ranked = top_rows(clicks, LATEST_KEY, order, max_rank)
    new = F.col(RANK) == 1
    return ranked.withColumns({"is_new_click": new, "stored_for": F.when(new, F.col("anonymous_id"))})


def with_click_time_text(clicks: DataFrame) -> DataFrame:
    stamp = fx.click_time_text(F.col("clid_params"), F.col("k"))
    return clicks.withColumn("click_time_text", stamp)


def click_instances(events: DataFrame) -> DataFrame:
    """The last event of each (visitor, user, click id, click time) instance.

    The click-time text, not its number, is part of the key, and the click-id
    name is not.
    """
    clicks = with_click_time_text(explode_clicks(events))
    order = [F.desc("event_time"), *arrival_order(events)]
    return instance_rows(top_rows(clicks, INSTANCE_KEY, order))


def instance_rows(clicks: DataFrame) -> DataFrame:
    return clicks.select(
        F.col("anonymous_id").alias("fingerprint"),
        "user_id",
        F.col("v").alias("click_id"),
        F.col("k").alias("click_id_name"),
        "click_time",
        F.col("utm_params").alias("utm_json"),
    )


def _keyed(items: DataFrame) -> DataFrame:
    """Items without a full key are not stored."""
    return items.where(F.col("fingerprint").isNotNull() & F.col("click_id_name").isNotNull())


def click_items(clicks: DataFrame, now: Column | None = None) -> DataFrame:
    """Stored items for winning clicks; rows without a key are not stored."""
    winners = clicks.where("is_new_click") if "is_new_click" in clicks.columns else clicks
    fields = fx.stored_click(
        F.col("anonymous_id"),
        F.col("click_time"),
        F.col("user_id"),
        F.col("v"),
        F.col("k"),
        F.col("utm_params"),
        F.col("event_id"),
        now,
    )
    return _keyed(winners.select(*fields))


def named_click_items(events: DataFrame, name: str, now: Column | None = None) -> DataFrame:
    """Stored items for one click-id name, straight from the events."""
    params = F.col("clid_params")
    fields = fx.stored_click(
        F.col("anonymous_id"),
        fx.click_time(params, F.lit(name)),
        F.col("user_id"),
        params[name],
        F.lit(name),
        F.col("utm_params"),
        now=now,
    )
    return _keyed(with_click(events, name).select(*fields))


def instance_items(instances: DataFrame) -> DataFrame:
    """Items from click instances, which carry no event, write time or expiry."""
    none = {
        "event_id": F.lit(None).cast("string"),
        "updated_at": F.lit(None).cast("bigint"),
        "expire_at": F.lit(None).cast("bigint"),
    }
    return _keyed(instances.withColumns(none).select(*schemas.CLICK_ITEMS))


def last_written(items: DataFrame) -> DataFrame:
    """One whole item per key from several writes of one batch.

    The newest click wins; among equals the ids decide, so a replay writes the
    same item.
    """
    order = [F.desc(c) for c in ("click_time", "event_id", "click_id", "user_id")]
    rows = top_rows(items, schemas.CLICK_KEY, order)
    return rows.select(*schemas.CLICK_ITEMS)


def unexpired(items: DataFrame, now: Column | None = None) -> DataFrame:
    """Items still alive at ``now``; items without a click time never expire."""
    seconds = F.unix_seconds(F.current_timestamp() if now is None else now)
    return items.where(F.col("expire_at").isNull() | (F.col("expire_at") > seconds))
