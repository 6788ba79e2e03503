"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes counted in Spark.

A window is ``WINDOW`` consecutive words of one document; it is repeated if its words also
start anywhere else.  Every window gets a rolling hash.  Counting all of them would shuffle
as many rows as there are words, so each window is first represented by its anchor, the
least hash of the shorter ``ANCHOR``-word grams in it: equal windows have equal anchors, and
neighbouring windows mostly share one.  Anchors of one text only cannot belong to a repeated
window; only windows of the other anchors are counted, each by the pair (anchor, window
hash).  Windows counted once give their place back with the count, so nothing is joined
back to the windows; overlapping repeated windows merge into maximal removal intervals.

Copies of a text are counted as one text with a number; all their windows are repeated.
A window that a text repeats itself leaves it as one row that says so, and rows are counted
within a task first, so a passage in a third of all documents is no hot group.

Defined results: null or empty text has no words; texts of under ``WINDOW`` words lose none;
repeated rows are copies; other columns pass through ``remove_repeats`` as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import (
    as_table,
    code_points,
    packed,
    span_hashes,
    text_keys,
    unpacked,
    unpacked_text,
    window_hashes,
    word_spans,
)

WINDOW = 35
ANCHOR = 8


def windows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and anchor of every window of a text."""
    points = code_points(text)
    words = span_hashes(points, *word_spans(points))
    found = window_hashes(words, WINDOW)
    if not len(found):
        return found, found
    grams = window_hashes(words, ANCHOR)
    anchors = grams[: len(found)].copy()
    for shift in range(1, WINDOW - ANCHOR + 1):
        np.minimum(anchors, grams[shift : shift + len(found)], out=anchors)
    return found, anchors


def repeated_within(found: np.ndarray) -> np.ndarray:
    """Whether each window occurs more than once in its own text."""
    _, place, many = np.unique(found, return_inverse=True, return_counts=True)
    return many[place] > 1


def spans_of(repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of words (end exclusive) that repeated windows cover."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > WINDOW)
    return at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))] + WINDOW


def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per text: number of words, distinct anchors, and which of them the text itself repeats."""
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found, anchors = windows(text)
            own = np.unique(anchors[repeated_within(found)]) if len(found) else found
            rows.append((np.setdiff1d(anchors, own).view(np.int64), own.view(np.int64)))
        yield batch[["h1", "h2"]].assign(once=[r[0] for r in rows], often=[r[1] for r in rows])


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (anchor, window, text, place, weight) of the windows of live anchors."""
    for batch in batches:
        parts = []
        for tid, data, copies, live in zip(batch["tid"], batch["packed"], batch["copies"], batch["live"]):
            found, anchors = windows(unpacked(data))
            used = np.flatnonzero(np.isin(anchors, np.asarray(live, dtype=np.int64).view(np.uint64)))
            _, first, many = np.unique(found[used], return_index=True, return_counts=True)
            at = used[first]
            weight = np.minimum(many * copies, 2)
            parts.append((anchors[at].view(np.int64), found[at].view(np.int64), np.full(len(at), tid), at, weight))
        if parts:
            yield pd.DataFrame(dict(zip(("anchor", "window", "tid", "place", "weight"), map(np.concatenate, zip(*parts)))))


def _cleaned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Remove what repeated windows cover: live windows but those found to be unique."""
    for batch in batches:
        rows = []
        for data, live, unique in zip(batch["packed"], batch["live"], batch["unique"]):
            text = unpacked(data)
            found, anchors = windows(text)
            repeated = np.isin(anchors, np.asarray(live, dtype=np.int64).view(np.uint64))
            if unique is not None:
                repeated[np.asarray(unique, dtype=np.int64)] = False
            rows.append(_cut(text, *spans_of(repeated)))
        out = pd.DataFrame(rows, columns=["n_removed", "starts", "ends", "cleaned"], index=batch.index)
        yield pd.concat([batch[["h1", "h2"]], out], axis=1)


def _cut(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Number of words removed, their intervals, and the text without them and the white space after."""
    if not len(starts):
        return 0, [], [], None
    first, _ = word_spans(code_points(text))
    edges = np.append(first, len(text))
    kept, at = [], 0
    for a, b in zip(edges[starts].tolist(), edges[ends].tolist()):
        kept.append(text[at:a])
        at = b
    return int((ends - starts).sum()), starts, ends, "".join([*kept, text[at:]])


def find_repeats(docs: DataFrame) -> DataFrame:
    """Per distinct text that loses words: ``h1, h2, n_removed, starts, ends, cleaned``."""
    source = docs.select("text", *text_keys()).where(F.col("text").isNotNull())
    rows = as_table(
        source.mapInPandas(_anchored, "h1 bigint, h2 bigint, once array<bigint>, often array<bigint>").where(
            F.size("once") + F.size("often") > 0
        ).withColumn("tid", F.monotonically_increasing_id()),
        "substrings-anchors",
    )
    each = rows.select("h1", F.explode("once").alias("anchor"))
    own = rows.select(F.explode("often").alias("anchor")).groupBy("anchor").agg(F.lit(True).alias("own"))
    # An anchor of one text (copies have one h1) is dead, unless a text repeats it itself.
    single = each.groupBy("anchor").agg(F.min("h1").alias("h1"), F.max("h1").alias("high")).where("h1 = high")
    dead = single.join(own, "anchor", "left_anti").groupBy("h1").agg(F.collect_list("anchor").alias("dead"))
    # The least number of a text's rows stands for all its copies, which have the same anchors.
    first = [F.first(c).alias(c) for c in ("once", "often")]
    texts = rows.groupBy("h1", "h2").agg(F.min("tid").alias("tid"), F.count(F.lit(1)).alias("copies"), *first)
    known = texts.join(dead, "h1", "left")
    every = F.concat("once", "often")
    live = F.when((F.col("copies") > 1) | F.col("dead").isNull(), every).otherwise(F.array_except(every, F.col("dead")))
    wanted = known.select("h1", "h2", "tid", "copies", live.alias("live")).where(F.size("live") > 0)
    # Texts cross shuffles packed, as they are most of what is shuffled.
    distinct = source.select("h1", "h2", packed(F.col("text")).alias("packed")).dropDuplicates(["h1", "h2"])
    held = as_table(distinct.join(wanted, ["h1", "h2"]), "substrings-texts")

    counted = held.select("tid", "packed", "copies", "live").mapInPandas(
        _counted, "anchor bigint, window bigint, tid bigint, place bigint, weight bigint"
    )
    lone = counted.groupBy("anchor", "window").agg(
        F.sum("weight").alias("weight"), F.min("tid").alias("tid"), F.min("place").alias("place")
    )
    unique = lone.where("weight = 1").groupBy("tid").agg(F.collect_list("place").alias("unique"))
    ready = held.join(unique, "tid", "left").select("h1", "h2", "packed", "live", "unique")
    cleaned = ready.mapInPandas(
        _cleaned, "h1 bigint, h2 bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, cleaned string"
    )
    return as_table(cleaned.where("n_removed > 0"), "substrings-cleaned")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The same rows and columns; ``text`` loses every word that a repeated window covers."""
    found = find_repeats(docs).select("h1", "h2", "cleaned")
    # A text crosses the shuffle once and packed; only texts that stay as they are get unpacked.
    row = F.struct(*(packed(F.col(c)).alias(c) if c == "text" else F.col(c) for c in docs.columns))
    keyed = docs.select(row.alias("row"), *text_keys()).join(found, ["h1", "h2"], "left")
    text = F.coalesce("cleaned", unpacked_text(F.when(F.col("cleaned").isNull(), F.col("row")["text"])))
    return keyed.select(*((text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
