"""Keep the best row per key over micro-batches, forgetting idle keys.

A row goes out when it is the first of its key or better than every row of the
key so far, so a late copy with an earlier timestamp replaces the row already
written.  Sinks must therefore overwrite by key.

What has to be remembered is one narrow row per live key: its order columns and
a deadline.  It is kept as a Parquet table next to the stream's checkpoint, in
two slots: micro-batch ``n`` reads slot ``n - 1`` and rewrites slot ``n``
(modulo 2).  A slot says which batch wrote it, and a missing slot or one of
another batch stops the query: nothing known is never guessed.  A replayed batch
finds its input slot untouched, the table never outgrows the keys seen within
the lifetime, and ranking is the same ROW_NUMBER as in batch, so a hot key is
cut down before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline.operators.dedup import RANK, top_rows

# Fixed value: a key is forgotten after two minutes without a better row.
STATE_TTL_SECONDS = 120

_DEADLINE = "deadline"
_KNOWN = "known"
_BATCH = "written_by"


def batch_clock(spark: SparkSession, checkpoint: str, batch_id: int) -> datetime:
    """The processing time of a micro-batch, from the query's offset log.

    It is what ``current_timestamp`` gives within the batch.  The log is written
    before the batch runs and kept for a replay, and no source is read for it.
    """
    log = spark.read.text(f"{checkpoint}/offsets/{batch_id}")
    stamp = F.get_json_object("value", "$.batchTimestampMs").cast("bigint")
    (millis,) = log.select(stamp.alias("ms")).where("ms IS NOT NULL").first()
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=millis)


class LostState(RuntimeError):
    """The rows remembered by the batch before are missing or not its own."""


@dataclass(frozen=True)
class BestRows:
    """The best row per ``keys`` under ``order``, a list of (column, "asc"/"desc")."""

    path: str
    keys: Sequence[str]
    order: Sequence[tuple[str, str]]
    ttl_seconds: int = STATE_TTL_SECONDS
    first_batch: int = 0  # the batch with which this table begins

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def _remembered(self, batch: DataFrame, batch_id: int, now: datetime) -> DataFrame:
        names = list(dict.fromkeys([*self.keys, *[c for c, _ in self.order]]))
        fields = [batch.schema[c] for c in names]
        schema = T.StructType([*fields, T.StructField(_DEADLINE, T.TimestampType())])
        if batch_id <= self.first_batch:
            return batch.sparkSession.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
        try:
            slot = batch.sparkSession.read.schema(stored).parquet(self._slot(batch_id - 1))
            (writer,) = slot.agg(F.max(_BATCH)).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            writer = None
        if writer != batch_id - 1:
            raise LostState(
                f"{self.path}: batch {batch_id} needs the rows of batch {batch_id - 1}, found "
                f"those of {writer}; a table added to a running query must name its first batch"
            )
        return slot.where(F.col(_DEADLINE) > F.lit(now)).drop(_BATCH)

    def winners(self, batch: DataFrame, batch_id: int, now: datetime) -> DataFrame:
        """The best of the batch and what is remembered, one row per live key.

        Persist the result, take :meth:`improved` from it, then :meth:`save` it.
        """
        deadline = F.lit(now + timedelta(seconds=self.ttl_seconds))
        fresh = batch.withColumns({_DEADLINE: deadline, _KNOWN: F.lit(False)})
        known = self._remembered(batch, batch_id, now).withColumn(_KNOWN, F.lit(True))
        candidates = fresh.unionByName(known, allowMissingColumns=True)
        order = [F.asc(c) if way == "asc" else F.desc(c) for c, way in self.order]
        # An equal row is not an improvement: the remembered one stays.
        return top_rows(candidates, self.keys, [*order, F.desc(_KNOWN)]).drop(RANK)

    def improved(self, winners: DataFrame) -> DataFrame:
        """The rows of this batch that are new or better."""
        return winners.where(~F.col(_KNOWN)).drop(_KNOWN, _DEADLINE)

    def save(self, winners: DataFrame, batch_id: int) -> None:
        names = list(dict.fromkeys([*self.keys, *[c for c, _ in self.order]]))
        rows = winners.select(*names, _DEADLINE)
        # A row without a deadline only says whose slot this is, also if no key is live.
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        mark = winners.sparkSession.range(1, numPartitions=1).select(*blank)
        stored = rows.union(mark).withColumn(_BATCH, F.lit(batch_id).cast("bigint"))
        stored.write.mode("overwrite").parquet(self._slot(batch_id))
