"""Packing token pieces into fixed-size sequences by exact complements, then best fit.

Only the histogram of lengths decides a packing, and it has at most ``capacity``
entries however many pieces there are.  So the plan is made on the driver from that
histogram: single lengths, pairs and triples that fill a gap exactly are consumed
under their availability counts, longest piece first; what is left goes best-fit
decreasing, a whole class of equal sequences at a time.  The plan says which ranks
of each length go where.  Ranks are dealt by Spark: a piece's number within its task
and length, plus how many pieces of that length earlier tasks have.

Defined results: null text is empty text, whose only token is the end mark; repeated
rows and null ids are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from touchline.llm.bpe import codec
from touchline.llm.common import as_table

CAPACITY = 2048
END = 0  # the id that closes every document
RANKS = 1 << 40  # more than any length has pieces


def encode(path: str, text: str | None) -> bytes:
    """Token ids of one text as little-endian 32-bit numbers."""
    return array("I", codec(path).encode(text or "")).tobytes()


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = array("I", [END]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(path, text) + end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                cuts = [0, *range(first, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a : 4 * b]
                    own = (np.frombuffer(part, dtype="<u4").astype(np.int64),) if with_ids else ()
                    rows.append((doc_id, i, a, b - a, zlib.crc32(part), *own))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"][: int(with_ids)]]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Token pieces of at most ``capacity`` ids; of a longer document the first is the shorter."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids array<bigint>"
    return docs.select("doc_id", "text").mapInPandas(_pieces(path, capacity, with_ids), schema)


class Plan:
    """Sequences as (lengths, how many), made by consuming a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.sequences: list[tuple[tuple[int, ...], int]] = []
        self._exact()
        self._best_fit()

    def _take(self, *lengths: int) -> None:
        need = Counter(lengths)
        n = min(int(self.left[x]) // k for x, k in need.items())
        if n:
            for x, k in need.items():
                self.left[x] -= n * k
            self.sequences.append((lengths, n))

    def _pairs(self, total: int) -> list[tuple[int, int]]:
        """Available lengths b >= c with b + c = total, the longest b first."""
        if total < 2:
            return []
        b = np.arange(total - 1, (total - 1) // 2, -1)
        ok = (self.left[b] > 0) & (self.left[total - b] > 0)
        return [(int(x), total - int(x)) for x in b[ok]]

    def _exact(self) -> None:
        self._take(self.capacity)
        for longest in range(self.capacity - 1, 0, -1):
            gap = self.capacity - longest
            if self.left[longest]:
                self._take(longest, gap)
            for pair in self._pairs(gap) if self.left[longest] else []:
                self._take(longest, *pair)
                if not self.left[longest]:
                    break
            for third in range(gap - 2, 0, -1):
                if not self.left[longest]:
                    break
                if self.left[third]:
                    for b, c in self._pairs(gap - third):
                        if b <= third:
                            self._take(longest, third, b, c)

    def _best_fit(self) -> None:
        bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            for gap in range(length, self.capacity):
                while n and bins[gap]:
                    lengths, many = bins[gap].pop()
                    put = min(n, many)
                    if many > put:
                        bins[gap].append((lengths, many - put))
                    bins[gap - length].append(((*lengths, length), put))
                    n -= put
                if not n:
                    break
            each = self.capacity // length
            if n >= each:
                bins[self.capacity - each * length].append(((length,) * each, n // each))
            if n % each:
                bins[self.capacity - n % each * length].append(((length,) * (n % each), 1))
            self.left[length] = 0
        self.sequences += [s for group in bins.values() for s in group]

    def segments(self) -> np.ndarray:
        """Rows (length * RANKS + first rank, first sequence, offset), sorted by the first."""
        used, rows, base = Counter(), [], 0
        for lengths, many in self.sequences:
            offset = 0
            for length in lengths:
                rows.append((length * RANKS + used[length], base, offset))
                used[length] += many
                offset += length
            base += many
        return np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number the pieces of each length within the task."""
    seen: Counter = Counter()
    task = TaskContext.get().partitionId()
    for batch in batches:
        nth = batch.groupby("length").cumcount() + batch["length"].map(lambda x: seen[x])
        seen.update(batch["length"].value_counts().to_dict())
        yield batch.assign(task=task, nth=nth.astype("int64"))


def _placed(segments: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            key = batch["length"].to_numpy(np.int64) * RANKS + batch["rank"].to_numpy(np.int64)
            at = np.searchsorted(segments[:, 0], key, side="right") - 1
            yield batch.drop(columns="rank").assign(
                sequence_id=segments[at, 1] + key - segments[at, 0], offset=segments[at, 2]
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``."""
    kept = T.StructType([f for f in pieces.schema.fields if f.name not in ("task", "nth", "rank", "sequence_id", "offset")])
    number = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("nth", T.LongType())])
    place = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    source = pieces.select(*kept.names)
    numbered = as_table(source.mapInPandas(_numbered, T.StructType(kept.fields + number.fields)), "packing-pieces")
    per_task = numbered.groupBy("task", "length").agg(F.count(F.lit(1)).alias("many"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"))
    # At most one row per length, so at most ``capacity`` rows come here.
    counts = {r["length"]: r["many"] for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("many")).collect()}
    ranked = numbered.join(before, ["task", "length"]).select(*kept.names, (F.col("nth") + F.col("before")).alias("rank"))
    return ranked.mapInPandas(_placed(Plan(counts, capacity).segments()), T.StructType(kept.fields + place.fields))
