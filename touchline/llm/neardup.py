"""Near-duplicate classes by SetSketch registers, likelihood estimates and exact checks.

A document is the set of its five-word shingles.  Each of ``REGISTERS`` hash functions maps
shingles to exponential values; a register keeps their minimum, truncated to an exponent of
``BASE``.  Registers of two sets merge by maximum, and they agree about as often as the sets
overlap, so bands of them lead similar sets to common buckets.  The registers that are
greater, smaller and equal give the likelihood of every overlap at once, and pairs whose
best estimate is far below the threshold are dropped; every other pair is checked on the
full sets.

No bucket is ever expanded into all its pairs:

1. Copies are one class; only classes are compared.
2. In each bucket every class is compared with one pivot, the class that shares most buckets
   with others.  That links a group of near copies to its middle in one round.
3. Only classes still apart from others of their bucket are left.  What such a class shares
   with another component is at most what occurs outside its own; that bounds its similarity,
   exactly, and classes that cannot reach the threshold drop out.
4. The rest are compared with a second pivot, the class of their bucket that has least of its
   own, and then with all classes of other components of their bucket within the bound.

Defined results: null, empty or blank text has an empty set and is linked with nothing; a
text of fewer words than a shingle is one shingle; rows with a null id belong to their class
but do not name it, unless no row of it has an id; repeated rows are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import as_table, code_points, lower_ascii, mix, window_hashes, word_hashes

SHINGLE = 5
PERCENT = 85  # least similarity of linked sets
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
BASE, RATE = 1.1, 20.0
SLACK = 0.15  # estimates this far below the threshold (six deviations) are not checked


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = word_hashes(lower_ascii(code_points(text)))
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(SHINGLE, len(words))))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
    return (seeds[:REGISTERS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[REGISTERS:] >> np.uint64(32)).astype(np.uint32)


_FACTORS, _SHIFTS = _functions()


def registers(found: np.ndarray) -> np.ndarray:
    """The set's registers: truncated exponents of its least values."""
    least = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    low, high = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(found), 512):
        values = low[at : at + 512, None] * _FACTORS + (high[at : at + 512, None] ^ _SHIFTS)
        np.minimum(least, values.min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, 255).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs of sets, from their registers (rows) and sizes."""
    greater, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = REGISTERS - greater - smaller
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :]

    def apart(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = apart(u - v * grid), apart(v - u * grid)
    tiny = 1e-12
    likelihood = greater * np.log(more + tiny) + smaller * np.log(less + tiny) + equal * np.log(np.maximum(1 - more - less, tiny))
    return grid[0][likelihood.argmax(axis=1)]


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found = shingles(text)
            key = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
            rows.append((len(found), key, registers(found).tobytes() if len(found) else None))
        out = pd.DataFrame(rows, columns=["n", "key", "registers"], index=batch.index)
        yield pd.concat([batch[["doc_id", "text_hash"]], out], axis=1)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[["cid"]].assign(found=[shingles(t).tobytes() for t in batch["text"]])


def _likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            a, b = (np.frombuffer(b"".join(batch[c]), dtype=np.uint8).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            best = estimate(a, b, batch["na"].to_numpy(float), batch["nb"].to_numpy(float))
            yield batch.loc[best >= PERCENT / 100 - SLACK, ["a", "b"]]


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ok = []
        for x, y in zip(batch["fa"], batch["fb"]):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.loc[np.array(ok, dtype=bool), ["a", "b"]]


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        each = [np.frombuffer(f, dtype=np.int64) for f in batch["found"]]
        if each:
            sizes = [len(e) for e in each]
            yield pd.DataFrame({c: np.repeat(batch[c].to_numpy(), sizes) for c in ("cid", "label")} | {"shingle": np.concatenate(each)})


def check_pairs(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough, estimated first and then checked."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("registers").alias(f"r{c}"), F.col("n").alias(f"n{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = sized.where((100 * F.col("na") >= PERCENT * F.col("nb")) & (100 * F.col("nb") >= PERCENT * F.col("na")))
    likely = sized.mapInPandas(_likely, "a bigint, b bigint")
    full = lambda c: sets.select(F.col("cid").alias(c), F.col("found").alias(f"f{c}"))
    return likely.join(full("a"), "a").join(full("b"), "b").mapInPandas(_linked, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``cid, label``: the least node of every linked node's component.

    Each round takes the least label of all neighbours, then the label's own label, which
    doubles the reach; rounds are written tables.
    """
    both = as_table(
        edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").where("a <> b").distinct(), "components-edges"
    )
    labels = as_table(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("cid"), F.least("a", "b").alias("label")), "components")
    while True:
        near = both.join(labels.select(F.col("cid").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels["cid"] == near["a"]).select("cid", "label", F.least("label", "near").alias("next"))
        least = as_table(least, "components-least")
        far = least.select(F.col("cid").alias("next"), F.col("next").alias("far"))
        jumped = least.join(far, "next").select("cid", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved"))
        jumped = as_table(jumped, "components")
        labels = jumped.select("cid", "label")
        if jumped.where("moved").isEmpty():
            return labels


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their label, of buckets that hold more than one component."""
    labelled = members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    return labelled.join(as_table(mixed.select("bucket"), "neardup-mixed"), "bucket")


def _bounded(common, n, other):
    """Whether two sets can be similar enough if they share at most ``common`` shingles."""
    return (100 + PERCENT) * common >= PERCENT * (n + other)


def _able(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``apart`` that can still be similar enough to another component's class.

    ``common`` is how many of a class's shingles occur in another component at all.
    """
    owners = apart.select("cid", "label").distinct()
    held = sets.join(owners, "cid").select("cid", "label", "found").mapInPandas(_contents, "cid bigint, label bigint, shingle bigint")
    held = as_table(held, "neardup-shingles")
    spread = held.groupBy("shingle").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    common = held.join(spread.select("shingle"), "shingle").groupBy("cid").agg(F.count(F.lit(1)).alias("common"))
    sized = apart.select("bucket", "band", "cid", "n").join(common, "cid")
    least = apart.groupBy("bucket").agg(F.min("n").alias("least"))
    other = F.greatest("least", F.ceil(F.col("n") * PERCENT / 100))
    able = sized.join(least, "bucket").where(_bounded(F.col("common"), F.col("n"), other))
    return as_table(able.select("bucket", "band", "cid", "n", "common"), "neardup-able")


def _second_pairs(able: DataFrame, labels: DataFrame) -> DataFrame:
    """Each class of another component with its bucket's class that has most in common."""
    named = _apart(able, labels)
    pivots = named.groupBy("bucket").agg(F.max_by("cid", F.col("common") / F.col("n")).alias("pivot"))
    owner = labels.select(F.col("cid").alias("pivot"), F.col("label").alias("main"))
    owned = pivots.join(owner, "pivot", "left").withColumn("main", F.coalesce("main", "pivot"))
    met = named.join(owned, "bucket").where("label <> main")
    return met.select(F.col("cid").alias("a"), F.col("pivot").alias("b")).distinct()


def _remaining_pairs(able: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of one bucket, of different components, that could still be similar enough.

    A pair that shares several buckets comes from the first of its bands only.
    """
    named = as_table(_apart(able, labels).join(classes.select("cid", "registers"), "cid"), "neardup-apart")
    many = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("many"))
    main = many.groupBy("bucket").agg(F.max_by("label", "many").alias("main"))
    mine = [F.col(c).alias(f"s_{c}") for c in ("cid", "label", "n", "common", "main", "registers")]
    strays = named.join(main, "bucket").where("label <> main").select("bucket", *mine)
    other = (F.col("label") != F.col("s_label")) & ((F.col("label") == F.col("s_main")) | (F.col("s_cid") < F.col("cid")))
    part = lambda registers: f"substring({registers}, b * {ROWS} + 1, {ROWS})"
    earlier = F.expr(f"band > 0 AND exists(sequence(0, greatest(band - 1, 0)), b -> {part('registers')} = {part('s_registers')})")
    within = _bounded(F.least("common", "s_common"), F.col("n"), F.col("s_n"))
    met = strays.join(named, "bucket").where(other & within & ~earlier)
    return met.select(F.col("s_cid").alias("a"), F.col("cid").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    ``component_id`` is the least id of the rows that links lead to, itself included; ``kept``
    says that it is the row's own.
    """
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = as_table(
        source.mapInPandas(_sketched, "doc_id bigint, text_hash bigint, n bigint, key binary, registers binary"), "neardup-rows"
    )
    distinct = rows.where("n > 0").select("key", "n", "registers", "text_hash").dropDuplicates(["key"])
    classes = as_table(distinct.withColumn("cid", F.monotonically_increasing_id()), "neardup-classes")

    banded = classes.select("cid", "n", "registers", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    bucket = F.xxhash64("band", F.expr(f"substring(registers, band * {ROWS} + 1, {ROWS})"))
    banded = banded.select(bucket.alias("bucket"), "band", "cid", "n")
    # One row per bucket, written, so that a join may split the rows of a hot bucket.
    shared = as_table(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "neardup-buckets")
    members = as_table(banded.join(shared, "bucket"), "neardup-members")

    texts = source.select("text_hash", "text").dropDuplicates(["text_hash"])
    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", "text_hash")
    sets = as_table(texts.join(wanted, "text_hash").mapInPandas(_sets, "cid bigint, found binary"), "neardup-sets")

    central = members.groupBy("cid").agg(F.sum("size").alias("central"))
    ranked = members.join(central, "cid")
    pivots = as_table(ranked.groupBy("bucket").agg(F.max_by("cid", "central").alias("pivot")), "neardup-pivots")
    met = members.join(pivots, "bucket").where("cid <> pivot").groupBy("cid", "pivot").agg(F.count(F.lit(1)).alias("bands"))
    first = met.groupBy(F.col("cid").alias("a")).agg(F.max_by("pivot", "bands").alias("b"))
    links = as_table(check_pairs(first, classes, sets), "neardup-links")

    labels = components(links)
    apart = as_table(_apart(members.select("bucket", "band", "cid", "n"), labels), "neardup-apart")
    able = _able(apart, sets)
    second = as_table(check_pairs(_second_pairs(able, labels), classes, sets), "neardup-links")
    labels = components(links.union(second))
    apart = as_table(_apart(able.select("bucket", "band", "cid", "n"), labels), "neardup-apart")
    more = as_table(check_pairs(_remaining_pairs(_able(apart, sets), labels, classes), classes, sets), "neardup-links")
    labels = components(links.union(second).union(more))

    named = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    keyed = classes.select("key", "cid").join(named, "key").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    component = keyed.groupBy("label").agg(F.min("least").alias("component_id"))
    owner = keyed.select("key", "label").join(component, "label").select("key", "component_id")
    joined = rows.select("doc_id", "n", "key").join(owner, "key", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each class.

    A document is named by its id: rows of one id stay or go together, and of rows equal in
    id and text one stays.
    """
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text").join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    once = rows.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"])
    return once.select("row.*")
