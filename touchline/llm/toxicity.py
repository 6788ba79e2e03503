"""Toxicity by class-conditional Kneser-Ney models of characters.

One model is learned from texts labelled toxic and one from the others, of n-grams of
``ORDER`` lower-case code points.  The two models share what they back off to: the
Kneser-Ney continuation counts of all labelled texts, so an expression that one class
has seen rarely or never is judged by how ordinary its parts are in both.  A document
is compared by its length-normalised log-likelihoods under the two models, as a whole
and word by word: insults are few among many ordinary words, so the words with the
highest ratios count on their own.  A small logistic fit on a bounded sample of labelled
documents outside the counts turns these ratios into a score.

Counts cover every labelled row given, and the model keeps the ratio of every n-gram and
context as a table, which grows with the corpus.  To be scored, documents are dealt to
chunks of neighbouring ids of about ``CHUNK`` code points; the distinct n-grams of a chunk
meet their ratios, or those of their contexts, once, and each chunk's ratios meet its texts,
which are dealt in compressed blocks.

Defined results: null or empty text has ratios of 0 and scores as such; without tuning
labels of both classes every score is about 0; label rows of unknown documents and null labels are ignored;
repeated rows are scored each, and count once per row when learning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import as_table, code_points, fit_logistic, packed_bytes, unpacked

ORDER = 5
BITS = 12  # bits of a symbol within an n-gram's code
CONTEXT = 1 << 61  # added to the code of a context, to tell it from n-grams
CHUNK = 16_000_000  # code points of the texts that are scored together, about
HELD = 1_000_000  # n-grams that a task holds before it hands them on
HANDED = 100_000  # keys in a batch that it hands on
BLOCK = 1_000_000  # code points of texts that are compressed together, about
DISCOUNT = 0.75
WORST = 3  # words with the highest ratios that are averaged
SAMPLE = 4000  # labelled documents per class, about, for the final fit
FEATURES = 4
TUNING_FOLD = 8  # one in so many labelled documents is kept out of the counts for the fit


def plain(text: str | None) -> str:
    """What is read of a text: lower case, runs of white space as one blank; plain text stays as it is."""
    return " ".join((text or "").lower().split())


def symbols(text: str | None) -> np.ndarray:
    """The code points of a plain text as numbers of ``BITS`` bits."""
    return plain_symbols([plain(text)])


def plain_symbols(texts: list[str]) -> np.ndarray:
    """The symbols of plain texts, one after the other."""
    points = code_points("".join(f"{'':{ORDER - 1}}{text} " for text in texts))
    return ((points ^ (points >> np.uint32(BITS))) & np.uint32((1 << BITS) - 1)).astype(np.uint64)


def codes(s: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The code of every n-gram of a row of symbols; its low bits are its last symbol."""
    n = len(s) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(order):
        out <<= np.uint64(BITS)
        out |= s[i : i + n]
    return out


def distinct(parts: list[np.ndarray]) -> np.ndarray:
    """The different codes of some rows of codes, in order; sorting them takes a fifth of the time of ``np.unique``."""
    found = np.sort(np.concatenate([np.empty(0, dtype=np.uint64), *parts]))
    fresh = np.ones(len(found), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=fresh[1:])
    return found[fresh]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-grams of a batch with their counts, by label."""
    for batch in batches:
        for label, texts in batch.groupby("label")["text"]:
            held: list[np.ndarray] = []
            size = 0
            for text in [*texts, None]:
                if text is not None:
                    held.append(codes(symbols(text)))
                    size += len(held[-1])
                if held and (text is None or size > HELD):
                    found, many = np.unique(np.concatenate(held), return_counts=True)
                    for at in range(0, len(found), HANDED):
                        own = slice(at, at + HANDED)
                        yield pd.DataFrame({"code": found[own].view(np.int64), "label": label, "n": many[own].astype(np.int64)})
                    held, size = [], 0


@dataclass
class Model:
    ratios: DataFrame  # ``key, ratio``: log-likelihood ratio of every n-gram, and of every context for unseen n-grams
    weights: np.ndarray  # of the logistic fit: bias, then the features


def ratios_of(code: np.ndarray, keys: pd.Index, ratios: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every n-gram, from a table of different keys in any order."""

    def look(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = keys.get_indexer(wanted)
        return at >= 0, ratios[at]

    if not len(keys):
        return np.zeros(len(code))
    seen, value = look(code.view(np.int64))
    rest = np.flatnonzero(~seen)
    known, other = look((code[rest] >> np.uint64(BITS)).view(np.int64) | CONTEXT)
    value[rest] = np.where(known, other, 0.0)
    return value


def features(text: str | None, keys: np.ndarray, ratios: np.ndarray) -> tuple[float, ...]:
    """Ratio per symbol of the whole text, of its worst word, of its worst words, and log length."""
    return plain_features([plain(text)], pd.Index(keys), ratios)[0]


def plain_features(texts: list[str], keys: pd.Index, ratios: np.ndarray) -> list[tuple[float, ...]]:
    """The features of plain texts, whose n-grams are looked up together."""
    s = plain_symbols(texts)
    values = ratios_of(codes(s), keys, ratios)
    starts = s[ORDER - 2 :] == 32  # whether a word may start with the last symbol of an n-gram
    out, at = [], 0
    for text in texts:
        end = at + len(text) + 1
        if not text:
            out.append((0.0,) * FEATURES)
        else:
            value = values[at:end]
            words = np.add.reduceat(value, np.flatnonzero(starts[at:end]))
            worst = np.sort(words)[-WORST:]
            out.append((float(value.mean()), float(worst[-1]), float(worst.sum() / WORST), float(np.log(len(words)))))
        at = end + ORDER - 1
    return out


@dataclass
class Chunks:
    """Ranges of ``place`` with about ``CHUNK`` code points, by the places at which the next one begins.

    Tasks find the chunk of a row in the same step that reads its text, so that a task needs one
    Python worker and not one for each step.
    """

    bounds: np.ndarray

    def of(self, places: pd.Series) -> np.ndarray:
        return np.searchsorted(self.bounds, places.to_numpy(np.int64)).astype(np.int32)

    def keys(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Distinct n-grams of a task's texts, by chunk."""
        held: dict[int, np.ndarray] = {}

        def emptied(most: int) -> Iterator[pd.DataFrame]:
            while sum(map(len, held.values())) > most:
                chunk = next(iter(held))
                found = held.pop(chunk)
                for at in range(0, len(found), HANDED):
                    yield pd.DataFrame({"chunk": np.int32(chunk), "key": found[at : at + HANDED].view(np.int64)})

        for batch in batches:
            for chunk, texts in batch["text"].groupby(self.of(batch["place"])):
                parts, size = [held.pop(chunk)] if chunk in held else [], 0
                for text in texts:
                    parts.append(codes(symbols(text)))
                    size += len(parts[-1])
                    if size > HELD:
                        parts, size = [distinct(parts)], 0
                held[chunk] = distinct(parts)
            # The chunks read longest ago go first: where ids are in order, they are over.
            yield from emptied(HELD)
        yield from emptied(0)

    def texts(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of texts of a chunk, packed together: a line with id, blank and plain text for each."""
        for batch in batches:
            for chunk, rows in batch.groupby(self.of(batch["place"])):
                block, size = [], 0
                for doc_id, named, text in zip(rows["id"], rows["named"], rows["text"]):
                    block.append(f"{doc_id if named else ''} {plain(text)}")
                    size += len(block[-1])
                    if size > BLOCK:
                        yield pd.DataFrame({"chunk": [np.int32(chunk)], "packed": [packed_bytes("\n".join(block))]})
                        block, size = [], 0
                if block:
                    yield pd.DataFrame({"chunk": [np.int32(chunk)], "packed": [packed_bytes("\n".join(block))]})


def _chunks(docs: DataFrame) -> Chunks:
    """The chunks of ``place, text`` rows."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    many = chars // CHUNK + 1
    shares = [i / many for i in range(1, many)]
    found = docs.agg(F.percentile_approx("place", shares, 100 * many).alias("b")).first()["b"] if shares else []
    return Chunks(np.array(sorted(set(found or [])), dtype=np.int64))


def looked_up(keys: DataFrame, ratios: DataFrame) -> DataFrame:
    """``chunk, key, ratio`` of the n-grams ``chunk, key`` that have a ratio, their own or that of their context."""
    given = ratios.select(F.lit(None).cast("int").alias("chunk"), "key", "ratio")
    asked = keys.select("chunk", "key", F.lit(None).cast("double").alias("ratio"))
    is_context = F.col("key") >= CONTEXT
    context = F.when(is_context, F.col("key").bitwiseXOR(F.lit(CONTEXT))).otherwise(F.shiftright("key", BITS))
    # Rows of a context are together, so are those of an n-gram: both windows need no shuffle but this one.
    together = given.unionAll(asked).repartition(context).withColumn("context", context)
    # By n-gram first: rows sorted for that are sorted for the other window, which reads its column and so stays behind it.
    by_gram = Window.partitionBy("context", "key").orderBy("chunk")
    everywhere = by_gram.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = together.withColumns({"own": F.max("ratio").over(everywhere), "before": F.lag("chunk").over(by_gram)})
    other = F.max(F.when(is_context, F.col("own"))).over(Window.partitionBy("context"))
    # Several tasks may ask for an n-gram of a chunk; it goes to the chunk once.
    found = own.withColumn("other", other).where("chunk IS NOT NULL AND NOT chunk <=> before")
    return found.select("chunk", "key", F.coalesce("own", "other").alias("ratio")).where("ratio IS NOT NULL")


def measure(docs: DataFrame, ratios: DataFrame, place: Column) -> DataFrame:
    """``id`` and features ``f0`` and on of every row (``id, text``); rows near in ``place`` share their look-ups."""
    docs = docs.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("place", place.cast("bigint"))
    chunks = _chunks(docs)
    keys = docs.select("place", "text").mapInPandas(chunks.keys, "chunk int, key bigint")
    looked = looked_up(keys, ratios).withColumn("packed", F.lit(None).cast("binary"))
    ids = docs.select("place", "text", F.coalesce("id", F.lit(0)).cast("bigint").alias("id"), F.col("id").isNotNull().alias("named"))
    texts = ids.mapInPandas(chunks.texts, "chunk int, packed binary")
    texts = texts.select("chunk", F.lit(0).cast("bigint").alias("key"), F.lit(0.0).alias("ratio"), "packed")
    names = [f"f{i}" for i in range(FEATURES)]

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, parts, table = None, [], None
        for batch in batches:
            for chunk, rows in batch.groupby("chunk", sort=False):
                if chunk != current:
                    current, parts, table = chunk, [], None
                is_text = rows["packed"].notna()
                looked = rows[~is_text]
                if len(looked):
                    parts.append((looked["key"].to_numpy(np.int64), looked["ratio"].to_numpy(np.float64)))
                if is_text.any() and table is None:  # all ratios of a chunk come before its texts
                    key = np.concatenate([np.empty(0, dtype=np.int64), *(k for k, _ in parts)])
                    ratio = np.concatenate([np.empty(0), *(r for _, r in parts)])
                    table, parts = (pd.Index(key), ratio), []
                for block in rows["packed"][is_text]:
                    ids, texts = zip(*(line.split(" ", 1) for line in unpacked(block).split("\n")))
                    found = pd.DataFrame(plain_features(texts, *table), columns=names)
                    yield found.assign(id=[int(i or 0) for i in ids], named=[i != "" for i in ids])

    # One chunk to a task, where a hash would put several together and leave other tasks without.
    dealt = looked.unionAll(texts).repartitionById(len(chunks.bounds) + 1, "chunk")
    schema = ", ".join(f"{n} double" for n in names) + ", id bigint, named boolean"
    measured_rows = dealt.sortWithinPartitions("chunk", F.col("packed").isNotNull()).mapInPandas(measured, schema)
    return measured_rows.select(F.when(F.col("named"), F.col("id")).alias("id"), *names)


def shared_probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``suffix, shared``: Kneser-Ney probability of the last symbol given ``order`` - 2 before it.

    The counts are continuation counts over both classes: of how many different longer
    n-grams an n-gram is the end.
    """
    longer, tables = grams.select("code"), {}
    for k in range(order - 1, 0, -1):
        end = F.col("code").bitwiseAND(F.lit((1 << (BITS * k)) - 1))
        tables[k] = longer.select(end.alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
        longer = tables[k].select("code")
    total = tables[1].agg(F.sum("n").alias("n")).first()["n"] or 1
    shared = tables[1].select(F.col("code").alias("suffix"), (F.col("n") / total).alias("shared"))
    for k in range(2, order):
        end = F.col("code").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
        table = tables[k].withColumns({"context": F.shiftright("code", BITS), "suffix": end})
        contexts = table.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        joined = table.join(contexts, "context").join(shared, "suffix")
        seen = F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0))
        value = (seen + DISCOUNT * F.col("kinds") * F.col("shared")) / F.col("total")
        shared = joined.select(F.col("code").alias("suffix"), value.alias("shared"))
    return shared


def learn(train: DataFrame) -> Model:
    """A model from ``text, label`` rows; both classes must have rows."""
    rows = train.withColumn("tuning", F.pmod(F.xxhash64("text"), F.lit(TUNING_FOLD)) == 0)
    counts = rows.where("not tuning").select("text", "label").mapInPandas(_count, "code bigint, label int, n bigint")
    one = lambda c: F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}")
    grams = as_table(counts.groupBy("code").agg(one(0), one(1)), "toxicity-grams")
    grams = grams.withColumns(
        {"context": F.shiftright("code", BITS), "suffix": F.col("code").bitwiseAND(F.lit((1 << (BITS * (ORDER - 1))) - 1))}
    )
    contexts = grams.groupBy("context").agg(
        *(F.sum(f"n{c}").alias(f"total{c}") for c in (0, 1)), *(F.count_if(F.col(f"n{c}") > 0).alias(f"kinds{c}") for c in (0, 1))
    )

    def backoff(c: int):
        """Share of a context's probability that goes to the shared counts."""
        return F.when(F.col(f"total{c}") > 0, DISCOUNT * F.col(f"kinds{c}") / F.col(f"total{c}")).otherwise(F.lit(1.0))

    def probability(c: int):
        seen = F.greatest(F.col(f"n{c}") - F.lit(DISCOUNT), F.lit(0.0)) / F.greatest(F.col(f"total{c}"), F.lit(1))
        return seen + backoff(c) * F.col("shared")

    joined = grams.join(contexts, "context").join(shared_probabilities(grams), "suffix")
    ratio = F.log(probability(1)) - F.log(probability(0))
    unseen = contexts.select(
        F.col("context").bitwiseOR(F.lit(CONTEXT)).alias("key"), (F.log(backoff(1)) - F.log(backoff(0))).alias("ratio")
    )
    ratios = as_table(joined.select(F.col("code").alias("key"), ratio.alias("ratio")).unionAll(unseen), "toxicity-ratios")
    model = Model(ratios, np.zeros(1 + FEATURES))
    many = {r["label"]: r["n"] for r in rows.where("tuning").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(many) == 2:
        share = F.when(F.col("label") == 1, F.lit(SAMPLE / many[1])).otherwise(F.lit(SAMPLE / many[0]))
        drawn = rows.where("tuning").where(F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(1 << 30)) < share * (1 << 30))
        names = [f"f{i}" for i in range(FEATURES)]
        drawn = as_table(drawn.select(F.col("label").cast("bigint").alias("id"), "text"), "toxicity-drawn")
        tuned = measure(drawn, ratios, F.xxhash64("text")).withColumnRenamed("id", "label").toPandas()
        tuned = tuned.sort_values([*names, "label"])
        model.weights = fit_logistic(tuned[names].to_numpy(), tuned["label"].to_numpy())
    else:
        model.weights = np.array([-30.0] + [0.0] * FEATURES)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, the probability of being toxic, of every row."""
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    bias, *weights = map(float, model.weights)
    found = measure(rows, model.ratios, F.coalesce("id", F.xxhash64("text")))
    z = sum((F.lit(w) * F.col(f"f{i}") for i, w in enumerate(weights)), F.lit(bias))
    return found.select(F.col("id").alias("doc_id"), (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))).alias("score"))
