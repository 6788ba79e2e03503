"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Random indexing gives every word a fixed sparse random vector; a word's own vector is the
sum of those of its neighbours, over the whole corpus.  Words are hashed to a fixed number
of rows, so the sums have one size however large the corpus is, and Spark adds them up.
A document's words are pooled to a few numbers per dimension; a two-layer network is
trained on a bounded sample of labelled documents, and its probabilities are calibrated by
a temperature on a part of the sample that it was not trained on.

Defined results: null or empty text is pooled to zeros and scored as such; without labels
of both classes every score is the share of label 1; null labels are ignored; repeated rows
are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import code_points, mix, span_hashes

ROWS = 8192  # rows of word vectors
SIZE = 24  # dimensions
ACTIVE = 4  # entries of a random vector that are not zero
REACH = 2  # neighbours on either side
SAMPLE = 6000  # labelled documents per class, about, on which the network is trained
HIDDEN = 24
EPOCHS = 60


#: Class of a code point: white space, other visible ASCII and Latin-1 signs, letters and digits.
GAP, SIGN, LETTER = 0, 1, 2
_CLASSES = np.array(
    [GAP if c == 32 or 9 <= c <= 13 else LETTER if chr(c).isalnum() else SIGN for c in range(256)] + [LETTER], dtype=np.int8
)


def tokens(text: str | None) -> np.ndarray:
    """Row of every token: runs of letters and digits, and runs of other visible characters."""
    points = code_points(text)
    kind = _CLASSES[np.minimum(points, 256)]
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(points)]))
    used = kind[starts] != GAP if len(points) else np.zeros(1, dtype=bool)
    return (span_hashes(points, starts[used], ends[used]) % np.uint64(ROWS)).astype(np.int64)


def random_vectors() -> np.ndarray:
    """Each row's random vector, and a row of zeros that stands between documents."""
    seeds = mix(np.arange(ROWS * ACTIVE, dtype=np.uint64) + np.uint64(1)).reshape(ROWS, ACTIVE)
    signs = np.where((seeds >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.float32)
    vectors = np.zeros((ROWS + 1, SIZE), dtype=np.float32)
    for k in range(ACTIVE):
        vectors[np.arange(ROWS), (seeds[:, k] % np.uint64(SIZE)).astype(np.int64)] += signs[:, k]
    return vectors


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the neighbours' random vectors, by row, of a task's texts."""
    vectors, sums = random_vectors(), np.zeros((ROWS + 1, SIZE))
    between = np.full(REACH, ROWS)

    def add(held: list[np.ndarray]) -> None:
        ids = np.concatenate([between, *held])
        own = vectors[ids]
        near = np.zeros_like(own)
        for step in range(1, REACH + 1):
            near[step:] += own[:-step]
            near[:-step] += own[step:]
        order = np.argsort(ids, kind="stable")
        found, first = np.unique(ids[order], return_index=True)
        sums[found] += np.add.reduceat(near[order], first, axis=0)

    held, size = [], 0
    for batch in batches:
        for text in batch["text"]:
            ids = tokens(text)
            held += [ids, between]
            size += len(ids)
            if size > 100_000:
                add(held)
                held, size = [], 0
    if held:
        add(held)
    used = np.flatnonzero(np.abs(sums[:ROWS]).sum(axis=1))
    yield pd.DataFrame(sums[used], columns=[f"v{i}" for i in range(SIZE)]).assign(row=used)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all rows, from every document."""
    columns = [f"v{i}" for i in range(SIZE)]
    schema = ", ".join(f"{c} double" for c in columns) + ", row bigint"
    summed = docs.select("text").mapInPandas(_neighbours, schema).groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))
    found = summed.toPandas()  # at most ROWS rows
    vectors = np.zeros((ROWS, SIZE))
    vectors[found["row"].to_numpy(np.int64)] = np.round(found[columns].to_numpy())
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1)).astype(np.float32)


def pool(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and likeness of neighbours per dimension, and the text's size."""
    ids = tokens(text)
    if not len(ids):
        return np.zeros(3 * SIZE + 2)
    counts = np.bincount(ids, minlength=ROWS)
    used = np.flatnonzero(counts)
    share = counts[used] / len(ids)
    own = vectors[used].astype(np.float64)
    mean = share @ own
    spread = np.sqrt(np.maximum(share @ own**2 - mean**2, 0))
    chain = vectors[ids]
    near = (chain[1:] * chain[:-1]).mean(axis=0) if len(ids) > 1 else np.zeros(SIZE)
    return np.concatenate([mean, spread, near, [np.log1p(len(ids)), np.log1p(len(used))]])


@dataclass
class Network:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    first: tuple[np.ndarray, np.ndarray]
    second: tuple[np.ndarray, np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.centre) / self.scale) @ self.first[0] + self.first[1], 0)
        return (hidden @ self.second[0] + self.second[1])[:, 0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Fit the two layers by Adam on four fifths of the rows, the temperature on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    width = x.shape[1]
    net = Network(
        vectors,
        x[used].mean(axis=0),
        x[used].std(axis=0) + 1e-3,
        (rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN)),
        (rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, 1)), np.zeros(1)),
    )
    weights = [*net.first, *net.second]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            inputs = (x[part] - net.centre) / net.scale
            hidden = np.maximum(inputs @ weights[0] + weights[1], 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30)))
            error = (p - y[part][:, None]) / len(part)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [inputs.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m in zip(weights, slopes, moments):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                w -= 0.003 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8) + 1e-5 * w
    if len(held):
        logits = net.logits(x[held])

        def loss(t: float) -> float:
            z = logits / t
            return float(np.mean(np.logaddexp(0, z) - y[held] * z))

        net.temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return net


def learn(docs: DataFrame, rows: DataFrame) -> Network:
    """Word vectors from all of ``docs``, the network from ``text, label`` rows."""
    vectors = word_vectors(docs)
    many = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(many) < 2:
        share = float(bool(many.get(1)))
        flat = np.zeros(3 * SIZE + 2)
        none = (np.zeros((len(flat), HIDDEN)), np.zeros(HIDDEN))
        return Network(vectors, flat, flat + 1, none, (np.zeros((HIDDEN, 1)), np.full(1, 60.0 * share - 30)))
    share = F.when(F.col("label") == 1, F.lit(SAMPLE / many[1])).otherwise(F.lit(SAMPLE / many[0]))
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30)).select("text", "label")
    held = drawn.sparkSession.sparkContext.broadcast(vectors)
    names = [f"x{i}" for i in range(3 * SIZE + 2)]

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([pool(t, held.value) for t in batch["text"]]).reshape(-1, len(names))
            yield pd.DataFrame(x, columns=names).assign(label=batch["label"].to_numpy())

    schema = ", ".join(f"{n} double" for n in names) + ", label int"
    found = drawn.mapInPandas(pooled, schema).toPandas().sort_values([*names, "label"])
    return train(vectors, found[names].to_numpy(), found["label"].to_numpy(np.float64))


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, of every row."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id"]].assign(score=_scores(batch["text"], held.value))

    return docs.select("doc_id", "text").mapInPandas(scored, "doc_id bigint, score double")


def _scores(texts: pd.Series, net: Network) -> np.ndarray:
    x = np.array([pool(t, net.vectors) for t in texts]).reshape(-1, len(net.centre))
    return net.probabilities(x)


def keep_good(docs: DataFrame, net: Network, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(texts, held.value))

    return docs.where(scored("text") >= least)
