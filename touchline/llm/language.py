"""Language identification by nearest clustered centroids of character n-grams.

A text is a vector of hashed letter n-grams, weighted by TF-IDF and of length one.  The
document frequencies cover all training rows.  The training vectors of a bounded sample of
each language are clustered (spherical k-means), so a language may have several centroids;
a text gets the language of the centroid with the greatest cosine.  Each centroid also
knows how far its own members lie, and a text farther away than nearly all of them is
rejected as no known language.

Defined results: a null text or one without a letter gets ``und``, is rejected and scores
0; without training rows every text does; null languages are not learned; repeated rows are
predicted each; columns other than ``doc_id`` and ``text`` are ignored when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import code_points

SIZE = 8192  # hashed n-grams
CLUSTERS = 3  # centroids per language
SAMPLE = 1200  # training vectors that are clustered, about, over all languages
TAIL = 0.005  # share of a centroid's own members beyond its distance of rejection
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of 1 to 3 letters, with word ends, and how often each occurs."""
    points = code_points(" " + (text or "").lower() + " ").astype(np.uint64)
    letter = _letters()[points]
    points = np.where(letter, points, np.uint64(32))
    # Runs of what is not a letter count as one word end.
    used = letter | np.concatenate(([True], letter[:-1]))
    s = points[used]
    if len(s) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0)
    two = s[:-1] * np.uint64(0x1F3D5B79) + s[1:] * np.uint64(0x9E3779B1)
    three = two[:-1] * np.uint64(0x85EBCA6B) + s[2:] * np.uint64(0xC2B2AE35)
    hashed = [s[s != 32] * np.uint64(0x27D4EB2F165667C5), two * np.uint64(0x9FB21C651E98DF25), three * np.uint64(0xD6E8FEB86659FD93)]
    counts = np.bincount((np.concatenate(hashed) >> np.uint64(51)).astype(np.int64), minlength=SIZE)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's unit vector."""
    found, counts = grams(text)
    values = (1 + np.log(counts)) * idf[found]
    return found, values / max(np.linalg.norm(values), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    names: list[str]  # the language of each centroid
    centroids: np.ndarray
    least: np.ndarray  # cosine below which a centroid rejects

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found, values = vector(text, self.idf)
        if not len(found) or not self.names:
            return UNKNOWN, 0.0, True
        likeness = self.centroids[:, found] @ values
        best = int(likeness.argmax())
        return self.names[best], float(np.clip(likeness[best], 0, 1)), bool(likeness[best] < self.least[best])


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many texts of a task each n-gram occurs; place -1 counts the texts."""
    seen, many = np.zeros(SIZE, dtype=np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            seen[grams(text)[0]] += 1
            many += 1
    yield pd.DataFrame({"place": np.arange(-1, SIZE), "n": np.concatenate(([many], seen))})


def cluster(x: np.ndarray, k: int, seed: int = 1, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit vectors by spherical k-means, and each vector's centroid."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    own = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.array([x[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres, (x @ centres.T).argmax(axis=1)


def learn(train: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """A model from ``text, lang`` rows."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counted = train.select("text").mapInPandas(_frequencies, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    frequency = np.zeros(SIZE + 1)
    for row in counted.collect():  # one row per place
        frequency[row["place"] + 1] = row["n"]
    idf = np.log((1 + frequency[0]) / (1 + frequency[1:])) + 1
    many = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not many:
        return Model(idf, [], np.zeros((0, SIZE)), np.zeros(0))
    each = sample / len(many)
    shares = F.create_map(*(F.lit(x) for lang, n in many.items() for x in (lang, min(1.0, each / n))))
    drawn = train.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [vector(t, idf) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "at": [r[0] for r in rows], "value": [r[1].astype(np.float32) for r in rows]})

    found = drawn.mapInPandas(vectors, "lang string, at array<int>, value array<float>").toPandas()
    names, centroids, least = [], [], []
    for lang, rows in found.groupby("lang"):
        x = np.zeros((len(rows), SIZE), dtype=np.float32)
        for i, (at, value) in enumerate(zip(rows["at"], rows["value"])):
            x[i, np.asarray(at, dtype=np.int64)] = value
        x = x[np.lexsort(x[:, :16].T)]  # the result must not depend on the order of rows
        x = x[x.any(axis=1)]
        if not len(x):
            continue
        centres, own = cluster(x, clusters)
        for c, centre in enumerate(centres):
            members = (x[own == c] @ centre) if (own == c).any() else np.ones(1)
            names.append(lang)
            centroids.append(centre)
            least.append(np.quantile(members, TAIL))
    return Model(idf, names, np.array(centroids).reshape(-1, SIZE), np.array(least))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row; the score is the cosine."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [held.value.predict(t) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"], index=batch.index)
            yield pd.concat([batch[["doc_id"]], out], axis=1)

    return docs.select("doc_id", "text").mapInPandas(predicted, "doc_id bigint, lang_pred string, score double, rejected boolean")
