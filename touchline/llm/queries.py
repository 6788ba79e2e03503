"""The registered queries of the operators, and the SQL that some of them must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import (
    bpe,
    clustering,
    fingerprints,
    infill,
    language,
    neardup,
    oracles,
    packing,
    quality_model,
    quality_rules,
    secrets,
    substrings,
    toxicity,
    warc,
)
from touchline.llm.common import documents, fold, importable, labelled, labels, small_batches, text_keys, words_of
from touchline.session import work_dir

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"

# Held-out folds (remainder, folds) and the scores from which a label is predicted.
LANGUAGE_HELD, TOXIC_HELD, QUALITY_HELD = (2, 4), (1, 3), (0, 5)
TOXIC_FROM, QUALITY_FROM = 0.7, 0.3


def held_out(which: tuple[int, int]):
    return fold(F.col("doc_id"), which[1]) == which[0]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding by tree concatenation."""
    return bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY), full=False)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language identification by clustered centroids."""
    docs = documents(spark, sf_dir)
    model = language.learn(docs.where(~held_out(LANGUAGE_HELD)))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out(LANGUAGE_HELD).alias("held_out"), "lang_pred", "score", "rejected")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules as a short-circuit cascade."""
    return quality_rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing by exact complements."""
    path = public_tokenizers.path(BYTE_VOCABULARY)
    return packing.pack(packing.token_pieces(documents(spark, sf_dir), path, with_ids=False))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret scans with linked credential parts."""
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))

    def many(kind: str):
        return F.size(F.filter("spans", lambda s: s["rank"] == secrets.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    base = secrets.listed(F.filter("spans", lambda s: s["rank"] < 3))
    return found.select(
        "doc_id",
        *map(many, secrets.KINDS[:3]),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes by SetSketch registers."""
    return neardup.near_duplicates(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity by class-conditional Kneser-Ney models."""
    docs = documents(small_batches(spark), sf_dir)
    model = toxicity.learn(labelled(docs, labels(spark, sf_dir), "toxic", ~held_out(TOXIC_HELD)))
    return _judged(toxicity.score(docs, model), TOXIC_HELD, TOXIC_FROM)


def quality_network(docs: DataFrame, marks: DataFrame) -> quality_model.Network:
    return quality_model.learn(docs, labelled(docs, marks, "quality", ~held_out(QUALITY_HELD)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality by pooled random-indexing vectors and a two-layer network."""
    docs = documents(spark, sf_dir)
    return _judged(quality_model.score(docs, quality_network(docs, labels(spark, sf_dir))), QUALITY_HELD, QUALITY_FROM)


def _judged(scored: DataFrame, held: tuple[int, int], least: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(held).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated windows of words."""
    docs = documents(spark, sf_dir)

    def digest(words):
        return F.sha2(F.array_join(words, " ").cast("binary"), 256)

    found = substrings.find_repeats(docs).select("h1", "h2", "n_removed", digest(words_of(F.col("cleaned"))).alias("cut"))
    whole = docs.select("doc_id", *text_keys(), words_of(F.col("text")).alias("words"))
    narrow = whole.select("doc_id", "h1", "h2", F.size("words").cast("bigint").alias("n_words"), digest(F.col("words")).alias("uncut"))
    return narrow.join(found, ["h1", "h2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("cut", "uncut").alias("kept_sha256"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document fingerprints by closed syncmers."""
    return fingerprints.fingerprint_edits(documents(spark, sf_dir))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid clustering by equal-average equal-variance search."""
    vectors = importable(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return clustering.with_inertia(*clustering.cluster(vectors)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle transformation and its reversal."""

    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    made = infill.fill_in_middle(documents(spark, sf_dir))
    text = infill.restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(text).alias("restored_sha256"),
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of all pages, written and read back."""
    pages = importable(spark).read.parquet(f"{sf_dir}/pages.parquet")
    root = work_dir(spark, "warc")
    warc.write_archives(pages, root)
    return warc.read_archives(spark, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_language,
        op3_quality_rules,
        op4_packing,
        op5_secrets,
        op6_neardup,
        op7_toxicity,
        op8_quality,
        op9_substrings,
        op10_fingerprints,
        op11_clustering,
        op12_infill,
        op13_warc,
    )
}
ORACLES = {
    "op3_quality_rules": oracles.QUALITY_RULES,
    "op6_neardup": oracles.NEAR_DUPLICATES,
    "op9_substrings": oracles.SUBSTRINGS,
    "op11_clustering": oracles.CLUSTERING,
    "op12_infill": oracles.INFILL,
    "op13_warc": oracles.WARC,
}
