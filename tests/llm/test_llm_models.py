import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.llm import language, quality_model, toxicity
from touchline.llm.common import documents, fit_logistic, packed, unpacked
from touchline.llm.queries import op2_language, op7_toxicity, op8_quality

SF = "/root/testdata/sf0.01"


def remainder(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def test_language_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, SF).collect()}
    found = op2_language(spark, SF).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]
    assert np.mean(held) > 0.97


def test_language_on_edges(spark, tables, edges):
    german, english = "der die das und nicht ein schöner tag ", "the and with a fine day of that "
    rows = [*edges, *((100 + i, (german if i % 2 else english) * (1 + i % 5)) for i in range(40)), (200, "123 !!"), (201, "Z")]
    langs = {100 + i: ("de" if i % 2 else "en") for i in range(40)}
    found = op2_language(spark, tables(rows, langs=langs)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[i]["lang_pred"] for i in (1, 2, 3, 200)} == {"und"}
    assert by_id[201]["lang_pred"] in ("de", "en") and by_id[7]["lang_pred"] in ("de", "en")
    assert all(by_id[100 + i]["lang_pred"] == langs[100 + i] for i in range(40))
    far = language.learn(spark.createDataFrame([(german * 3, "de"), (english * 3, "en")], "text string, lang string"))
    assert far.predict("zzz qqq xxx")[2] and not far.predict(german * 3)[2]


def test_language_without_training_rows(spark, tables):
    assert {r["lang_pred"] for r in op2_language(spark, tables([(1, "some text")])).collect()} == {"und"}
    assert op2_language(spark, tables([])).count() == 0


def toxic_rows(prose, many=500):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(many):
        words = prose(rng.randint(40, 200), i).split()
        toxic = i % 4 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["moron", "scum", "worthless", "clown"]))
        rows.append((i, " ".join(words)))
        labels.append((i, None if i % 7 == 0 else 1, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark, tables, prose, edges):
    rows, labels = toxic_rows(prose)
    extra = [(1000 + (i or 0), t) for i, t in edges] + [(None, "no id")]
    found = op7_toxicity(spark, tables(rows + extra, [*labels, (9999, 1, 1), (None, 1, 1), (1, None, None)])).collect()
    assert len(found) == len(rows) + len(extra)
    truth = {i: t for i, _, t in labels}
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    right = [r["predicted"] == truth[r["doc_id"]] for r in held]
    assert np.mean(right) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in found)


def test_shared_probabilities_add_up(spark):
    codes = [toxicity.codes(toxicity.symbols(t)) for t in ("the cat sat on the mat", "that hat")]
    grams = spark.createDataFrame([(int(c),) for c in set(np.concatenate(codes).tolist())], "code long")
    rows = toxicity.shared_probabilities(grams).collect()
    by_context = {}
    for r in rows:
        by_context.setdefault(r["suffix"] >> toxicity.BITS, []).append(r["shared"])
    assert all(0 < sum(p) <= 1 + 1e-9 for p in by_context.values())


@pytest.mark.parametrize("query", [op7_toxicity, op8_quality])
def test_without_labels(spark, tables, query, edges):
    found = query(spark, tables(edges)).collect()
    assert len(found) == len(edges) and {r["predicted"] for r in found} == {0}
    assert query(spark, tables([])).count() == 0


def test_quality_of_held_out_documents(spark, tables):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = op8_quality(spark, SF).collect()
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    good = [r["predicted"] for r in held if truth[r["doc_id"]] == 1]
    bad = [r["predicted"] for r in held if truth[r["doc_id"]] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.4


def test_word_vectors_do_not_depend_on_partitions(spark, prose):
    docs = spark.createDataFrame([(prose(50, i),) for i in range(20)] + [(None,), ("",)], "text string")
    one, many = (quality_model.word_vectors(docs.repartition(n)) for n in (1, 5))
    assert (one == many).all()


def test_temperature_and_weights_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    weights = fit_logistic(x, y)
    assert weights[1] > 2 * abs(weights[2])
    net = quality_model.train(np.zeros((1, 1)), x, y)
    assert np.mean((net.probabilities(x) > 0.5) == y) > 0.85 and 0.25 <= net.temperature <= 8


def test_toxicity_keeps_every_ngram_and_context(spark, monkeypatch):
    rng = random.Random(8)
    rows = [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1500)), int(i % 4 == 0)) for i in range(250)]
    model = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    hashes = spark.createDataFrame(rows, "text string, label int").selectExpr("text", f"pmod(xxhash64(text), {toxicity.TUNING_FOLD}) AS fold")
    counted = [toxicity.codes(toxicity.symbols(r["text"])) for r in hashes.collect() if r["fold"]]
    grams = np.unique(np.concatenate(counted))
    table = {r["key"]: r["ratio"] for r in model.ratios.collect()}
    contexts = {int(c) | toxicity.CONTEXT for c in grams >> np.uint64(toxicity.BITS)}
    assert set(table) == set(grams.tolist()) | contexts
    # Scores by chunks of few texts are those by one look-up in the whole table.
    monkeypatch.setattr(toxicity, "CHUNK", 4000)
    texts = [(i if i else None, t) for i, (t, _) in enumerate(rows[:12])] + [(2**60 + 1, "ab zzz unseen 漢字"), (2**60 + 2, None)]
    docs = spark.createDataFrame(texts, "id long, text string")
    found = {r["id"]: tuple(r)[1:] for r in toxicity.measure(docs, model.ratios, F.coalesce("id", F.xxhash64("text"))).collect()}
    keys = np.array(sorted(table))
    ratios = np.array([table[k] for k in keys.tolist()])
    assert found.keys() == {i for i, _ in texts}
    for i, text in texts:
        assert found[i] == pytest.approx(toxicity.features(text, keys, ratios))


def test_texts_and_contexts_are_not_shuffled_as_they_are(spark):
    docs = spark.createDataFrame([(1, "ab  CD"), (2, None), (3, "İΣ x")], "id long, text string")
    forms = docs.select("id", packed(F.coalesce("text", F.lit("")), toxicity.plain).alias("p")).collect()
    assert {r["id"]: unpacked(bytes(r["p"])) for r in forms} == {i: toxicity.plain(t) for i, t in [(1, "ab  CD"), (2, None), (3, "İΣ x")]}
    code = toxicity.codes(toxicity.symbols("abcdef")).view(np.int64).tolist()
    context = (code[0] >> toxicity.BITS) | toxicity.CONTEXT
    ratios = spark.createDataFrame([(code[0], 0.5), (context, -1.0)], "key long, ratio double")
    beside = (code[0] >> toxicity.BITS << toxicity.BITS) | 7  # unseen, of the same context
    keys = spark.createDataFrame([(0, code[0]), (1, code[0]), (1, beside), (1, code[-1])], "chunk int, key long")
    looked = toxicity.looked_up(keys, ratios)
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 2
    assert sorted(map(tuple, looked.collect())) == sorted([(0, code[0], 0.5), (1, code[0], 0.5), (1, beside, -1.0)])


def test_toxicity_needs_one_python_worker_a_task_and_one_sort_a_step(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 100)
    texts = [(i if i % 5 else None, "lorem ipsum dolor sit amet " * (1 + i % 3)) for i in range(40)]
    docs = spark.createDataFrame(texts, "id long, text string")
    ratios = spark.createDataFrame([(1, 0.5)], "key long, ratio double")
    found = toxicity.measure(docs, ratios, F.coalesce("id", F.xxhash64("text")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Two in one task were memory that the largest executor did not have.
    assert plan.count("ArrowEvalPython") == 0 and plan.count("MapInPandas") == 3
    looked = toxicity.looked_up(spark.createDataFrame([(0, 1)], "chunk int, key long"), ratios)
    assert looked._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    # No task has a second chunk's rows to sort: there are as many tasks with rows as chunks with texts.
    placed = docs.withColumn("place", F.coalesce("id", F.xxhash64("text")))
    used = set(toxicity._chunks(placed).of(placed.toPandas()["place"]))
    assert found.groupBy(F.spark_partition_id()).count().count() == len(used) > 10
    assert found.count() == 40 and found.where("id IS NULL").count() == 8


def test_toxicity_looks_texts_up_together(prose, monkeypatch):
    texts = [toxicity.plain(t) for t in (prose(30, 1), "", prose(5, 2), None, "x", "İΣ 漢字 zzz \U0001f600", prose(200, 3))]
    rng = np.random.default_rng(5)
    grams = [toxicity.codes(toxicity.symbols(t)) for t in texts]
    assert toxicity.distinct(grams).tolist() == sorted(set(np.concatenate(grams).tolist()))
    assert not len(toxicity.distinct([])) and toxicity.distinct([grams[4], grams[4]]).tolist() == sorted(set(grams[4].tolist()))
    known = {c: rng.normal() for c in toxicity.distinct(grams).tolist() if rng.random() < 0.6}
    known |= {c >> toxicity.BITS | toxicity.CONTEXT: rng.normal() for c in toxicity.distinct(grams).tolist()[::2]}
    expected = []
    for text, codes in zip(texts, grams):
        value = [known.get(c, known.get(c >> toxicity.BITS | toxicity.CONTEXT, 0.0)) for c in codes.tolist()]
        starts = [i for i, c in enumerate(" " + text) if c == " "] + [len(value)]
        worst = sorted(sum(value[a:b]) for a, b in zip(starts, starts[1:]))[-3:]
        expected.append((np.mean(value), worst[-1], sum(worst) / 3, np.log(len(starts) - 1)) if text else (0.0,) * 4)
    calls = []
    real = toxicity.ratios_of
    monkeypatch.setattr(toxicity, "ratios_of", lambda *given: calls.append(1) or real(*given))
    keys, ratios = pd.Index(list(known)), np.array(list(known.values()))
    found = toxicity.plain_features(texts, keys, ratios)
    assert [pytest.approx(e) for e in expected] == found and len(calls) == 1
    assert [toxicity.features(t, keys, ratios) for t in texts] == found
