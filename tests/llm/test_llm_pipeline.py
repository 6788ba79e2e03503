import brute
import corpus_pipeline
from test_llm_bpe import check_packing
from touchline.llm.common import documents
from touchline.llm.queries import op8_quality

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, folder):
    docs, kept = documents(spark, SF), None
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        texts = {r["doc_id"]: r["text"] for r in before}
        path = f"{folder}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == columns
            kept = {r["doc_id"]: r["text"] for r in after}
        if name == "quality classifier":
            judged = {r["doc_id"] for r in op8_quality(spark, SF).collect() if r["predicted"]}
            assert set(kept) == judged
        elif name == "near-duplicates":
            classes = brute.components(list(texts.items()))
            assert set(kept) == {i for i, least in classes.items() if i == least}
        elif name == "substring dedup":
            stays = brute.without_repeats(texts.values())
            assert {i: brute.words(t) for i, t in kept.items()} == dict(zip(texts, stays))
        elif name == "secret scans":
            assert set(kept) == set(texts)
            assert not any(brute.base_spans(t) for t in kept.values())
            assert all(kept[i] == t for i, t in texts.items() if not brute.base_spans(t))
        elif name == "best-fit packing":
            used, least = check_packing(after, texts)
            assert used <= 1.02 * least + 1


def test_empty_input(spark, tables):
    assert corpus_pipeline.run(spark, tables([])).count() == 0
