import hashlib
import random

import public_tokenizers
import pytest

from touchline.llm import bpe, packing
from touchline.llm.common import documents
from touchline.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, op1_bpe, op4_packing

WORDS = public_tokenizers.path(WORD_VOCABULARY)
BYTES = public_tokenizers.path(BYTE_VOCABULARY)
PARTS = "hello aaa ciónes l'll don't 123 éàü é 😀😀 <|endoftext|> !!!''s ß 漢字   İ ﬁ thetheth %%% ¼ µ 'S".split(" ")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def library(path, text):
    tokenizer = bpe.load_tokenizer(path)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [16, 40, 64])
def test_tree_gives_the_library_encoding(leaf):
    rng, tokenizer = random.Random(leaf), bpe.load_tokenizer(WORDS)
    for i in range(200):
        text = "".join(rng.choices(PARTS if i % 2 else "abcdeths'", k=rng.randint(0, 150)))
        assert bpe.encode_tree(tokenizer, text, leaf) == library(WORDS, text)[0]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_codec_gives_the_library_result(path):
    rng, codec = random.Random(1), bpe.codec(path)
    for i in range(500):
        pool = PARTS + [" ", "\n", "  ", "\t ", "\x0b"] if i % 2 else [chr(c) for c in (*range(32, 127), *range(161, 256), 10)]
        text = "".join(rng.choices(pool, k=rng.randint(0, 60)))
        ids = codec.encode(text)
        assert (ids, codec.decode(ids)) == library(path, text)


def test_query_on_edges(spark, tables, edges):
    rows = op1_bpe(spark, tables(edges)).collect()
    expected = []
    for doc_id, text in edges:
        ids, decoded = library(WORDS, text)
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_leaves_on_tasks_and_real_outputs(spark, tables):
    texts = {1: "thenation" * 50, 2: "short", 3: "ab'll" * 90 + " x"}
    docs = documents(spark, tables(texts.items()))
    for row in bpe.encode_decode(docs, WORDS, leaf=64).collect():
        assert (row["ids"], row["decoded"]) == library(WORDS, texts[row["doc_id"]])


def test_parts_of_long_texts_as_rows(spark, tables):
    rng = random.Random(5)
    texts = {i: "".join(rng.choices([*PARTS, " ", "\n", "e\u0301\u0323", " it's "], k=rng.randint(40, 400))) for i in range(20)}
    texts[20] = "a" + "\u0301\u0323" * 300 + "b" * 90 + " " * 500 + "end"
    docs = documents(spark, tables(texts.items()))
    for row in bpe.encode_decode(docs, WORDS, leaf=40, spread=90).collect():
        assert (row["ids"], row["decoded"]) == library(WORDS, texts[row["doc_id"]])


def test_real_texts_through_the_tree(spark):
    tokenizer = bpe.load_tokenizer(WORDS)
    long = [r["text"] for r in documents(spark, "/root/testdata/sf0.01").where("length(text) > 4096").collect()]
    assert len(long) > 50
    for text in long:
        expected = library(WORDS, text)[0]
        assert bpe.encode_tree(tokenizer, text) == expected
        assert bpe.encode_tree(tokenizer, text, 200) == expected
        assert bpe.encode_tree(tokenizer, text, pieces=bpe.codec(WORDS).pieces) == expected


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_of_a_part_are_the_library_tokens_and_places(path):
    rng, codec = random.Random(2), bpe.codec(path)
    for i in range(300):
        pool = PARTS + [" ", "\n", "it's "] if i % 2 else [*map(chr, range(32, 127)), "\n", " "]
        part = "".join(rng.choices(pool, k=rng.randint(0, 80)))
        quick, plain = codec.pieces(part, 7), bpe.Pieces.of(codec.tokenizer, part, 7)
        for k in ("ids", "starts", "ends"):
            assert getattr(quick, k).tolist() == getattr(plain, k).tolist()


def test_parts_of_latin_letters_go_by_the_ranks(monkeypatch):
    rng, codec = random.Random(9), bpe.codec(WORDS)
    parts = ["".join(rng.choices("abcdeÉÀéüßµÆñÿ«»÷½² \t\n'.1ºs", k=rng.randint(0, 80))) for _ in range(200)]
    expected = [bpe.Pieces.of(codec.tokenizer, part, 5) for part in parts]
    monkeypatch.setattr(bpe.Pieces, "of", None)  # the slower way is not taken
    for part, other in zip(parts, expected):
        found = codec.pieces(part, 5)
        for field in ("ids", "starts", "ends"):
            assert getattr(found, field).tolist() == getattr(other, field).tolist()


def test_marks_stay_with_their_letter():
    rng, tokenizer = random.Random(8), bpe.load_tokenizer(WORDS)
    for _ in range(200):
        text = "".join(rng.choices(["a", "e ", "o", "\u1100\u1161\u11a8", "\u0915\u093c"], k=9)) + "".join(rng.choices("\u0301\u0323\u0327", k=rng.randint(0, 120))) + "".join(rng.choices("abc d'", k=60))
        assert bpe.encode_tree(tokenizer, text, 24) == library(WORDS, text)[0]


def test_empty_table(spark, tables):
    folder = tables([])
    assert op1_bpe(spark, folder).count() == 0
    assert op4_packing(spark, folder).count() == 0


def check_packing(rows, texts, capacity=2048):
    """Every document's pieces are its ids in order, and sequences have no gap and fit."""
    import zlib
    from array import array

    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = [*library(BYTES, text)[0], 0]
        at = 0
        for i, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], r["length"]) == (i, at, len(part))
            assert r["ids_crc32"] == zlib.crc32(array("I", part).tobytes())
            assert r["length"] == capacity or i == 0
            at += r["length"]
        assert at == len(ids)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_of_real_documents_is_near_the_bound(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in documents(spark, folder).collect()}
    used, least = check_packing(op4_packing(spark, folder).collect(), texts)
    assert used <= least + 1


def test_packing_edges(spark, tables, edges):
    distinct = {i: t for i, t in edges if i not in (None, 5)}
    check_packing(op4_packing(spark, tables(distinct.items())).collect(), distinct)
    rows = op4_packing(spark, tables(edges)).collect()
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert sum(r["doc_id"] == 5 for r in rows) == 2


@pytest.mark.parametrize(
    "counts, sequences",
    [
        ({}, 0),
        ({2048: 3}, 3),
        ({1000: 2, 1048: 2}, 2),
        ({1000: 1, 500: 1, 548: 1}, 1),
        ({1000: 1, 500: 1, 300: 1, 248: 1}, 1),
        ({5: 3}, 1),
        ({1500: 2, 600: 1}, 3),
    ],
)
def test_plan_consumes_exact_complements(counts, sequences):
    plan = packing.Plan(counts, 2048)
    assert sum(n for _, n in plan.sequences) == sequences
    used = {}
    for lengths, n in plan.sequences:
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == counts


def test_pack_takes_any_pieces_and_keeps_their_columns(spark):
    pieces = spark.createDataFrame([("a", 6, 1), ("b", 4, 2), ("c", 10, 3)], "name string, length long, rank int")
    rows = packing.pack(pieces, capacity=10).collect()
    assert len({r["sequence_id"] for r in rows}) == 2
    assert {r["name"] for r in rows} == {"a", "b", "c"}
