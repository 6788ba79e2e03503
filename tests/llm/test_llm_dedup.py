import hashlib
import json
import random

import brute
import numpy as np
import pytest

from touchline.llm import common, neardup, substrings
from touchline.llm.common import documents, unpacked
from touchline.llm.queries import ORACLES, op6_neardup, op9_substrings
from oracle import assert_matches

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query, name", [(op6_neardup, "op6_neardup"), (op9_substrings, "op9_substrings")])
def test_query_matches_sql(spark, query, name):
    assert assert_matches(query(spark, SF), ORACLES[name], SF) > 0


def near_copies(prose, size=120, many=60):
    """Copies of one text with some words changed, so that links form a wide range."""
    rng, base = random.Random(5), prose(size, 3).split()
    rows = [(100, " ".join(base))]
    for i in range(many):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(size)] = f"new{rng.randrange(9)}"
        rows.append((101 + i, " ".join(words)))
    return rows


def test_components_of_near_copies(spark, tables, prose):
    rows = near_copies(prose) + [(i, prose(40, i)) for i in range(200, 230)]
    # A chain in which each text is near the next only.
    chain = prose(100, 77).split()
    for i in range(12):
        rows.append((300 + i, " ".join(chain[i * 3 : i * 3 + 60])))
    rows += [(400, rows[0][1].upper()), (401, "one two"), (402, "ONE two"), (403, "one  two three")]
    found = {r["doc_id"]: r["component_id"] for r in op6_neardup(spark, tables(rows)).collect()}
    assert found == brute.components(rows)


def test_near_duplicates_on_edges(spark, tables, edges):
    found = op6_neardup(spark, tables(edges)).collect()
    assert len(found) == len(edges)
    assert all(r["kept"] for r in found)
    assert {r["n_shingles"] for r in found if r["doc_id"] in (1, 2, 3)} == {0}
    assert [r["component_id"] for r in found if r["doc_id"] == 5] == [5, 5]


def test_a_null_id_belongs_to_its_class(spark, tables):
    found = op6_neardup(spark, tables([(None, "a b c d e f"), (9, "a b c d e f")])).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(None, 9, False), (9, 9, True)}


def test_keep_one_of_each_class(spark, tables, prose):
    rows = near_copies(prose, many=8) + [(1, None), (1, None), (2, "")]
    docs = documents(spark, tables(rows))
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {i for i, c in brute.components([r for r in rows if r[0] >= 100]).items() if i == c} | {1, 2}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_estimates_are_close():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for overlap in (0.5, 0.85, 1.0):
        size = 1000
        both = int(2 * size * overlap / (1 + overlap))
        a, b = pool[:size], np.concatenate([pool[:both], pool[2000 : 2000 + size - both]])
        best = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], np.array([1000.0]), np.array([1000.0]))
        assert abs(best[0] - overlap) < 0.12
    merged = np.maximum(neardup.registers(pool[:500]), neardup.registers(pool[500:900]))
    assert (merged == neardup.registers(pool[:900])).all()


def substring_rows(prose):
    shared = prose(60, 8)
    rows = [(i, f"{prose(30 + i, i)} {shared} {prose(20, 100 + i)}") for i in range(6)]
    rows += [(10, "a " * 34), (11, "b " * 36), (12, prose(90, 50)), (13, prose(90, 50).replace(" ", "\n ")), (13, prose(35, 60))]
    rows += [(14, prose(35, 60)), (15, shared[: len(shared) // 2])]
    return rows


def test_substrings_match_brute_force(spark, tables, prose, edges):
    rows = substring_rows(prose) + edges
    found = op9_substrings(spark, tables(rows)).collect()
    stays = brute.without_repeats([t for _, t in rows])
    expected = [
        (i, len(brute.words(t)), len(brute.words(t)) - len(s), hashlib.sha256(" ".join(s).encode()).hexdigest())
        for (i, t), s in zip(rows, stays)
    ]
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected, key=str)


def test_removal_keeps_rows_columns_and_the_rest_of_the_text(spark, tables, prose):
    rows = substring_rows(prose) + [(1, None)]
    docs = documents(spark, tables(rows))
    cut = substrings.remove_repeats(docs)
    assert cut.columns == docs.columns
    got = sorted((r["doc_id"], " ".join(brute.words(r["text"]))) for r in cut.collect())
    assert got == sorted((i, " ".join(s)) for (i, _), s in zip(rows, brute.without_repeats([t for _, t in rows])))
    assert {r["text"] for r in cut.where("doc_id = 10").collect()} == {"a " * 34}


def test_intervals_are_maximal():
    starts, ends = substrings.spans_of(np.array([False, True, True, False] + [False] * 40 + [True]))
    assert (starts.tolist(), ends.tolist()) == ([1, 44], [37, 79])


def test_dedup_of_empty_tables(spark, tables):
    folder = tables([])
    assert op6_neardup(spark, folder).count() == 0
    assert op9_substrings(spark, folder).count() == 0


def test_texts_are_shuffled_packed(spark, tables, prose, monkeypatch):
    written = {}
    real = substrings.as_table
    monkeypatch.setattr(substrings, "as_table", lambda frame, label: written.setdefault(label, frame) and real(frame, label))
    shared = prose(60, 1)
    texts = [(1, shared + " " + prose(40, 2)), (2, prose(50, 3) + " " + shared), (3, shared + " é 漢字"), (4, None)]
    substrings.find_repeats(documents(spark, tables(texts)))
    assert "text" not in written["substrings-texts"].columns and "packed" in written["substrings-texts"].columns
    held = {unpacked(bytes(r["packed"])) for r in written["substrings-texts"].collect()}
    assert held == {t for _, t in texts if t}


def test_removal_shuffles_a_text_once_and_packed(spark, tables, prose, monkeypatch):
    shared = prose(60, 1)
    texts = [(1, shared + " " + prose(40, 2)), (2, prose(50, 3) + " " + shared), (3, "é 漢字  \n"), (4, None), (5, "")]
    docs = documents(spark, tables([*texts, (6, "x y " * 9000), (6, "x y " * 9000), (7, "ab " * 34)]))
    monkeypatch.setattr(common, "BATCH_BYTES", 20)
    cut = substrings.remove_repeats(docs)
    node = cut._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    crossing = {f["name"]: f["type"] for f in json.loads(node.children().head().schema().json())["fields"]}
    assert crossing.keys() == {"row", "h1", "h2"}
    assert {f["name"]: f["type"] for f in crossing["row"]["fields"]}["text"] == "binary"
    got = sorted((r["doc_id"], r["text"]) for r in cut.where("doc_id < 6").collect() if r["text"] is not None)
    assert got == [(1, prose(40, 2)), (2, prose(50, 3) + " "), (3, "é 漢字  \n"), (5, "")]
    assert sorted(map(tuple, cut.where("doc_id IN (4, 6, 7)").select("doc_id", "text").collect())) == [
        (4, None), (6, ""), (6, ""), (7, "ab " * 34)
    ]
