import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from touchline.llm import fingerprints as fp
from touchline.llm.common import documents
from touchline.llm.queries import op10_fingerprints

SF = "/root/testdata/sf0.001"


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed=h)
    return h


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def syncmers(units, k=fp.K, s=fp.S):
    """Closed syncmers by their definition."""
    hashes = [xxhash.xxh64_intdigest(u.encode(), seed=42) for u in units]
    if 0 < len(units) < k:
        return [(signed(chained(hashes)), 0)]
    inner = [signed(chained(hashes[i : i + s])) for i in range(len(hashes) - s + 1)]
    found = []
    for i in range(len(units) - k + 1):
        window = inner[i : i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            found.append((signed(chained(hashes[i : i + k])), i))
    return found


def test_anchors_match_the_definition(spark, prose):
    texts = [prose(300, 1), prose(12, 2), "abc", "", "éß漢" * 9]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fp.anchors(F.col("text")).alias("a"))
    for r in frame.collect():
        units = r["text"].split() if len(r["text"]) >= fp.CHAR_LIMIT else list(r["text"])
        assert [tuple(x) for x in r["a"]] == syncmers(units)


def test_edits_match_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in documents(spark, SF).collect())
    found = {r["doc_id"]: r for r in op10_fingerprints(spark, SF).collect()}
    assert len(found) == len(rows)
    prints = {}
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = found[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
    likeness = [r["near_edited"] for r in found.values()]
    assert sorted(likeness)[len(likeness) // 10] > 0.5
    assert sum(r["near_next"] > 0.3 for r in found.values() if r["n_chars"] > 200) <= len(rows) // 50


def test_edges(spark, tables, edges):
    found = op10_fingerprints(spark, tables(edges)).collect()
    assert len(found) == len(edges)
    empty = [r for r in found if r["doc_id"] in (1, 2)]
    assert {(r["n_chars"], r["fingerprint"], r["near_edited"]) for r in empty} == {(0, "", 1.0)}
    first = [r for r in found if r["doc_id"] == 5]
    assert sorted(r["near_next"] for r in first)[-1] == 1.0


@pytest.mark.parametrize("rows", [[], [(1, "only one row")], [(None, "x")]])
def test_few_rows(spark, tables, rows):
    found = op10_fingerprints(spark, tables(rows)).collect()
    assert [r["near_next"] for r in found] == [1.0] * len(rows)


def test_texts_on_two_sides_of_the_limit_are_alike(spark, tables, prose):
    text = prose(400, 9)
    wordless = "".join(chr(0x4E00 + (i * i * 7919 + i * 31) % 5000) for i in range(3000))
    pairs = [(text[:1000], text[:1300]), (text[:1300], text[:1000]), (text[:1000], prose(300, 10)), (wordless, wordless[:2900] + "漢字" * 20)]
    rows = [(i, t) for i, t in enumerate(t for pair in pairs for t in pair)]
    found = {r["doc_id"]: r for r in op10_fingerprints(spark, tables(rows)).collect()}
    near = [found[2 * i]["near_next"] for i in range(len(pairs))]
    assert near[0] > 0.8 and near[1] == pytest.approx(near[0]) and near[2] < 0.4 and near[3] > 0.9
    # The last quarter of 1,200 code points gives way to a short next text.
    edited = op10_fingerprints(spark, tables([(1, text[:1200]), (2, "a few words")])).where("doc_id = 1").first()
    assert edited["near_edited"] > 0.7


def pieces(text):
    """Runs of up to four letters and digits; every other code point but white space alone."""
    letter = "0-9A-Za-zÀ-ɏͰ-῿"
    return re.findall(f"[{letter}]{{1,4}}|[^\x20\x09-\x0d{letter}]", text)


def printed(text):
    return ",".join(f"{h % 2**64:x}@{p}" for h, p in syncmers(pieces(text)))


def likeness(a, b):
    """Share of anchors with a partner of the same hash in the same or a neighbouring cell, from two fingerprints."""

    def cells(print_):
        return {(h, int(p) // fp.SHIFT) for h, p in (x.split("@") for x in print_.split(",") if x)}

    def met(mine, theirs):
        return sum(any((h, c + d) in theirs for d in (-1, 0, 1)) for h, c in mine)

    a, b = cells(a), cells(b)
    return (met(a, b) + met(b, a)) / (len(a) + len(b)) if a or b else 1.0


def check_prints(rows, found):
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        r = found[doc_id]
        own, edited = printed(text), printed(text[: len(text) - quarter] + following[:quarter])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, edited)
        assert r["near_edited"] == pytest.approx(likeness(own, edited))
        assert r["near_next"] == pytest.approx(likeness(own, printed(following)))


def test_prints_and_likeness_match_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in documents(spark, SF).collect())
    check_prints(rows, {r["doc_id"]: r for r in op10_fingerprints(spark, SF).collect()})


def test_cuts_at_every_kind_of_place_match_brute_force(spark, tables, prose):
    texts = ["", " ", "a", "ab cd", "漢字" * 40, "x" * 400, " lead", "trail   ", "a b c d e f g h", "one two three four five six seven eight"]
    texts += ["(a)[b]{c}" * 9 + " ü", "μήλο и яблоко " * 5, "😀 " * 30, "no-space-" * 20, prose(700, 3), prose(5, 4) + "\n" * 50, "\n" * 90 + prose(9, 5)]
    texts += [prose(n, n) for n in range(1, 40)]
    rows = list(enumerate(texts))
    check_prints(rows, {r["doc_id"]: r for r in op10_fingerprints(spark, tables(rows)).collect()})


def test_copies_of_nearly_equal_length_share_their_anchors(spark, tables, prose):
    text = prose(400, 9)
    found = op10_fingerprints(spark, tables([(1, text[:1023]), (2, text[:1025])])).collect()
    assert min(r["near_next"] for r in found) > 0.98
