import hashlib
import random
import re

import numpy as np
import pytest

from oracle import assert_matches
from touchline.llm import infill
from touchline.llm.common import documents
from touchline.llm.queries import ORACLES, op12_infill
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_query_matches_sql(spark):
    assert assert_matches(op12_infill(spark, SF), ORACLES["op12_infill"], SF) > 0


def test_query_matches_plain_version(spark, tables, edges):
    rows = edges + [(i, t) for i, t in enumerate(["a<P>b", "<S>", "x<M", "<<S>", "é" * 5000, "漢😀" * 4100, "<P <S <M"] * 30, 100)]
    rows += [(500, "word é😀 " * 60_000)]
    found = op12_infill(spark, tables(rows)).collect()

    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    expected = [(i, *plain(i, t)[:4], sha(plain(i, t)[4]), sha(t)) for i, t in rows]
    order = lambda rs: sorted(map(str, rs))
    assert order(tuple(r) for r in found) == order(expected)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_no_rows(spark, tables):
    assert op12_infill(spark, tables([])).collect() == []


@pytest.mark.parametrize("unit", infill.UNITS)
@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_cuts_equal_a_scan(unit, block):
    rng = random.Random(block)
    patterns = {"char": r"(?s).", "word": r"(?s)^\s+$|^\s*\S+\s*|\S+\s*", "line": r"[^\n]*\n|[^\n]+"}
    for _ in range(60):
        text = "".join(rng.choices("a b\né漢😀  \n", k=rng.randint(0, 90)))
        units = re.findall(patterns[unit], text)
        assert "".join(units) == text
        blocks = infill.Blocks(np.frombuffer(text.encode(), dtype=np.uint8), unit, block)
        assert (blocks.units, blocks.points) == (len(units), len(text))
        for u in range(len(units) + 2):
            before = "".join(units[:u])
            assert blocks.cut(u) == (len(before.encode()), len(before))


@pytest.mark.parametrize("unit", infill.UNITS)
def test_texts_come_back_whatever_the_unit(spark, tables, edges, unit):
    rows = edges + [(i, "<S <M P> <<P " * (i % 5) + "line\nof é words 😀\n" * (i % 9)) for i in range(100, 180)]
    docs = documents(spark, tables(rows))
    made = infill.fill_in_middle(docs, unit=unit, rate=100, spm=50, block=16)
    back = made.select("doc_id", "form", infill.restored(F.col("form"), F.col("output")).alias("text")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}


def test_an_unknown_unit_is_refused(spark, tables):
    with pytest.raises(ValueError, match="unit"):
        infill.fill_in_middle(documents(spark, tables([])), unit="page")
