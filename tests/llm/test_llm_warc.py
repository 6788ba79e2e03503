import base64
import glob
import gzip
import hashlib
import os

import pytest
from pyspark.errors import PythonException

from oracle import assert_matches
from touchline.llm import warc
from touchline.llm.queries import ORACLES, op13_warc

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, id string, sha1 string, size string, shard string, first string, h string"


def pages(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "i", "s", "z", "x", "f", "h") for r in rows], SCHEMA).repartition(parts)


ROWS = [
    (5, "http://a/5", "same"),
    (2, "http://a/2 with space\r\nX: y", "same"),
    (9, None, "same"),
    (9, "http://a/9", "same"),
    (2, "http://a/2b", "same"),
    (1, "http://a/1", None),
    (4, "http://a/4", ""),
    (None, "http://a/null", "same"),
    (None, None, None),
    (7, "http://a/7", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\né😀"),
    (8, "http://a/8", "<p>" + "long text " * 60_000),
    (-3, "http://a/-3", "alone"),
    (2**62, "http://a/far", "alone"),
]


def expected(rows, least=0):
    payloads = [(r[2] or "").encode() for r in rows]
    first = {}
    for r, p in zip(rows, payloads):
        if r[0] is not None:
            first[p] = min(first.get(p, r[0]), r[0])
    result = []
    for r, p in zip(rows, payloads):
        revisit = r[0] is not None and r[0] > first[p] and len(p) >= least
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        result.append((r[0], len(p), digest, "revisit" if revisit else "response", first[p] if revisit else None))
    return sorted(map(str, result))


def read(spark, root):
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(str(tuple(r)) for r in warc.read_archives(spark, root).select(*fields).collect())


def test_query_matches_sql(spark):
    assert assert_matches(op13_warc(spark, SF), ORACLES["op13_warc"], SF) > 0


@pytest.mark.parametrize("options", [{}, {"least": 5}, {"shard_bytes": 20_000, "roll_bytes": 300}, {"shard_bytes": 100_000, "bins": 3}])
def test_pages_come_back(spark, folder, options):
    warc.write_archives(pages(spark, ROWS), f"{folder}/w", **options)
    assert read(spark, f"{folder}/w") == expected(ROWS, options.get("least", 0))


def test_no_pages(spark, folder):
    assert warc.write_archives(pages(spark, []), f"{folder}/w").count() == 0
    assert read(spark, f"{folder}/w") == []


def many():
    rows = [(i, f"http://h/{i}", f"text {i % 37} " * (i % 50)) for i in range(400)]
    return rows + [(1000 + i, f"http://h/c{i}", "hot") for i in range(300)] + [(3, "http://h/3", f"v{i}") for i in range(200)]


def files(root):
    return {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{root}/*.warc.gz")}


def test_files_are_the_same_for_any_partitions(spark, folder):
    small = {"shard_bytes": 40_000, "roll_bytes": 4_000}
    warc.write_archives(pages(spark, many(), 2), f"{folder}/a", **small)
    warc.write_archives(pages(spark, many()[::-1], 7), f"{folder}/b", **small)
    assert len(files(f"{folder}/a")) > 10
    assert files(f"{folder}/a") == files(f"{folder}/b")
    assert read(spark, f"{folder}/a") == expected(many())


def test_files_are_rolled_sorted_and_listed(spark, folder):
    manifest = warc.write_archives(pages(spark, many()), f"{folder}/w", shard_bytes=40_000, roll_bytes=4_000).collect()
    found = files(f"{folder}/w")
    assert {r["name"] for r in manifest} == set(found)
    assert not os.path.exists(f"{folder}/w/_temporary")
    for r in manifest:
        data = found[r["name"]]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        assert r["bytes"] < 4_000 + 1_000  # closed by the record that reaches the size
        assert r["first_id"] <= r["last_id"]
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"\r\nWARC-Record-ID") == r["records"] + 1
    ids = [(r["first_id"], r["last_id"]) for r in sorted(manifest, key=lambda r: r["name"])]
    assert all(a[1] <= b[0] for a, b in zip(ids, ids[1:]) if 3 not in (*a, *b))


def test_record_ids_are_unique_and_references_meet(spark, folder):
    rows = ROWS + [(5, "http://a/5", "same"), (1, "http://a/1", None)]
    warc.write_archives(pages(spark, rows), f"{folder}/w")
    found = warc.read_archives(spark, f"{folder}/w", payloads=True).collect()
    assert len({r["record_id"] for r in found}) == len(rows)
    long = next(r for r in found if r["page_id"] == 8)
    assert bytes(long["payload"]).decode() == ROWS[10][2]
    assert next(r for r in found if r["page_id"] == 5)["payload"] is None
    assert next(r for r in found if r["page_id"] == 2)["target_uri"].startswith("http://a/2")
    assert not any(c in r["target_uri"] for r in found for c in " \r\n")


def test_leftovers_of_lost_tasks_are_not_read(spark, folder):
    root = f"{folder}/w"
    warc.write_archives(pages(spark, ROWS), root)
    os.makedirs(f"{root}/_temporary")
    for name in ("_temporary/pages-000000-00000.warc.gz.dead", "pages-000099-00000.warc.gz"):
        with open(f"{root}/{name}", "wb") as out:
            out.write(b"half a file")
    assert read(spark, root) == expected(ROWS)


def test_a_repeated_commit_finds_its_files(spark, folder):
    root = f"{folder}/w"
    warc.write_archives(pages(spark, ROWS), root)
    listed = warc.read_manifest(spark, root).selectExpr("*", "'_temporary/gone' AS temporary")
    batches = listed.select(*[f.name for f in warc._MANIFEST]).toArrow().to_batches()
    assert sum(b.num_rows for b in warc._committer(root)(iter(batches))) == 1
    os.remove(glob.glob(f"{root}/*.warc.gz")[0])
    with pytest.raises(OSError):
        list(warc._committer(root)(iter(batches)))


@pytest.mark.parametrize("damage", ["cut", "payload"])
def test_damaged_archives_are_noticed(spark, folder, damage):
    root = f"{folder}/w"
    warc.write_archives(pages(spark, ROWS), root)
    path = glob.glob(f"{root}/*.warc.gz")[0]
    data = open(path, "rb").read()
    if damage == "cut":
        data = data[:-30]
    else:
        data = b"".join(warc.member(m.replace(b"long text", b"lost text")) for m in warc.members(open(path, "rb")))
    open(path, "wb").write(data)
    with pytest.raises(PythonException, match="CorruptArchive"):
        read(spark, root)
