"""WARC archives of pages: a deterministic writer in shards, and a reader.

Writing
    1. A narrow table of ids, sizes and digests is written once.  Of pages with equal payloads
       that with the least id is the response; the others revisit it.
    2. The span of ids is cut in ``BINS`` bins of equal width.  Bins are laid together in order
       to shards of about ``SHARD_BYTES``; a heavier bin is dealt to several by a hash of id and
       digest.  Counts decide this, never a sample, so the shards of a table are always the same.
    3. Each shard is sorted by id and written by one task, record by record, as one gzip member
       each.  A file is closed once it has ``ROLL_BYTES`` compressed bytes.  Headers, record ids
       and digests are made anew from the rows alone, so a repeated task writes equal bytes.
    4. Tasks write under temporary names and return manifest rows.  Spark keeps the rows of one
       attempt per task; a second job renames what they list, and the manifest in
       ``<root>/manifest`` is written last.  Readers know only its files, so a lost executor, a
       failed or a repeated task leaves nothing behind that anyone reads.

The folder may be in any store that ``pyarrow.fs`` reaches; it must be shared by all executors.

Edge cases: null html counts as empty text.  Payloads below ``least`` bytes are all responses, as
are pages without an id and, where the least id of equal payloads is repeated, all its rows; pages
without an id come first.  Ties are ordered by digest and URL.  White space and control characters
of URLs are percent-encoded; a null URL becomes ``urn:page:<id>``.  Rows equal in id and html share a
shard; their record ids are numbered.  A page is held in memory whole, nothing else is.  An empty table gives a
manifest without files.  Only the three named columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm.common import as_table, importable

SHARD_BYTES = 128 << 20  # payload that one task writes
ROLL_BYTES = 32 << 20  # compressed bytes after which a file is closed
BINS = 65_536  # ranges of ids whose sizes the driver sees
SALTS = 16  # parts in which the pages of one payload meet its response
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of retrieval

# The WARC profile of a revisit, and our two fields of page ids.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID, REFERS_TO_ID = "Page-Id", "Refers-To-Page-Id"

_OVERHEAD = 512  # bytes of headers per record, for balancing shards
_MANIFEST = pa.schema(
    [
        ("shard", pa.int64()),
        ("file", pa.int64()),
        ("name", pa.string()),
        ("temporary", pa.string()),
        ("bytes", pa.int64()),
        ("records", pa.int64()),
        ("responses", pa.int64()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("sha256", pa.string()),
    ]
)
_MANIFEST_DDL = (
    "shard bigint, file bigint, name string, temporary string, bytes bigint, records bigint, responses bigint, "
    "first_id bigint, last_id bigint, sha256 string"
)


class CorruptArchive(ValueError):
    """A record or a file that is not what its headers or the manifest say."""


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"\w[\w+.-]*:", path) else (fs.LocalFileSystem(), path)


# ---- records ---------------------------------------------------------------------------------


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(*name: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(str, name)))}>"


def _uri(url: str | None, page: int | None) -> str:
    if url is None:
        return f"urn:page:{'' if page is None else page}"
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A record as one gzip member, without a time."""
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(record) + press.flush()


def info_record(name: str, date: str) -> bytes:
    block = b"software: touchline\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", _record_id("file", name)),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/warc-fields"),
    ]
    return _record(fields, block)


def page_record(page: int | None, url: str | None, payload: bytes, first: int | None, repeat: int, date: str) -> bytes:
    """The response of a page, or with ``first`` its revisit of that page's response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base32_sha1(payload)
    revisit = first is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id("page", page, digest, *[repeat][: repeat > 0])),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(url, page)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id("page", first, digest) if revisit else None),
        (REFERS_TO_ID, first),
        (PAGE_ID, page),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(fields, block)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record whose length and block digest are right."""
    head, end, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields.get("Content-Length", -1))
    if not end or not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise CorruptArchive(f"broken record {fields.get('WARC-Record-ID')}")
    block = rest[:size]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise CorruptArchive(f"block digest of {fields['WARC-Record-ID']}")
    return fields, block


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    data = stream.read(1 << 20)
    while data:
        press, parts = zlib.decompressobj(31), []
        while not press.eof:
            if not data:
                raise CorruptArchive("a file ends within a record")
            parts.append(press.decompress(data))
            data = press.unused_data if press.eof else stream.read(1 << 20)
        yield b"".join(parts)
        data = data or stream.read(1 << 20)


# ---- writing ---------------------------------------------------------------------------------


def _bin(width: int) -> Column:
    return F.expr(f"id div {width}L").alias("bin")


def _shards(sizes: list[tuple[int | None, int]], shard_bytes: int) -> list[tuple[int | None, int, int]]:
    """``bin, first shard, number of shards`` from the bytes of the bins."""
    plan, shard, filled = [], 0, 0
    for name, size in sorted(sizes, key=lambda x: (x[0] is not None, x[0])):
        if filled and filled + size > shard_bytes:
            shard, filled = shard + 1, 0
        parts = max(1, -(-size // shard_bytes))
        plan.append((name, shard, parts))
        filled += size
        if parts > 1:
            shard, filled = shard + parts, 0
    return plan


class _Roll:
    """The open file of a shard under its temporary name."""

    def __init__(self, root: str, shard: int, number: int, date: str):
        self.row = {"shard": shard, "file": number, "name": f"pages-{shard:06d}-{number:05d}.warc.gz"}
        self.row |= {"temporary": f"_temporary/{self.row['name']}.{uuid.uuid4().hex}", "bytes": 0, "records": 0, "responses": 0}
        store, path = _store(root)
        store.create_dir(f"{path}/_temporary", recursive=True)
        self._out = store.open_output_stream(f"{path}/{self.row['temporary']}", compression=None)
        self._hash = hashlib.sha256()
        self.add(member(info_record(self.row["name"], date)))

    def add(self, data: bytes) -> None:
        self._out.write(data)
        self._hash.update(data)
        self.row["bytes"] += len(data)

    def add_page(self, data: bytes, page: int | None, response: bool) -> None:
        self.add(data)
        self.row["records"] += 1
        self.row["responses"] += response
        self.row.setdefault("first_id", page)
        self.row["last_id"] = page

    def close(self) -> pa.RecordBatch:
        self._out.close()
        return pa.RecordBatch.from_pylist([self.row | {"sha256": self._hash.hexdigest()}], schema=_MANIFEST)


def _writer(root: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, last, repeat, mark, target = None, None, 0, None, None
        for batch in batches:
            for shard, page, sha1, h, first, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                name = (page, sha1, h)
                if payload is None:
                    mark, target = name, first
                    continue
                if roll and (roll.row["shard"] != shard or roll.row["bytes"] >= roll_bytes):
                    number = roll.row["file"] + 1 if roll.row["shard"] == shard else 0
                    yield roll.close()
                    roll = _Roll(root, shard, number, date)
                roll = roll or _Roll(root, shard, 0, date)
                first = target if mark == name else None
                repeat = repeat + 1 if last == name else 0
                last = name
                roll.add_page(member(page_record(page, url, payload, first, repeat, date)), page, first is None)
        if roll:
            yield roll.close()

    return run


def _committer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(root)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{path}/{row['name']}"
                try:
                    store.move(f"{path}/{row['temporary']}", final)
                except OSError:
                    # An attempt before this one has renamed it.
                    if store.get_file_info(final).size != row["bytes"]:
                        raise
            yield batch

    return run


def write_archives(
    pages: DataFrame,
    root: str,
    key: str = "page_id",
    html: str = "html",
    url: str = "url",
    least: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    bins: int = BINS,
    date: str = DATE,
) -> DataFrame:
    """Write every page to ``root`` as a record and return the manifest, one row per file."""
    spark = importable(pages.sparkSession)
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    source = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    named = source.withColumns({"sha1": F.sha1("payload"), "h": F.xxhash64("payload")})
    narrow = as_table(named.select("id", "sha1", "h", F.octet_length("payload").cast("bigint").alias("size")), "warc-narrow")

    low, high = narrow.agg(F.min("id"), F.max("id")).first()
    width = 1 if low is None else (high - low) // bins + 1
    # At most bins + 2 rows: ids are cut in so many ranges, and null is one more.
    sizes = narrow.groupBy(_bin(width)).agg(F.sum(F.col("size") + _OVERHEAD).alias("bytes")).collect()
    plan = _shards([(r["bin"], r["bytes"]) for r in sizes], shard_bytes)
    shards = max(1, max((first + parts for _, first, parts in plan), default=1))
    places = F.broadcast(spark.createDataFrame(plan, "at bigint, first_shard bigint, parts bigint"))

    def dealt(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("id", "sha1"), F.col("parts"))
        placed = rows.withColumn("bin", _bin(width)).join(places, F.col("bin").eqNullSafe(F.col("at")))
        return placed.select((F.col("first_shard") + part).alias("shard"), *rows.columns)

    same = ["sha1", "h", "size"]
    able = narrow.where(F.col("id").isNotNull() & (F.col("size") >= least))
    groups = able.groupBy(*same).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    salted = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = able.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, [*same, "salt"])
    marks = copies.where(F.col("id") > F.col("first")).select("id", "sha1", "h", "first")

    # What a page revisits travels to its shard as a row of its own, sorted before the page.
    rows = dealt(named).unionByName(dealt(marks), allowMissingColumns=True).repartition(shards, "shard")
    rows = rows.select("shard", "id", "sha1", "h", "first", "url", "payload")
    order = ["shard", F.asc_nulls_first("id"), "sha1", "h", F.asc_nulls_last("first"), F.asc_nulls_first("url")]
    ordered = rows.sortWithinPartitions(*order)
    written = f"{root}/_temporary-manifest"
    ordered.mapInArrow(_writer(root, roll_bytes, date), _MANIFEST_DDL).write.parquet(written)
    listed = spark.read.schema(_MANIFEST_DDL).parquet(written)
    listed.mapInArrow(_committer(root), _MANIFEST_DDL).drop("temporary").write.parquet(f"{root}/manifest")
    store, path = _store(root)
    for folder in ("_temporary", "_temporary-manifest"):
        if store.get_file_info(f"{path}/{folder}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/{folder}")
    return read_manifest(spark, root)


# ---- reading ---------------------------------------------------------------------------------


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_DDL.replace("temporary string, ", "")).parquet(f"{root}/manifest")


def _page(fields: dict[str, str], block: bytes) -> dict | None:
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\ncontent-length: *(\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(body) != size or base32_sha1(body) != digest):
        raise CorruptArchive(f"payload of {fields['WARC-Record-ID']}")
    number = {name: None if name not in fields else int(fields[name]) for name in (PAGE_ID, REFERS_TO_ID)}
    return {
        "page_id": number[PAGE_ID],
        "target_uri": fields["WARC-Target-URI"],
        "record_id": fields["WARC-Record-ID"],
        "record_type": kind,
        "refers_to": number[REFERS_TO_ID],
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": body if kind == "response" else None,
    }


_PAGE = pa.schema(
    [
        ("file", pa.string()),
        ("page_id", pa.int64()),
        ("target_uri", pa.string()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
_BATCH_BYTES = 8 << 20


def _reader(root: str, payloads: bool):
    schema = _PAGE if payloads else _PAGE.remove(len(_PAGE) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(root)
        for batch in batches:
            for name, records in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        page = _page(*parse(data))
                        if page is None:
                            continue
                        seen += 1
                        held += len(page["payload"] or b"") if payloads else 256
                        rows.append({"file": name} | page)
                        if held >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if seen != records:
                    raise CorruptArchive(f"{name} has {seen} records, the manifest says {records}")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_archives(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """The pages of all files in the manifest, every digest checked; with ``payloads`` of responses."""
    importable(spark)
    files = read_manifest(spark, root).select("name", "records")
    ddl = (
        "file string, page_id bigint, target_uri string, record_id string, record_type string, refers_to bigint, "
        "payload_bytes bigint, payload_digest string" + ", payload binary" * payloads
    )
    return files.repartition(max(1, files.count())).mapInArrow(_reader(root, payloads), ddl)
