"""Fill-in-the-middle transformation of texts, and back.

A text is held as UTF-8 in blocks of ``BLOCK`` bytes.  A Fenwick tree over the blocks stores how
many units and how many code points begin in each; a cut "after u units" is found by a descent
over its powers of two to the block where unit u begins, and the boundary itself by a look at that
block alone.  Units are code points, words (with the white space that follows; leading white space
belongs to the first) or lines (with their line feed).

Edge cases: null text counts as empty; an empty text and one that holds a mark stay ``plain``, so
every output can be turned back.  A null id counts as empty text in the hash.  Very long texts are
one row of bytes and two arrays of flags; ties and repeated rows get equal results, as only the id
and the text decide.  An empty table gives no rows.  ``fill_in_middle`` reads the id and the text,
so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from touchline.llm.common import importable

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

BLOCK = 4096
UNITS = ("char", "word", "line")

_FIELDS = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_TYPE = pa.struct(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _point_starts(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    if unit == "char":
        return _point_starts(data)
    starts = np.zeros(len(data), dtype=bool)
    if unit == "line":
        starts[1:] = data[:-1] == 10
    else:
        white = (data == 32) | ((data >= 9) & (data <= 13))
        starts[1:] = white[:-1] & ~white[1:]
        if len(data) and white[0] and starts.any():
            starts[np.argmax(starts)] = False
    starts[:1] = True
    return starts


class Blocks:
    """A text in blocks, with the Fenwick tree of their counts."""

    def __init__(self, data: np.ndarray, unit: str = "char", block: int = BLOCK):
        self._block = block
        self._size = len(data)
        self._points = _point_starts(data)
        self._units = self._points if unit == "char" else _unit_starts(data, unit)
        firsts = np.arange(0, len(data), block)
        counts = np.zeros((len(firsts) + 1, 2), dtype=np.int64)
        if len(firsts):
            counts[1:, 0] = np.add.reduceat(self._units, firsts, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(self._points, firsts, dtype=np.int64)
        before = counts.cumsum(axis=0)
        node = np.arange(len(counts))
        # Node i covers the blocks after i without its lowest bit, up to i.
        self._tree = (before - before[node - (node & -node)]).tolist()
        self.units, self.points = map(int, before[-1])

    def cut(self, u: int) -> tuple[int, int]:
        """Byte offset of the end of the first ``u`` units, and the code points before it."""
        if u >= self.units:
            return self._size, self.points
        tree, at, units, points = self._tree, 0, 0, 0
        step = 1 << (len(tree) - 1).bit_length() >> 1
        while step:
            if at + step < len(tree) and units + tree[at + step][0] <= u:
                at += step
                units, points = units + tree[at][0], points + tree[at][1]
            step >>= 1
        first = at * self._block
        here = int(np.flatnonzero(self._units[first : first + self._block])[u - units])
        return first + here, points + int(np.count_nonzero(self._points[first : first + here]))


def transform(raw: bytes, hashes: tuple[int, int, int, int], unit: str, rate: int, spm: int, block: int = BLOCK) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text in UTF-8."""
    text = Blocks(np.frombuffer(raw, dtype=np.uint8), unit, block)
    h1, h2, h3, h4 = hashes
    if not raw or h3 % 100 >= rate or any(mark.encode() in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return text.units, "plain", None, None, raw
    first, second = sorted((h1 % (text.units + 1), h2 % (text.units + 1)))
    (a, before), (b, until) = text.cut(first), text.cut(second)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < spm:
        return text.units, "spm", before, until - before, b"".join((s, suffix, p, prefix, m, middle))
    return text.units, "psm", before, until - before, b"".join((p, prefix, s, suffix, m, middle))


def _as_text(values: list[bytes]) -> pa.Array:
    """The bytes as strings, without decoding them."""
    return pa.array(values, type=pa.binary()).view(pa.string())


def _transformer(unit: str, rate: int, spm: int, block: int):
    @arrow_udf(_FIELDS)
    def run(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        raws = text.cast(pa.binary()).to_pylist()
        hashes = zip(*(h.to_pylist() for h in (h1, h2, h3, h4)))
        rows = [transform(raw, h, unit, rate, spm, block) for raw, h in zip(raws, hashes)]
        n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
        columns = [pa.array(x, type=t.type) for x, t in zip((n, form, prefix, middle), _TYPE)]
        return pa.StructArray.from_arrays([*columns, _as_text(list(output))], fields=list(_TYPE))

    return run


def numbers(key: Column, seed: int) -> list[Column]:
    """The first four groups of 8 hex digits of the SHA-256 of ``seed:key``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, unit: str = "char", rate: int = 90, spm: int = 20, seed: int = 1, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every text.

    Of 100 texts about ``rate`` are cut in three, and of those about ``spm`` of 100 have the
    suffix first.  Which ones and where is decided by a hash of the id, so a run can be repeated.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    importable(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    made = _transformer(unit, rate, spm, block)(text, *numbers(F.col("doc_id"), seed))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made of; every mark stands in it exactly once."""

    def around(text: Column, mark: str) -> tuple[Column, Column]:
        return F.substring_index(text, mark, 1), F.substring_index(text, mark, -1)

    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    prefix, rest = around(body, SUFFIX)
    suffix, middle = around(rest, MIDDLE)
    suffix_first, rest = around(body, PREFIX)
    prefix_second, middle_last = around(rest, MIDDLE)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(output)
    )
