"""BPE encoding and decoding by tree concatenation.

A text longer than ``LEAF`` is cut anywhere, words and white space regardless: its parts
are encoded apart, and each join is then mended by re-encoding a growing window around it
until the window's tokens agree with both sides.  Two token sequences that share a token
on the same span can be spliced there, because a BPE encoding is right exactly if every
two neighbours are.  Only combining marks are never parted from what they stand on, since
they are put in order with it before anything is encoded.

Parts of a text up to ``SPREAD`` are encoded and joined by the task that has it, so most
texts are not shuffled; those of longer texts are spread over Spark tasks as rows of
their own, and the joins of one document then run in one task, on token ids and offsets.

Short texts and parts of printable Latin-1 characters, where the two libraries' character
classes are the same and a character has one byte or two, are merged by ``tiktoken`` on the
ranks of the tokenizer's own file, which takes a fraction of the time; all other texts and
parts, and all windows, go through ``tokenizers``.

Defined results: null text is empty text; empty text has no tokens and decodes to
empty text; repeated rows and null ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import as_table

LEAF = 4096  # code points that are encoded in one go
SPREAD = 16 * LEAF  # code points of a text whose parts are not spread over tasks
GUARD = 32  # code points next to a window's edge whose tokens are not trusted

# The end-of-word mark of the vocabulary, and both vocabularies' split patterns.
WORD_END = "</w>"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xac\xae-\xff]*\Z")


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Pieces:
    """Token ids with the spans they cover, of one stretch of text."""

    def __init__(self, ids, starts, ends):
        self.ids, self.starts, self.ends = ids, starts, ends

    @classmethod
    def of(cls, tokenizer, text: str, at: int = 0) -> "Pieces":
        encoding = tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2) + at
        return cls(np.array(encoding.ids, dtype=np.int64), spans[:, 0], spans[:, 1])

    def cut(self, lo: int, hi: int) -> "Pieces":
        return Pieces(self.ids[lo:hi], self.starts[lo:hi], self.ends[lo:hi])

    def keys(self, lo: int, hi: int) -> dict[tuple[int, int, int], int]:
        """Index of each token inside [lo, hi] that shares no code point with another."""
        apart = np.ones(len(self.ids), dtype=bool)
        if len(self.ids) > 1:
            clear = self.ends[:-1] <= self.starts[1:]
            apart[:-1] &= clear
            apart[1:] &= clear
        inside = np.flatnonzero(apart & (self.starts >= lo) & (self.ends <= hi) & (self.ends > self.starts))
        return {(int(self.ids[i]), int(self.starts[i]), int(self.ends[i])): int(i) for i in inside}


def chain(parts: list[Pieces]) -> Pieces:
    return Pieces(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("ids", "starts", "ends")))


def join(tokenizer, text: str, left: Pieces, right: Pieces, lo: int, mid: int, hi: int) -> Pieces:
    """The encoding of ``text[lo:hi]`` from those of its two parts."""
    reach = 2 * GUARD
    while True:
        a, b = max(lo, mid - reach), min(hi, mid + reach)
        while a > lo and unicodedata.combining(text[a]):
            a -= 1
        while b < hi and unicodedata.combining(text[b]):
            b += 1
        window = Pieces.of(tokenizer, text[a:b], a)
        if a == lo and b == hi:
            return window
        # Tokens near an edge that is not the edge of the text may be cut short.
        mine = window.keys(a if a == lo else a + GUARD, b if b == hi else b - GUARD)
        theirs = left.keys(a, mid - 1)
        heads = [(i, theirs[k]) for k, i in mine.items() if k in theirs]
        theirs = right.keys(mid + 1, b)
        tails = [(i, theirs[k]) for k, i in mine.items() if k in theirs]
        first = (0, 0) if a == lo else min(heads, default=None)
        last = (len(window.ids), len(right.ids)) if b == hi else max(tails, default=None)
        if first is not None and last is not None and first[0] <= last[0]:
            return chain([left.cut(0, first[1]), window.cut(first[0], last[0]), right.cut(last[1], len(right.ids))])
        reach *= 2


def merge(tokenizer, text: str, leaves: list[Pieces], cuts: list[int]) -> Pieces:
    """Join neighbouring parts pairwise, level by level, up to the whole text."""
    while len(leaves) > 1:
        joined, edges = [], [cuts[0]]
        for i in range(0, len(leaves), 2):
            if i + 1 < len(leaves):
                joined.append(join(tokenizer, text, leaves[i], leaves[i + 1], cuts[i], cuts[i + 1], cuts[i + 2]))
                edges.append(cuts[i + 2])
            else:
                joined.append(leaves[i])
                edges.append(cuts[i + 1])
        leaves, cuts = joined, edges
    return leaves[0]


def part_pattern(leaf: int) -> str:
    """Matches the next part of a text, for Java's and Python's expressions alike."""
    return rf"(?s).{{1,{leaf}}}\p{{M}}*"


def encode_tree(tokenizer, text: str, leaf: int = LEAF, pieces=None) -> list[int]:
    """Token ids of one text, the parts of which are encoded apart, by ``pieces(part, at)`` if given."""
    import regex

    parts = regex.findall(part_pattern(leaf), text) or [""]
    cuts = [0, *accumulate(map(len, parts))]
    of = pieces or (lambda part, at: Pieces.of(tokenizer, part, at))
    leaves = [of(part, at) for part, at in zip(parts, cuts)]
    return merge(tokenizer, text, leaves, cuts).ids.tolist()


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary.

    Printable bytes stand for themselves; the others are numbered from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Codec:
    """Encoder of whole texts by the ranks of a ``tokenizers`` file; same ids as that library."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        self.tokenizer = load_tokenizer(path)
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        special = {t["content"] for t in stored["added_tokens"]}
        self.ends_words = stored["model"]["end_of_word_suffix"] == WORD_END
        letters, ranks = _byte_letters(), {}
        for token, rank in stored["model"]["vocab"].items():
            if token not in special:
                ended = self.ends_words and token.endswith(WORD_END)
                ranks[bytes(letters[c] for c in token.removesuffix(WORD_END if ended else "")) + b"\0" * ended] = rank
        # A word's end is a zero byte, which plain texts do not have.
        pattern = r"[^\x00]+\x00" if self.ends_words else BYTE_SPLIT
        self.ranked = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(WORD_SPLIT).findall
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token.rstrip(b"\0")) if self.ends_words else len(token)
        self.special = special
        self.decimals = [str(i) for i in range(self.tokenizer.get_vocab_size())]
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(len(self.decimals))]

    def encode(self, text: str) -> list[int]:
        if not _PLAIN.match(text) or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if self.ends_words:
            words = self.split(text.lower())
            text = "\0".join(words) + "\0" if words else ""
        return self.ranked.encode_ordinary(text)

    def pieces(self, part: str, at: int = 0) -> Pieces:
        """Token ids of a part with their places."""
        if not (self.ends_words and _PLAIN.match(part)) or any(s in part for s in self.special):
            return Pieces.of(self.tokenizer, part, at)
        part = part.lower()
        words = self.split(part)
        if not words:
            return Pieces(*(np.empty(0, dtype=np.int64) for _ in range(3)))
        ids = np.array(self.ranked.encode_ordinary("\0".join(words) + "\0"), dtype=np.int64)
        # Words leave out white space only, so their bytes stand where the other characters do.
        points = np.frombuffer(part.encode("latin-1"), dtype=np.uint8)
        places = np.flatnonzero((points != 32) & (points > 13))
        places = np.repeat(places, 1 + (points[places] > 127)) + at
        ends = np.cumsum(self.lengths[ids])
        return Pieces(ids, places[ends - self.lengths[ids]], places[ends - 1] + 1)

    def shown(self, ids: list[int]) -> str:
        """Ids as decimals joined by one space."""
        return " ".join([self.decimals[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """What the library decodes: it joins tokens by a space if the file names no decoder."""
        if self.ends_words:
            return " ".join([self.tokens[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _row(known: Codec, ids: list[int], full: bool) -> tuple:
    if full:
        return len(ids), ids, known.decode(ids)
    return len(ids), _sha(known.shown(ids)), _sha(known.decode(ids))


def _names(full: bool) -> list[str]:
    return ["n_tokens", "ids", "decoded"] if full else ["n_tokens", "ids_sha256", "decoded_sha256"]


def _in_task(path: str, full: bool, leaf: int):
    """Texts whose parts stay in the task that has them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = codec(path)
        for batch in batches:
            ids = [known.encode(t) if len(t) <= leaf else encode_tree(known.tokenizer, t, leaf, known.pieces) for t in batch["text"]]
            out = pd.DataFrame([_row(known, x, full) for x in ids], columns=_names(full), index=batch.index)
            yield pd.concat([batch[["doc_id"]], out], axis=1)

    return run


def _leaves(path: str):
    """The tokens of a part, with their places in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = codec(path)
        for batch in batches:
            found = [known.pieces(part) for part in batch["part"]]
            yield batch.assign(
                ids=[p.ids for p in found], starts=[p.starts for p in found], ends=[p.ends for p in found]
            )

    return run


def _joined(path: str, full: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known = codec(path)
        group = group.sort_values("nth")
        text = "".join(group["part"])
        cuts = [0, *accumulate(map(len, group["part"]))]
        spans = zip(group["ids"], group["starts"], group["ends"], cuts)
        leaves = [Pieces(np.asarray(i, dtype=np.int64), np.asarray(s, dtype=np.int64) + at, np.asarray(e, dtype=np.int64) + at) for i, s, e, at in spans]
        ids = merge(known.tokenizer, text, leaves, cuts).ids.tolist()
        row = (group["doc_id"].iloc[0], *_row(known, ids, full))
        return pd.DataFrame([row], columns=["doc_id", *_names(full)]).astype({"doc_id": "Int64"})

    return run


def encode_decode(docs: DataFrame, path: str, full: bool = True, leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """Encode ``text`` of every row and decode it again.

    Gives ``doc_id, n_tokens`` and the ids and the decoded text, or with
    ``full=False`` only the SHA-256 of each (ids as decimals joined by one space).
    """
    rest = "ids array<bigint>, decoded string" if full else "ids_sha256 string, decoded_sha256 string"
    schema = f"doc_id bigint, n_tokens bigint, {rest}"
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = source.where(F.length("text") <= spread).mapInPandas(_in_task(path, full, leaf), schema)
    far = as_table(source.where(F.length("text") > spread).withColumn("row", F.monotonically_increasing_id()), "bpe-long")
    parts = (
        far.select("row", "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(part_pattern(leaf)), F.lit(0))).alias("nth", "part"))
        .repartition(F.col("row"), F.col("nth"))
        .mapInPandas(
            _leaves(path),
            "row bigint, doc_id bigint, nth int, part string, ids array<int>, starts array<int>, ends array<int>",
        )
    )
    return near.unionByName(parts.groupBy("row").applyInPandas(_joined(path, full), schema))
