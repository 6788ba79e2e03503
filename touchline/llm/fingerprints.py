"""Document fingerprints by closed syncmers, in native expressions only.

A k-mer of consecutive units is chosen if its minimal inner s-mer (by hash) is its
first or its last one.  That depends on the k-mer alone, so equal passages choose equal
anchors wherever they stand, and an edit changes only the anchors that it touches.
The units of every fingerprint are ``pieces``: runs of up to ``PIECE`` letters and digits of
alphabetic scripts, and every other code point but white space alone.  Where a piece ends
depends on its run only, so white space cuts a text into parts whose pieces are those of the
text.  An anchor is the k-mer's hash with its place.

Anchors match if hash and place agree up to a shift of ``SHIFT`` units; the likeness of
two fingerprints is the share of matching anchors of both (Dice).  It follows from the two
fingerprints alone.

Defined results: null text is empty text; a text of under k units has one anchor, the hash
of all its units; a text without units (empty or white space only) has an empty fingerprint;
two of these are alike (1), such a text and another are not (0);
rows with equal ids follow each other in the order of their texts; a null id comes first;
the only row's next document is itself; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import words_of

K, S = 8, 2  # units of a k-mer and of an inner s-mer
SHIFT = 256  # units by which matching anchors may be apart, at least
PIECE = 4  # code points of a piece, at most
CHAR_LIMIT = 1024  # of ``units``
WORD_LIMIT = 32  # code points to a word, at most, on average

# White space, and letters and digits of alphabetic scripts (Latin to Greek Extended).
SPACE = r"\x20\x09-\x0D"
LETTER = r"0-9A-Za-z\u00C0-\u024F\u0370-\u1FFF"
PIECES = f"[{LETTER}]{{1,{PIECE}}}|[^{SPACE}{LETTER}]"

ANCHORS = "array<struct<hash:bigint,place:int>>"


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))


def by_words(text: Column) -> Column:
    """Whether a text's units are words."""
    return (F.length(text) >= CHAR_LIMIT) & (F.size(words_of(text)) * WORD_LIMIT >= F.length(text))


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def units(text: Column) -> Column:
    """Words of a long text, code points of a short one: for texts of one kind only."""
    return F.when(by_words(text), words_of(text)).otherwise(characters(text))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def hashed(units: Column) -> Column:
    return F.transform(units, lambda u: F.xxhash64(u))


def anchors(text: Column, k: int = K, s: int = S, cut=units) -> Column:
    """Anchors of a text, in order of place: array of (hash, place)."""
    return _let(hashed(cut(text)), lambda h: anchors_of(h, k, s))


def syncmers(hashes: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of k or more units with these hashes: array of (hash, place)."""
    last = k - s

    def chosen(inner: Column) -> Column:
        """Places whose s-mers have their minimum at an edge; ``inner`` has the s-mers' hashes."""

        def edge(i: Column) -> Column:
            inside = F.least(*(F.get(inner, i + j) for j in range(1, last)))
            return F.least(F.get(inner, i), F.get(inner, i + last)) <= inside

        return F.filter(F.sequence(F.lit(0), F.size(inner) - last - 1), edge)

    inner = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - s), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(s)))
    )
    kmer = lambda i: F.struct(F.xxhash64(F.slice(hashes, i + 1, F.lit(k))).alias("hash"), i.alias("place"))
    return F.transform(_let(inner, chosen), kmer)


def anchors_of(hashes: Column, k: int = K, s: int = S) -> Column:
    """Anchors of a text whose units have these hashes."""
    n = F.size(hashes)
    whole = F.array(F.struct(F.xxhash64(hashes).alias("hash"), F.lit(0).alias("place")))
    return F.when(n >= k, syncmers(hashes, k, s)).when(n > 0, whole).otherwise(F.array()).cast(ANCHORS)


def anchors_after(own: Column, hashes: Column, kept: Column, tail: Column, k: int = K, s: int = S) -> Column:
    """Anchors of a text made of the first ``kept`` units of another and of units ``tail``.

    ``own`` and ``hashes`` are the other's anchors and hashes.  Anchors that end within the
    kept units stay; only those that reach into the tail are chosen anew.
    """
    first = F.greatest(kept - (k - 1), F.lit(0))  # the least place whose k-mer reaches into the tail
    stay = F.when(F.size(hashes) >= k, F.filter(own, lambda a: a["place"] < first)).otherwise(F.array().cast(ANCHORS))
    anew = _let(
        F.concat(F.slice(hashes, first + 1, kept - first), tail),
        lambda h: F.when((F.size(h) < k) & (first > 0), F.array().cast(ANCHORS)).otherwise(
            F.transform(anchors_of(h, k, s), lambda a: F.struct(a["hash"].alias("hash"), (a["place"] + first).alias("place")))
        ),
    )
    return F.concat(stay, anew)


def printed(found: Column) -> Column:
    """``hash@place`` of each anchor, comma-joined."""
    return F.lower(F.array_join(F.transform(found, lambda a: F.concat(F.hex(a["hash"]), F.lit("@"), a["place"].cast("string"))), ","))


def cells(found: Column, shift: int = SHIFT) -> Column:
    """What likeness compares of a fingerprint: its anchors by cells of ``shift`` units.

    ``own`` has each anchor's hash with its cell, ``near`` also with the cells next to it.
    """
    cell = lambda a, d: F.xxhash64(a["hash"], F.shiftright(a["place"], shift.bit_length() - 1) + d)
    near = F.flatten(F.transform(found, lambda a: F.array(*(cell(a, d) for d in (-1, 0, 1)))))
    return F.struct(F.array_distinct(F.transform(found, lambda a: cell(a, 0))).alias("own"), near.alias("near"))


def likeness(a: Column, b: Column) -> Column:
    """Share of anchors that match in hash and, up to a shift, in place; of two ``cells``."""
    met = F.size(F.array_intersect(a["own"], b["near"])) + F.size(F.array_intersect(b["own"], a["near"]))
    total = F.size(a["own"]) + F.size(b["own"])
    return F.when(total == 0, F.lit(1.0)).otherwise(met / total)


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows in buckets of consecutive ids, each with a copy (``guard``) of the row that follows its last.

    The bounds of buckets are quantiles of all ids.  The row after the last is the first.
    """
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    shares = [i / many for i in range(1, many)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 100 * many).alias("b")).first()["b"] or []
    cuts = sorted({b for b in bounds if b is not None})
    limits = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    # Null ids are below every bound; ties stay in one bucket, as its bound is one id.
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.array_size(F.filter(limits, lambda b: b < F.col("doc_id")))
    )
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")
    rows = docs.withColumns({"bucket": bucket, "tie": F.xxhash64("text"), "guard": F.lit(False)})
    firsts = rows.groupBy("bucket").agg(F.min(order).alias("least"))
    # One row per bucket, so a bounded number; only here all buckets meet.
    heads = [r["bucket"] for r in firsts.select("bucket").orderBy("bucket").collect()]
    before = {b: heads[i - 1] for i, b in enumerate(heads)}
    if not before:
        return rows
    moved = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    guards = (
        rows.join(F.broadcast(firsts), "bucket")
        .where(order.eqNullSafe(F.col("least")))
        .groupBy("bucket")
        .agg(F.first(F.struct(*docs.columns, "tie")).alias("r"))
        .select("r.*", moved[F.col("bucket")].alias("bucket"), F.lit(True).alias("guard"))
    )
    return rows.unionByName(guards)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has its last quarter replaced by as much of the next document's start.
    Each document's anchors are chosen once, on its own row; the next row's come from there,
    as both windows have one order.  Of the edited text only the anchors behind the last
    white space before the cut are chosen anew.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("bucket").orderBy("guard", F.col("doc_id").asc_nulls_first(), "tie")
    place = ["bucket", "guard", "doc_id", "tie"]
    text, quarter = F.col("text"), F.floor(F.length("text") / 4).cast("int")
    left = F.substring(text, F.lit(1), F.length(text) - quarter)
    # Pieces never span white space, so those before the last of it are the same in both texts.
    safe = F.length(F.regexp_extract(left, f"(?s)^.*[{SPACE}]", 0))
    edits = (
        _in_order(source)
        # Only texts are shuffled: anchors take more room than the text.
        .withColumn("start", F.substring(F.lead("text").over(w), F.lit(1), quarter))
        .select(*place, "text", left.alias("left"), "start", safe.alias("safe"), hashed(pieces(text)).alias("hashes"))
        .select(
            *place,
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2(F.concat("left", F.coalesce("start", F.lit(""))).cast("binary"), 256).alias("edited_sha256"),
            "hashes",
            anchors_of(F.col("hashes")).alias("own"),
            (F.size("hashes") - F.size(pieces(F.expr("substring(text, safe + 1)")))).alias("kept"),
            hashed(pieces(F.concat(F.expr("substring(left, safe + 1)"), F.coalesce("start", F.lit(""))))).alias("tail"),
        )
        .select(
            *place,
            "n_chars",
            "edited_sha256",
            "own",
            anchors_after(*map(F.col, ("own", "hashes", "kept", "tail"))).alias("other"),
        )
        .select(*place, "n_chars", "edited_sha256", "own", "other", cells(F.col("own")).alias("mine"))
        .withColumn("next", F.lead("mine").over(w))
        .where(~F.col("guard"))
    )
    return edits.withColumn("edited", cells(F.col("other"))).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("mine"), F.col("edited")).alias("near_edited"),
        likeness(F.col("mine"), F.col("next")).alias("near_next"),
    )
