"""Secret scans with linking of credential parts, in native expressions only.

Strong patterns are reported wherever they stand.  Weak candidates - a bare secret-like
string, an account name, an endpoint - are harmless alone, so each is reported only if
the parts that complete it to a credential stand within ``SCOPE`` code points.  A URL with
user and password is complete by itself and reported wherever it stands.  One stretch of
text is never two parts: weak kinds are matched by one expression, so a link or a setting
swallows the strings inside it, and a weak candidate that overlaps a strong match is no part
(but for the endpoint of a URL with a password).  A bare string must look random: mixed
kinds of characters, few slashes, entropy.  It never begins inside a URL or a path.  Linking is
an interval join on places: per document and stretch of ``SCOPE``, the first and the last
part of each role are all that can be nearest, so parts are reduced to those before the
join, and no pair of parts is ever built.

A pattern's places come from two native functions: what it matches, and what lies
between the matches; running sums of their lengths, taken in blocks, give all places.

Defined results: null text is empty text without spans; repeated rows are scanned each on
its own; null ids give a row; columns other than ``text`` pass through ``redact`` as they are;
a text may have any number of matches.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import text_keys

SCOPE = 400  # code points within which parts belong together

# The base patterns, and how many characters make a match count.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # runs of 32 or more; shorter runs never count
MIN_VALUE, MIN_ACCESS = 8, 16

# Weak candidates: account names, long mixed strings, and places to connect to.
ACCOUNT = r"(?:[uU][sS][eE][rR](?:[nN][aA][mM][eE])?|[lL][oO][gG][iI][nN]|[cC][lL][iI][eE][nN][tT]_?[iI][dD])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
OPAQUE = r"(?<![A-Za-z0-9+/_.~%@-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{24,}={0,2}(?![A-Za-z0-9+/=_-])"
_HOST = r"[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?"
ENDPOINT = r"[a-z][a-z0-9+]{1,12}://(?:[^\x00-\x20/@\"'<>]+@)?" + _HOST
# A URL with a password, which is strong but no base pattern.
LOGIN = r"[a-z][a-z0-9+]{1,12}://[^\x00-\x20/@:\"'<>]*:[^\x00-\x20/@\"'<>]+@" + _HOST
# What else belongs to a URL after the place to connect to: no candidate begins there.
_URL_REST = r"[^\x00-\x20\"'<>]*"

CHANGES = r"(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]"  # another kind of character follows
PER_CHANGE, PER_SLASH = 4, 12  # a random string has a change in as few characters, a slash in no fewer
ENTROPY = 3.5  # bits a character, at least
BLOCK = 64  # sums that are added up in one array

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "account", "opaque", "endpoint", "login")
#: What a kind is part of a credential as.
ROLE = {"access": "identifier", "account": "identifier", "assign": "secret", "hex": "secret", "opaque": "secret", "endpoint": "endpoint", "login": "secret"}
#: A weak kind needs one of these roles nearby.
NEEDS = {"account": ("secret",), "opaque": ("identifier", "endpoint"), "endpoint": ("secret",)}


_SPANS = "array<struct<start:int,rank:int,end:int>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sums(values: Column) -> Column:
    """0 and the running sums of an array; copies the array for each element."""
    start = F.array(F.lit(0)).cast("array<int>")
    return F.aggregate(values, start, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def running_sums(values: Column) -> Column:
    """Running sums of an array: within blocks, then of the blocks, so long arrays stay cheap."""
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: _sums(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))

    def added(inner: Column) -> Column:
        bases = _sums(F.transform(inner, lambda x: F.element_at(x, -1)))
        within = lambda x, base: F.transform(F.slice(x, F.lit(2), F.lit(BLOCK)), lambda y: y + base)
        return F.flatten(F.zip_with(inner, F.slice(bases, F.lit(1), F.size(inner)), within))

    return _let(blocks, added)


def _places(text: Column, pattern: str, span) -> Column:
    """``span(start, hit)`` of every match of a pattern."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def of(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        ends = running_sums(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)))
        return F.zip_with(ends, hits, lambda end, hit: span(end - F.length(hit), hit))

    none = F.array().cast(_SPANS)
    return F.when(text.rlike(pattern), F.filter(_let(hits, of), lambda s: s.isNotNull())).otherwise(none)


def _span(start: Column, kind: str, length: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + length).alias("end"))


def _spans(text: Column, kind: str, pattern: str, counts) -> Column:
    """Spans of a pattern; ``counts`` says of a match whether it counts."""
    return _places(text, pattern, lambda start, hit: F.when(counts(hit), _span(start, kind, F.length(hit))))


def strong_spans(text: Column) -> Column:
    return F.concat(
        _spans(text, "assign", ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= MIN_VALUE),
        _spans(text, "access", ACCESS, lambda hit: F.length(hit) >= MIN_ACCESS),
        _spans(text, "hex", HEX, lambda hit: F.lit(True)),
        _spans(text, "login", LOGIN, lambda hit: F.lit(True)),
    )


def entropy(text: Column) -> Column:
    """Bits a character of a string of letters, digits, ``+``, ``/`` and ``=``."""
    n = F.length(text)
    signs = F.array(*(F.lit(c) for c in string.ascii_letters + string.digits + "+/="))

    def bits(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return F.when(share > 0, -share * F.log2(share)).otherwise(F.lit(0.0))

    return F.aggregate(signs, F.lit(0.0), lambda total, c: total + bits(c))


def looks_random(text: Column) -> Column:
    n = F.length(text)
    mixed = F.regexp_count(text, F.lit(CHANGES)) * PER_CHANGE >= n
    return mixed & (F.regexp_count(text, F.lit("/")) * PER_SLASH <= n) & (entropy(text) >= ENTROPY)


def weak_spans(text: Column) -> Column:
    """Weak candidates, the leftmost first, none inside another."""
    pattern = f"{ENDPOINT}{_URL_REST}|{ACCOUNT}|{OPAQUE}"

    def span(start: Column, hit: Column) -> Column:
        place = F.regexp_extract(hit, "^" + ENDPOINT, 0)
        return (
            F.when(place != "", _span(start, "endpoint", F.length(place)))
            .when(hit.rlike("^" + ACCOUNT), _span(start, "account", F.length(hit)))
            .when(looks_random(hit), _span(start, "opaque", F.length(hit)))
        )

    return _places(text, pattern, span)


def _apart(parts: DataFrame) -> DataFrame:
    """Parts without the weak ones that overlap a strong one."""
    rank = KINDS.index
    strong = ~F.col("rank").isin(rank("account"), rank("opaque"), rank("endpoint"))
    plain = strong & (F.col("rank") != rank("login"))
    before = Window.partitionBy("h1", "h2").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("h1", "h2").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)

    def overlaps(of: Column) -> Column:
        earlier = F.coalesce(F.max(F.when(of, F.col("end"))).over(before), F.lit(0)) > F.col("start")
        later = F.min(F.when(of, F.col("start"))).over(after) < F.col("end")
        return earlier | F.coalesce(later, F.lit(False))

    hit = F.when(F.col("rank") == rank("endpoint"), overlaps(plain)).otherwise(overlaps(strong))
    return parts.withColumn("inside", hit).where(strong | ~F.col("inside")).drop("inside")


def _role(rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(ROLE[k]) for k in KINDS)), rank + 1)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``h1, h2`` and the weak spans that complementary parts complete.

    ``found`` has one row per distinct text with arrays ``strong`` and ``weak``.
    """
    parts = _apart(found.select("h1", "h2", F.inline(F.concat("strong", "weak"))))
    parts = parts.withColumns({"role": _role(F.col("rank")), "cell": F.floor(F.col("start") / scope)})
    nearest = parts.groupBy("h1", "h2", "role", "cell").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    # Parts of a stretch can complete candidates of this stretch and of its neighbours.
    reach = nearest.select(
        "h1", "h2", "role", "first", "last", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell")
    )
    wants = F.create_map(*(x for k, roles in NEEDS.items() for x in (F.lit(KINDS.index(k)), F.array(*map(F.lit, roles)))))
    weak = parts.where(F.col("rank").isin([KINDS.index(k) for k in NEEDS])).withColumn("role", F.explode(wants[F.col("rank")]))
    near = (F.abs(F.col("first") - F.col("start")) <= scope) | (F.abs(F.col("last") - F.col("start")) <= scope)
    # Within the candidate's own stretch every part is near enough, whichever is first or last.
    hits = weak.join(reach, ["h1", "h2", "role", "cell"]).where(near)
    span = F.struct("start", "rank", "end")
    return hits.groupBy("h1", "h2").agg(F.collect_set(span).alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Every row with ``spans``: sorted (start, rank of the kind, end) in code points."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), "text", *text_keys())
    found = keyed.select("row", "h1", "h2", strong_spans(text).alias("strong"))
    # Only texts with a weak candidate and another part can have a link; equal texts count once.
    candidates = (
        keyed.select("h1", "h2", strong_spans(text).alias("strong"), weak_spans(text).alias("weak"))
        .where((F.size("weak") > 0) & (F.size("strong") + F.size("weak") > 1))
        .dropDuplicates(["h1", "h2"])
    )
    links = linked(candidates, scope)
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    spans = F.array_sort(F.concat("strong", F.coalesce("linked", none)))
    result = found.join(links, ["h1", "h2"], "left").select("row", spans.alias("spans"))
    return result.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "spans"), "spans")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; every found span in ``text`` is replaced by ``mark``."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    found = scan(packed, scope)
    # Overlapping spans become one: keep the running end, and cut what is covered.
    text = F.col("text")
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        done = F.when(fresh, F.concat(state["done"], gap, F.lit(mark))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.greatest(state["at"], s["end"]).alias("at"))

    clean = F.aggregate(
        "spans", start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    replaced = F.when(F.size("spans") > 0, clean).otherwise(text)
    return found.select(*((replaced if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
