"""Quality rules as a short-circuit cascade, in native expressions only.

Each rule rejects a document or lets it pass to the next one.  On a bounded sample
the cost of a rule (wall time of evaluating it alone) and its selectivity (the share
it rejects) are estimated, and the rules are ordered by rejections per cost, so most
bad documents are rejected by cheap rules and dear ones run on few.  The order can
not change a verdict, because a document is kept only if no rule rejects it.

Defined results: null or empty text has no words and is rejected by the base rule;
null ids and repeated rows give a row each; clashing columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import words_of

SAMPLE_ROWS = 500  # rows on which costs and selectivities are estimated

# Thresholds of the base rule and the symbols it counts.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words, within one text only.  Equal
    ones come next to each other when (window, place) pairs are sorted; the sort is
    skipped where no window occurs twice.
    """
    n = F.size(words)
    threes = F.slice(F.arrays_zip(words, F.slice(words, 2, n), F.slice(words, 3, n)), F.lit(1), F.greatest(n - 2, F.lit(0)))
    hashes = F.transform(threes, lambda w: F.xxhash64(w))

    def covered(windows: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(windows) - 1)
        ordered = F.sort_array(F.arrays_zip(windows.alias("w"), places.alias("i")))

        def same(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            hit = F.filter(
                ordered,
                lambda x, k: ((k > 0) & (F.get(ordered, k - 1)["w"] == x["w"]))
                | ((k < last) & (F.get(ordered, k + 1)["w"] == x["w"])),
            )
            return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return _let(ordered, same)

    return _let(hashes, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the text's length."""
    text = F.coalesce("text", F.lit(""))
    source = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("words"))
    return source.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        _dup_lines(F.col("text")).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("bigint").alias("n_upper"),
        F.regexp_count("text", F.lit("!")).cast("bigint").alias("n_bangs"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
    )


# Each rule names the measures it needs and says when it rejects, in whole numbers.
RULES: dict[str, str] = {
    "mean word of under 2 or over 20 characters": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "a symbol for every five words": "5 * n_symbols > n_words",
    "a third of the lines repeated": "3 * n_dup_lines > n_lines",
    "half of the characters upper case": "2 * n_upper > word_chars",
    "an exclamation mark for every three words": "3 * n_bangs > n_words",
}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_PERCENT) * F.col("n_words")
    )


def order_rules(docs: DataFrame, rules: dict[str, str] = RULES, rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by estimated rejections per cost, the best first.

    Only the measures a rule names are computed when it is timed, because the
    others are pruned from the plan.
    """
    sample = docs.select("doc_id", "text").limit(rows)
    worth = {}
    for name, rejects in rules.items():
        start = time.perf_counter()
        found = measure(sample).agg(F.count_if(F.expr(rejects)).alias("n"), F.count(F.lit(1)).alias("of")).first()
        cost = time.perf_counter() - start
        worth[name] = found["n"] / max(1, found["of"]) / cost
    return sorted(rules, key=lambda name: (-worth[name], name))


def cascade(measured: DataFrame, order: list[str], rules: dict[str, str] = RULES) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``rejected_by``, the first rule in ``order`` that rejects."""
    first = reduce(
        lambda rest, name: F.when(F.expr(rules[name]), F.lit(name)).otherwise(rest), reversed(order), F.lit(None).cast("string")
    )
    return measured.withColumns({"base_failed": base_failed()}).withColumns(
        {"rejected_by": F.when(F.col("base_failed"), F.lit("base")).otherwise(first)}
    ).withColumns({"kept": F.col("rejected_by").isNull()})


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document."""
    return cascade(measure(docs), order_rules(docs))
