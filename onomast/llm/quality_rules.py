"""Quality rules as a cascade that stops at the first rule a document fails. Native columns only.

On a sample each rule is timed and its share of rejections counted; rules then run in falling order of rejections per
second. The order changes what the cascade costs, never its verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .common import WORD, word_count

# White space and symbols of the base counts.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def lines_of(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_of(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"))


def repeated_words(text: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    Windows are sorted by (hash, place); neighbours with one hash are repeats. Back in order of place, each repeated
    window adds the words up to the next one, three at most. Work grows as n log n with the words of a text.
    """

    def windows(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 3)
        return F.sort_array(
            F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
        )

    def repeats(found: Column) -> Column:
        same = lambda k: F.get(found, k)["h"]
        kept = F.filter(found, lambda w, k: F.coalesce((w["h"] == same(k - 1)) | F.lit(False), F.lit(False)) | F.coalesce(w["h"] == same(k + 1), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda w: w["i"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)

    count = let(words_of(text), lambda words: F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(let(windows(words), lambda f: let(repeats(f), covered))))
    return F.coalesce(count, F.lit(0).cast("bigint"))


def base_counts(docs: DataFrame, carried: list[str], text: str = "text") -> DataFrame:
    """The carried columns, the text and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null is an empty text."""
    plain = F.coalesce(F.col(text), F.lit(""))
    without = lambda c: (F.length(plain) - F.length(F.translate(plain, c, ""))).cast("bigint")
    return docs.select(
        *carried,
        F.col(text).alias("_text"),
        word_count(text).alias("n_words"),
        (F.length(plain).cast("bigint") - without(SPACES)).alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        duplicate_lines(plain).alias("n_dup_lines"),
        repeated_words(plain).alias("n_repeat_words"),
    )


def default_rules() -> dict[str, Column]:
    """Conditions under which a document fails, on the columns of ``base_counts`` and its text."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    shouted = F.length(text) - F.length(F.regexp_replace(text, "[A-ZÀ-ÖØ-Þ]", ""))
    return {
        "symbols": F.col("n_symbols") * 10 > F.col("n_words") * 3,
        "word_length": (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 16),
        "duplicate_lines": (F.col("n_dup_lines") >= 4) & (F.col("n_dup_lines") * 10 > F.size(lines_of(text)) * 3),
        "shouting": shouted * 2 > F.col("word_chars"),
        "letters": F.length(F.regexp_replace(text, r"[^\p{L}]", "")) * 2 < F.col("word_chars"),
    }


def some_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A sample of about ``rows`` rows."""
    total = docs.count()
    return docs.sample(min(1.0, rows / total), seed=1) if total else docs


def measure(sample: DataFrame, rules: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """(seconds, share of rejections) of each rule on a sample, which is written once."""
    sample = stage(sample, "rules")

    def seconds(column: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = sample.agg(F.avg(F.when(column, 1.0).otherwise(0.0))).first()[0] or 0.0
        return time.perf_counter() - start, share

    seconds(F.lit(False))
    empty = min(seconds(F.lit(False))[0] for _ in range(2))
    return {name: (max(found[0] - empty, 1e-4), found[1]) for name, rule in rules.items() for found in [seconds(rule)]}


def cascade(df: DataFrame, rules: dict[str, Column], sample: DataFrame, out: str = "failed_rule") -> DataFrame:
    """The table with the first rule that each row fails, null if none; a rule is worked out only where the earlier ones passed.

    ``sample`` has the columns of ``df`` for some rows, from which cost and selectivity are estimated. A null condition
    counts as passed. Without rows, rules keep their given order.
    """
    figures = measure(sample, rules)
    order = sorted(rules, key=lambda name: -figures[name][1] / figures[name][0])
    chain = F.lit(None).cast("string")
    for name in reversed(order):
        chain = F.when(rules[name], F.lit(name)).otherwise(chain)
    return df.withColumn(out, chain)
