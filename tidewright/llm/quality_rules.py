"""Quality rules as a short-circuit cascade of SQL expressions.

Each rule's cost and rejection share are measured on a bounded sample; rules then run in falling order of rejections per
second, and a text that one rule rejects is not put to the next. The order changes the cost only, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common as c

#: Rows read to estimate cost and selectivity.
SAMPLE_ROWS = 400
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and in whatever lambda the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def word_chars(word_list: Column) -> Column:
    return F.length(F.array_join(word_list, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, _SYMBOL, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(worded_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(word_list: Column, k: int = 8) -> Column:
    """Words inside a window of ``k`` words that occurs twice or more in the text, the first place included."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
        )

    def places(window: Column) -> Column:
        ordered = F.sort_array(F.transform(window, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda a: F.filter(
                a,
                lambda x, j: F.coalesce(F.get(a, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(a, j + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def width(place: Column) -> Column:
        steps = F.transform(place, lambda p, j: F.least(F.coalesce(F.get(place, j + 1) - p, F.lit(k)), F.lit(k)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(window: Column) -> Column:
        return F.when(F.size(F.array_distinct(window)) == F.size(window), 0).otherwise(let(places(window), width))

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    some = let(let(hashed, windows), count)
    return F.when(F.size(word_list) >= k, some).otherwise(0).cast("long")


def upper_share(text: Column) -> Column:
    """Capital letters among ASCII letters, 0 without any."""
    text = F.coalesce(text, F.lit(""))
    capital = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    small = F.length(text) - F.length(F.regexp_replace(text, "[a-z]+", ""))
    return F.when(capital + small > 0, capital / (capital + small)).otherwise(0.0)


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes a boolean column from the frame's measures; it is evaluated only where no earlier rule rejects."""

    name: str
    rejects: Callable[[], Column]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the columns of ``MEASURES`` (replacing any of those names); null text has no words."""
    docs = docs.drop(*MEASURES)
    listed = c.fresh(docs, "word_list")
    text = F.col(text_col)
    return (
        docs.withColumn(listed, words(text))
        .withColumns(
            {
                "n_words": F.size(listed).cast("long"),
                "word_chars": word_chars(F.col(listed)),
                "n_symbols": n_symbols(text),
                "n_dup_lines": n_dup_lines(text),
                "n_repeat_words": n_repeat_words(F.col(listed)),
            }
        )
        .drop(listed)
    )


def base_rules() -> list[Rule]:
    return [
        Rule("short", lambda: F.col("n_words") < 20),
        Rule("repeats", lambda: F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
    ]


def text_rules(text_col: str = "text") -> list[Rule]:
    """Rules of the cascade proper."""
    text = F.col(text_col)
    return [
        Rule("symbols", lambda: n_symbols(text) * 10 > F.size(words(text))),
        Rule("repeated lines", lambda: let(worded_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))) * 10 > F.size(x) * 3)),
        Rule("shouting", lambda: upper_share(text) > 0.5),
        Rule("word length", lambda: let(words(text), lambda w: (word_chars(w) < F.size(w) * 2) | (word_chars(w) > F.size(w) * 20))),
    ]


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


def estimate(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and rejection share of each rule on the first ``sample_rows`` rows, best rejection per second first."""
    rows = docs.select(F.col(text_col).cast("string").alias(text_col)).limit(sample_rows).collect()
    if not rows:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    sample = docs.sparkSession.createDataFrame(rows, f"`{text_col}` string").repartition(1)

    def timed(column: Column) -> tuple[float, int]:
        start = time.perf_counter()
        n = sample.agg(F.count_if(column)).first()[0]
        return time.perf_counter() - start, n

    timed(F.lit(True))
    idle, _ = timed(F.lit(True))
    found = []
    for rule in rules:
        seconds, n = timed(rule.rejects())
        found.append(Estimate(rule, max(seconds - idle, 1e-3), n / len(rows)))
    return sorted(found, key=lambda e: -e.rejected / e.seconds)


def first_rejection(rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects the row; null if none does. Later rules are not evaluated."""
    out = None
    for rule in rules:
        out = F.when(rule.rejects(), rule.name) if out is None else out.when(rule.rejects(), rule.name)
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents with their measures, ``base_failed``, ``rejected_by`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of words inside repeated 8-word windows. The other rules run, in the
    estimated order, only where the base holds; ``rejected_by`` names the first that rejects and so may vary with the
    order, ``kept`` may not. Null and empty texts fail the base; repeated rows are judged alike; an empty table gives an
    empty one; columns of the added names are replaced.
    """
    docs = docs.drop("base_failed", "rejected_by", "kept")
    order = [e.rule for e in estimate(docs, text_rules(text_col), text_col, sample_rows)]
    base = [r.rejects() for r in base_rules()]
    judged = measures(docs, text_col).withColumn("base_failed", base[0] | base[1])
    judged = judged.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(first_rejection(order)))
    return judged.withColumn("kept", F.col("rejected_by").isNull())
