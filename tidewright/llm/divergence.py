"""Audit of how far the sources of a language differ in their words, with exact arithmetic.

Divergences between two sources sum a term ``f`` over the whole vocabulary. Most counts are zero, so the sum is that of
all-zero counts, plus corrections for single nonzero counts, plus corrections for pairs of nonzero counts. The rows of
terms (nonzero counts in the order of sources) are inserted in a frequent-pattern tree with their multiplicities:
rows that begin alike share a path, and a pair's correction is worked out once per node and ancestor.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import common as c
from tidewright.llm.scratch import landed

#: Share of the whole that probabilities count in.
SCALE = 1_000_000_000
#: Counts that a task holds before it gives them out.
HELD = 300_000
#: Node and ancestor pairs worked on at once.
BLOCK = 1 << 20

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "lang string, source string, item string, value long"


def share(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)`` without leaving 64 bits: three digits at a time."""
    whole, rest = F.expr("0L"), count + 1
    parts = []
    for _ in range(4):
        parts.append((rest, total))
        rest = (rest % total) * 1000
    for rest, total in parts:
        whole = whole * 1000 + F.call_function("div", rest, total)
    return whole + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; both are at most ``SCALE + 1``, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term, added up as far as memory allows."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def give_out() -> pa.RecordBatch:
        lang, source, term, n, docs = [], [], [], [], []
        for (a, b), (occurs, in_docs) in found.items():
            lang += [a] * len(occurs)
            source += [b] * len(occurs)
            term += [t.decode("utf-8", "replace") for t in occurs]
            n += occurs.values()
            docs += [in_docs[t] for t in occurs]
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"],
        )

    for batch in c.slices(batches, "text"):
        for a, b, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), c.texts(batch.column("text")), strict=True):
            here = Counter(_TERM.findall(text.lower()))
            occurs, in_docs = found.setdefault((a, b), (Counter(), Counter()))
            held -= len(occurs)
            occurs.update(here)
            in_docs.update(here.keys())
            held += len(occurs)
            if held > HELD:
                yield give_out()
                held = 0
    if found:
        yield give_out()


class Tree:
    """Rows of (source, count) pairs in the order of sources, as paths that share what they begin with."""

    def __init__(self, source: np.ndarray, count: np.ndarray, length: np.ndarray, times: np.ndarray):
        """Flat items of all rows, how many each row has, and how often each row occurs. Rows are sorted."""
        start = np.cumsum(length) - length
        depth = c.ragged(np.zeros(len(length), np.int64), length)
        row = np.repeat(np.arange(len(length)), length)
        # An item opens a node unless the row before has the same items up to here.
        before = np.where(row > 0, start[row - 1] + depth, 0)
        same = (row > 0) & (depth < length[row - 1])
        same[same] = (source[before[same]] == source[same]) & (count[before[same]] == count[same])
        broken = np.cumsum(~same)
        self.new = ~same | (broken > np.append(0, broken)[start][row])
        self.source, self.count, self.depth = source, count, depth
        self.start = start[row]
        self.times = self._times(length, times, row)

    def _times(self, length: np.ndarray, times: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each node's path begins a row: its own row and those after it that share it."""
        order = np.lexsort((row, self.depth))
        node = np.cumsum(self.new[order])  # at one depth, rows without a new node continue the one before
        total = np.zeros(node[-1] + 1 if len(node) else 1, np.int64)
        np.add.at(total, node, times[row[order]])
        out = np.zeros(len(row), np.int64)
        out[order] = total[node]
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (flat index of a node, flat index of an ancestor, times): every combination once."""
        nodes = np.flatnonzero(self.new & (self.depth > 0))
        ends = np.cumsum(self.depth[nodes])
        begin = 0
        while begin < len(nodes):
            base = ends[begin] - self.depth[nodes[begin]]
            stop = max(begin + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
            at = nodes[begin:stop]
            ancestor = c.ragged(self.start[at], self.depth[at])
            node = np.repeat(at, self.depth[at])
            yield node, ancestor, self.times[node]
            begin = stop


def _pair_corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of pair corrections, in both directions, from a tree per language and batch of rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        items = batch.column("items")
        length = pa.compute.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = items.flatten()
        names = pa.compute.dictionary_encode(flat.field("source"))
        source = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count, p, zero = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("n", "p", "zero"))
        times = batch.column("times").to_numpy(zero_copy_only=False)
        langs = batch.column("lang").to_pylist()
        cuts = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
        edges = np.append(0, np.cumsum(length))
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = slice(edges[a], edges[b])
            tree = Tree(source[part], count[part], length[a:b], times[a:b])
            p_, zero_, source_ = p[part], zero[part], source[part]
            for node, up, n in tree.pairs():
                both = [(up, node), (node, up)]
                key = np.concatenate([source_[x] * len(names.dictionary) + source_[y] for x, y in both])
                value = np.concatenate(
                    [
                        n * (_gap(p_[x], p_[y]) - _gap(p_[x], zero_[y]) - _gap(zero_[x], p_[y]) + _gap(zero_[x], zero_[y]))
                        for x, y in both
                    ]
                )
                order = np.argsort(key, kind="stable")
                first, _ = c.runs(np.append(True, key[order][1:] != key[order][:-1]))
                key, value = key[order][first], np.add.reduceat(value[order], first)
                x, y = np.divmod(key, len(names.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([langs[a]] * len(key), pa.string()),
                        names.dictionary.take(pa.array(x)).cast(pa.string()),
                        names.dictionary.take(pa.array(y)).cast(pa.string()),
                        pa.array(value, pa.int64()),
                    ],
                    names=["lang", "source", "item", "value"],
                )
    c.release()


def term_counts(docs: DataFrame, min_docs: int = 3, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, total``: counts of the terms that at least ``min_docs`` documents of the language have.

    ``total`` is the term's count in the language. Null text, language and source read as empty.
    """
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"), F.col(text_col).alias("text")
    )
    added = rows.mapInArrow(_counts, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    every = added.select("*", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("total"))
    return every.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total")


def audit(
    docs: DataFrame,
    min_docs: int = 3,
    top_terms: int = 200,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from every other, and by which terms it stands out.

    Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII. A group is a language and source that
    occurs, with or without terms; its share of a term is ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, where ``V``
    terms are kept for the language and ``N`` is the sum of the group's counts.

    Part ``pair`` has, for each other source of the language, ``floor((p - q)^2 / q)`` summed over all kept terms, zero
    counts included. Part ``term`` has the terms a group has with more than the language's share ``q``, the first
    ``top_terms`` of them. Both are ranked by value, then by item.

    Null text, language and source read as empty. Repeated rows count as often as they occur, ties rank by item, other
    columns are left aside, an empty table gives an empty one, and a language without kept terms has pairs of value 0.
    """
    empty = F.lit("")
    kept = landed(term_counts(docs, min_docs, text_col, lang_col, source_col), "term-counts")
    # Each term's rows of a language share their total, so that one of its rows can stand for it.
    per_lang = (
        kept.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    )
    seen = docs.select(F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = seen.join(sums, ["lang", "source"], "left").join(per_lang, "lang", "left")
    size = F.coalesce(F.col("group_n"), F.lit(0)) + F.coalesce(F.col("v"), F.lit(0))
    groups = landed(
        groups.select("lang", "source", "v", F.col("lang_n"), size.alias("size"), F.when(F.col("v") > 0, share(F.lit(0).cast("long"), size)).alias("zero")),
        "groups",
    )
    rows = landed(
        kept.join(groups, ["lang", "source"]).select(
            *kept.columns, share(F.col("n"), F.col("size")).alias("p"), "zero", share(F.col("total"), F.col("lang_n") + F.col("v")).alias("q")
        ),
        "shares",
    )

    item = F.struct("source", "n", "p", "zero")
    paths = rows.groupBy("lang", "term").agg(F.array_sort(F.collect_list(item)).alias("items")).groupBy("lang", "items").agg(F.count("*").alias("times"))
    # Rows that begin alike meet in one task as neighbours; a common beginning that is hot is cut between tasks.
    paths = paths.where(F.size("items") > 1).repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    inner = paths.mapInArrow(_pair_corrections, _PAIRS)

    a, b = groups.alias("a"), groups.alias("b")
    other = [F.col("a.lang") == F.col("b.lang"), F.col("a.source") != F.col("b.source")]
    whole = F.coalesce(F.col("a.v") * gap(F.col("a.zero"), F.col("b.zero")), F.lit(0).cast("long"))
    base = a.join(b, other).select("a.lang", "a.source", F.col("b.source").alias("item"), whole.alias("value"))
    times = rows.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times")).alias("a")
    p, zero, theirs, n = F.col("a.p"), F.col("a.zero"), F.col("b.zero"), F.col("times")
    alone = times.join(b, other).select(
        F.col("a.lang").alias("lang"),
        F.inline(
            F.array(
                F.struct(F.col("a.source").alias("source"), F.col("b.source").alias("item"), (n * (gap(p, theirs) - gap(zero, theirs))).alias("value")),
                F.struct(F.col("b.source").alias("source"), F.col("a.source").alias("item"), (n * (gap(theirs, p) - gap(theirs, zero))).alias("value")),
            )
        ),
    )
    pairs = base.unionByName(alone).unionByName(inner).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    terms = rows.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).alias("rank")
    parts = [
        pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked),
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", ranked).where(F.col("rank") <= top_terms),
    ]
    return parts[0].unionByName(parts[1])
