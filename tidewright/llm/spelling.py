"""Groups spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary acceptor reads a word and ends in a final state if it is one. Composed with a transducer that makes one
edit, and with the acceptor again, it accepts exactly the pairs of words one edit apart. The composition is taken apart
by initial states: all words that begin and end alike, with the edit in between, start from one state of their own.
Every pair has its first difference in exactly one such part, and parts are made smaller until none is large.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common as c
from tidewright.llm.scratch import landed

#: Words that start from one initial state; larger parts are halved by the place of the edit.
PART = 10_000
#: Distinct words that a task counts before it gives them out.
HELD = 300_000
#: Words, and entries of the composition, that are worked on at once.
WORDS = 100_000
BLOCK = 1 << 19

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_PART = ("short", "begin", "end", "head", "tail")
_FOUND = "word string, n_near long, form_n long, form string"


def _counter(min_length: int, drop_one_in: int):
    """Occurrences of words, added up per task as far as memory allows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def give_out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return made

        for batch in c.slices(batches, "text"):
            for i, text in zip(batch.column("id").to_pylist(), c.texts(batch.column("text")), strict=True):
                seed = zlib.crc32(f"{i}:".encode())
                for word, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                    if len(word) < min_length:
                        continue
                    if drop_one_in and (h := zlib.crc32(word.encode(), seed)) % drop_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    found[word] += n
                if len(found) > HELD:
                    yield give_out()
        yield give_out()

    return run


def count_words(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, drop_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n``: runs of Latin letters (A-Z lower-cased) of a least length that occur often enough.

    ``drop_one_in`` plants typing errors: where it divides the crc32 of ``<id>:<run>``, that run loses a letter in that
    document. Null texts have no words; a null id reads as empty.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(_counter(min_length, drop_one_in), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


class Acceptor:
    """Minimised acceptor of sorted words under several initial states, each word numbered by its place.

    A trie is laid out level by level; each of its nodes covers the words ``first .. first + count``. Nodes with equal
    right languages become one state, found bottom up from signatures of 64 bits and then compared edge by edge.
    """

    def __init__(self, root: np.ndarray, words: list[str]):
        """Words in order under ascending ``root`` numbers."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.cumsum(length) - length
        first, count = c.runs(np.append(True, root[1:] != root[:-1]))
        self.roots = len(first)
        levels = [(first, count, np.full(len(first), -1), np.zeros(len(first), np.int64))]
        node = np.repeat(np.arange(len(first)), count)
        alive, made, depth = np.arange(len(words)), len(first), 0
        while True:
            more = length[alive] > depth
            alive, node = alive[more], node[more]
            if not len(alive):
                break
            symbol = code[at[alive] + depth]
            opens, n = c.runs(np.append(True, (node[1:] != node[:-1]) | (symbol[1:] != symbol[:-1])))
            levels.append((alive[opens], n, node[opens], symbol[opens]))
            node = np.repeat(made + np.arange(len(opens)), n)
            made += len(opens)
            depth += 1
        self.first, self.count, parent, symbol = (np.concatenate(x) for x in zip(*levels, strict=True))
        self.depth = np.repeat(np.arange(len(levels)), [len(x[0]) for x in levels])
        # A word that ends in a node is the first one the node covers.
        self.final = length[self.first] == self.depth
        children = np.bincount(parent[self.roots :], minlength=made)
        begin = self.roots + np.cumsum(children) - children  # children follow one another
        self._minimise(parent, symbol, begin, children)

    def _minimise(self, parent: np.ndarray, symbol: np.ndarray, begin: np.ndarray, children: np.ndarray) -> None:
        seed = np.uint64(0x9E3779B97F4A7C15)
        while True:
            sign = c.mixed(self.final.astype(np.uint64) + seed)
            edge = c.mixed(symbol.astype(np.uint64) * seed)
            bounds = np.flatnonzero(np.append(True, self.depth[1:] != self.depth[:-1]))
            for a, b in reversed(list(zip(bounds, np.append(bounds[1:], len(sign)), strict=True))[1:]):
                sign[a:b] = c.mixed(sign[a:b])
                np.add.at(sign, parent[a:b], c.mixed(sign[a:b] ^ edge[a:b]))
            sign[: self.roots] = c.mixed(sign[: self.roots])
            _, keep, state = np.unique(sign, return_index=True, return_inverse=True)
            # States as they are in one of their nodes, and whether all other nodes agree.
            like = keep[state]
            agree = (children == children[like]) & (self.final == self.final[like])
            if agree.all():
                own, theirs = c.ragged(begin, children), c.ragged(begin[like], children)
                if (symbol[own] == symbol[theirs]).all() and (state[own] == state[theirs]).all():
                    break
            seed = c.mixed(np.array([seed]))[0]  # two languages met in one signature
        self.state = state
        self.nodes = np.argsort(state, kind="stable")
        self.node_start = np.searchsorted(state[self.nodes], np.arange(len(keep) + 1))
        self.accepts, self.words_from = self.final[keep], self.count[keep]
        self.edges = children[keep]
        self.edge_start = np.cumsum(self.edges) - self.edges
        to = c.ragged(begin[keep], self.edges)
        self.edge_symbol, self.edge_state = symbol[to], state[to]
        self.edge_place = self.first[to] - np.repeat(self.first[keep], self.edges)  # of its first word among the state's
        self.alphabet = int(symbol.max()) + 1 if len(symbol) else 1
        self.edge_key = np.repeat(np.arange(len(keep)), self.edges) * self.alphabet + self.edge_symbol

    def _step(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Common symbols of two states: index of the pair, and the edges of each."""
        e = c.ragged(self.edge_start[p], self.edges[p])
        i = np.repeat(np.arange(len(p)), self.edges[p])
        key = q[i] * self.alphabet + self.edge_symbol[e]
        at = np.minimum(np.searchsorted(self.edge_key, key), max(len(self.edge_key) - 1, 0))
        both = self.edge_key[at] == key if len(self.edge_key) else np.zeros(0, bool)
        return i[both], e[both], at[both]

    def _common(self, origin, p, q, x, y, ban) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words accepted from both ``p`` and ``q``, as places ``x`` and ``y`` among the words of ``origin``.

        Words that begin with the symbol ``ban`` are left out.
        """
        while len(p):
            same = (p == q) & (ban < 0)
            n = self.words_from[p[same]]
            yield np.repeat(origin[same], n), c.ragged(x[same], n), c.ragged(y[same], n)
            origin, p, q, x, y, ban = (v[~same] for v in (origin, p, q, x, y, ban))
            end = self.accepts[p] & self.accepts[q]
            yield origin[end], x[end], y[end]
            i, e, f = self._step(p, q)
            keep = self.edge_symbol[e] != ban[i]
            i, e, f = i[keep], e[keep], f[keep]
            origin, x, y = origin[i], x[i] + self.edge_place[e], y[i] + self.edge_place[f]
            p, q, ban = self.edge_state[e], self.edge_state[f], np.full(len(i), -1)

    def _edits(self, states: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """The composition right after the edit, for edits in each of the states: replaced and left-out symbols."""
        n = self.edges[states]
        e = c.ragged(self.edge_start[states], n)
        origin = np.repeat(states, n)
        none = np.full(len(e), -1)
        later = np.repeat(self.edge_start[states] + n, n) - e - 1  # edges of the state after this one
        a, b = np.repeat(e, later), c.ragged(e + 1, later)
        yield np.repeat(origin, later), self.edge_state[a], self.edge_state[b], self.edge_place[a], self.edge_place[b], np.repeat(none, later)
        yield origin, self.edge_state[e], origin, self.edge_place[e], np.zeros(len(e), np.int64), self.edge_symbol[e]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (place, place, symbols before the first difference) for words one edit apart under one root."""
        several = np.flatnonzero(self.words_from > 1)
        cost = np.cumsum(self.edges[several] ** 2 + 1)
        part = cost // BLOCK
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(several)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for start in self._edits(several[a:b]):
                for origin, x, y in self._common(*start):
                    n = np.diff(self.node_start)[origin]
                    node = self.nodes[c.ragged(self.node_start[origin], n)]
                    yield self.first[node] + np.repeat(x, n), self.first[node] + np.repeat(y, n), self.depth[node]


def _near_in(rows: pa.Table) -> pa.RecordBatch:
    """Near words of whole parts, whose rows follow one another."""
    words = rows.column("word").to_pylist()
    n, short, begin, end = (rows.column(x).to_numpy().astype(np.int64) for x in ("n", "short", "begin", "end"))
    length = np.fromiter(map(len, words), np.int64, len(words))
    trail = np.maximum(short - end, 0)
    opens = _opens(words, short, begin, end)
    alone = opens & np.append(opens[1:], True)
    middle = [w[a : k - t] for w, a, k, t in zip(words, begin.tolist(), length.tolist(), trail.tolist(), strict=True)]
    root = np.cumsum(opens).tolist()
    order = sorted(np.flatnonzero(~alone).tolist(), key=lambda i: (root[i], middle[i]))
    words, middle, root = ([x[i] for i in order] for x in (words, middle, root))
    n, short, begin, end, length = (x[order] for x in (n, short, begin, end, length))

    # Best first: most occurrences, then code points, as UTF-8 and str both order them.
    place = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    preference = np.empty(len(words), np.int64)
    preference[place] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for x, y, lead in Acceptor(np.array(root, np.int64), middle).pairs() if words else ():
        a, b = np.minimum(length[x], length[y]), np.maximum(length[x], length[y])
        own = (a == short[x]) & (b <= a + 1) & (begin[x] + lead < end[x])
        x, y = x[own], y[own]
        for u, v in ((x, y), (y, x)):
            near += np.bincount(u, minlength=len(words))
            np.minimum.at(best, u, preference[v])
    found = np.flatnonzero(near)
    form = place[best[found]]
    take = lambda at: pa.array([words[i] for i in at.tolist()], pa.string())
    return pa.RecordBatch.from_arrays(
        [take(found), pa.array(near[found], pa.int64()), pa.array(n[form], pa.int64()), take(form)], names=["word", "n_near", "form_n", "form"]
    )


def _opens(words: list[str], short: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where the part is another than that of the row before."""
    keys = list(zip(short.tolist(), begin.tolist(), end.tolist(), strict=True))
    keys = [(m, a, b, w[:a], w[len(w) - m + b :] if b < m else "") for w, (m, a, b) in zip(words, keys, strict=True)]
    return np.array([True, *(x != y for x, y in zip(keys, keys[1:], strict=False))], bool)


def _near_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts sorted rows between parts and passes some parts at a time on."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= WORDS:
            both = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch])
            keys = (both.column(x).to_numpy() for x in ("short", "begin", "end"))
            cut = np.flatnonzero(_opens(both.column("word").to_pylist(), *keys)[1:])
            if len(cut):
                held.append(batch.slice(0, cut[0]))
                yield _near_in(pa.Table.from_batches(held))
                held, size, batch = [], 0, batch.slice(cut[0])
        held.append(batch)
        size += batch.num_rows
    if size:
        yield _near_in(pa.Table.from_batches(held))
    c.release()


def _parts(words: DataFrame, cut: Column) -> DataFrame:
    """Rows of parts: pairs whose shorter word has ``short`` symbols and whose first difference is at ``begin .. end - 1``."""
    rows = words.select("word", "n", "short", F.explode(cut).alias("cut")).where("cut.begin < cut.end").select("word", "n", "short", "cut.*")
    return rows.select(
        "*", F.substr("word", F.lit(1), F.col("begin")).alias("head"), F.expr("right(word, greatest(short - end, 0))").alias("tail")
    )


def _halves(begin: Column, mid: Column, end: Column) -> Column:
    return F.array(F.struct(begin.alias("begin"), mid.alias("end")), F.struct(mid.alias("begin"), end.alias("end")))


def near_words(words: DataFrame, min_length: int = 1) -> DataFrame:
    """``word, n_near, form_n, form`` for words with a near one: how many there are, and the one of largest ``n``.

    ``words`` has distinct ``word`` of at least ``min_length`` code points, and its ``n``. Near words differ by one
    inserted, deleted or replaced code point; of equal ``n`` the smallest in code-point order counts. Null words are left
    out.
    """
    words = words.select("word", "n").where("word is not null")
    size = F.length("word")
    # A word meets those of its length and one longer, and as the longer one those one shorter.
    shorts = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).where(F.col("short") >= min_length)
    rows = landed(_parts(shorts, _halves(F.lit(0), F.expr("short div 2").cast("int"), F.col("short") + 1)), "spelling-parts")
    while True:
        sizes = rows.groupBy(*_PART).agg(F.count("*").alias("size"))
        large = landed(sizes.where((F.col("size") > PART) & (F.col("end") - F.col("begin") > 1)), "large-parts")
        if large.isEmpty():
            break
        hot = rows.join(large, list(_PART), "left_semi").withColumnsRenamed({"begin": "a", "end": "b"})
        halves = _parts(hot, _halves(F.col("a"), F.expr("(a + b) div 2").cast("int"), F.col("b")))
        rows = landed(rows.join(large, list(_PART), "left_anti").unionByName(halves), "spelling-parts")
    rows = rows.repartition(*_PART).sortWithinPartitions(*_PART).select("word", "n", "short", "begin", "end")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form")))
    found = rows.mapInArrow(_near_rows, _FOUND).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form"))


def group_variants(words: DataFrame, ratio: int = 5, min_length: int = 1) -> DataFrame:
    """Adds ``n_near, form, form_n, root`` to ``word, n``.

    A word's ``form`` is the most frequent of its near words, if that occurs at least ``ratio`` times as often, else null;
    ``root`` follows forms to the last. As ``n`` grows from form to form, there are no rings (``ratio`` is at least 2).
    Words are distinct and not null; of no words, none come out; other columns are left aside.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = landed(words.select("word", "n").where("word is not null"), "words")
    both = words.join(near_words(words, min_length), "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    formed = landed(
        both.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("form")).alias("form"),
            F.when(enough, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    # Each round doubles the number of forms a link jumps over.
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        links = landed(links, "links")
        jump = links.join(links.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left")
        jump = landed(jump, "jumps")
        if jump.where("further is not null").isEmpty():
            break
        links = jump.select("word", F.coalesce("further", "root").alias("root"))
    rooted = formed.join(links, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame,
    min_length: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    drop_one_in: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of a corpus; see ``count_words`` and ``group_variants``.

    Repeated rows count as often as they occur; ids matter only where typing errors are planted (``drop_one_in``).
    """
    return group_variants(count_words(docs, min_length, min_count, drop_one_in, id_col, text_col), ratio, min_length)
