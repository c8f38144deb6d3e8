"""Byte-level BPE as a monoid: the encoding of a text is put together from the encodings of its halves.

A token sequence is what the merges make of its bytes exactly when every two neighbours are *stable*: encoded together
they give themselves. So two encodings join by looking at the seam. Where it is not stable, a window of tokens around it
is encoded anew and grown until both its edges are stable; tokens outside can then not change. Decoding is the same
fold, with concatenation as the join.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewright.llm import common as c

#: Encodings of words that a task keeps; when full, it starts over.
CACHED_WORDS = 500_000
#: Pairs of tokens whose stability, and short runs whose encoding, a task keeps.
CACHED_PAIRS = 300_000
CACHED_RUNS = 200_000
#: Bytes of a run that is not halved any more.
LEAF = 8
_FOLD = 1 << 14
# Formats of other lengths, which Python keeps, and iterators over matches leave objects between the words of a cache; so few of
# them hold all its memory after the task. Hence one format for one id, and texts are split instead.
_ID = struct.Struct("<I").pack
_RUN_OF_SPACE = re.compile("([\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,})")


class Bounded(dict):
    """Values worked out on first use; emptied when it holds ``most``."""

    def __init__(self, work: Callable, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        value = self.work(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Encoder and decoder for a rank file: lines of a base64 token and its rank, which is also its id.

    The pattern's matches must not run from a character into white space after it. A space between two other characters
    then always starts a match, and what stands between two such spaces is encoded once for all its occurrences.
    """

    def __init__(self, rank_file: bytes, pattern: str, cached: int = CACHED_WORDS):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.stable = Bounded(lambda ab: self.merged(self.tokens[ab[0]] + self.tokens[ab[1]]) == ab, CACHED_PAIRS)
        self.leaves = Bounded(self.merged, CACHED_RUNS)
        self.words = Bounded(lambda word: self._packed(" " + word), cached)
        self.heads = Bounded(self._packed, cached // 8)

    def forget(self) -> None:
        """Empty the caches; they refer back to the encoder, which so outlives its last use until Python looks for cycles.

        That search also drops the spare tuples that Python keeps, which lie between the words.
        """
        for cache in (self.stable, self.leaves, self.words, self.heads):
            cache.clear()
        self.ranks, self.tokens = {}, {}
        gc.collect()
        c.release()

    def merged(self, data: bytes) -> tuple[int, ...]:
        """The merges in order of rank, leftmost first, over a run of bytes."""
        n = len(data)
        if n <= 24:
            return self._merged_short([data[i : i + 1] for i in range(n)])
        end = list(range(1, n + 1))  # of the part that begins here
        before = list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j <= i or j >= n or end[j] != stop:  # one of the two parts has been merged meanwhile
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _merged_short(self, parts: list[bytes]) -> tuple[int, ...]:
        ranks, never = self.ranks, len(self.ranks) + 256
        pairs = [ranks.get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := min(pairs)) < never:
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], never)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], never)
        return tuple([ranks[x] for x in parts])

    def joined(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of the bytes of ``a`` followed by those of ``b``."""
        if not a or not b:
            return a or b
        if self.stable[a[-1], b[0]]:
            return a + b
        k = 1
        while True:
            window = self.merged(b"".join([self.tokens[t] for t in a[-k:] + b[:k]]))
            if (k >= len(a) or self.stable[a[-k - 1], window[0]]) and (k >= len(b) or self.stable[window[-1], b[k]]):
                return a[:-k] + window + b[k:]
            k *= 2

    def tree(self, data: bytes) -> tuple[int, ...]:
        """Encoding of a run of bytes from those of its halves."""
        if len(data) <= LEAF:
            return self.leaves[data]
        half = len(data) // 2
        return self.joined(self.tree(data[:half]), self.tree(data[half:]))

    def word(self, data: bytes) -> tuple[int, ...]:
        """Encoding of one match of the pattern; a word that is a token is that token."""
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.tree(data)

    def _packed(self, text: str) -> bytes:
        return b"".join([_ID(i) for match in self.pattern.findall(text) for i in self.word(match.encode())])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        first, *others = _RUN_OF_SPACE.split(text)
        out: list[bytes] = []
        self._spaced(first, out)
        for run, after in zip(others[::2], others[1::2], strict=True):
            if after:  # all of a run but its last character is one match, unless it ends the text
                out.append(self.heads[run[:-1]])
                self._spaced(run[-1] + after, out)
            else:
                out.append(self.heads[run])
        return b"".join(out)

    def _spaced(self, text: str, out: list[bytes]) -> None:
        """Ids of a text in which no two white spaces meet."""
        if text:
            head, *rest = text.split(" ")
            if head:
                out.append(self.heads[head])
            out.extend(map(self.words.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        def fold(a: np.ndarray) -> bytes:
            if len(a) <= _FOLD:
                return b"".join(map(self.tokens.__getitem__, a.tolist()))
            half = len(a) // 2
            return fold(a[:half]) + fold(a[half:])

        return fold(np.frombuffer(ids, "<u4"))


def _broadcast(docs: DataFrame, path: str):
    """The rank file, under a megabyte, for all tasks."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens`` and ``token_ids``: ids as packed little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded on its own, without special tokens. Null and empty texts have no tokens;
    columns of the added names are replaced; an empty table gives an empty one.
    """
    text_col = c.named(docs, text_col)
    docs = docs.drop("n_tokens", "token_ids")
    c.small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())])
    file = _broadcast(docs, rank_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(file.value, pattern)
        for batch in c.slices(batches, text_col):
            ids = [bpe.encode(t) if t else b"" for t in batch.column(text_col).to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "token_ids": pa.array(ids, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)
        bpe.forget()  # worker processes outlive their tasks

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, rank_path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded``: the bytes of the tokens, whether or not they are valid UTF-8. Null ids decode to nothing."""
    ids_col = c.named(docs, ids_col)
    docs = docs.drop("decoded")
    c.small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("decoded", T.BinaryType())])
    file = _broadcast(docs, rank_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(file.value, pattern)
        for batch in c.slices(batches, ids_col):
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["decoded"] = pa.array([bpe.decode(x) if x else b"" for x in batch.column(ids_col).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
        bpe.forget()  # worker processes outlive their tasks

    return docs.mapInArrow(run, schema)
