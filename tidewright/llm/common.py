"""Words, hashes and Arrow batches for the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id in orders: later than every real one.
LAST_ID = 2**63 - 1
#: Texts are worked on in slices of about this many bytes, whatever the size of Spark's batches.
SLICE_BYTES = 4 << 20
#: Spark's own limit for a batch and, for operators on long texts, its value in bytes; a worker holds two or three batches.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ASCII_LETTER_OR_DIGIT = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ordered_id(column: str) -> Column:
    """The integer id as an order key; null comes last."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def fingerprint(column: str) -> Column:
    """Tells apart rows that share an id but not the text."""
    return F.xxhash64(F.col(column))


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands Python workers batches of about ``BATCH_BYTES``, unless the session has a limit of its own."""
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or of one row.

    Worker processes outlive their tasks, so after the last batch freed memory goes back to the machine.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Give freed memory back: Arrow's, and where the C library can (glibc), that of the process."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null gives none."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def plain_words(text: bytes) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.split()


def lower_words(text: bytes) -> list[bytes]:
    """Plain words with A-Z lower-cased."""
    return text.lower().split()


def letter_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), ASCII digits and anything beyond ASCII."""
    return text.translate(_ASCII_LETTER_OR_DIGIT).split()


def flat(lists: list[list]) -> tuple[list, np.ndarray]:
    """All items in one list, and how many each list had."""
    return list(chain.from_iterable(lists)), np.fromiter(map(len, lists), np.int64, len(lists))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 2**64))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp value of every run of ``k`` hashes: the polynomial over 64 bits, put together from runs of 1, 2, 4 ..."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    out, done, block, size = None, 0, hashes, 1
    while k:
        if k & 1:
            if out is None:
                out, done = block, size
            else:
                out = out[: len(block) - done] * _power(size) + block[done:]
                done += size
        k >>= 1
        if k:
            block = block[: len(block) - size] * _power(size) + block[size:]
            size *= 2
    return mixed(out)


def sliding_min(values: np.ndarray, k: int) -> np.ndarray:
    """Least value of every run of ``k``."""
    block, size = values, 1
    while size * 2 <= k:
        block = np.minimum(block[: len(block) - size], block[size:])
        size *= 2
    rest = k - size
    return np.minimum(block[: len(block) - rest], block[rest:]) if rest else block


def runs(starts_new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run, from a mask that is true where a run begins."""
    first = np.flatnonzero(starts_new)
    return first, np.diff(np.append(first, len(starts_new)))


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask over ``n`` places of those in ``[start, start + k)`` for any start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + k, n), -1)
    return np.cumsum(edge[:n]) > 0


def named(df: DataFrame, column: str) -> str:
    """The frame's own spelling of a column, which Python workers need; Spark itself ignores case."""
    found = [c for c in df.columns if c == column] or [c for c in df.columns if c.lower() == column.lower()]
    if not found:
        raise ValueError(f"no column {column!r} among {df.columns}")
    return found[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for every pair of a start and a length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
