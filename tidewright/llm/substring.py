"""Substring dedup: passages of ``k`` words that an earlier document also has are removed.

Every window of ``k`` words gets a Rabin-Karp hash. Shipping each as a row of its own would move many times the input,
so windows travel in runs: neighbours that share the least hash of the ``GRAM``-word pieces inside them form one row,
keyed by that least hash. Equal windows have equal pieces and so meet under the same key, where they are compared by the
window hash (112 bits with the key). Windows are counted by a hash of their key beforehand; where many meet, the key is
split by bits of the window hash, so that no task has to hold what one common piece draws together. A batch of documents first settles the windows that repeat within it and ships each
window for its earliest document only, so that a passage in a third of all documents gives one entry per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c

#: Words of a piece; the rarer the pieces, the fewer windows meet without being equal.
GRAM = 8
#: Bytes kept of a window's hash, next to the eight of its key.
KEPT = 6
#: Windows that may meet under one key, and bits of the key hash by which they are counted.
HOT, COUNTED_BITS = 1 << 20, 20
_RUN = "key long, id long, fp long, pos int, n int, hashes binary"
_SPAN = "id long, fp long, start int, stop int"


def _earliest(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each entry the least id among those with its key."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first, count = c.runs(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
    out = np.empty_like(ids)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], first), count)
    return out


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _windows(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each slice: id and text hash of its documents, and of each window its document, its place there, its hash, the
    least hash of the pieces inside, and whether the slice has it in an earlier document."""
    gram = min(GRAM, k)
    for batch in c.slices(batches, "text"):
        words, counts = c.flat([c.plain_words(t) for t in c.texts(batch.column("text"))])
        if len(words) < k:
            continue
        hashes = c.word_hashes(words)
        del words
        doc = np.repeat(np.arange(len(counts)), counts)
        begin = np.cumsum(counts) - counts
        at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])  # windows inside one document
        if not len(at):
            continue
        window = c.rolling(hashes, k)[at]
        least = c.sliding_min(c.rolling(hashes, gram), k - gram + 1)[at]
        doc = doc[at]
        id_of, fp_of = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("id", "fp"))
        yield id_of, fp_of, doc, at - begin[doc], window, least, id_of[doc] > _earliest(window, id_of[doc])


def _counted(least: np.ndarray) -> np.ndarray:
    return (c.mixed(least) >> np.uint64(64 - COUNTED_BITS)).view(np.int64)


def _count_keys(k: int) -> Callable:
    """How many windows a task ships under each hash of their key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTED_BITS, np.int64)
        for *_, least, settled in _windows(batches, k):
            total += np.bincount(_counted(least[~settled]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["counted", "n"])

    return run


def _split_bits(keyed: DataFrame, k: int, hot: int) -> np.ndarray:
    """By how many bits of the window hash the keys of each counted hash are split: none under ``hot`` windows."""
    counts = keyed.mapInArrow(_count_keys(k), "counted int, n long").groupBy("counted").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    found = counts.toArrow()  # as many rows as there are counted hashes at most
    bits = np.zeros(1 << COUNTED_BITS, np.uint8)
    bits[found.column("counted").to_numpy()] = np.ceil(np.log2(found.column("n").to_numpy() / hot))
    return bits


def _window_runs(k: int, bits) -> Callable:
    """Rows of ``_RUN``: windows to compare, and with ``n`` below 0 those that the batch itself has settled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_of, fp_of, doc, place, window, least, settled in _windows(batches, k):
            split = bits.value[_counted(least)].astype(np.uint64)
            part = c.mixed(window) & ((np.uint64(1) << split) - np.uint64(1))
            key = np.where(part > 0, c.mixed(least + part * np.uint64(0x9FB21C651E98DF25)), least)
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (settled[1:] != settled[:-1]) | (~settled[1:] & (key[1:] != key[:-1]))
            first, length = c.runs(new)
            done = settled[first]
            kept = window[~settled].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(done, fp_of[doc[first]], key[first].view(np.int64))),
                    pa.array(id_of[doc[first]]),
                    pa.array(fp_of[doc[first]]),
                    pa.array(place[first].astype(np.int32)),
                    pa.array(np.where(done, -length, length).astype(np.int32)),
                    _binary(np.ascontiguousarray(kept), np.where(done, 0, length * KEPT)),
                ],
                names=["key", "id", "fp", "pos", "n", "hashes"],
            )

    return run


def _later_copies(k: int) -> Callable:
    """From runs sorted by key to the spans of words whose window an earlier document has."""

    def spans(ids, fps, starts, lengths) -> pa.RecordBatch:
        columns = [ids, fps, starts.astype(np.int32), (starts + lengths + k - 1).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["id", "fp", "start", "stop"])

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        key, ids, fps, pos, n = (table.column(x).to_numpy() for x in ("key", "id", "fp", "pos", "n"))
        if (done := n < 0).any():
            yield spans(ids[done], fps[done], pos[done], -n[done])
        key, ids, fps, pos, n = (x[~done] for x in (key, ids, fps, pos, n))
        if not len(key):
            return
        same = np.append(key[1:] == key[:-1], False)
        same[1:] |= same[:-1].copy()  # a key that only one run has needs no comparing
        if not same.any():
            return
        column = table.column("hashes").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        hashes = pa.concat_arrays([column.filter(pa.array(~done)).filter(pa.array(same))])
        key, ids, fps, pos, n = (x[same] for x in (key, ids, fps, pos, n))
        raw = np.frombuffer(b"".join(hashes.to_pylist()), np.uint8).reshape(-1, KEPT)
        window = np.zeros((len(raw), 8), np.uint8)
        window[:, :KEPT] = raw
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        joint = c.mixed(window.view("<u8").ravel() * np.uint64(0x9FB21C651E98DF25) + key.view(np.uint64)[row])
        of = ids[row]
        later = of > _earliest(joint, of)
        hit = np.flatnonzero(later)
        if not len(hit):
            return
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])
        first, length = c.runs(new)
        at = hit[first]
        yield spans(ids[row[at]], fps[row[at]], pos[row[at]] + place[at], length)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the runs of the last key seen, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut or held and held[-1].column("key")[-1].as_py() != key[0]:
                yield from compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from compare(pa.Table.from_batches(held))

    return run


def repeated_spans(docs: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, spans``: word ranges of each document that are covered by windows an earlier document has.

    ``id`` is the document's id (null as the largest), ``fp`` a hash of its text; documents without such a window are
    absent. Rows that share an id are the same age, so neither removes words of the other.
    """
    keyed = docs.select(c.ordered_id(id_col).alias("id"), c.fingerprint(text_col).alias("fp"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.where(F.col("text").isNotNull())
    bits = docs.sparkSession.sparkContext.broadcast(_split_bits(keyed, k, HOT))
    runs = keyed.mapInArrow(_window_runs(k, bits), _RUN)
    spans = runs.repartition("key").sortWithinPartitions("key").mapInArrow(_later_copies(k), _SPAN)
    return spans.groupBy("id", "fp").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def _cut(text: str, spans: str, n_words: str, n_removed: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, text):
            out, total, gone = [], [], []
            for value, cuts in zip(batch.column(text).cast(pa.binary()).to_pylist(), batch.column(spans).to_pylist(), strict=True):
                words = c.plain_words(value or b"")
                total.append(len(words))
                if cuts:
                    keep = np.ones(len(words), bool)
                    for cut in cuts:
                        keep[cut["start"] : cut["stop"]] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                gone.append(total[-1] - len(words))
                out.append(None if value is None else b" ".join(words))
            columns = {n: batch.column(n) for n in batch.schema.names if n != spans}
            columns |= {text: pa.array(out, pa.binary()).cast(pa.string()), n_words: pa.array(total, pa.int64()), n_removed: pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def remove_repeats(docs: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the words covered by a ``k``-word window that also starts in a document with a smaller id.

    Windows are judged on the input. Words left are joined by one space. Adds ``n_words`` and ``n_removed`` (columns of
    those names are replaced). Null text stays null and has no words; a null id is later than every other; rows that
    share an id are kept and judged alike; texts under ``k`` words keep all words; an empty table gives an empty one.
    """
    text_col = c.named(docs, text_col)
    docs = docs.drop("n_words", "n_removed")
    names = docs.columns
    id_key, fp_key, spans = (c.fresh(docs, x) for x in ("span_id", "span_fp", "span_list"))
    found = repeated_spans(docs, k, id_col, text_col).toDF(id_key, fp_key, spans)
    keyed = docs.withColumn(id_key, c.ordered_id(id_col)).withColumn(fp_key, c.fingerprint(text_col))
    joined = keyed.join(found, [id_key, fp_key], "left").select(*names, spans)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(_cut(text_col, spans, "n_words", "n_removed"), schema)
