"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target texts and one of all raw text, give every document an importance
weight; Gumbel top-k then draws as many documents as the labels say pass. N-grams are words, pairs of words, word
beginnings and word shapes. Only n-grams that the target has significantly less often than the raw text count, so that a
long run of ordinary words cannot make up for bad ones; the sum is divided by the root of the document's length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.llm.scratch import landed

#: Hash buckets of the n-gram models.
BUCKET_BITS = 21
#: Counts travel in ranges of so many buckets.
RANGE = 1 << 12
#: Texts are looked at in slices of about this many bytes: the arrays of their n-grams take some thirty times as much.
SLICE = 1 << 20
#: Most labelled documents used: those with the least hash of their id. One in four of them sets the cut.
LABELLED = 20_000
#: Standard deviations by which a count may have to fall short to matter; the held labels choose among them, as what they
#: show depends on the size of the tables. Labels that do not tell them apart leave the one closest to ``SIGNIFICANT``.
GATES, SIGNIFICANT = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0, 7.0, 10.0), 5.0
#: The count added to either side.
ADDED = 0.5
#: Scale of the Gumbel noise in units of the log weight.
TEMPERATURE = 0.05
#: Bytes of the word beginnings used, eight at most.
BEGINNINGS = (4, 5, 6, 8)

_SHAPE = bytes(65 if 65 <= x <= 90 else 97 if 97 <= x <= 122 or x >= 128 else 48 if 48 <= x <= 57 else x for x in range(256))
_SAME = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Grams:
    """The n-grams of some texts: those of a word are listed once for each distinct word, ``-1`` where it has none."""

    of_word: np.ndarray  # a row of buckets for each distinct word
    word: np.ndarray  # the distinct word of each place
    doc: np.ndarray  # the text of each place
    pair: np.ndarray  # bucket of each pair of neighbours
    pair_doc: np.ndarray
    texts: int

    @staticmethod
    def of(texts: list[bytes]) -> Grams:
        words, counts = c.flat([c.plain_words(t) for t in texts])
        doc = np.repeat(np.arange(len(texts)), counts)
        _, at, back = np.unique(c.word_hashes(words), return_index=True, return_inverse=True)
        kinds = [words[i] for i in at.tolist()]  # each distinct word is looked at once
        lower = [w.lower() for w in kinds]
        whole = c.word_hashes(lower)
        shape = c.word_hashes([s[:1] + s[-3:] for s in (w.translate(_SHAPE) for w in kinds)]) + np.uint64(1)
        columns = [_bucket(whole), _bucket(shape)]
        length = np.fromiter(map(len, lower), np.int64, len(lower))
        first = np.array(lower, "S8").view("<u8") if lower else np.zeros(0, np.uint64)  # up to eight bytes as a number
        for n in BEGINNINGS:
            begins = c.mixed(first & np.uint64((1 << 8 * n) - 1)) + np.uint64(n)
            columns.append(np.where(length > n, _bucket(begins), -1))
        word = whole[back]
        inside = doc[1:] == doc[:-1]
        pair = np.where(word[1:] == word[:-1], _SAME, word[:-1] * np.uint64(3) + word[1:])[inside]
        return Grams(np.stack(columns, axis=1), back, doc, _bucket(pair), doc[1:][inside], len(texts))

    def add_to(self, counts: np.ndarray, chosen: np.ndarray | None = None) -> None:
        """Add how often each bucket occurs, in all texts or in the chosen ones, to ``counts``."""
        word, pair = (self.word, self.pair) if chosen is None else (self.word[chosen[self.doc]], self.pair[chosen[self.pair_doc]])
        times = np.repeat(np.bincount(word, minlength=len(self.of_word)).astype(counts.dtype), self.of_word.shape[1])
        bucket = self.of_word.ravel()
        some = bucket >= 0
        np.add.at(counts, bucket[some], times[some])
        np.add.at(counts, pair, counts.dtype.type(1))

    def sums(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: the sum of its n-grams' values, and their number."""
        some = self.of_word >= 0
        of_word = np.where(some, value[np.maximum(self.of_word, 0)], 0).sum(axis=1, dtype=np.float64)
        total = np.bincount(self.doc, of_word[self.word], minlength=self.texts) + np.bincount(self.pair_doc, value[self.pair], minlength=self.texts)
        return total, np.bincount(self.doc, some.sum(axis=1)[self.word], minlength=self.texts) + np.bincount(self.pair_doc, minlength=self.texts)


def _bucket(gram: np.ndarray) -> np.ndarray:
    return (c.mixed(gram) >> np.uint64(64 - BUCKET_BITS)).view(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, and of the target ones among them, as blobs of ``RANGE`` buckets."""
    raw, target = (np.zeros(1 << BUCKET_BITS, np.int32) for _ in range(2))
    for batch in c.slices(batches, "text", SLICE):
        grams = Grams.of(c.texts(batch.column("text")))
        grams.add_to(raw)
        good = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        if good.any():
            grams.add_to(target, good)
    some = np.flatnonzero(raw.reshape(-1, RANGE).any(axis=1))
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array(some.astype(np.int32)),
            "raw": pa.array([raw[i * RANGE : (i + 1) * RANGE].tobytes() for i in some], pa.binary()),
            "target": pa.array([target[i * RANGE : (i + 1) * RANGE].tobytes() for i in some], pa.binary()),
        }
    )


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blobs of each range, from rows sorted by range."""
    part, sums = None, [np.zeros(0, np.int64)] * 2

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "raw": pa.array([sums[0].tobytes()]), "target": pa.array([sums[1].tobytes()])})

    for batch in batches:
        for i, raw, target in zip(*(batch.column(n).to_pylist() for n in ("part", "raw", "target")), strict=True):
            counts = [np.frombuffer(x, np.int32).astype(np.int64) for x in (raw, target)]
            if i == part:
                sums = [a + b for a, b in zip(sums, counts, strict=True)]
                continue
            if part is not None:
                yield row()
            part, sums = i, counts
    if part is not None:
        yield row()


@dataclass(frozen=True)
class Model:
    """Log ratio of target to raw model for each bucket, and the least log weight of a document that passes."""

    ratio: np.ndarray
    cut: float


def log_ratio(raw: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of target to raw text for each bucket, and how many of the ``GATES`` its lack in the target reaches."""
    expected = raw * (target.sum() / max(1, raw.sum()))
    lack = (expected - target) / np.sqrt(expected + 1)
    return np.log((target + ADDED) / (expected + ADDED)).astype(np.float32), np.searchsorted(GATES, lack, side="right").astype(np.uint8)


def gated(ratio: np.ndarray, reached: np.ndarray, gate: int) -> np.ndarray:
    """What each bucket adds to a log weight: 0 unless the target lacks it by as much as the gate says."""
    return np.where(reached > gate, ratio, np.float32(0))


def best_cut(weight: np.ndarray, good: np.ndarray) -> float:
    """The cut with the fewest labelled documents on the wrong side, in the middle of the widest such gap."""
    if not len(weight) or good.all():
        return float("-inf")
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([np.cumsum(~g[::-1])[::-1], [0]])  # the first i are rejected
    edges = np.concatenate([[w[0] - 1.0], w, [w[-1] + 1.0]])
    gap = np.diff(edges)
    wrong = np.where(gap > 0, wrong, len(w) + 1)
    fewest = np.flatnonzero(wrong == wrong.min())
    at = fewest[np.argmax(gap[fewest])]
    return float((edges[at] + edges[at + 1]) / 2)


def best_gate(weights: np.ndarray, good: np.ndarray) -> tuple[int, float]:
    """The gate whose column of weights leaves the fewest labelled documents on the wrong side of its cut, and that cut."""
    cuts = [best_cut(w, good) for w in weights.T]
    wrong = [int(((w >= cut) != good).sum()) for w, cut in zip(weights.T, cuts, strict=True)]
    gate = min(range(len(GATES)), key=lambda i: (wrong[i], abs(GATES[i] - SIGNIFICANT)))
    return gate, cuts[gate]


def log_weights(texts: list[bytes], ratio: np.ndarray) -> np.ndarray:
    total, n = Grams.of(texts).sums(ratio)
    return total / np.sqrt(n + 1.0)


def _weigh(ratio, text: str, weight: str, kept: list[str]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, text, SLICE):
            columns = {n: batch.column(n) for n in kept}
            columns[weight] = pa.array(log_weights(c.texts(batch.column(text)), ratio.value))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _weigh_gates(model, text: str, kept: str) -> Callable:
    """The log weights of every text, one for each gate."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, reached = model.value
        for batch in c.slices(batches, text, SLICE):
            grams = Grams.of(c.texts(batch.column(text)))
            sums = (grams.sums(gated(ratio, reached, i)) for i in range(len(GATES)))
            weights = np.stack([total / np.sqrt(n + 1.0) for total, n in sums], axis=1)
            yield pa.RecordBatch.from_pydict({kept: batch.column(kept), "w": pa.array(list(weights), pa.list_(pa.float64()))})

    return run


def labelled(labels: DataFrame, id_col: str = "doc_id", most: int = LABELLED) -> DataFrame:
    """``id, good, fits``: at most ``most`` labelled ids, by hash; ``good`` needs quality and no toxicity.

    Labels with a null id, quality or toxicity say nothing; of repeated labels the worst counts. Documents that ``fits``
    is false for set the cut and take no part in the models.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    one = known.where("id is not null and good is not null").groupBy("id").agg(F.min("good").alias("good"))
    return one.orderBy(F.xxhash64("id"), "id").limit(most).select("id", "good", (F.xxhash64("id", F.lit(2)) % 4 != 0).alias("fits"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Models of the target (good labelled documents) and of all documents, and the gate and cut that best part good from bad ones."""
    spark = docs.sparkSession
    known = landed(labelled(labels, id_col), "labelled")  # at most LABELLED rows
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = keyed.join(F.broadcast(known), "id", "left").select("id", "text", F.coalesce(F.col("good") & F.col("fits"), F.lit(False)).alias("target"))
    blobs = marked.select("text", "target").mapInArrow(_count, "part int, raw binary, target binary")
    sums = blobs.repartition("part").sortWithinPartitions("part").mapInArrow(_add, "part int, raw binary, target binary")
    raw, target = (np.zeros(1 << BUCKET_BITS, np.int64) for _ in range(2))
    for row in sums.toLocalIterator():
        for to, blob in ((raw, row["raw"]), (target, row["target"])):
            to[row["part"] * RANGE : (row["part"] + 1) * RANGE] = np.frombuffer(bytes(blob), np.int64)
    ratio, reached = log_ratio(raw, target)
    held = keyed.join(F.broadcast(known.where("not fits").select("id", "good")), "id").select("good", "text")
    every = spark.sparkContext.broadcast((ratio, reached))
    scored = held.mapInArrow(_weigh_gates(every, "text", "good"), "good boolean, w array<double>").toArrow()
    weights = np.array(scored.column("w").to_pylist(), np.float64).reshape(-1, len(GATES))
    gate, cut = best_gate(weights, scored.column("good").to_numpy().astype(bool))
    return Model(gated(ratio, reached, gate), cut)


def gumbel(key: list[Column], seed: int) -> Column:
    """Noise from a hash, the same whenever and wherever a row is computed."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The ``k``-th largest of finite values, from counts in ever finer bins; a bin list of bounded length reaches the driver."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    for _ in range(12):
        if not high > low:
            break
        width = (high - low) / 4096
        inside = values.where(F.col(column).between(low, high))
        bins = inside.groupBy(F.least(((F.col(column) - low) / width).cast("int"), F.lit(4095)).alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        above = values.where(F.col(column) > high).count()
        for row in sorted(bins.collect(), key=lambda r: -r["b"]):
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
    return low


ADDED_COLUMNS = ("log_weight", "kept")


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", temperature: float = TEMPERATURE, seed: int = 7) -> DataFrame:
    """Documents with ``log_weight`` and ``kept``.

    As many documents are kept as have a log weight above the cut that best parts the held labels; which ones is drawn
    by Gumbel top-k, so documents close to the cut may change places. Null and empty texts have weight 0, that of an
    ordinary text; rows equal in id and text are judged alike (ties at the last place are all kept); without good labels
    every weight is 0 and without bad ones every document is kept; an empty table gives an empty one; columns of the
    added names are replaced.
    """
    text_col = c.named(docs, text_col)
    docs = docs.drop(*ADDED_COLUMNS)
    model = fit(docs, labels, id_col, text_col)
    weighed = _weighed(docs, model, text_col, docs.columns)
    key = _drawn(id_col, c.fingerprint(text_col), temperature, seed)
    values = landed(weighed.select(key.alias("key"), (F.col("log_weight") >= F.lit(model.cut)).alias("passes")), "weights")
    return weighed.withColumn("kept", _kept(key, values))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", temperature: float = TEMPERATURE, seed: int = 7) -> DataFrame:
    """What ``resample`` gives, without the text and so with one pass less over it."""
    text_col = c.named(docs, text_col)
    docs = docs.drop(*ADDED_COLUMNS)
    model = fit(docs, labels, id_col, text_col)
    names, fp, key, passes = [n for n in docs.columns if n != text_col], *(c.fresh(docs, x) for x in ("text_fp", "drawn_key", "passes"))
    marked = docs.withColumn(fp, c.fingerprint(text_col))
    weighed = _weighed(marked, model, text_col, [*names, fp])
    drawn = weighed.withColumns({key: _drawn(id_col, F.col(fp), temperature, seed), passes: F.col("log_weight") >= F.lit(model.cut)})
    held = landed(drawn.drop(fp), "weights")
    values = held.select(F.col(key).alias("key"), F.col(passes).alias("passes"))
    return held.select(*names, "log_weight", _kept(F.col(key), values).alias("kept"))


def _weighed(docs: DataFrame, model: Model, text_col: str, kept: list[str]) -> DataFrame:
    ratio = docs.sparkSession.sparkContext.broadcast(model.ratio)
    schema = T.StructType([*[docs.schema[n] for n in kept], T.StructField("log_weight", T.DoubleType())])
    return docs.mapInArrow(_weigh(ratio, text_col, "log_weight", kept), schema)


def _drawn(id_col: str, fp: Column, temperature: float, seed: int) -> Column:
    """Log weight in units of the temperature, with the noise of the row."""
    return F.col("log_weight") / temperature + gumbel([F.col(id_col).cast("long"), fp], seed)


def _kept(key: Column, values: DataFrame) -> Column:
    """Whether a row is among the ``k`` largest keys, ``k`` being the number of rows that pass."""
    total, k = values.agg(F.count("*"), F.coalesce(F.count_if("passes"), F.lit(0))).first()
    if k == total or not k:
        return F.lit(k == total)
    return key >= F.lit(kth_largest(values, "key", k))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``resample`` keeps, as they came."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return resample(packed, labels.withColumnRenamed(id_col, "id"), "id", "text").where("kept").select("row.*")
