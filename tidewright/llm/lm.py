"""Language-model scoring: a log-bilinear neural model over word classes, and word counts within the classes.

The most frequent words are classes of their own; the others share classes by how they are written. The model predicts a
word's class from the two before it: context vectors, weighted by position, add up to a predicted vector, whose products
with the class vectors (plus biases) are the scores. It is trained by noise-contrastive estimation on the counts of class
triples of the whole training text. As there are few classes, the normalised log-probabilities of every context come from
one batched matrix product, so scoring a token is a look-up. The chance of a word within its class comes from its count.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.llm.scratch import landed

#: Classes: the end of a text, its beginning (context only), frequent words, and forms of the other words.
CLASSES = 128
END, BEGIN = 0, 1
FORMS = 62
SINGLE = CLASSES - FORMS - 2
#: Frequent words whose counts are broadcast; the others are looked up by a join.
FREQUENT = 200_000
#: Added to every count, and to one unseen word.
ADDED = 0.1
#: Size of the vectors; noise classes per observed one; most passes of the training over all triples.
WIDTH, NOISE, STEPS = 24, 24, 400
#: Training ends when so many passes have raised the log-likelihood by less than this share of it.
EVERY, SETTLED = 20, 1e-5
#: Distinct words that a task counts before it sends them on.
HELD = 1_000_000
_STOP = frozenset(b".,;:!?")


def form(word: bytes) -> int:
    """Class among the ``FORMS`` of words that have none of their own: by beginning, and by a stop at the end."""
    return zlib.crc32(word[:2]) % (FORMS // 2) * 2 + (word[-1] in _STOP)


def _tokens(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    words, counts = c.flat([c.lower_words(t) for t in c.texts(batch.column("text"))])
    return words, c.word_hashes(words), counts


def _summed(keys: list[np.ndarray], values: list[np.ndarray], more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, value, other = np.concatenate(keys), np.concatenate(values), np.concatenate(more)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first, _ = c.runs(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], np.add.reduceat(value[order], first) if len(first) else value, other[order][first]


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, values, forms, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(keys[0].view(np.int64)), "form": pa.array(forms[0]), "n": pa.array(values[0])})

    for batch in c.slices(batches, "text"):
        words, hashes, _ = _tokens(batch)
        key, at, count = np.unique(hashes, return_index=True, return_counts=True)
        keys, values = [*keys, key], [*values, count.astype(np.int64)]
        forms = [*forms, np.array([form(words[i]) for i in at.tolist()], np.int32)]
        held += len(key)
        if held > HELD:
            key, count, kind = _summed(keys, values, forms)
            keys, values, forms, held = [key], [count], [kind], len(key)
            if held > HELD // 2:
                yield out()
                keys, values, forms, held = [], [], [], 0
    if held:
        key, count, kind = _summed(keys, values, forms)
        keys, values, forms = [key], [count], [kind]
        yield out()


@dataclass
class Words:
    """The frequent words by hash, with class and log10 of the count plus ``ADDED``; and log10 of the mass of each class."""

    word: np.ndarray
    kind: np.ndarray
    log_count: np.ndarray
    log_mass: np.ndarray

    def classes(self, words: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of every word, its log10 count (that of an unseen word if it is not frequent), and which are frequent."""
        if not len(self.word):
            known = np.zeros(len(hashes), bool)
            at = np.zeros(len(hashes), np.int64)
            kind, log_count = np.zeros(len(hashes), np.int64), np.full(len(hashes), np.log10(ADDED))
        else:
            at = np.minimum(np.searchsorted(self.word, hashes), len(self.word) - 1)
            known = self.word[at] == hashes
            kind = self.kind[at].astype(np.int64)
            log_count = np.where(known, self.log_count[at], np.log10(ADDED))
        rare = np.flatnonzero(~known)
        kind[rare] = [CLASSES - FORMS + form(words[i]) for i in rare.tolist()]
        return kind, log_count, known


def _contexts(kind: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the class triple (two before, one before, this) of every token with the ends, text and place of each token."""
    total = len(kind) + len(counts)
    doc = np.repeat(np.arange(len(counts)), counts + 1)
    stop = np.cumsum(counts + 1) - 1
    seq = np.full(total, END, np.int64)
    word = np.ones(total, bool)
    word[stop] = False
    seq[word] = kind
    start = stop - counts
    one = np.concatenate([[BEGIN], seq[:-1]]) if total else seq
    one[start] = BEGIN
    two = np.concatenate([[BEGIN], one[:-1]]) if total else seq
    two[start] = BEGIN
    return (two * CLASSES + one) * CLASSES + seq, doc, word


def _triples(words) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = words.value, np.zeros(CLASSES**3, np.int64)
        for batch in c.slices(batches, "text"):
            found, hashes, width = _tokens(batch)
            kind, _, _ = known.classes(found, hashes)
            counts += np.bincount(_contexts(kind, width)[0], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"triple": pa.array(some), "n": pa.array(counts[some])})

    return run


def train(triple: np.ndarray, count: np.ndarray, seed: int = 11, steps: int = STEPS) -> np.ndarray:
    """Log10 probability of each class in each context, as an array (two before, one before, class).

    Noise-contrastive estimation: for each observed triple the model tells its class from ``NOISE`` classes with the class
    frequencies. Nothing is drawn: each step takes every triple as often as it occurs, and the noise by its expectation,
    so the slopes are those of the whole training text, which the counts of triples say all about. Steps are Adam's.
    Without triples every class is as likely as any other.
    """
    rng = np.random.default_rng(seed)
    k, d = CLASSES, WIDTH
    context, target = (rng.normal(0, 0.1, (k, d)).astype(np.float32) for _ in range(2))
    near, far = np.ones(d, np.float32), np.full(d, 0.5, np.float32)
    seen = np.bincount(triple % k, count, minlength=k) if len(triple) else np.zeros(k)
    noise = (seen + 1.0) / (seen.sum() + k)
    bias = np.log(noise).astype(np.float32)
    weights = [context, target, near, far, bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    log_noise = np.log(NOISE * noise).astype(np.float32)
    at = np.unique(triple // k)  # the contexts that occur
    one, two = at % k, at // k
    observed = np.zeros((len(at), k), np.float32)
    if len(triple):
        np.add.at(observed, (np.searchsorted(at, triple // k), triple % k), (count / count.sum()).astype(np.float32))
    contrast = observed.sum(1, keepdims=True) * (NOISE * noise).astype(np.float32)
    of_one, of_two = (np.eye(k, dtype=np.float32)[x].T for x in (one, two))
    before = -np.inf
    for step in range(steps if len(triple) else 0):
        query = near * context[one] + far * context[two]
        margin = query @ target.T + (bias - log_noise)
        chance = 1 / (1 + np.exp(np.minimum(-margin, 80)))  # that a class is an observed one
        if step % EVERY == 0:
            gain = float((observed * np.log(chance + 1e-30) + contrast * np.log(1 - chance + 1e-30)).sum(dtype=np.float64))
            if gain - before < SETTLED * abs(gain) and step:
                break
            before = gain
        slope_of = observed * (1 - chance) - contrast * chance  # of the log-likelihood
        slope = slope_of @ target
        to_one, to_two = of_one @ slope, of_two @ slope
        slopes = [
            to_one * near + to_two * far,
            slope_of.T @ query,
            (to_one * context).sum(0),
            (to_two * context).sum(0),
            slope_of.sum(0),
        ]
        rate = 0.05 * (1 - step / steps) + 0.0005
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-12)
    table = np.empty((k, k, k), np.float32)
    for two in range(k):
        score = (near * context + far * context[two]) @ target.T + bias
        score[:, BEGIN] = -np.inf
        top = score.max(1, keepdims=True)
        table[two] = (score - top - np.log(np.exp(score - top).sum(1, keepdims=True))) / np.log(10)
    return table


@dataclass(frozen=True)
class Model:
    """Counts of the training text and the trained class model. ``counts`` has ``word, n`` of every training word."""

    counts: DataFrame
    words: Words
    table: np.ndarray
    tokens: int
    distinct: int
    texts: int


def fit(docs: DataFrame, train_col: str, text_col: str = "text") -> Model:
    """Learn from the documents whose ``train_col`` is true; null text is empty."""
    spark = docs.sparkSession
    texts = docs.where(F.col(train_col)).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(_word_counts, "word long, form int, n long").groupBy("word").agg(F.min("form").alias("form"), F.sum("n").alias("n"))
    counts = landed(counted, "words")
    n_texts = texts.count()
    by_form = counts.groupBy("form").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    tokens, distinct = sum(r["n"] for r in by_form) + n_texts, sum(r["kinds"] for r in by_form) + (n_texts > 0)
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    word, kind, n = (top.column(x).to_numpy() for x in ("word", "form", "n"))
    kind = kind.astype(np.uint8) + (CLASSES - FORMS)
    mass = np.zeros(CLASSES)
    for r in by_form:
        mass[CLASSES - FORMS + r["form"]] += r["n"] + ADDED * r["kinds"]
    single = np.arange(len(n)) < SINGLE
    np.subtract.at(mass, kind[single], n[single] + ADDED)
    kind[single] = 2 + np.flatnonzero(single)
    order = np.argsort(word.view(np.uint64))
    words = Words(word.view(np.uint64)[order], kind[order], np.log10(n[order] + ADDED), np.log10(np.maximum(mass, 0) + ADDED))
    triples = texts.mapInArrow(_triples(spark.sparkContext.broadcast(words)), "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).toArrow()
    triple, count = triples.column("triple").to_numpy(), triples.column("n").to_numpy()
    order = np.argsort(triple)
    return Model(counts.select("word", "n"), words, train(triple[order], count[order]), tokens, distinct, n_texts)


_SCORED = ("n_tokens", "n_known", "base_score", "score")


def _score(model, known_end: int, log_end: float, log_all: float, kept: list[str], rare_col: str) -> Callable:
    """Tokens, known words, and both scores as far as the frequent words go; other words count as unseen and are listed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = model.value
        flat = table.reshape(-1)
        for batch in c.slices(batches, "text"):
            found, hashes, width = _tokens(batch)
            kind, log_count, frequent = words.classes(found, hashes)
            triple, doc, _ = _contexts(kind, width)
            of = np.repeat(np.arange(len(width)), width)
            m = len(width)
            inner = np.where(kind >= CLASSES - FORMS, log_count - words.log_mass[kind], 0.0)
            score = np.bincount(doc, flat[triple], minlength=m) + np.bincount(of, inner, minlength=m)
            base = np.bincount(of, log_count, minlength=m) + log_end - (width + 1) * log_all
            rare = np.flatnonzero(~frequent)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(of[rare], minlength=m))]).astype(np.int32)
            columns = {n: batch.column(n) for n in kept}
            columns |= {
                "n_tokens": pa.array(width + 1),
                "n_known": pa.array(np.bincount(of, frequent, minlength=m).astype(np.int64) + known_end),
                "base_score": pa.array(base),
                "score": pa.array(score),
                rare_col: pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[rare].view(np.int64))),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def score(docs: DataFrame, train_col: str, text_col: str = "text") -> DataFrame:
    """All columns but the text, and ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` per document.

    Words are runs of anything but ASCII white space, A-Z lower-cased; each text ends with one more token. ``base_score``
    sums log10((c+0.1)/(N+0.1(V+1))) over the tokens, ``score`` is the model's log10 probability of the text. Null and
    empty texts are an end alone; null in ``train_col`` means not trained on; repeated rows count each; an empty table
    gives an empty one; columns of the added names are replaced.
    """
    text_col = c.named(docs, text_col)
    spark = docs.sparkSession
    docs = docs.drop(*_SCORED, "train_tokens")
    names = [n for n in docs.columns if n != text_col]
    model = fit(docs, train_col, text_col)
    held = spark.sparkContext.broadcast((model.words, model.table))
    rare, row = c.fresh(docs, "rare_words"), c.fresh(docs, "text_row")
    log_end, log_all = np.log10(model.texts + ADDED), np.log10(model.tokens + ADDED * (model.distinct + 1))
    work = docs.select(F.struct(*names).alias("kept"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType(
        [
            work.schema["kept"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField(rare, T.ArrayType(T.LongType())),
        ]
    )
    scored = work.mapInArrow(_score(held, int(model.texts > 0), float(log_end), float(log_all), ["kept"], rare), schema)
    scored = landed(scored.withColumn(row, F.monotonically_increasing_id()), "scores")
    unseen = scored.select(F.col(row).alias("row"), F.explode(rare).alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    seen = unseen.join(model.counts, "word").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * (F.log10(F.col("n") + ADDED) - float(np.log10(ADDED)))).alias("gain"))
    out = scored.join(seen, F.col(row) == F.col("row"), "left")
    gain, known = F.coalesce("gain", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return out.select("kept.*", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + gain).alias("base_score"), (F.col("score") + gain).alias("score"))
