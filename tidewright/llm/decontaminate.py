"""Benchmark decontamination: words of documents that lie in a passage of a test item.

The n-grams of the test items are a broadcast hash set. Its size is checked: items are dealt into blocks of at most
``BLOCK_BYTES`` of text, and the documents pass by one block after the other, each adding to what the last has found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c

#: Most text of test items, in bytes, that one broadcast holds.
BLOCK_BYTES = 32 << 20


class Grams:
    """N-grams of test items by length: sorted hashes, with the words and items behind each."""

    def __init__(self, items: list[tuple], n: int):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found: dict[int, dict[int, dict[tuple, set]]] = {}
        for item, text in items:
            words = c.letter_words((text or "").encode())
            size = min(n, len(words))
            if not size:
                continue
            for at, h in enumerate(c.rolling(c.word_hashes(words), size).tolist()):
                found.setdefault(size, {}).setdefault(h, {}).setdefault(tuple(words[at : at + size]), set()).add(item)
        self.items = found
        for size, grams in found.items():
            hashes = np.array(sorted(grams), np.uint64)
            seen = np.zeros(1 << 20, bool)  # most windows are turned away by 20 bits of their hash
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[size] = hashes, seen

    def hits(self, words: list[bytes], hashes: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """Place, length and items of every window of ``words`` that is an n-gram of an item, after comparing the words."""
        for size, (known, seen) in self.by_length.items():
            value = c.rolling(hashes, size)
            at = np.flatnonzero(seen[(value >> np.uint64(44)).view(np.int64)])
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(known, value[at]), len(known) - 1)
            for i in at[known[place] == value[at]].tolist():
                if items := self.items[size][int(value[i])].get(tuple(words[i : i + size])):
                    yield i, size, items


def _scan(grams, text: str, spans: str, items: str, counted: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = grams.value
        for batch in c.slices(batches, text):
            words, counts = c.flat([c.letter_words(t) for t in c.texts(batch.column(text))])
            doc = np.repeat(np.arange(len(counts)), counts)
            begin = np.cumsum(counts) - counts
            found = [(list(s or []), set(i or [])) for s, i in zip(batch.column(spans).to_pylist(), batch.column(items).to_pylist(), strict=True)]
            for at, size, of in known.hits(words, c.word_hashes(words)):
                d = int(doc[at])
                if doc[at + size - 1] == d:
                    start = int(at - begin[d])
                    cuts = found[d][0]
                    if cuts and cuts[-1]["start"] <= start <= cuts[-1]["stop"]:  # goes on from the last window
                        cuts[-1]["stop"] = max(cuts[-1]["stop"], start + size)
                    else:
                        cuts.append({"start": start, "stop": start + size})
                    found[d][1].update(of)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[spans] = pa.array([s for s, _ in found], batch.schema.field(spans).type)
            columns[items] = pa.array([sorted(x for x in i if x is not None) for _, i in found], batch.schema.field(items).type)
            columns[counted] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_pydict(columns, schema=batch.schema)

    return run


def _digest(spans: str, hit: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged, total = [], []
            for cuts in batch.column(spans).to_pylist():
                out: list[dict] = []
                for cut in sorted(cuts or [], key=lambda x: x["start"]):
                    if out and cut["start"] <= out[-1]["stop"]:
                        out[-1]["stop"] = max(out[-1]["stop"], cut["stop"])
                    else:
                        out.append(dict(cut))
                merged.append(out)
                total.append(sum(x["stop"] - x["start"] for x in out))
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[spans] = pa.array(merged, batch.schema.field(spans).type)
            columns[hit] = pa.array(total, pa.int64())
            yield pa.RecordBatch.from_pydict(columns, schema=batch.schema)

    return run


ADDED = ("n_words", "n_hit", "hit_spans", "hit_items")


def find_passages(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit`` (words inside a window of an item), ``hit_spans`` (word ranges, merged) and
    ``hit_items`` (ids of the items, sorted).

    A window is ``n`` consecutive words of an item, or all words of a shorter one. Words are runs of ASCII letters and
    digits (letters lower-cased) and of anything beyond ASCII. Null texts have no words; an item without words or an
    empty benchmark hits nothing; a hit of an item whose id is null counts, without an id to list; repeated documents
    and items change nothing for others; columns of the added names are replaced.
    """
    text_col = c.named(docs, text_col)
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-size // block_bytes))
    kind = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    out = docs.withColumns(
        {
            "n_words": F.lit(None).cast("long"),
            "n_hit": F.lit(None).cast("long"),
            "hit_spans": F.array().cast(T.ArrayType(kind)),
            "hit_items": F.array().cast(T.ArrayType(items.schema["item"].dataType)),
        }
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        grams = spark.sparkContext.broadcast(Grams([tuple(r) for r in part.collect()], n))
        out = out.mapInArrow(_scan(grams, text_col, "hit_spans", "hit_items", "n_words"), schema)
    return out.mapInArrow(_digest("hit_spans", "n_hit"), schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, most_hit: float = 0.0, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents of which at most the share ``most_hit`` of words lies in a passage of the benchmark, as they came."""
    hit = find_passages(docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")), benchmark, n, "text", item_col, item_text)
    return hit.where(F.col("n_hit") <= F.lit(most_hit) * F.col("n_words")).select("row.*")


def remove_passages(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents whose words inside a passage of the benchmark are cut out of the text; the rest of the text stays as it is."""
    text_col = c.named(docs, text_col)
    hit = find_passages(docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")), benchmark, n, "text", item_col, item_text)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(rf"(?:{word.replace('+', '')}|[A-Z])+")
        for batch in batches:
            out = []
            for value, cuts in zip(batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist(), strict=True):
                if cuts:
                    places = [m.span() for m in pattern.finditer(value)]
                    for cut in reversed(cuts):
                        value = value[: places[cut["start"]][0]] + value[places[cut["stop"] - 1][1] :]
                out.append(value)
            columns = {n: batch.column(n) for n in batch.schema.names} | {"text": pa.array(out, pa.string())}
            yield pa.RecordBatch.from_pydict(columns, schema=batch.schema)

    cut = hit.mapInArrow(run, hit.schema)
    return cut.select(*[F.col("text").alias(x) if x == text_col else F.col("row")[x].alias(x) for x in docs.columns])
