"""N-gram Jaccard join by T-occurrence search over inverted lists (DivideSkip).

Documents with equal shingle sets are one class. Of a class with ``n`` shingles a partner must share ``T`` of them, so it
shares one of the ``n - T + 1`` rarest: only the lists of these are merged across the cluster, and the ``T - 1`` longer
ones are left to probing. Which shingles count as rare is an estimate and touches the cost alone.

A list never gives all pairs of its classes. First each class is paired with one class of each of its lists, drawn by hash;
links found join components. Then only classes of different components in one list are held against each other, and a
list gives out a spanning forest of the pairs it cannot rule out. To rule pairs out there are sketches: a set's hash range is
cut into parts and each part summed to one byte. A shingle that only one set has changes one part at most, so pairs with
more differing parts than a link may have differing shingles are out, and no link is lost.

Pairs that stay open join clusters, and every link lies inside one. A cluster's sets are dealt to blocks; a task gets two
blocks, each set once, searches partners by DivideSkip and gives out only links that join two components.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm import common as c
from tidewright.llm.components import components
from tidewright.llm.scratch import landed

#: Shingles with the highest counts, broadcast to put them last in the order of rarity.
HEAVY = 100_000
#: Counts from which a list is so long that no single task may read it.
LONG = 10_000
#: Bits of the filter that tells which documents' sets are needed; a fixed size, false hits cost time only.
FILTER_BITS = 1 << 25
#: Classes of a list, and bytes and number of a cluster's sets, that form a block; a task holds two blocks.
LIST_BLOCK = 4_000
SET_BLOCK = 8 << 20
SETS = 128
#: Parts that rows of one class are dealt to when they learn their component.
SALT = 8
#: Weight of probing against merging in the choice of how many lists to probe.
MU = 0.01


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any partner of a set of ``n`` shares with it."""
    return -(-percent * n // 100)


def most_apart(n, percent: int):
    """Shingles that two linked sets of ``n`` together may not share, counted on both sides; ``n`` may be an array."""
    return n - 2 * -(-percent * n // (100 + percent))


def sketch(one: np.ndarray, percent: int) -> np.ndarray:
    """Byte sums of the parts of a set's hash range: two to four times as many parts as shingles may differ."""
    bits = max(3, (2 * most_apart(2 * len(one), percent)).bit_length())
    part = (one >> np.uint64(64 - bits)).view(np.int64)
    return (np.bincount(part, (one & np.uint64(255)).astype(np.float64), minlength=1 << bits) % 256).astype(np.uint8)


def parts_apart(a: np.ndarray, b: np.ndarray) -> int:
    """Parts in which two sketches differ; the finer one is summed up to the other's parts."""
    if len(a) < len(b):
        a, b = b, a
    return int((a.reshape(len(b), -1).sum(axis=1, dtype=np.uint8) != b).sum())


def _sets(texts: list[bytes], k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct shingle hashes of each text, and all of them."""
    words, counts = c.flat([c.lower_words(t) for t in texts])
    hashes = c.word_hashes(words)
    shingles = c.rolling(hashes, k)
    out, begin = [], 0
    for n in counts.tolist():
        one = shingles[begin : begin + n - k + 1] if n >= k else c.rolling(hashes[begin : begin + n], n) if n else hashes[:0]
        out.append(np.unique(one))
        begin += n
    return out, np.concatenate(out) if out else hashes[:0]


def _name(one: np.ndarray) -> int:
    """64-bit name of a set, as a signed integer."""
    return xxhash.xxh3_64_intdigest(one.tobytes()) - 2**63


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _describe(k: int, percent: int) -> Callable:
    """A row per document (``heavy`` null), and rows of shingles that are frequent in a batch with their count in ``n``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, "text"):
            sets, every = _sets(c.texts(batch.column("text")), k)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "fp": batch.column("fp"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([_name(s) for s in sets], pa.int64()),
                    "sketch": pa.array([sketch(s, percent).tobytes() for s in sets], pa.binary()),
                    "heavy": pa.nulls(len(sets), pa.int64()),
                }
            )
            shingle, count = np.unique(every, return_counts=True)
            often = np.flatnonzero(count > 2)
            often = often[np.argsort(-count[often], kind="stable")[: HEAVY // 4]]
            if len(often):
                none = pa.nulls(len(often), pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {"id": none, "fp": none, "n": pa.array(count[often].astype(np.int64)), "node": none, "sketch": pa.nulls(len(often), pa.binary()), "heavy": pa.array(_signed(shingle[often]))}
                )

    return run


def _postings(k: int, percent: int, heavy) -> Callable:
    """The rarest shingles of each set that can link with another: ``n - T + 1`` of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = heavy.value
        for batch in c.slices(batches, "text"):
            tokens, nodes, sizes, often = [], [], [], []
            for one in _sets(c.texts(batch.column("text")), k)[0]:
                n = len(one)
                if n * (100 - percent) < percent:  # one shingle more or less is already too much
                    continue
                rank = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, one), len(known) - 1)
                    rank = np.where(known[at] == one, counts[at], 0)
                first = np.lexsort((one, rank))[: n - least_overlap(n, percent) + 1]
                tokens.append(one[first])
                often.append(rank[first] >= LONG)
                nodes.append(_name(one))
                sizes.append(n)
            if not tokens:
                continue
            width = [len(t) for t in tokens]
            yield pa.RecordBatch.from_pydict(
                {
                    "token": pa.array(_signed(np.concatenate(tokens))),
                    "node": pa.array(np.repeat(np.array(nodes, np.int64), width)),
                    "n": pa.array(np.repeat(np.array(sizes, np.int32), width)),
                    "hot": pa.array(np.concatenate(often)),
                }
            )

    return run


def _filter_places(key):
    """The two bits of a document in the filter."""
    return F.array(F.pmod(F.xxhash64(F.lit(1), *key), F.lit(FILTER_BITS)), F.pmod(F.xxhash64(F.lit(2), *key), F.lit(FILTER_BITS)))


def _bits(spark: SparkSession, keys: DataFrame):
    """Broadcast filter over ``id, fp``; at most ``FILTER_BITS / 64`` numbers reach the driver."""
    places = keys.select(F.explode(_filter_places(("id", "fp"))).alias("p"))
    words = places.groupBy((F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
    found = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found.column("w").to_numpy()] = found.column("v").to_numpy()
    return spark.sparkContext.broadcast(out)


def _needed_sets(k: int, bits) -> Callable:
    """Sets of the documents in the filter, as sorted 48-bit numbers of six bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bits.value
        for batch in c.slices(batches, "text"):
            places = np.array(batch.column("places").to_pylist(), np.int64).reshape(-1, 2)
            inside = ((words[places >> 6] >> (places & 63)) & 1).all(axis=1)
            if not inside.any():
                continue
            sets, _ = _sets(c.texts(batch.column("text").filter(pa.array(inside))), k)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([_name(s) for s in sets], pa.int64()),
                    "shingles": pa.array([np.unique(s >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets], pa.binary()),
                }
            )

    return run


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """How often each number occurs in sorted lists, for those that occur ``least`` times or more.

    The longest lists are set aside; the others are merged through a heap, and what occurs in them often enough that the
    long ones could make up the rest is looked up in these by binary search.
    """
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < least:
        return {}
    aside = min(least - 1, int(least / (MU * log(len(lists[-1]) + 1) + 1)))
    short, long_ones = lists[: len(lists) - aside], lists[len(lists) - aside :]
    out: dict[int, int] = {}
    last, count = None, 0
    for x in [*heapq.merge(*short), None]:
        if x == last:
            count += 1
            continue
        if last is not None and count >= least - aside:
            left = aside
            for probe in long_ones:
                at = bisect_left(probe, last)
                if at < len(probe) and probe[at] == last:
                    count += 1
                left -= 1
                if count + left < least:
                    break
            if count >= least:
                out[last] = count
        last, count = x, 1
    return out


def _unpack(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def links_of(one: np.ndarray, others: list[np.ndarray], percent: int) -> list[int]:
    """Indexes of the sets whose Jaccard similarity with ``one`` is ``percent`` or more."""
    place, who = [], []
    for i, other in enumerate(others):
        at = np.minimum(np.searchsorted(one, other), len(one) - 1)
        hit = at[one[at] == other]
        place.append(hit)
        who.append(np.full(len(hit), i))
    place, who = np.concatenate(place), np.concatenate(who)
    order = np.lexsort((who, place))
    lists = [x.tolist() for x in np.split(who[order], np.cumsum(np.bincount(place, minlength=len(one)))[:-1])]
    found = divide_skip(lists, max(1, least_overlap(len(one), percent)))
    return [i for i, same in found.items() if 100 * same >= percent * (len(one) + len(others[i]) - same)]


class _Near:
    """Which sets of a block neither sizes nor sketches rule out as partners of one; sketches of one width lie together."""

    def __init__(self, n: np.ndarray, sketches: list[np.ndarray], percent: int):
        self.n, self.sketches, self.percent = n, sketches, percent
        width = np.array([len(x) for x in sketches])
        self.blocks = [(at := np.flatnonzero(width == w), np.stack([sketches[i] for i in at])) for w in np.unique(width).tolist()]

    def of(self, i: int, among: np.ndarray) -> np.ndarray:
        """Indexes, of those that the mask ``among`` leaves."""
        mine, n, out = self.sketches[i], self.n, []
        for at, block in self.blocks:
            keep = among[at]
            keep &= np.minimum(n[at], n[i]) * 100 >= np.maximum(n[at], n[i]) * self.percent
            if not keep.any():
                continue
            at, block = at[keep], block[keep]
            w = block.shape[1]
            one = mine.reshape(w, -1).sum(axis=1, dtype=np.uint8) if w < len(mine) else mine
            if w > len(mine):
                block = block.reshape(len(at), len(mine), -1).sum(axis=2, dtype=np.uint8)
            out.append(at[(block != one).sum(axis=1) <= most_apart(n[at] + n[i], self.percent)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def open_forest(n: np.ndarray, label: np.ndarray, block: np.ndarray, sketches: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of one list, in different components, that neither sizes nor sketches rule out.

    Where the classes come from two blocks, pairs within a block are another task's.
    """
    near, left, two = _Near(n, sketches, percent), np.ones(len(n), bool), bool((block != block[0]).any())
    edges = []
    for start in range(len(n)):
        if not left[start]:
            continue
        left[start] = False
        stack = [start]
        while stack:
            i = stack.pop()
            among = left & (label != label[i])
            if two:
                among &= block != block[i]
            met = near.of(i, among) if among.any() else ()
            if len(met):
                left[met] = False
                edges += [(i, j) for j in met.tolist()]
                stack += met.tolist()
    return edges


def link_forest(label: np.ndarray, block: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets, as far as they join two components; ``label`` names those that are known."""
    root = {x: x for x in np.unique(label).tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    n, two = np.array([len(x) for x in sets]), bool((block != block[0]).any())
    near, edges, names = _Near(n, [sketch(x, percent) for x in sets], percent), [], label.tolist()
    for i in range(len(sets)):
        among = np.zeros(len(sets), bool)
        among[i + 1 :] = (block[i + 1 :] != block[i]) if two else True
        met = near.of(i, among).tolist() if among.any() else []
        for begin in range(0, len(met), 256):
            mine = find(names[i])
            rest = [j for j in met[begin : begin + 256] if find(names[j]) != mine]
            for j in links_of(sets[i], [sets[j] for j in rest], percent) if rest else ():
                a, b = find(names[i]), find(names[rest[j]])
                if a != b:
                    root[a] = b
                    edges.append((i, rest[j]))
    return edges


def _groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of one key after the other, from sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        opens = np.append(True, np.any([x[1:] != x[:-1] for x in columns], axis=0))
        first, length = c.runs(opens[: batch.num_rows])
        for f, m in zip(first.tolist(), length.tolist(), strict=True):
            key = tuple(x[f] for x in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(f, m))
    if held:
        yield pa.Table.from_batches(held)


def _edges(node: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (node[[e[i] for e in edges]] if edges else np.zeros(0, np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


def _open(percent: int) -> Callable:
    """Forests of the open pairs of lists, from rows sorted by token and blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _groups(batches, ("token", "i", "j")):
            node, n, label, block = (one.column(x).to_numpy() for x in ("node", "n", "label", "block"))
            sketches = [np.frombuffer(x, np.uint8) for x in one.column("sketch").to_pylist()]
            yield _edges(node, open_forest(n, label, block, sketches, percent))

    return run


def _links(percent: int) -> Callable:
    """Forests of the links of clusters, from rows sorted by cluster and blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _groups(batches, ("cluster", "i", "j")):
            node, label, block = (one.column(x).to_numpy() for x in ("node", "label", "block"))
            if len(node) > 1:
                yield _edges(node, link_forest(label, block, [_unpack(x) for x in one.column("shingles").to_pylist()], percent))
        c.release()

    return run


def _in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """A row for each pair of blocks ``i <= j`` that the row's own ``block`` is one of; of a single block, just one."""
    own = rows.withColumn("__of", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("__of")).cast("int"))
    spread = own.withColumn("__x", F.explode(F.sequence(F.lit(0), F.col("__of") - 1)))
    return spread.withColumns({"i": F.least("block", "__x"), "j": F.greatest("block", "__x")}).drop("__of", "__x")


def _possible(percent: int) -> Callable:
    """Pairs that their sketches do not rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            size = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()).tolist()
            near = [parts_apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= most_apart(n, percent) for x, y, n in zip(left, right, size, strict=True)]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in ("a", "b")], names=["a", "b"])

    return run


def _not_ruled_out(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches leave open."""
    for side, other in (("a", "left"), ("b", "right")):
        pairs = pairs.join(known.select(F.col("node").alias(side), F.col("size").alias(f"n{side}"), F.col("sketch").alias(other)), side)
    return pairs.mapInArrow(_possible(percent), "a long, b long")


def _linked(pairs: DataFrame, labels: DataFrame | None, rows: DataFrame, keyed: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that join the components ``node, label``, among all sets of each cluster that open pairs connect.

    Sets are made again from the texts of one document for each class that is still in question.
    """
    clusters = components(pairs).withColumnRenamed("label", "cluster")
    chosen = rows.join(clusters, "node", "left_semi").groupBy("node").agg(F.min(F.struct("id", "fp")).alias("x")).select("x.id", "x.fp")
    bits = _bits(keyed.sparkSession, chosen)
    wanted = keyed.where("text is not null").select("text", _filter_places((F.col("id"), F.col("fp"))).alias("places"))
    sets = wanted.mapInArrow(_needed_sets(k, bits), "node long, shingles binary").dropDuplicates(["node"])
    sets = sets.join(clusters, "node")
    known = sets.join(labels, "node", "left") if labels is not None else sets.withColumn("label", F.col("node"))
    known = landed(known.withColumn("label", F.coalesce("label", "node")), "cluster-sets")
    most = F.greatest(F.sum(F.length("shingles")) / SET_BLOCK, F.count("*") / SETS)
    sizes = known.groupBy("cluster").agg(F.ceil(most).alias("blocks"))
    dealt = _in_blocks(known.join(sizes, "cluster"), F.col("blocks")).drop("blocks")
    key = ["cluster", "i", "j"]
    return landed(dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_links(percent), "a long, b long").distinct(), "links")


def _pairs(x: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of ``node, n`` and ``node2, n2`` whose sizes allow a link."""
    near = (F.col("node") != F.col("node2")) & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
    return x.where(near).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def classes(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents as ``id, fp, n, node`` (``node`` names the shingle set), and ``node, label`` for sets linked with others."""
    spark = docs.sparkSession
    keyed = docs.select(c.ordered_id(id_col).alias("id"), c.fingerprint(text_col).alias("fp"), F.col(text_col).cast("string").alias("text"))
    described = landed(keyed.mapInArrow(_describe(k, percent), "id long, fp long, n long, node long, sketch binary, heavy long"), "described")
    rows = described.where("heavy is null")
    top = described.where("heavy is not null").groupBy("heavy").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "heavy").limit(HEAVY).toArrow()
    token, count = top.column("heavy").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(token)
    heavy = spark.sparkContext.broadcast((token[order], count[order]))

    postings = keyed.where("text is not null").mapInArrow(_postings(k, percent, heavy), "token long, node long, n int, hot boolean")
    # A class stays in a list if another one there has a size that a link allows.
    reach = int(1_000_000 * log(100 / percent)) + 3  # millionths of the logarithm, rounded towards more
    of_token = Window.partitionBy("token").orderBy(F.floor(F.log(F.col("n").cast("double")) * 1_000_000)).rangeBetween(-reach, reach)
    shared = postings.where("not hot").withColumns({"lo": F.min("node").over(of_token), "hi": F.max("node").over(of_token)}).where("lo <> hi")
    lists = landed(shared.select("token", "node", "n").union(postings.where("hot").select("token", "node", "n")), "lists")

    drawn = lists.groupBy("token").agg(F.min(F.struct(F.xxhash64("node", "token").alias("h"), F.col("node").alias("node2"), F.col("n").alias("n2"))).alias("d")).select("token", "d.node2", "d.n2")
    known = rows.groupBy("node").agg(F.first("n").alias("size"), F.first("sketch").alias("sketch"))
    near = _not_ruled_out(_pairs(lists.join(drawn, "token"), percent), known, percent)
    first = _linked(near, None, rows, keyed, k, percent)
    labels = components(first)

    marked = lists.join(labels, "node", "left").select("token", "node", "n", F.coalesce("label", "node").alias("label"))
    marked = landed(marked.distinct(), "marked")
    sizes = marked.groupBy("token").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    blocks = sizes.select("token", F.ceil(F.col("m") / LIST_BLOCK).alias("blocks"))
    open_lists = _in_blocks(marked.join(blocks, "token"), F.col("blocks")).join(known, "node")
    open_lists = open_lists.select("token", "i", "j", "block", "node", F.col("n").cast("long").alias("n"), "label", "sketch")
    key = ["token", "i", "j"]
    apart = open_lists.repartition(*key).sortWithinPartitions(*key).mapInArrow(_open(percent), "a long, b long").distinct()
    second = _linked(apart, labels, rows, keyed, k, percent)
    return rows.select("id", "fp", "n", "node"), components(first.union(second))


def link_documents(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, n_shingles, component_id`` for every row: ``component_id`` is the least id that links lead to.

    Two documents link if 100 times their common ``k``-word shingles are ``percent`` times all their shingles or more.
    Words are lower-cased (A-Z). A text of fewer than ``k`` words has its whole sequence as its one shingle; texts without
    words (null, empty) have none and link with nothing. ``fp`` is a hash of the text; repeated rows give a row each; a
    null id comes last and stays null where no other id is linked; an empty table gives an empty one.
    """
    rows, labels = classes(docs, k, percent, id_col, text_col)
    # Least ids of classes, then of components of classes; only then the rows learn them, rows of one class in parts.
    least = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    named = least.join(labels, "node", "left")
    group = named.where("label is not null").groupBy("label").agg(F.min("least").alias("group_least"))
    told = named.join(group, "label", "left").where((F.col("rows") > 1) | F.col("label").isNotNull())
    told = told.select("node", F.coalesce("group_least", "least").alias("least"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "fp"), F.lit(SALT)).cast("int"))
    out = salted.join(told, ["node", "salt"], "left")
    own = F.when((F.col("n") > 0), F.coalesce("least", "id")).otherwise(F.col("id"))
    real = lambda x: F.when(x != c.LAST_ID, x)
    return out.select(real(F.col("id")).alias("id"), "fp", F.col("n").alias("n_shingles"), real(own).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group that links connect: the one with the least id (of rows that share it, the least text hash).

    Documents without words link with nothing and all stay. Rows equal in id and text count once.
    """
    rows, labels = classes(docs, k, percent, id_col, text_col)
    marked = rows.join(labels, "node", "left").withColumn("group", F.coalesce("label", "node"))
    stay = marked.where("n > 0").groupBy("group").agg(F.min(F.struct("id", "fp")).alias("x")).select("x.id", "x.fp")
    stay = stay.union(marked.where("n = 0").select("id", "fp")).distinct()
    id_key, fp_key = (c.fresh(docs, x) for x in ("class_id", "class_fp"))
    keyed = docs.withColumn(id_key, c.ordered_id(id_col)).withColumn(fp_key, c.fingerprint(text_col))
    joined = keyed.join(stay.toDF(id_key, fp_key), [id_key, fp_key])
    return joined.groupBy(id_key, fp_key).agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
