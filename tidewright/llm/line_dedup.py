"""Line dedup: a suffix array over line ids, by distributed prefix doubling.

Level ``j`` ranks every place by its next ``2**j`` lines. Ranks follow the order of the sorted pairs (rank here, rank
``2**j`` lines on), so they are the suffix array of what still repeats; a place whose lines occur once drops out. The
places that share a rank form one interval of longest common prefix, and all but its first place hold later copies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import common as c
from tidewright.llm.scratch import landed

_PLACE = ("id", "fp", "pos")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: place and two 64-bit hashes of the line. Rows equal in id and text have their places once, since
    joins of places would multiply them by themselves at every level."""
    line_hashes = F.transform(F.split(text_col, "\n"), lambda x: F.struct(F.xxhash64(x).alias("r1"), F.xxhash64(F.lit(1), x).alias("r2")))
    keyed = docs.where(F.col(text_col).isNotNull()).select(c.ordered_id(id_col).alias("id"), c.fingerprint(text_col).alias("fp"), line_hashes.alias("lines"))
    return keyed.dropDuplicates(["id", "fp"]).select("id", "fp", F.posexplode("lines").alias("pos", "line")).select(*_PLACE, "line.r1", "line.r2")


def _ranked(pairs: DataFrame, name: str) -> DataFrame:
    """Places whose pair occurs again: their rank in the order of pairs, and whether an earlier place has the same."""
    classes = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first")).where("n > 1")
    ranks = classes.orderBy("r1", "r2").select("r1", "r2", "first", F.monotonically_increasing_id().alias("rank"))
    found = pairs.join(ranks, ["r1", "r2"]).select(*_PLACE, "rank", (F.col("first") < F.struct(*_PLACE)).alias("later"))
    return landed(found, name)


def _pairs(places: DataFrame, step: int) -> DataFrame:
    """Each place's rank with that of the place ``step`` lines on; places without such a neighbour occur once."""
    on = places.select("id", "fp", (F.col("pos") - step).alias("pos"), F.col("rank").alias("r2"))
    return places.select(*_PLACE, F.col("rank").alias("r1")).join(on, list(_PLACE))


def repeated_runs(docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, start, stop``: maximal line ranges of each document made of runs of ``min_lines`` lines or more that also
    start at an earlier place (a smaller id, or the same text further up)."""
    lines = landed(_lines(docs, id_col, text_col), "lines")
    places, size, spans = _ranked(lines, "places"), 1, []

    def later(found: DataFrame, length: int) -> DataFrame:
        return found.where("later").select(*_PLACE, (F.col("pos") + length).alias("stop"))

    while not places.isEmpty():
        if size >= min_lines:
            spans.append(later(places, size))
        elif size * 2 > min_lines:  # the shortest runs that count lie between two powers of two
            spans.append(later(_ranked(landed(_pairs(places, min_lines - size), "pairs"), "places"), min_lines))
        places = _ranked(landed(_pairs(places, size), "pairs"), "places")
        size *= 2
    if not spans:
        spans = [later(places, size)]
    longest = reduce(DataFrame.union, spans).groupBy(*_PLACE).agg(F.max("stop").alias("stop"))
    in_order = Window.partitionBy("id", "fp").orderBy("pos")
    reach = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = longest.withColumn("opens", F.when(F.col("pos") <= reach, 0).otherwise(1))
    islands = opens.withColumn("island", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("id", "fp", "island").agg(F.min("pos").alias("start"), F.max("stop").alias("stop")).drop("island")


def remove_repeated_lines(
    docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_blank: bool = False
) -> DataFrame:
    """Documents without later copies of runs of ``min_lines`` equal lines or more; adds ``n_lines`` and ``n_removed``.

    A line goes if some run of ``min_lines`` lines around it also starts at an earlier place: in a document with a
    smaller id (null is the largest), or further up in the same one. Lines are compared whole, by 128 bits of hash. With
    ``keep_blank`` lines without a word stay, wherever they are, so that paragraphs stay apart when single lines go.
    Null text stays null and has no lines, an empty one has one; rows equal in id and text are judged alike and do not
    remove each other's lines; an empty table gives an empty one; columns of the added names are replaced.
    """
    text_col = c.named(docs, text_col)
    docs = docs.drop("n_lines", "n_removed")
    names = docs.columns
    id_key, fp_key, spans = (c.fresh(docs, x) for x in ("line_id", "line_fp", "line_spans"))
    runs = repeated_runs(docs, min_lines, id_col, text_col)
    found = runs.groupBy("id", "fp").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).toDF(id_key, fp_key, spans)
    keyed = docs.withColumn(id_key, c.ordered_id(id_col)).withColumn(fp_key, c.fingerprint(text_col))
    joined = keyed.join(found, [id_key, fp_key], "left")
    lines, gone = c.fresh(joined, "line_list"), c.fresh(joined, "line_gone")
    covered = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["stop"] - 1)))
    split = joined.withColumn(lines, F.split(text_col, "\n"))
    if keep_blank:
        covered = F.filter(covered, lambda i: F.get(F.col(lines), i).rlike(r"[^\x20\x09-\x0D]"))
    split = split.withColumn(gone, F.coalesce(covered, F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(
        F.element_at(F.transform(F.array(F.struct(F.col(lines).alias("a"), kept.alias("k"))), lambda x: F.transform(x["k"], lambda i: F.get(x["a"], i))), 1), "\n"
    )
    text = F.when(F.size(gone) == 0, F.col(text_col)).otherwise(rest)
    others = [F.when(F.col(text_col).isNotNull(), text).alias(n) if n == text_col else F.col(n) for n in names]
    return split.select(*others, F.coalesce(F.when(F.col(text_col).isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_removed"))
