"""Chat formatting: reply trees to conversations with a loss mask.

Self-joins by pointer doubling make jump tables in log2(depth) rounds. Every leaf climbs them to its root, which gives the
length and the score of its path; the best leaves of each conversation are followed once more, message by message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.scratch import landed

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_TAIL = CLOSE + "\n"


def escape(text: Column) -> Column:
    """Puts one backslash more between ``<`` and ``|`` wherever only backslashes stand between them, so no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line: backslash as ``\\b``, line feed as ``\\n``."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def thread(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, id, parent, role, text, score`` of conversations without branches: each row answers the one before it.

    Rows are in order of turn (nulls first), role and text; repeated rows are turns of their own.
    """
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    picked = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    numbered = picked.withColumn("id", F.row_number().over(order).cast("long"))
    return numbered.select("conv", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _on(conv: str, node: str) -> Column:
    """Join with a jump table whose columns are ``conv2, id2``."""
    return F.col(conv).eqNullSafe(F.col("conv2")) & (F.col(node) == F.col("id2"))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Jump tables ``conv2, id2, up, gain``: table ``k`` leads ``2**k`` answers up, for messages with so many above them.

    ``gain`` is the score of the messages left behind. Only messages that can still climb take part in the next round.
    """
    first = nodes.where("parent is not null").select(F.col("conv").alias("conv2"), F.col("id").alias("id2"), F.col("parent").alias("up"), F.col("score").alias("gain"))
    tables, most = [landed(first, "jumps")], nodes.count()
    while 2 ** len(tables) <= most and not tables[-1].isEmpty():
        low = tables[-1].toDF("conv", "id", "mid", "low")
        step = low.join(tables[-1], _on("conv", "mid")).select(F.col("conv").alias("conv2"), F.col("id").alias("id2"), "up", (F.col("low") + F.col("gain")).alias("gain"))
        tables.append(landed(step, "jumps"))
    return tables


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``conv, leaf, rank, at, id``: the messages (``at`` counts from 1 at the root) on the ``best`` root-to-leaf paths of each conversation.

    Paths are ranked by the sum of their scores, then by length, then by the smaller leaf id.
    """
    nodes = messages.select("conv", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("conv").alias("conv2"), F.col("id").alias("id2"))
    nodes = nodes.join(known, _on("conv", "parent"), "left").select("conv", "id", F.col("id2").alias("parent"), "score")  # an answer to no known message starts a tree
    nodes = landed(nodes, "nodes")
    jumps = _jumps(nodes)
    answered = nodes.where("parent is not null").select(F.col("conv").alias("conv2"), F.col("parent").alias("id2")).distinct()
    ends = nodes.join(answered, _on("conv", "id"), "left_anti")
    ends = ends.select("conv", F.col("id").alias("leaf"), F.col("id").alias("top"), F.lit(0).alias("below"), F.lit(0.0).alias("total"))
    for k in reversed(range(len(jumps))):  # climb to the root, farthest jumps first
        up = F.coalesce("up", "top").alias("top"), (F.col("below") + F.when(F.col("up").isNotNull(), 2**k).otherwise(0)).alias("below")
        ends = ends.join(jumps[k], _on("conv", "top"), "left").select("conv", "leaf", *up, (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"))
    roots = nodes.where("parent is null").select(F.col("conv").alias("conv2"), F.col("id").alias("id2"), F.col("score").alias("gain"))
    ends = ends.join(roots, _on("conv", "top")).withColumn("total", F.col("total") + F.col("gain"))
    order = Window.partitionBy("conv").orderBy(F.desc("total"), F.desc("below"), "leaf")
    path = ends.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    path = path.select("conv", "leaf", "rank", (F.col("below") + 1).alias("at"), F.col("leaf").alias("id"))
    for k in reversed(range(len(jumps))):  # distances whose bit k is set
        joined = path.join(jumps[k], _on("conv", "id"), "left")
        here = F.struct(F.col("at"), F.col("id"))
        there = F.when(F.col("up").isNotNull(), F.struct((F.col("at") - 2**k).alias("at"), F.col("up").alias("id")))
        both = joined.select("conv", "leaf", "rank", F.explode(F.filter(F.array(here, there), lambda x: x.isNotNull())).alias("x"))
        path = both.select("conv", "leaf", "rank", "x.at", "x.id")
    return path


def format_trees(messages: DataFrame, best: int = 1, loss_role: str = "assistant") -> DataFrame:
    """``conv, leaf, rank, n_turns, text, loss_spans``: each chosen path as one conversation.

    ``messages`` has ``conv, id, parent, role, text, score``; other columns are left out. A turn is
    ``<|im_start|>role\\ntext<|im_end|>\\n`` with control strings inside role and text escaped reversibly; ``loss_spans``
    are the code point ranges (start from 0, length) of the texts said by ``loss_role``. Null role or text is empty, null
    score 0; a null id counts as an unanswered message of its own; of messages that share an id the least by parent,
    role, text and score counts; an unknown parent makes a root; messages that answer each other in a circle lead to no
    root and are not formatted; an empty table gives an empty one.
    """
    texts = messages.select(
        "conv",
        F.coalesce(F.col("id").cast("long"), -1 - F.monotonically_increasing_id()).alias("id"),
        F.col("parent").cast("long").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    texts = texts.groupBy("conv", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("conv", "id", "m.*")
    texts = landed(texts, "messages")
    chosen = paths(texts, best).toDF("conv", "leaf", "rank", "at", "id")
    said = texts.select(F.col("conv").alias("conv2"), F.col("id").alias("id2"), F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("loss"))
    turns = chosen.join(said, _on("conv", "id"))
    sizes = F.length("head") + F.length("body") + len(_TAIL)
    before = Window.partitionBy("conv", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", (F.coalesce(F.sum(sizes).over(before), F.lit(0)) + F.length("head")).cast("int"))
    turn = F.struct("at", F.concat("head", "body", F.lit(_TAIL)).alias("piece"), "start", F.length("body").alias("length"), "loss")
    listed = turns.groupBy("conv", "leaf").agg(F.first("rank").alias("rank"), F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return listed.select(
        "conv", "leaf", "rank", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"), spans.alias("loss_spans")
    )


def read_turns(text: Column) -> Column:
    """Role and text of every turn of a formatted conversation."""

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        role = F.substr(piece, F.lit(1), at - 1)
        body = F.substr(piece, at + 1, F.length(piece) - at - len(_TAIL))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, OPEN.replace("|", r"\|"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)


def read_loss(text: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, each span once and in order."""
    said = F.transform(F.transform(F.array(F.struct(text.alias("t"), spans.alias("s"))), lambda x: F.transform(x["s"], lambda s: unescape(F.substr(x["t"], s["start"] + 1, s["length"])))), lambda a: F.array_join(a, ""))
    return F.element_at(said, 1)
