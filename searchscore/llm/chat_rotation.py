"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and everyone else as a named user; the speaker's own
words are the trained spans. System turns are instructions, not a participant:
they stay system turns in every rendering and are never trained.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, and a part in pieces
of as many rows, so a conversation of any length is never gathered into one row:
part 0 holds turns 0 .. 63, and so on, and only where numbers repeat or are null
is there more than piece 0. The rendered dialogue is its parts and pieces one
after another. Rows of over-full parts are numbered by ranges: dealt in their
order over all tasks, counted in each range, and moved up by the ranges before.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

#: Turn numbers of a part, and rows of a piece.
PART_TURNS = 64
#: Role that is no participant.
SYSTEM = "system"
#: Name of a participant without a role.
NOBODY = "unknown"
#: Fixed marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>\n"


def _name(role: Column) -> Column:
    """The role as a name: trimmed, inner white space and marks that would end a header as '_'."""
    clean = F.regexp_replace(F.trim(role), r"[\s<>|]+", "_")
    return F.when(clean.isNull() | (clean == ""), NOBODY).otherwise(clean)


def _plain(text: Column) -> Column:
    """The text with the format's own marks broken up, so that content never ends its turn."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")


def _in_pieces(rows: DataFrame, part_turns: int) -> DataFrame:
    """``rows`` (conv_id, turn, name, body, part) with ``piece``: in each part its rows by
    (turn, name, body), ``part_turns`` a piece."""
    full = cut_lineage(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > part_turns).drop("n"))
    single = rows.withColumn("piece", F.lit(0).cast("long"))
    if full.isEmpty():
        return single
    full = full.select(F.col("conv_id").alias("f_conv"), F.col("part").alias("f_part"))
    is_full = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("part") == F.col("f_part"))
    order = ["turn", "name", "body"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are told apart by their place, so that many of them fall into several ranges
    dealt = (rows.join(full, is_full, "left_semi").withColumn("tie", F.monotonically_increasing_id())
             .repartitionByRange(n, "conv_id", "part", *order, "tie").withColumn("dealt", F.spark_partition_id()))
    dealt = cut_lineage(dealt)
    counts = dealt.groupBy("conv_id", "part", "dealt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id", "part").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1))
    # a group that goes on from one range to the next is the first of the next: one row a range at most
    starts = counts.select(F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part"), F.col("dealt").alias("s_dealt"), before.alias("start")).where("start > 0")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part", "dealt").orderBy(*order)) - 1
    ranked = dealt.withColumn("rank", inside).join(
        F.broadcast(starts), F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("part") == F.col("s_part")) & (F.col("dealt") == F.col("s_dealt")), "left")
    place = F.col("rank") + F.coalesce("start", F.lit(0))
    pieces = ranked.select("conv_id", *order, "part", F.floor(place / part_turns).cast("long").alias("piece"))
    return single.join(full, is_full, "left_anti").unionByName(pieces)


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, piece, text, n_turns, n_chars, train_spans, train_mask).

    One row per conversation, participant, part and piece with turns. ``text`` is the
    rendered part; train_spans are [start, end) code points of the perspective's
    own words and end marks in it; train_mask has one flag per turn.

    Turns go by number, null numbers first (in a part of their own, -1), ties by role
    and text; a piece holds at most ``part_turns`` rows; repeated rows stay. Null or blank roles are a participant
    ``unknown``; null texts are empty turns. Rows of a null conv_id form one
    conversation. A conversation of system turns alone has no participant and no
    row. An empty table gives an empty one; further columns are not read."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), _name(F.col(role)).alias("name"), _plain(F.col(text)).alias("body"))
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long")
    rows = _in_pieces(rows.withColumn("part", part), part_turns)
    parts = rows.groupBy("conv_id", "part", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "name", "body"))).alias("turns"))
    speakers = rows.where(F.col("name") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("name").alias("perspective")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))

    own = lambda t: t["name"] == F.col("perspective")
    header = lambda t: F.concat(F.lit(START), F.when(own(t), "assistant").when(t["name"] == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), t["name"])), F.lit("\n"))
    both = both.withColumn("pieces", F.transform("turns", lambda t: F.struct(header(t).alias("head"), F.concat(t["body"], F.lit(END)).alias("rest"), own(t).alias("train"))))
    both = both.withColumn("lengths", F.transform("pieces", lambda p: F.length(p["head"]) + F.length(p["rest"])))
    # start of each turn: running sum over a part's few lengths
    starts = F.aggregate("lengths", F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    both = both.withColumn("starts", starts)
    spans = F.filter(F.transform("pieces", lambda p, i: F.when(p["train"], F.struct(
        (F.get("starts", i) + F.length(p["head"])).alias("start"), F.get("starts", i + 1).alias("end")))), lambda s: s.isNotNull())
    return both.select(
        "conv_id", "perspective", "part", "piece",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["rest"])), "").alias("text"),
        F.size("turns").cast("long").alias("n_turns"), F.element_at("starts", -1).cast("long").alias("n_chars"),
        spans.alias("train_spans"), F.transform("pieces", lambda p: p["train"].cast("int")).alias("train_mask"))
