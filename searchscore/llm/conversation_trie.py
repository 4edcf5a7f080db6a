"""Prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of ``BLOCK_TURNS`` turns. Every turn gives a
128-bit term from its place, role and text; the digest of a prefix is the xor of
its terms, so digests of blocks combine in any order and a long conversation is
worked on in segments. Conversations are grouped by the digest up to the end of
each successive block first. Only inside blocks that have siblings (another block
after the same prefix) are turn boundaries refined: one row stands for all
conversations of a block there, and its turns are grouped again by their digests.
All turns of a block without siblings have the block's members.

A node is known by its smallest member and its depth. The nodes with the same
smallest member form a chain down to that conversation's end, so the trie falls
into chains and every node belongs to one. What a chain holds in all counts for
each proper ancestor of its first node; sums over subtrees are therefore
the rest of the node's own chain plus the chains that hang below, and these are
gathered by the same block digests, without walking the tree level by level.

Counts, sums and minima are all combined before they are shuffled, so a first turn
that a third of all conversations share is one row a task.
"""
from __future__ import annotations

from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

from .numbering import numbered

#: Turns of a block.
BLOCK_TURNS = 4
#: Blocks (and in chains: turns) that running sums go over at a time.
SEGMENT = 1024
#: Consecutive conv_ids whose ends in one node are joined into one row.
ID_RANGE = 4096

KEY = ["depth", "q1", "q2"]


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("long")


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, h1, h2, size): the turns of each conversation from 0, with 120 bits of
    the SHA-256 of role and text, and the text's UTF-8 bytes.

    By turn, null first; equal turn numbers by the hash, so repeated rows are turns
    of their own. Null role or text is empty. Rows without conv_id belong to no
    conversation. Texts are hashed where they are read and do not move."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    h = F.sha2(F.concat(F.octet_length(name(role)).cast("string"), F.lit(":"), name(role), name(text)), 256)
    lane = lambda at: F.conv(F.substring("h", at, 15), 16, 10).cast("long")
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), h.alias("h"), F.octet_length(name(text)).cast("long").alias("size"))
    rows = cut_lineage(rows.select("conv", "turn", lane(1).alias("h1"), lane(16).alias("h2"), "size"))
    return numbered(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")], "pos").drop("turn")


def with_lent_turns(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) rebuilt: conversation c begins with the first h turns of c - c mod ``family``
    (all if it has fewer, none if there is none), and goes on with its own after its first h;
    h is the unsigned crc32 of the decimal c, mod ``most``."""
    turns = cut_lineage(turns)
    convs = turns.groupBy("conv").agg(F.count("*").alias("n"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv").cast("string").cast("binary")) % most, "first": F.col("conv") - F.pmod(F.col("conv"), F.lit(family))})
    first_n = convs.select(F.col("conv").alias("first"), F.col("n").alias("first_n"))
    convs = convs.join(first_n, "first", "left")
    lent = F.least(F.col("h"), F.coalesce("first_n", F.lit(0)))
    convs = cut_lineage(convs.select("conv", "h", lent.alias("lent"), (lent + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(convs, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "h1", "h2", "size", "length")
    to = turns.where((F.col("pos") < most - 1) & (F.pmod(F.col("conv"), F.lit(family)) == 0))
    to = to.select(F.explode(F.sequence(F.col("conv"), F.col("conv") + family - 1)).alias("conv"), "pos", "h1", "h2", "size")
    taken = to.join(convs, "conv").where("pos < h").select("conv", "pos", "h1", "h2", "size", "length")
    return own.unionByName(taken), convs.select("conv", "length")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) as they are."""
    turns = cut_lineage(turns)
    convs = cut_lineage(turns.groupBy("conv").agg(F.count("*").alias("length")))
    return turns.join(convs, "conv"), convs


def _xor(*columns: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


_A, _B, _S = ([f"{x}{j}" for j in range(BLOCK_TURNS)] for x in "abs")


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv, length, k, a*, b*, s*, u1, u2, v1, v2): a row a block, with the terms (0 if there is no
    such turn) and sizes (null) of its turns, and the digests before and after it."""
    at = [F.col("pos"), F.col("h1"), F.col("h2")]
    rows = turns.select("conv", "length", _div(F.col("pos"), BLOCK_TURNS).alias("k"), F.pmod(F.col("pos"), F.lit(BLOCK_TURNS)).alias("i"),
                        F.xxhash64(F.lit(1), *at).alias("a"), F.xxhash64(F.lit(2), *at).alias("b"), F.col("size").alias("s"))
    rows = rows.withColumn("seg", _div(F.col("k"), SEGMENT)).repartition("conv", "seg")
    one = lambda c, j: F.max(F.when(F.col("i") == j, F.col(c)))
    aggs = [F.coalesce(one(c, j), F.lit(0)).alias(f"{c}{j}") for c in "ab" for j in range(BLOCK_TURNS)] + [one("s", j).alias(f"s{j}") for j in range(BLOCK_TURNS)]
    blocks = rows.groupBy("conv", "seg", "k").agg(F.max("length").alias("length"), *aggs)
    blocks = blocks.withColumns({"x1": _xor(*map(F.col, _A)), "x2": _xor(*map(F.col, _B))})
    inside = Window.partitionBy("conv", "seg").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({f"u{i}": F.coalesce(F.bit_xor(f"x{i}").over(inside), F.lit(0)) for i in (1, 2)})
    blocks = cut_lineage(blocks)
    # conversations of more than one segment: what the segments before give
    segs = blocks.where(F.col("length") > BLOCK_TURNS * SEGMENT).groupBy("conv", "seg").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.select("conv", "seg", F.bit_xor("x1").over(before).alias("o1"), F.bit_xor("x2").over(before).alias("o2")).where("o1 is not null")
    blocks = blocks.join(segs, ["conv", "seg"], "left")
    u = [_xor(F.col(f"u{i}"), F.coalesce(f"o{i}", F.lit(0))) for i in (1, 2)]
    return blocks.select("conv", "length", "k", *_A, *_B, *_S, u[0].alias("u1"), u[1].alias("u2"), _xor(u[0], F.col("x1")).alias("v1"), _xor(u[1], F.col("x2")).alias("v2"))


def _of_block(*aggs: Column):
    """Aggregates of rows of one block; its turns are the same in every row."""
    return [*aggs, *[F.max(c).alias(c) for c in (*_A, *_B, *_S, "u1", "u2")]]


def _turns_of(blocks: DataFrame, *keep: str) -> DataFrame:
    """(depth, q1, q2, p1, p2, size, *keep): a row a turn, with the digests after and before it."""
    out, p1, p2 = [], F.col("u1"), F.col("u2")
    for j in range(BLOCK_TURNS):
        q1, q2 = _xor(p1, F.col(f"a{j}")), _xor(p2, F.col(f"b{j}"))
        out.append(F.struct((F.col("k") * BLOCK_TURNS + j + 1).alias("depth"), q1.alias("q1"), q2.alias("q2"), p1.alias("p1"), p2.alias("p2"), F.col(f"s{j}").alias("size")))
        p1, p2 = q1, q2
    return blocks.select(*keep, F.explode(F.array(*out)).alias("t")).select(*keep, "t.*").where("size is not null")


def _nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, q1, q2, p1, p2, size, n, rep) of every node, rep the smallest member."""
    grouped = cut_lineage(blocks.groupBy("k", "v1", "v2").agg(*_of_block(F.count("*").alias("n"), F.min("conv").alias("rep"))))
    parted = grouped.where("k > 0").groupBy("k", "u1", "u2").agg(F.count("*").alias("siblings")).where("siblings > 1")
    later = grouped.where("k > 0").join(parted, ["k", "u1", "u2"], "left")
    # first blocks all follow the empty prefix
    grouped = cut_lineage(later.unionByName(grouped.where("k = 0").withColumn("siblings", F.lit(2).cast("long"))))
    alone = _turns_of(grouped.where("siblings is null"), "n", "rep")
    refined = _turns_of(grouped.where("siblings is not null"), "n", "rep").groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("size").alias("size"), F.sum("n").alias("n"), F.min("rep").alias("rep"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("rep")).where("n > 0").select(
        zero.alias("depth"), zero.alias("q1"), zero.alias("q2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("size"), "n", "rep")
    return cut_lineage(alone.unionByName(refined).unionByName(root))


def _linked(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with parent and n_children, and (conv, first) of the chains that hang on another."""
    chains = cut_lineage(nodes.groupBy(F.col("rep").alias("conv")).agg(
        F.min("depth").alias("first"), F.max("depth").alias("last"), F.min_by("p1", "depth").alias("p1"), F.min_by("p2", "depth").alias("p2")))
    heads = chains.where("first > 0")
    top = chains.agg(F.min("conv")).first()[0]  # the root's
    deep = heads.where("first > 1").select("conv", "first", (F.col("first") - 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    deep = deep.join(nodes.select(*KEY, F.col("rep").alias("parent")), KEY).select("conv", "first", "parent")
    heads = cut_lineage(deep.unionByName(heads.where("first = 1").select("conv", "first", F.lit(top).cast("long").alias("parent"))))
    none = F.lit(None).cast("long")
    tags = (heads.groupBy(F.col("parent").alias("rep"), (F.col("first") - 1).alias("depth")).agg(F.count("*").alias("heads"))
            .select("rep", "depth", "heads", none.alias("parent"), none.alias("ends"))
            .unionByName(heads.select(F.col("conv").alias("rep"), F.col("first").alias("depth"), none.alias("heads"), "parent", none.alias("ends")))
            .unionByName(chains.select(F.col("conv").alias("rep"), F.col("last").alias("depth"), none.alias("heads"), none.alias("parent"), F.lit(1).cast("long").alias("ends"))))
    tags = tags.groupBy("rep", "depth").agg(*[F.max(c).alias(c) for c in ("heads", "parent", "ends")])
    linked = nodes.join(tags, ["rep", "depth"], "left")
    linked = linked.withColumns({"n_children": F.coalesce("heads", F.lit(0)) + F.lit(1) - F.coalesce("ends", F.lit(0)),
                                 "parent": F.when(F.col("depth") > 0, F.coalesce("parent", "rep"))})
    return linked.drop("heads", "ends", "p1", "p2"), heads.select("conv", "first")


def _below(blocks: DataFrame, chains: DataFrame) -> DataFrame:
    """(depth, q1, q2, leaves, saved): for each node the sums over chains that hang below it.

    ``chains`` is (conv, first, leaves, saved); a chain counts for its conversation's nodes above ``first``."""
    rows = blocks.join(chains, "conv").where(F.col("k") * BLOCK_TURNS + 1 < F.col("first"))
    last = _div(F.col("first") - 1, BLOCK_TURNS)
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    whole = rows.where(F.col("k") < last).groupBy("k", "v1", "v2").agg(*_of_block(*sums))
    edge = _turns_of(rows.where(F.col("k") == last), "first", "leaves", "saved").where("depth < first")
    both = _turns_of(whole, "leaves", "saved").select(*KEY, "leaves", "saved").unionByName(edge.select(*KEY, "leaves", "saved"))
    return both.groupBy(*KEY).agg(*sums)


def _rest_of_chain(nodes: DataFrame) -> DataFrame:
    """``nodes`` with leaves and saved summed from the node to the end of its chain."""
    nodes = nodes.withColumn("seg", _div(F.col("depth"), SEGMENT))
    segs = nodes.groupBy("rep", "seg").agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    after = Window.partitionBy("rep").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.select("rep", "seg", F.sum("leaf").over(after).alias("more_leaf"), F.sum("save").over(after).alias("more_save")).where("more_leaf is not null")
    inside = Window.partitionBy("rep", "seg").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumns({"leaves": F.sum("leaf").over(inside), "saved": F.sum("save").over(inside)}).join(segs, ["rep", "seg"], "left")
    return nodes.withColumns({"leaves": F.col("leaves") + F.coalesce("more_leaf", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_save", F.lit(0))}).drop("seg", "more_leaf", "more_save")


def _ends(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, q1, q2, ends_sha256) of nodes that conversations end in.

    SHA-256 goes through the ids one after the other. Ids are joined by ranges of
    ``ID_RANGE`` before they move, and then read as a stream, in order."""
    zero = F.lit(0).cast("long")
    last = blocks.where(F.col("k") == _div(F.col("length") - 1, BLOCK_TURNS)).select("conv", F.col("length").alias("depth"), F.col("v1").alias("q1"), F.col("v2").alias("q2"))
    last = last.unionByName(convs.where("length = 0").select("conv", zero.alias("depth"), zero.alias("q1"), zero.alias("q2")))
    ids = last.groupBy(*KEY, _div(F.col("conv"), ID_RANGE).alias("r")).agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    ids = ids.repartition(*KEY).sortWithinPartitions(*KEY, "r")

    def hashed(batches):
        key, h = None, None
        for b in batches:
            out = []
            for *k, part in zip(b["depth"], b["q1"], b["q2"], b["ids"]):
                if k == key:
                    h.update(b",")
                else:
                    if key is not None:
                        out.append((*key, h.hexdigest()))
                    key, h = k, sha256()
                h.update(part.encode("ascii"))
            yield pd.DataFrame(out, columns=["depth", "q1", "q2", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, h.hexdigest())], columns=["depth", "q1", "q2", "ends_sha256"])

    return ids.select(*KEY, "ids").mapInPandas(hashed, "depth long, q1 long, q2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row a node.

    ``turns`` is (conv, pos, h1, h2, size, length) with pos 0, 1, ... in each
    conversation, ``convs`` (conv, length) holds every conversation, also those
    without a turn. A node is a distinct sequence of first turns, the root at depth 0
    included; members are the conversations that begin with it, conv_id the
    smallest. n_leaves counts childless nodes and saved_tokens sums (n_convs - 1)
    times the bytes of the node's last text, both over the node's subtree, itself
    included. ends_sha256 is the SHA-256 of the ids of members that end there,
    ascending, joined by commas. Without conversations there is no node."""
    convs = cut_lineage(convs)
    if convs.isEmpty():
        return convs.sparkSession.createDataFrame([], SCHEMA)
    blocks = cut_lineage(_blocks(turns))
    linked, heads = _linked(_nodes(blocks, convs))
    linked = cut_lineage(linked.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "save": (F.col("n") - 1) * F.col("size")}))
    sums = linked.groupBy(F.col("rep").alias("conv")).agg(F.sum("leaf").alias("leaves"), F.sum("save").alias("saved"))
    chains = cut_lineage(sums.join(heads, "conv", "left"))
    below = _below(blocks, chains.where("first is not null"))
    # below the root hang all chains but its own
    zero = F.lit(0).cast("long")
    root = chains.where("first is not null").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).where("leaves is not null")
    below = below.unionByName(root.select(zero.alias("depth"), zero.alias("q1"), zero.alias("q2"), "leaves", "saved"))
    below = below.select(*KEY, F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
    out = _rest_of_chain(linked).join(below, KEY, "left").join(_ends(blocks, convs), KEY, "left")
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves") + F.coalesce("below_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"))


SCHEMA = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
