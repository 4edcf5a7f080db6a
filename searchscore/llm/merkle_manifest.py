"""Merkle manifest of a dataset: one ternary hash tree a source, and one over the sources.

Every row is a leaf. Inside a source the leaves are cut into superblocks of
``SUPERBLOCK`` consecutive ones, a power of three, so a superblock is a whole
subtree of the source's tree. Going up, superblocks are reduced to their top
nodes, these are cut into superblocks again, and so on until one node a source is
left; the sources' nodes go the same way to the root. Going down, every superblock
of a round is cogrouped with what it needs of the tree outside it, the siblings
from its top node up to the root, and hands each of its nodes a path of its own.
In the last round that is done for the leaves: one cogrouped function reduces the
superblock again, joins each leaf's proof from inner and outer siblings, and folds
the leaf that is to be verified up to the root.

A hot source is only more superblocks. Texts are hashed where they are read and
never move; a leaf moves as two digests. The rounds grow with the logarithm of
the rows to the base ``SUPERBLOCK``.
"""
from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

from .numbering import numbered

#: Nodes that one node of the next level covers.
ARITY = 3
#: Levels of the tree that a superblock spans, and its leaves.
SUPERBLOCK_LEVELS = 7
SUPERBLOCK = ARITY ** SUPERBLOCK_LEVELS

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the columns, each "-" if null, else its UTF-8 byte count, ":" and its value."""
    def one(c: Column) -> Column:
        v = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))

    return F.sha2(F.concat(*[one(c) for c in columns]), 256)


def layers_of(nodes: list[str], alone: bool) -> list[list[str]]:
    """The levels of a superblock, from ``nodes`` to its top node. One that is its tree's only
    superblock (``alone``) ends where one node is left, any other after all its levels."""
    layers = [nodes]
    while len(layers[-1]) > 1 if alone else len(layers) <= SUPERBLOCK_LEVELS:
        last = layers[-1]
        layers.append([digest(last[i:i + ARITY]) for i in range(0, len(last), ARITY)])
    return layers


def siblings(layers: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node i's path in its runs, a string for each level."""
    left, right = [], []
    for layer in layers[:-1]:
        at, in_run = i - i % ARITY, i % ARITY
        run = layer[at:at + ARITY]
        left.append("".join(run[:in_run]))
        right.append("".join(run[in_run + 1:]))
        i //= ARITY
    return left, right


def fold(node: str, left, right) -> str:
    """The root that a node gives together with the siblings of its path."""
    for a, b in zip(left, right):
        node = digest((a, node, b))
    return node


def _block_layers(pdf: pd.DataFrame) -> list[list[str]]:
    # a first superblock that is not full is the only one of its tree
    return layers_of(pdf["hash"].tolist(), bool(pdf["block"].iat[0] == 0 and len(pdf) < SUPERBLOCK))


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / SUPERBLOCK).cast("long"))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of (tree, pos, hash): ``nodes``, the tops of their superblocks, and so on to one node a tree."""
    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": [pdf["tree"].iat[0]], "pos": [pdf["block"].iat[0]],
                             "hash": [_block_layers(pdf.sort_values("pos"))[-1][0]]})

    rounds, last = [nodes], 0
    while len(rounds) == 1 or last > 0:
        tops = _in_blocks(rounds[-1].select("tree", "pos", "hash")).groupBy("tree", "block").applyInPandas(top, "tree string, pos long, hash string")
        rounds.append(cut_lineage(tops))
        last = rounds[-1].agg(F.max("pos")).first()[0] or 0
    return rounds


PATH = "left array<string>, right array<string>, subroot string, root string"


def descend(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(tree, pos, path) of ``nodes`` from ``outer``, the (tree, pos, path) of their superblocks."""
    def down(pdf: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        pdf, o = pdf.sort_values("pos"), out.iloc[0]
        layers = _block_layers(pdf)
        paths = [siblings(layers, i) for i in range(len(pdf))]
        return pd.DataFrame({"tree": pdf["tree"], "pos": pdf["pos"], "left": [a + list(o["left"]) for a, _ in paths],
                             "right": [b + list(o["right"]) for _, b in paths], "subroot": o["subroot"], "root": o["root"]})

    return _exchange(nodes, outer, down, f"tree string, pos long, {PATH}")


def _exchange(nodes: DataFrame, outer: DataFrame, f, schema: str) -> DataFrame:
    inner = _in_blocks(nodes).groupBy("tree", "block")
    return inner.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(f, schema)


def verify(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    """Each leaf's digest with its proof, and the root that its ``changed`` digest folds to."""
    def finish(pdf: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        pdf, o = pdf.sort_values("pos"), out.iloc[0]
        layers, rows = _block_layers(pdf), []
        outer_left, outer_right = list(o["left"]), list(o["right"])
        outer_pairs = [x for pair in zip(outer_left, outer_right) for x in pair]
        for i, changed in enumerate(pdf["changed"]):
            left, right = siblings(layers, i)
            proof = digest([x for pair in zip(left, right) for x in pair] + outer_pairs)
            rows.append((proof, fold(changed, left + outer_left, right + outer_right)))
        return pd.DataFrame({"id": pdf["id"], "leaf": pdf["hash"], "subroot": o["subroot"], "root": o["root"],
                             "proof_sha256": [r[0] for r in rows], "folded_root": [r[1] for r in rows]})

    return _exchange(leaves, outer, finish, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def manifest(docs: DataFrame, changed_text: Column | None = None, source: str = "source") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row a row of ``docs``.

    A leaf covers doc_id, source, lang, n_chars and text; null values count as "-".
    ``changed_text`` is the text whose leaf is folded against the proofs (default:
    the text itself, which always verifies). Leaves of a source stand by doc_id,
    null first, then by digest; a null source is a source, the first. Repeated rows
    are leaves of their own, interchangeable. A source of one row has its leaf as
    subroot; with one source its subroot is the root. An empty table gives an empty
    one. Other columns are not read, whatever their names."""
    cols = {c: F.col(f"`{source if c == 'source' else c}`") for c in LEAF_COLUMNS}
    tree = F.coalesce(F.concat(F.lit("s"), cols["source"].cast("string")), F.lit("null"))
    new = cols["text"] if changed_text is None else changed_text
    leaf = leaf_digest(list(cols.values()))
    changed = F.when(new.eqNullSafe(cols["text"]), F.lit(None)).otherwise(leaf_digest([*list(cols.values())[:-1], new]))
    rows = docs.select(cols["doc_id"].alias("doc_id"), cols["doc_id"].cast("string").alias("id"), tree.alias("tree"), leaf.alias("hash"), changed.alias("changed"))
    rows = cut_lineage(rows.withColumn("changed", F.coalesce("changed", "hash")))
    leaves = cut_lineage(numbered(rows, "tree", [F.col("doc_id").asc_nulls_first(), F.col("hash")], "pos").drop("doc_id"))

    rounds = climb(leaves)
    subroots = rounds[-1].select("tree", "hash")
    # sources in the order of their names, null first; "t" is the tree over them
    names = subroots.select(F.lit("t").alias("of"), "tree", "hash")
    tops = cut_lineage(numbered(names, "of", [F.col("tree") != "null", F.col("tree")], "pos").select(F.col("of").alias("tree"), "pos", "hash", F.col("tree").alias("source")))
    upper = climb(tops.select("tree", "pos", "hash"))
    empty = F.array().cast("array<string>")
    outer = upper[-1].select("tree", "pos", empty.alias("left"), empty.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for nodes in reversed(upper[:-1]):
        outer = descend(nodes, outer)
    at = tops.select("pos", "source", F.col("hash").alias("own"))
    outer = outer.join(at, "pos").select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "left", "right", F.col("own").alias("subroot"), "root")
    outer = cut_lineage(outer)
    for nodes in reversed(rounds[1:-1]):
        outer = cut_lineage(descend(nodes, outer))
    out = verify(leaves, outer)
    return out.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def without_newlines_in_half(docs: DataFrame) -> Column:
    """The text, its \\n characters deleted where crc32 of the decimal doc_id is even (null ids: as it is)."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
