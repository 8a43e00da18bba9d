"""Prefix tries of conversations by cutting at half depth, after van Emde Boas.

Depths are cut into halves, those into halves again, down to single turns. On each
level all pieces are handled at once, in a few joins, so a trie of depth ``D`` takes
some ``log2(D)`` rounds, whatever the length of one conversation:

* from single turns up, each half piece of a conversation gets a digest of its two
  halves;
* from the whole down, the prefix that ends at a cut is named by the name of the prefix
  at the top of its piece and the digest of the upper half. This names the roots of
  the lower forest, so that the upper trie and the lower forest can be cut next,
  independently of one another;
* from single depths up, the totals of a lower forest's roots are grafted on to all
  nodes above them in the upper trie. A conversation hands on half its length on each
  level at most, and equal prefixes have become one node before.

A conversation is never gathered into one row or one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.ranges import positions
from martflow.llm.stored import stored

EMPTY = hashlib.sha256().hexdigest()


def _joined_name(first: Column, second: Column) -> Column:
    return F.unhex(F.sha2(F.concat(first, second), 256))


def turn_name(role: Column, text: Column) -> Column:
    """A digest that tells all pairs of a role and a text apart; null is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    mark = F.concat(F.char_length(role).cast("string"), F.lit(":"))
    return F.unhex(F.sha2(F.concat(mark, role, text).cast("binary"), 256))


def numbered_turns(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv, at, name, chars`` of all turns, with their place in the conversation.

    A null ``turn`` is the first; turns of one number follow in the order of their
    digests, and repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a key are left out; other columns are ignored.
    """
    df = conversations.where(conversations[key].isNotNull())
    rows = df.select(
        df[key].cast("long").alias("conv"),
        df[turn].alias("turn"),
        turn_name(df[role], df[text]).alias("name"),
        F.char_length(F.coalesce(df[text], F.lit(""))).cast("long").alias("chars"),
    )
    return positions(rows, "conv", ["turn", "name"]).drop("turn")


def _piece_digests(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each level ``conv, piece, name``: digests of pieces of 2 ** level turns."""
    pieces = [turns.select("conv", F.col("at").alias("piece"), "name")]
    for _ in range(1, levels):
        odd = F.col("piece") % 2 == 1
        whole = (
            pieces[-1]
            .groupBy("conv", F.shiftright("piece", 1).alias("piece"))
            .agg(
                F.max(F.when(~odd, F.col("name"))).alias("first"),
                F.max(F.when(odd, F.col("name"))).alias("second"),
            )
            .where("first IS NOT NULL AND second IS NOT NULL")
        )
        name = _joined_name(F.col("first"), F.col("second")).alias("name")
        pieces.append(stored(whole.select("conv", "piece", name)))
    return pieces


def prefix_names(turns: DataFrame, convs: DataFrame, levels: int) -> DataFrame:
    """``conv, depth, name`` of all prefixes, the empty one included."""
    pieces = _piece_digests(turns, levels)
    known = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit("").cast("binary").alias("name")
    )
    for level in reversed(range(levels)):
        top = known.select("conv", "depth", F.col("name").alias("above"))
        top = top.withColumn("piece", F.shiftright("depth", level))
        cut = top.join(pieces[level], ["conv", "piece"]).select(
            "conv",
            (F.col("depth") + (1 << level)).alias("depth"),
            _joined_name(F.col("above"), F.col("name")).alias("name"),
        )
        known = stored(known.unionByName(cut))
    return known


def _graft(totals: DataFrame, paths: DataFrame, level: int) -> DataFrame:
    """Add the totals at the roots of lower forests to all nodes of the tries above."""
    size = 1 << level
    roots = totals.where(F.col("depth") % (2 * size) == size).select(
        F.col("conv_id").alias("conv"),
        (F.shiftright("depth", level) - 1).alias("piece"),
        "n_leaves",
        "saved_tokens",
    )
    above = paths.withColumn("piece", F.shiftright("depth", level))
    more = (
        roots.join(above, ["conv", "piece"])
        .groupBy("depth", F.col("node").alias("conv_id"))
        .agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    )
    return totals.join(more, ["depth", "conv_id"], "left").select(
        *[c for c in totals.columns if c not in ("n_leaves", "saved_tokens")],
        (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
    )


def digest_of_ids(ended: DataFrame) -> DataFrame:
    """``depth, name, ends_sha256`` of ``depth, name, conv``: of all ids in order.

    The ids of a node are streamed, so memory stays bounded. The digest of a list is
    sequential by its nature: the ids of one node pass through one task.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            depth, name = batch.column("depth").to_numpy(), batch.column("name")
            code = name.dictionary_encode().indices.to_numpy()
            begins = np.ones(len(depth), bool)
            begins[1:] = (depth[1:] != depth[:-1]) | (code[1:] != code[:-1])
            conv = batch.column("conv").to_numpy()
            done = []
            starts = np.flatnonzero(begins).tolist()
            for start, stop in zip(starts, [*starts[1:], len(depth)], strict=True):
                own = (int(depth[start]), name[start].as_py())
                text = ",".join(map(str, conv[start:stop].tolist())).encode()
                if own == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                state.update(text)
            if done:
                yield _digests(done)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    key = ["depth", "name"]
    dealt = ended.select(*key, "conv").repartition(*key).sortWithinPartitions(*key, "conv")
    return dealt.mapInArrow(scan, "depth long, name binary, ends_sha256 string")


def _digests(done: list[tuple]) -> pa.RecordBatch:
    depth, name, text = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(depth, pa.int64()), pa.array(name, pa.binary()), pa.array(text)],
        ["depth", "name", "ends_sha256"],
    )


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conv, at, name, chars``, with the totals below them.

    A node is a sequence of first turns that some conversation begins with; it is told
    by its depth and its smallest member, ``conv_id``. ``convs`` lists all ``conv``
    once; those without turns are members of the root only. Per node: ``conv_id,
    depth, parent_conv_id`` (root: null), ``n_convs`` members, ``n_children,
    n_leaves`` of its subtree, ``saved_tokens`` (what its subtree need not store again,
    in code points), and ``ends_sha256`` of the ids that end in it, ascending.

    Equal conversations share all nodes. No conversations give no nodes.
    """
    turns, convs = stored(turns), stored(convs)
    sizes = convs.join(turns.groupBy("conv").agg(F.count("*").alias("size")), "conv", "left")
    sizes = stored(sizes.select("conv", F.coalesce("size", F.lit(0)).alias("size")))
    longest = sizes.agg(F.max("size")).first()[0] or 0
    levels = max(1, int(longest).bit_length())

    prefixes = prefix_names(turns, convs, levels)
    named = stored(
        prefixes.groupBy("depth", "name").agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")
        )
    )
    # Only conversations that stand for a node need the way up to the root.
    standing = prefixes.join(
        named.select(F.col("conv_id").alias("conv")).distinct(), "conv", "left_semi"
    )
    paths = stored(
        standing.join(named.select("depth", "name", F.col("conv_id").alias("node")), ["depth", "name"])
        .select("conv", "depth", "node")
    )
    parents = paths.select(
        F.col("conv").alias("conv_id"),
        (F.col("depth") + 1).alias("depth"),
        F.col("node").alias("parent_conv_id"),
    )
    last = turns.select(F.col("conv").alias("conv_id"), (F.col("at") + 1).alias("depth"), "chars")
    ended = prefixes.join(sizes.withColumnRenamed("size", "depth"), ["conv", "depth"])
    nodes = stored(
        named.join(parents, ["conv_id", "depth"], "left")
        .join(last, ["conv_id", "depth"], "left")
        .join(digest_of_ids(ended), ["depth", "name"], "left")
        .drop("name")
    )
    children = nodes.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")
    ).agg(F.count("*").alias("n_children"))
    totals = nodes.join(children, ["depth", "conv_id"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved_tokens"),
    )
    for level in range(levels):
        totals = _graft(stored(totals), paths, level)
    return totals


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """:func:`prefix_trie` of conversations as they are; see :func:`numbered_turns`."""
    turns = stored(numbered_turns(conversations, **columns))
    return prefix_trie(turns, turns.select("conv").distinct())
