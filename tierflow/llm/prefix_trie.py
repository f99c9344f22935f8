"""Conversation prefix trie by the Euler-tour technique (operator 13).

A node is a distinct sequence of first turns.  A turn is named by two 64-bit hashes, a
prefix by the exclusive or of its turns' names mixed with their positions: 128 bits that
running totals over range slices give for every turn, however long its conversation.

The tour enters each node, then its children by smallest member, then leaves the node: two
arcs a node, each with its successor.  The list of arcs is ranked by contraction: each
round every arc of one coin side takes in its successor of the other side, about a quarter
of all, with its weights, until few arcs are left for one task to walk; then the rounds
are undone and every arc learns its position and what lies before it.  Rounds grow with
the logarithm of the list and their sizes shrink geometrically; arcs join on their own
ids, so no key is hot.  A subtree is what lies between its node's two arcs, so its leaves
and savings are differences of the prefix sums there.

Defined results: turns are ordered by ``turn``, null first, then by the hashes of role and
text; equal rows are turns each; null roles and texts count as empty; words are what lies
between ASCII white space; rows without a ``conv_id`` are ignored; other columns are
ignored; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import Workspace, by_shuffle
from tierflow.operators.ordinals import number_rows, running_totals

#: Arcs that one task walks at the end of the contraction.
WALKED = 1 << 15
#: Ids of a block of endings that are joined before a digest reads them in order.
BLOCK = 4096


@dataclass(frozen=True)
class Trie:
    """``nodes``: ``id, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens``; ``ends``: node ``id`` and ``conv_id`` of every conversation."""

    nodes: DataFrame
    ends: DataFrame


def named_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, h1, h2, words)`` of every turn, positions from 1."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    return number_rows(rows, ["conv_id"], order, "position").drop("turn")


def prefix_trie(conversations: DataFrame) -> Trie:
    """The trie of all conversations of ``(conv_id, turn, role, text)``."""
    turns = named_turns(conversations)
    members = turns.select("conv_id").distinct()
    ws = Workspace(conversations.sparkSession, "prefix-trie")
    return trie_of(ws, turns, members)


def trie_of(ws: Workspace, turns: DataFrame, members: DataFrame) -> Trie:
    """The trie of ``members(conv_id)`` with their named turns; some may have none."""
    prefixes = ws.keep(_prefixes(turns))
    members = ws.keep(members)
    nodes = ws.keep(
        _nodes(prefixes, members).withColumn("id", F.monotonically_increasing_id())
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x1").alias("p1"),
        F.col("x2").alias("p2"),
        F.col("id").alias("up"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    linked = ws.keep(nodes.join(by_shuffle(parents), ["depth", "p1", "p2"], "left"))
    siblings = ws.keep(
        running_totals(
            linked.filter("up is not null").select("id", "up", "conv_id"),
            ["up"],
            [F.col("conv_id")],
            sums={"nth": F.lit(1)},
        )
    )
    ranks = list_ranked(ws, _arcs(linked, siblings), ["leaf", "saved"])

    def between(weight: str, name: str) -> Column:
        return (F.max(weight) - F.min(weight)).alias(name)

    subtrees = ranks.groupBy(F.shiftright("id", 1).alias("id")).agg(
        between("leaf", "n_leaves"), between("saved", "saved_tokens")
    )
    children = siblings.groupBy(F.col("up").alias("id")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    found = (
        linked.join(by_shuffle(subtrees), "id")
        .join(by_shuffle(children), "id", "left")
        .select(
            "id",
            "depth",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
        )
    )
    return Trie(found, _ends(prefixes, members, nodes))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Per turn the names of the prefix that ends with it and of the one before it."""
    named = turns.select(
        "conv_id",
        F.col("position").cast("long").alias("depth"),
        "words",
        F.xxhash64(F.col("position").cast("long"), "h1").alias("t1"),
        F.xxhash64(F.col("position").cast("long"), "h2").alias("t2"),
    )
    before = running_totals(
        named,
        ["conv_id"],
        [F.col("depth")],
        xors={"p1": F.col("t1"), "p2": F.col("t2")},
    )
    return before.select(
        "conv_id",
        "depth",
        "words",
        "p1",
        "p2",
        F.col("p1").bitwiseXOR(F.col("t1")).alias("x1"),
        F.col("p2").bitwiseXOR(F.col("t2")).alias("x2"),
    )


def _nodes(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    inner = prefixes.groupBy("depth", "x1", "x2").agg(
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"),
    )
    nothing = F.lit(None).cast("long")
    root = (
        members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .filter("n_convs > 0")
        .select(
            F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("x1"),
            F.lit(0).cast("long").alias("x2"),
            nothing.alias("p1"),
            nothing.alias("p2"),
            "conv_id",
            "n_convs",
            F.lit(0).cast("long").alias("words"),
        )
    )
    return inner.unionByName(root)


def _arcs(linked: DataFrame, siblings: DataFrame) -> DataFrame:
    """``(id, next, leaf, saved)``: arc ``2 n`` enters node ``n``, ``2 n + 1`` leaves it."""
    first = siblings.filter("nth = 0").select(
        F.col("up").alias("id"), F.col("id").alias("child")
    )
    enter = linked.join(by_shuffle(first), "id", "left").select(
        (F.col("id") * 2).alias("id"),
        F.coalesce(F.col("child") * 2, F.col("id") * 2 + 1).alias("next"),
        F.col("child").isNull().cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    following = siblings.select(
        "up", (F.col("nth") - 1).alias("nth"), F.col("id").alias("sibling")
    )
    leave = siblings.join(by_shuffle(following), ["up", "nth"], "left").select(
        (F.col("id") * 2 + 1).alias("id"),
        F.coalesce(F.col("sibling") * 2, F.col("up") * 2 + 1).alias("next"),
        F.lit(0).cast("long").alias("leaf"),
        F.lit(0).cast("long").alias("saved"),
    )
    last = linked.filter("up is null").select(
        (F.col("id") * 2 + 1).alias("id"),
        F.lit(None).cast("long").alias("next"),
        F.lit(0).cast("long").alias("leaf"),
        F.lit(0).cast("long").alias("saved"),
    )
    return enter.unionByName(leave).unionByName(last)


def list_ranked(
    ws: Workspace, arcs: DataFrame, weights: list[str], walked: int | None = None
) -> DataFrame:
    """``(id, position, weights)`` of one linked list ``(id, next, weights)``.

    The position counts from 0; each weight becomes its sum over the arcs before.
    ``walked`` is how many arcs one task may walk, ``WALKED`` where none is given.
    """
    walked = WALKED if walked is None else walked
    summed = ["position", *weights]
    current = ws.keep(
        arcs.select("id", "next", F.lit(1).cast("long").alias("position"), *weights)
    )
    rounds: list[DataFrame] = []
    while current.count() > walked:
        joined, current = _contracted(ws, current, summed, len(rounds))
        rounds.append(joined)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if sum(b.num_rows for b in held):
            yield _walked(pa.Table.from_batches(held), summed)

    schema = ", ".join(f"{c} long" for c in ["id", *summed])
    ranks = ws.keep(current.repartition(1).mapInArrow(walk, schema))
    ws.drop(current)
    for joined in reversed(rounds):
        into = ranks.select(
            F.col("id").alias("into"), *[F.col(c).alias(f"{c}_at") for c in summed]
        )
        taken = (
            joined.filter("into is not null")
            .join(by_shuffle(into), "into")
            .select("id", *[(F.col(f"{c}_at") + F.col(f"{c}_in")).alias(c) for c in summed])
        )
        wider = ws.keep(ranks.unionByName(taken))
        ws.drop(ranks, joined)
        ranks = wider
    return ranks


def _contracted(
    ws: Workspace, current: DataFrame, summed: list[str], nth: int
) -> tuple[DataFrame, DataFrame]:
    """Arcs of one coin side with the arc that takes them in, and the shorter list."""

    def coin(name: str) -> Column:
        side = F.pmod(F.xxhash64(F.lit(nth), F.col(name)), F.lit(2))
        return F.when(F.col(name).isNull(), 0).otherwise(side)

    takers = current.filter((coin("id") == 0) & (coin("next") == 1)).select(
        F.col("id").alias("into"),
        F.col("next").alias("id"),
        *[F.col(c).alias(f"{c}_in") for c in summed],
    )
    joined = ws.keep(
        current.filter(coin("id") == 1).join(by_shuffle(takers), "id", "left")
    )
    merged = joined.filter("into is not null").select(
        F.col("into").alias("id"),
        "next",
        *[(F.col(f"{c}_in") + F.col(c)).alias(c) for c in summed],
    )
    alone = joined.filter("into is null").select("id", "next", *summed)
    others = current.filter((coin("id") == 0) & (coin("next") == 0))
    shorter = ws.keep(merged.unionByName(alone).unionByName(others))
    ws.drop(current)
    return joined, shorter


def _walked(rows: pa.Table, summed: list[str]) -> pa.RecordBatch:
    """The list in order, with the sums of what lies before each row."""
    ids = rows.column("id").to_numpy()
    following = rows.column("next").to_pylist()
    place = {i: k for k, i in enumerate(ids.tolist())}
    heads = set(place) - set(following)
    if len(heads) != 1:
        raise ValueError("the arcs are not one list")
    order, at = [], heads.pop()
    while at is not None:
        order.append(place[at])
        at = following[place[at]]
    columns = [pa.array(ids[order])]
    for name in summed:
        weight = rows.column(name).to_numpy()[order]
        columns.append(pa.array(np.concatenate([[0], np.cumsum(weight)[:-1]])))
    return pa.RecordBatch.from_arrays(columns, names=["id", *summed])


def _ends(prefixes: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node and id of every conversation."""
    last = prefixes.groupBy("conv_id").agg(
        F.max(F.struct("depth", "x1", "x2")).alias("last")
    )
    none = F.lit(0).cast("long")
    keyed = members.join(by_shuffle(last), "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"last.{c}", none).alias(c) for c in ("depth", "x1", "x2")]
    )
    return keyed.join(
        by_shuffle(nodes.select("id", "depth", "x1", "x2")), ["depth", "x1", "x2"]
    ).select("id", "conv_id")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(id, ends_sha256)``: a node's endings, ascending and comma-joined, hashed.

    A block of neighbouring ids holds ``BLOCK`` of them at most, so joining its ids needs
    no bound; the digest then reads the blocks of a node in order, one after another.
    """
    blocks = (
        ends.groupBy("id", F.floor(F.col("conv_id") / BLOCK).alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("part"))
        .repartition("id")
        .sortWithinPartitions("id", "block")
        .select("id", "part")
    )
    return blocks.mapInArrow(_hashed, "id long, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    for batch in batches:
        ids, found = [], []
        for own, part in zip(*[c.to_pylist() for c in batch.columns]):
            if own == node:
                digest.update(b",")
            else:
                if node is not None:
                    ids.append(node)
                    found.append(digest.hexdigest())
                node, digest = own, hashlib.sha256()
            digest.update(part.encode())
        yield _digests(ids, found)
    if node is not None:
        yield _digests([node], [digest.hexdigest()])


def _digests(ids: list, found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(found, pa.string())],
        names=["id", "ends_sha256"],
    )
