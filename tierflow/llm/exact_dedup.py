"""Exact deduplication by deterministic block naming (operator 9).

A text falls into blocks of fixed size.  The distinct blocks are sorted and numbered, so
equal blocks and only these share an integer name.  Adjacent names form pairs, which are
sorted and numbered in turn, until one name is left of every text: its identity, free of
collisions.  Names of a level are written before they are joined back, and the joins are
of the shape in which adaptive execution splits a block that very many texts share.

Texts whose length, first and last block no other text has are settled by these blocks.

Defined results: equal means identical after lower-casing A-Z; a null text is empty, and
empty texts are equal to each other; of equal texts one row stays, the largest id's (of
rows with the same id and text an arbitrary one, null ids last); other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import Workspace, by_shuffle

BLOCK_BYTES = 1024
END_BYTES = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def _named(ws: Workspace, rows: DataFrame, content: list[str]) -> DataFrame:
    """``rows`` with ``content`` replaced by an integer name, in the order of content."""
    distinct = rows.select(*content).distinct().orderBy(*content)
    names = ws.keep(distinct.withColumn("name", F.monotonically_increasing_id()))
    named = ws.keep(rows.join(by_shuffle(names), content).select("row", "at", "name"))
    ws.drop(names)
    return named


def identities(ws: Workspace, texts: DataFrame) -> DataFrame:
    """``(row, name)`` of ``texts(row, body)``; equal bodies share the name."""
    size = F.greatest(F.octet_length("body"), F.lit(1))
    starts = F.sequence(F.lit(0), F.floor((size - 1) / BLOCK_BYTES).cast("int"))
    blocks = texts.select("row", "body", F.explode(starts).alias("at")).select(
        "row",
        "at",
        F.expr(f"substring(body, at * {BLOCK_BYTES} + 1, {BLOCK_BYTES})").alias(
            "block"
        ),
    )
    names = _named(ws, blocks, ["block"])
    while names.filter("at > 0").limit(1).count():
        even = F.col("at") % 2 == 0
        pairs = names.groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at"))
        pairs = ws.keep(
            pairs.agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias(
                    "right"
                ),
            )
        )
        following = _named(ws, pairs, ["left", "right"])
        ws.drop(names, pairs)
        names = following
    return names.select("row", "name")


def exact_dedup(documents: DataFrame) -> DataFrame:
    """Per row: id of the row that stays, group size, whether it stays, text digest."""
    ws = Workspace(documents.sparkSession, "exact-dedup")
    raw = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    binary = F.col("text").cast("binary")
    last = F.greatest(F.octet_length("text") - END_BYTES + 1, F.lit(1))
    ends = {
        "n_bytes": F.octet_length("text"),
        # The ends of a text may cut a character, so upper-case bytes go by way of hex.
        "head": normalised(F.decode(F.substring(binary, 1, END_BYTES), "ISO-8859-1")),
        "tail": normalised(
            F.decode(F.substring(binary, last, F.lit(END_BYTES)), "ISO-8859-1")
        ),
    }
    shared = ws.keep(
        raw.select(*[c.alias(n) for n, c in ends.items()])
        .groupBy(*ends)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(*ends, F.lit(True).alias("open"))
    )
    placed = raw.withColumns(ends).join(by_shuffle(shared), list(ends), "left")
    body = normalised(F.col("text"))
    rows = ws.keep(
        placed.select(
            "doc_id",
            F.sha2(body, 256).alias("text_sha256"),
            F.when(F.col("open"), body.cast("binary")).alias("body"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    candidates = rows.filter("body is not null")
    names = identities(ws, candidates.select("row", "body"))
    members = ws.keep(
        candidates.select("row", "doc_id", "text_sha256").join(by_shuffle(names), "row")
    )
    groups = ws.keep(
        members.groupBy("name").agg(
            F.max(F.struct("doc_id", "row")).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
        )
    )
    grouped = members.join(by_shuffle(groups), "name").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
    single = rows.filter("body is null").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return grouped.unionByName(single)
