"""Line deduplication by pairwise alignment (operator 4).

Documents overlap where they share a line, however many hold it and however long it is.
Each line links its later holders to its first one only, so a line in very many documents
gives as many links as holders and not their square.  Lines that a document repeats are
numbered, and the k-th in the later document is linked with the k-th in the first holder
(counted from the start again where that has fewer): a link then is one place on either
side, and a first holder of very many lines costs its partners nothing.

A document is aligned with each of its partners by patience diff.  As numbered lines occur
once on both sides, all of them are anchors, and the alignment is their longest common
order.  What it leaves, moved or repeated lines, is aligned among itself in the same way,
until every linked line lies in a chain.  A block is a run of lines that follow each other on
both sides of a chain, blank ones not counted.  A block of ``BLOCK_CHARS`` characters or
more is deleted from the later document; shorter ones are lines that agree by chance, such
as a lone bracket, and stay unless the lines before and after them go.  A blank line goes
where the lines before and after it go, or the only one of the two that there is.  A text
that equals an earlier one goes as a whole.

Lines are compared by a 128-bit digest of the line without surrounding white space.

Defined results: the earlier document is the one with the smaller id (then the smaller
text digest), and a first holder keeps the line it is first with, so all that is deleted stays
somewhere; a line of ``BLOCK_CHARS`` characters stays in its first holder only, with the
copies it has there.  A null text stays null, an empty one empty; rows that repeat id and text
are one document and are edited alike; a null id is never linked; columns of other names
than id and text are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import Workspace, by_shuffle, per_document

#: Characters of the least block that is deleted.
BLOCK_CHARS = 6
_WHITE = " \t\r\x0b\f"
#: The whole text stands for a line at this place.
_TEXT = -1

_LINES = (
    "doc_id long, digest binary, key binary, copy int, copies int, at int, line int, "
    "tail int, chars int"
)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def numbered_lines(text: str) -> Iterator[tuple]:
    """Every non-blank line as ``(key, copy, copies, at, line, tail, chars)``.

    ``at`` counts non-blank lines, ``line`` all of them; ``tail`` is the number of blank
    lines that end the text for the last one and -1 for others.
    """
    lines = text.split("\n")
    stripped = [(k, line.strip(_WHITE)) for k, line in enumerate(lines)]
    held = [(k, line) for k, line in stripped if line]
    copies = Counter(line for _, line in held)
    seen: Counter = Counter()
    keys = {x: hashlib.md5(x.encode("utf-8", "surrogatepass")).digest() for x in copies}
    for at, (k, line) in enumerate(held):
        tail = len(lines) - 1 - k if at == len(held) - 1 else -1
        yield keys[line], seen[line], copies[line], at, k, tail, len(line)
        seen[line] += 1


def _profiles(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
    rows = []
    for doc_id, text in zip(ids.to_pylist(), texts.to_pylist()):
        body = text.encode("utf-8", "surrogatepass")
        digest = hashlib.md5(body).digest()
        # No line holds a line feed, so none has the key of a text.
        whole = hashlib.md5(b"\n" + body).digest()
        rows.append((doc_id, digest, whole, 0, 1, _TEXT, _TEXT, -1, 0))
        rows.extend((doc_id, digest, *line) for line in numbered_lines(text))
    columns = zip(*rows) if rows else [()] * 9
    kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int32()] * 6]
    return [pa.array(c, kind) for c, kind in zip(columns, kinds)]


def longest_order(values: list[int]) -> list[int]:
    """Indices of a longest strictly ascending subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, value in enumerate(values):
        at = bisect_left(tails, value)
        tails[at : at + 1] = [value]
        ends[at : at + 1] = [k]
        back.append(ends[at - 1] if at else -1)
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(k)
        k = back[k]
    return chain[::-1]


def ascending_chains(values: list[int]) -> list[list[int]]:
    """Indices of all values in as few strictly ascending subsequences as there can be.

    A value goes to the chain with the greatest lesser end, of equal ones the latest, so
    a run of consecutive numbers is never parted.
    """
    ends: list[int] = []  # negated, ascending
    chains: list[list[int]] = []
    for k, value in enumerate(values):
        at = bisect_right(ends, -value)
        if at == len(ends):
            ends.append(-value)
            chains.append([k])
            continue
        latest = bisect_right(ends, ends[at]) - 1
        chains[at], chains[latest] = chains[latest], chains[at]
        ends[at] = -value
        chains[at].append(k)
    return chains


def aligned_blocks(links: list[tuple[int, int]]) -> list[list[int]]:
    """Indices of links ``(at, first_at)``, ascending by ``at``, as aligned blocks."""
    main = longest_order([j for _, j in links])
    taken = set(main)
    rest = [k for k in range(len(links)) if k not in taken]
    moved = ascending_chains([links[k][1] for k in rest])
    blocks: list[list[int]] = []
    for chain in [main, *[[rest[k] for k in c] for c in moved]]:
        last = None
        for k in chain:
            if last is None or links[k] != (last[0] + 1, last[1] + 1):
                blocks.append([])
            blocks[-1].append(k)
            last = links[k]
    return blocks


def deleted_lines(links: list[dict], block_chars: int = BLOCK_CHARS) -> list[int]:
    """Numbers of the lines, blank ones included, that a document loses."""
    links = sorted(links, key=lambda x: x["at"])
    partners: dict[tuple, list[dict]] = defaultdict(list)
    for link in links:
        partners[link["first_id"], link["first_digest"]].append(link)
    gone: set[int] = set()
    for own in partners.values():
        for block in aligned_blocks([(x["at"], x["first_at"]) for x in own]):
            if sum(own[k]["chars"] for k in block) >= block_chars:
                gone.update(own[k]["at"] for k in block)
    spared: list[int] = []  # linked lines that follow, without a gap, one that goes
    after_gone, last = False, None
    for at in [link["at"] for link in links]:
        if last is None or at != last + 1:
            spared, after_gone = [], False
        if at in gone:
            gone.update(spared)
            spared, after_gone = [], True
        elif after_gone:
            spared.append(at)
        last = at
    lines: list[int] = []
    before = None
    for link in links:
        if link["at"] not in gone:
            continue
        if link["at"] == 0:
            lines.extend(range(link["line"]))
        elif before is not None and before["at"] + 1 == link["at"]:
            lines.extend(range(before["line"] + 1, link["line"]))
        lines.append(link["line"])
        lines.extend(range(link["line"] + 1, link["line"] + 1 + max(link["tail"], 0)))
        before = link
    return lines


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, flags = [], [], []
        for k, cell in enumerate(batch.column("links")):
            links = cell.as_py()
            whole = any(x["at"] == _TEXT for x in links)
            lines = [] if whole else deleted_lines(links)
            if whole or lines:
                goes = np.zeros(lines[-1] + 1 if lines else 0, bool)
                goes[lines] = True
                kept.append(k)
                counts.append(None if whole else len(lines))
                flags.append(goes)
        rows = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                rows.column("digest"),
                pa.array([n is None for n in counts], pa.bool_()),
                pa.array(counts, pa.int64()),
                pa.array(flags, pa.list_(pa.bool_())),
            ],
            names=["doc_id", "digest", "whole", "n_gone", "goes"],
        )


def line_links(ws: Workspace, documents: DataFrame) -> DataFrame:
    """Every line that an earlier document holds too, with its place in the first one.

    ``(doc_id, digest, first_id, first_digest, at, line, tail, chars, first_at)``.
    """
    held = documents.select("doc_id", "text").filter("doc_id is not null and text <> ''")
    lines = ws.keep(per_document(held, _profiles, _LINES))
    # The least holder and the greatest; a group's rows shrink before the shuffle.
    holders = (
        lines.groupBy("key")
        .agg(
            F.min(F.struct("doc_id", "digest", "copies")).alias("first"),
            F.max(F.struct("doc_id", "digest")).alias("last"),
        )
        .filter(
            (F.col("first.doc_id") < F.col("last.doc_id"))
            | (F.col("first.digest") < F.col("last.digest"))
        )
        .select(
            "key",
            F.col("first.doc_id").alias("first_id"),
            F.col("first.digest").alias("first_digest"),
            F.col("first.copies").alias("first_copies"),
        )
    )
    joined = lines.join(by_shuffle(ws.keep(holders)), "key")
    is_first = (F.col("doc_id") == F.col("first_id")) & (
        F.col("digest") == F.col("first_digest")
    )
    shared = ws.keep(joined.withColumn("is_first", is_first))
    ws.drop(lines)
    places = ws.keep(
        shared.filter("is_first").groupBy("key", "copy").agg(F.min("at").alias("first_at"))
    )
    later = shared.filter("not is_first").withColumn(
        "copy", F.col("copy") % F.col("first_copies")
    )
    links = ws.keep(
        later.join(by_shuffle(places), ["key", "copy"]).select(
            "doc_id", "digest", "first_id", "first_digest",
            "at", "line", "tail", "chars", "first_at",
        )
    )
    ws.drop(shared, places)
    return links


def line_edits(ws: Workspace, documents: DataFrame) -> DataFrame:
    """``(doc_id, digest, whole, n_gone, goes)`` of every document that is edited.

    ``goes`` tells by line number whether a line is deleted; it ends with the last one.
    """
    links = line_links(ws, documents)
    # A document has at most as many links as lines; repeated rows give the same ones.
    row = F.struct(*[c for c in links.columns if c not in ("doc_id", "digest")])
    grouped = links.groupBy("doc_id", "digest").agg(F.collect_set(row).alias("links"))
    edits = ws.keep(
        grouped.mapInArrow(
            _edits,
            "doc_id long, digest binary, whole boolean, n_gone long, goes array<boolean>",
        )
    )
    ws.drop(links)
    return edits


def line_dedup(documents: DataFrame) -> DataFrame:
    """Every row with ``text`` edited, and ``n_lines`` and ``n_deleted`` added.

    All columns of ``documents`` are kept.
    """
    ws = Workspace(documents.sparkSession, "line-dedup")
    edits = line_edits(ws, documents).toDF(
        "__doc_id", "__digest", "__whole", "__n_gone", "__goes"
    )
    text = documents["text"].cast("string")
    joined = documents.join(
        by_shuffle(edits),
        (documents["doc_id"].cast("long") == edits["__doc_id"])
        & (_digest(text) == edits["__digest"]),
        "left",
    )
    lines = F.split(text, "\n", -1)
    n_lines = F.when(text.isNull() | (text == ""), 0).otherwise(F.size(lines))
    goes = edits["__goes"]
    kept = F.filter(lines, lambda _, i: ~F.coalesce(F.get(goes, i), F.lit(False)))
    edited = (
        F.when(edits["__whole"].isNull(), text)
        .when(edits["__whole"], F.lit(""))
        .otherwise(F.array_join(kept, "\n"))
    )
    n_deleted = F.when(edits["__whole"], n_lines).otherwise(
        F.coalesce(edits["__n_gone"], F.lit(0))
    )
    return joined.select(
        *[
            edited.alias(c) if c == "text" else documents[c]
            for c in documents.columns
            if c not in ("n_lines", "n_deleted")
        ],
        n_lines.cast("long").alias("n_lines"),
        n_deleted.cast("long").alias("n_deleted"),
    )
