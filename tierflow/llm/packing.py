"""Harmonic packing of documents into fixed-length sequences (operator 2).

Slots have the lengths ``capacity // k``: reciprocals of the capacity.  A document is
cut greedily into the longest slot that still fits, so every piece fills its slot, and
class ``k`` puts exactly ``k`` pieces into a bin.  The remainder shrinks quadratically,
so a document of n tokens has about ``n / capacity + 3`` pieces.

Each worker numbers its own pieces of a class.  A small table of counts per worker and
class shifts these numbers, and a piece's bin and place follow from its number alone.
At most ``k - 1`` pieces a class are left over, a number that does not grow with the
input; they are packed together, the longest first.

Defined results: a null or empty text is the end id alone; repeated rows are packed
each; null ids are kept; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.shared import Workspace, text_slices
from tierflow.llm.tokens import token_ids

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "worker int, number long"
)


def slot_lengths(capacity: int) -> list[int]:
    """Distinct reciprocal lengths, the longest first."""
    return sorted({capacity // k for k in range(1, capacity + 1)}, reverse=True)


def cuts(tokens: int, capacity: int, slots: np.ndarray) -> list[int]:
    """Lengths of the pieces of a document; ``slots`` ascend."""
    whole, rest = divmod(tokens, capacity)
    made = [capacity] * whole
    while rest:
        slot = int(slots[np.searchsorted(slots, rest, "right") - 1])
        made.append(slot)
        rest -= slot
    return made


def cut_documents(
    documents: DataFrame, path: str, capacity: int, end_id: int
) -> DataFrame:
    """Pieces with their number inside worker and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.array(slot_lengths(capacity)[::-1])
        worker, numbers = TaskContext.get().partitionId(), dict.fromkeys(slots, 0)
        for batch in batches:
            for part in text_slices(batch):
                ids, offsets = token_ids(part.column("text"), path)
                rows: list[tuple] = []
                for doc, first, last in zip(
                    part.column("doc_id").to_pylist(), offsets, offsets[1:]
                ):
                    own = np.append(ids[first:last], end_id).astype("<u4")
                    start = 0
                    for length in cuts(len(own), capacity, slots):
                        crc = zlib.crc32(own[start : start + length].tobytes())
                        number = numbers[length]
                        rows.append((doc, start, length, crc, len(own), worker, number))
                        numbers[length] += 1
                        start += length
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=[f.split()[0] for f in _PIECES.split(", ")],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, _PIECES)


def _left_over(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        """First fit, the longest first; at most a few thousand pieces ever come."""
        order = np.lexsort(
            [
                table.column(c).to_numpy()
                for c in ("number", "worker", "start", "length")
            ]
        )[::-1]
        lengths = table.column("length").to_numpy()[order]
        free: list[int] = []
        bins, offsets = [], []
        for length in lengths.tolist():
            k = next((i for i, room in enumerate(free) if room >= length), len(free))
            if k == len(free):
                free.append(capacity)
            bins.append(k)
            offsets.append(capacity - free[k])
            free[k] -= length
        return (
            table.take(pa.array(order))
            .drop_columns(["bin", "offset"])
            .append_column("bin", pa.array(bins, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    return pack


def pack(
    documents: DataFrame, path: str, capacity: int = 1024, end_id: int = 0
) -> DataFrame:
    """One row per piece: document, start, length, checksum, sequence and offset.

    Sequence ids count from 0 without gaps; offsets inside a sequence are gapless.
    """
    ws = Workspace(documents.sparkSession, "packing")
    pieces = ws.keep(cut_documents(documents, path, capacity, end_id))
    per_class = F.floor(F.lit(capacity) / F.col("length")).cast("long")

    # A row per worker and class; workers are Spark partitions.
    earlier = Window.partitionBy("length").orderBy("worker")
    counts = ws.keep(pieces.groupBy("length", "worker").agg(F.count("*").alias("n")))
    shifts = counts.select(
        "length",
        "worker",
        F.coalesce(
            F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
    )
    # A row per class: how many bins it fills, and how many the longer classes fill.
    filled = (
        counts.groupBy("length")
        .agg(F.sum("n").alias("n"))
        .select("length", F.floor(F.col("n") / per_class).cast("long").alias("bins"))
    )
    longer = Window.orderBy(F.col("length").desc())
    classes = ws.keep(
        filled.select(
            "length",
            "bins",
            (F.sum("bins").over(longer) - F.col("bins")).alias("base"),
            F.sum("bins").over(Window.partitionBy()).alias("all_bins"),
        )
    )
    shifts = ws.keep(shifts.join(F.broadcast(classes), "length"))
    placed = pieces.join(shifts, ["length", "worker"]).withColumns(
        {"rank": F.col("before") + F.col("number"), "per_bin": per_class}
    )
    bin_ = F.floor(F.col("rank") / F.col("per_bin")).cast("long")
    placed = placed.withColumns(
        {
            "bin": bin_,
            "offset": (F.col("rank") % F.col("per_bin")) * F.col("length"),
        }
    )
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = placed.filter("bin < bins").select(
        *out, (F.col("base") + F.col("bin")).alias("sequence_id"), "offset"
    )
    fields = [*out, "worker", "number", "all_bins", "bin", "offset"]
    rest = placed.filter("bin >= bins").select(*fields)
    rest = rest.groupBy().applyInArrow(_left_over(capacity), rest.schema)
    return full.unionByName(
        rest.select(
            *out, (F.col("all_bins") + F.col("bin")).alias("sequence_id"), "offset"
        )
    )
