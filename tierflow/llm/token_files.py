"""Token ids as Simple-8b coded files (operator 6).

A 64-bit word holds a selector in its upper four bits and below it as many ids as fit
at the selector's width.  Ids come in blocks of 1024; a chunk is a run of whole
documents with its blocks' word offsets, so all blocks of a chunk are coded and decoded
at once.  Chunks lie in Parquet files, which Spark's committer makes safe against lost
executors: a row has the shard, the chunk's place in it, the documents' ids and lengths,
the block offsets (little-endian 32-bit) and the words (little-endian 64-bit).

Selector 15 is the escape: one id of up to 60 bits on its own.

Defined results: a null or empty text is the end id alone; rows of the same id follow
each other, ordered by text; null ids come first; other columns are ignored; an empty
table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.shared import offsets_of, text_slices
from tierflow.llm.tokens import token_ids

BLOCK = 1024
CHUNK_IDS = 1 << 20
#: Ids a word holds, by selector; the width is 60 over this.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2])
WIDTHS = 60 // COUNTS
ESCAPE = 15
_SELECTOR = np.full(61, ESCAPE, np.uint8)
_SELECTOR[COUNTS] = np.arange(len(COUNTS))

_CHUNKS = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<bigint>, "
    "doc_lengths array<bigint>, block_offsets binary, words binary"
)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, exact below 2**53 and 60 from there on."""
    if int(ids.max(initial=0)) < len(_SHORT_BITS):
        return _SHORT_BITS[ids]
    bits = np.frexp(ids.astype(np.float64))[1]
    return np.where(ids >> np.uint64(53) != 0, 60, bits).astype(np.uint8)


_SHORT_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _steps(bits: np.ndarray) -> np.ndarray:
    """How many ids the densest word that begins at each place holds.

    ``widest`` is the greatest bit length of the next ids, for more and more of them.
    """
    step = np.ones(bits.shape, np.uint8)
    widest, reach = bits, 1
    for count, width in zip(COUNTS[::-1].tolist(), WIDTHS[::-1].tolist()):
        while reach < count:
            more = min(reach, count - reach)
            ahead = np.zeros_like(widest)
            ahead[:, :-more] = widest[:, more:]
            widest, reach = np.maximum(widest, ahead), reach + more
        np.copyto(step, count, where=widest <= width)
    return step


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids and the word offset of every block."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    if int(ids.max()) >= 1 << 60:
        raise ValueError("ids of more than 60 bits cannot be coded")
    blocks, most = -(-n // BLOCK), int(COUNTS[0])
    # Zeros behind every block let its last word reach past the end.
    padded = np.zeros((blocks, BLOCK + most), np.uint64)
    whole = n // BLOCK
    padded[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    padded[whole:, : n - whole * BLOCK] = ids[whole * BLOCK :]
    step = _steps(_bit_lengths(padded)).ravel()
    flat = padded.ravel()
    at = np.arange(blocks) * padded.shape[1]
    end = at + np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    found = []
    while len(at):  # the next word of every block at once
        found.append(at)
        at = at + step[at]
        at, end = at[at < end], end[at < end]
    begins = np.sort(np.concatenate(found))
    selector = _SELECTOR[step[begins]]
    words = selector.astype(np.uint64) << np.uint64(60)
    for k in np.unique(selector):
        rows = np.flatnonzero(selector == k)
        count, width = (1, 60) if k == ESCAPE else (int(COUNTS[k]), int(WIDTHS[k]))
        first = begins[rows]
        packed = words[rows]
        for j in range(count):
            packed |= flat[first + j] << np.uint64(j * width)
        words[rows] = packed
    per_block = np.bincount(begins // padded.shape[1], minlength=blocks)
    return words, offsets_of(per_block)


def decode_ids(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Ids of all blocks; only a block's last word may hold fewer than it could."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    held = np.where(selector == ESCAPE, 1, np.append(COUNTS, [1, 1, 1])[selector])
    blocks = len(offsets) - 1
    if blocks > 0:
        sizes = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
        summed = offsets_of(held)
        last = offsets[1:] - 1
        held[last] -= summed[offsets[1:]] - summed[offsets[:-1]] - sizes
    at = offsets_of(held)[:-1]
    out = np.empty(n, np.uint64)
    for k in np.unique(selector):
        rows = np.flatnonzero(selector == k)
        if k == ESCAPE:
            out[at[rows]] = words[rows] & np.uint64((1 << 60) - 1)
            continue
        mask = np.uint64((1 << int(WIDTHS[k])) - 1)
        for j in range(COUNTS[k]):
            some = rows[j < held[rows]]
            out[at[some] + j] = words[some] >> np.uint64(j * WIDTHS[k]) & mask
    return out


def _chunk(shard: int, chunk: int, first: int, docs: list, parts: list[np.ndarray]):
    ids = np.concatenate(parts)
    words, offsets = encode_ids(ids.astype(np.uint64))
    return {
        "shard": shard,
        "chunk": chunk,
        "first": first,
        "n_ids": len(ids),
        "doc_ids": docs,
        "doc_lengths": [len(part) for part in parts],
        "block_offsets": offsets.astype("<u4").tobytes(),
        "words": words.astype("<u8").tobytes(),
    }


def write_token_files(
    documents: DataFrame, target: str, path: str, end_id: int
) -> None:
    """Write all documents' ids under ``target`` in ascending order of ``doc_id``.

    Range partitions of the texts become shards; each is sorted and written apart.
    """
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("chunk", pa.int32()),
            ("first", pa.int64()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_lengths", pa.list_(pa.int64())),
            ("block_offsets", pa.binary()),
            ("words", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        parts: list[np.ndarray] = []
        held = 0

        def flushed() -> pa.RecordBatch:
            row = _chunk(shard, chunk, first, docs, parts)
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for piece in text_slices(batch):
                ids, offsets = token_ids(piece.column("text"), path)
                names = piece.column("doc_id").to_pylist()
                for doc, begin, end in zip(names, offsets, offsets[1:]):
                    docs.append(doc)
                    parts.append(np.append(ids[begin:end], np.uint32(end_id)))
                    held += len(parts[-1])
                    if held >= CHUNK_IDS:
                        yield flushed()
                        docs, parts, first = [], [], first + held
                        chunk, held = chunk + 1, 0
        if docs:
            yield flushed()

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    chunks = ordered.mapInArrow(run, _CHUNKS)
    chunks.write.option("compression", "zstd").parquet(target)


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files."""

    def rows(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(
            pa.array(offsets_of(lengths), pa.int32()), pa.array(ids.astype(np.int64))
        )

    return _decoded(spark, target, rows, "array<bigint>", "ids")


def read_token_checks(spark: SparkSession, target: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""

    def checks(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        data, ends = memoryview(ids.astype("<u4").tobytes()), offsets_of(lengths) * 4
        return pa.array(
            [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])], pa.int64()
        )

    return _decoded(spark, target, checks, "bigint", "ids_crc32")


def _decoded(spark: SparkSession, target: str, made, kind: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_ids(
                    np.frombuffer(row["words"], "<u8"),
                    np.frombuffer(row["block_offsets"], "<u4").astype(np.int64),
                    row["n_ids"],
                )
                lengths = np.array(row["doc_lengths"], np.int64)
                begins = row["first"] + offsets_of(lengths)[:-1]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins),
                        pa.array(lengths),
                        made(ids, lengths),
                    ],
                    names=["shard", "doc_id", "begin", "n_tokens", name],
                )

    files = spark.read.schema(_CHUNKS).parquet(target)
    documents = files.mapInArrow(
        run, f"shard int, doc_id bigint, begin bigint, n_tokens bigint, {name} {kind}"
    )
    # A row per shard, and shards are Spark partitions: a short window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (
        files.groupBy("shard")
        .agg(F.sum("n_ids").alias("n"))
        .select(
            F.col("shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
        )
    )
    return documents.join(shards, "shard").select(
        "doc_id", (F.col("begin") + F.col("shift")).alias("start"), "n_tokens", name
    )
