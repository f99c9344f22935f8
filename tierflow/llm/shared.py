"""What the operators share: written intermediates, components, exact similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sinks.scratch import scratch_path

#: Documents of one Arrow batch are worked on in slices of about this many bytes.
SLICE_BYTES = 16 << 20
#: Whether shuffle files are deleted as their execution ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """Intermediate tables of one operator call, written to the shared folder.

    A written table cuts the lineage, survives lost executors, and gives joins two
    plain shuffles, which is the shape in which adaptive execution splits a hot key.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._paths: list[tuple[DataFrame, str]] = []
        self._count = 0

    def keep(self, frame: DataFrame) -> DataFrame:
        """Write ``frame`` and read it back; its shuffle files go once it is written."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}"
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        self._paths.append((kept, path))
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Delete written tables that nothing will read any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [p for kept, p in self._paths if any(kept is f for f in frames)]:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        self._paths = [x for x in self._paths if all(x[0] is not f for f in frames)]


def by_shuffle(frame: DataFrame) -> DataFrame:
    """Ask for a sort-merge join with ``frame``, a side that grows with the input.

    The plan then is the same at every size, and a hot key can be split.
    """
    return frame.hint("merge")


def text_slices(
    batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows that hold a bounded number of text bytes.

    A single text may be longer than the bound; it then is a slice of its own.
    """
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    part = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def ragged_take(
    values: np.ndarray, offsets: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array in the given order: their values and lengths."""
    lengths = np.diff(offsets)[rows]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + len(values) < 2**31 else np.int64
    at = np.repeat((offsets[:-1][rows] - (ends - lengths)).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return values[at], lengths


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``edges(a, b)``, component the least id.

    Alternating star contractions: each round hangs all larger neighbours, then all
    smaller ones, on a node's least neighbour, until neither moves any.  Rounds grow with
    the logarithm of the longest chain.  The least neighbours are written apart, so the
    join can split a node that links to a large part of all others.
    """
    current = ws.keep(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    moved = True
    while moved:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            current.select("lo", "hi")
        )
        least = ws.keep(
            both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        )
        large = ws.keep(
            both.join(by_shuffle(least), "u")
            .filter("v > u and v <> m")
            .select(
                F.col("v").alias("hi"),
                F.col("m").alias("lo"),
                (F.col("m") != F.col("u")).alias("moved"),
            )
        )
        lower = ws.keep(large.groupBy("hi").agg(F.min("lo").alias("m")))
        following = ws.keep(
            large.join(by_shuffle(lower), "hi")
            .filter("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"), F.lit(True))
            .union(lower.select("hi", "m", F.lit(False)))
            .toDF("hi", "lo", "moved")
            .groupBy("hi", "lo")
            .agg(F.max("moved").alias("moved"))
        )
        moved = any(not x.filter("moved").isEmpty() for x in (large, following))
        ws.drop(current, least, large, lower)
        current = following
    roots = current.select("lo").distinct()
    return current.select(
        F.col("hi").alias("id"), F.col("lo").alias("component")
    ).union(roots.select("lo", "lo"))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space after lower-casing A-Z only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int) -> frozenset:
    """Distinct word shingles; a shorter text is one shingle, an empty one none."""
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[k:] for k in range(size)]))


def similar(a: frozenset, b: frozenset, percent: int) -> bool:
    """Whether the Jaccard similarity is at least ``percent`` of 100."""
    if not a or not b:
        return False
    shared = len(a & b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(
    ws: Workspace,
    pairs: DataFrame,
    texts: DataFrame,
    size: int,
    percent: int,
) -> DataFrame:
    """The pairs ``(a, b)`` of ``texts(id, text)`` whose full shingle sets are similar.

    ``texts`` should hold little else.  Rows arrive sorted by ``b``, the side a large
    group has in common, so its set is built once per run.
    """
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(by_shuffle(left), "a").join(by_shuffle(right), "b")
    joined = joined.select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_set = None, frozenset()
        for batch in batches:
            a, b = [], []
            for i, j, x, y in zip(*[c.to_pylist() for c in batch.columns]):
                if x == y:
                    same = bool(words_of(x))
                else:
                    if y != last_text:
                        last_text, last_set = y, shingle_set(words_of(y), size)
                    same = similar(shingle_set(words_of(x), size), last_set, percent)
                if same:
                    a.append(i)
                    b.append(j)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return ws.keep(joined.mapInArrow(check, "a long, b long").distinct())


def per_document(
    documents: DataFrame,
    work: Callable[[pa.Array, pa.Array], list],
    schema: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``work(ids, texts)`` over slices of all documents; it returns a column each.

    Ids become 64-bit integers; null ids and texts reach ``work`` as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=slice_bytes):
                made = work(piece.column("doc_id"), piece.column("text"))
                yield pa.RecordBatch.from_arrays(made, names=names)

    names = [field.split()[0] for field in schema.split(", ")]
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).mapInArrow(run, schema)


def annotated(
    documents: DataFrame,
    work: Callable[[pa.Array, pa.Array], list],
    schema: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All columns of ``documents`` and the ones that ``work`` adds, without a shuffle.

    As ``per_document``, but a column of an added name is replaced.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    kept = documents.drop(*names)
    added = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, text_column):
                ids = piece.column(id_column).cast(pa.int64())
                texts = piece.column(text_column).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *work(ids, texts)],
                    names=[*piece.schema.names, *names],
                )

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))
