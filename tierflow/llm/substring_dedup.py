"""Substring deduplication by MinHash banding of paragraphs (operator 1).

Paragraphs are lines of at least ``min_words`` words, and neighbouring shorter lines
joined until they hold as many.  Equal ones collapse first; the distinct ones get a
MinHash signature over word shingles, meet in shared bands, are verified on their full
shingle sets and form components.  Of a component the least document keeps its
paragraphs, those of other documents are removals.

A passage may also lie inside paragraphs that have little else in common, or run over
line breaks.  So every run of ``min_words`` words of a document's whole word stream that
another document keeps is a removal, found in two steps.  Of the ``SEED``-word runs
inside each such run the one of least hash is a seed; equal runs have equal seeds.  Then
only the runs whose seed occurs in several documents are compared, by a 64-bit hash of
all their words.  Runs that lie wholly in paragraphs removed before are left out, and a
document keeps a run for others only where none of its words lies in one.  Runs that
touch are one span; a span is reported line by line, so a row may hold fewer words than
``min_words`` where its span goes on in the next line.

Defined results: words are what lies between ASCII white space after lower-casing A-Z;
null and empty texts have no paragraph; what a document repeats of itself stays, and rows
that repeat an id are one document; a null id neither removes nor is removed; other
columns are ignored; an empty table gives no row.  Where runs overlap, the document that
keeps one may itself lose a part of it that a lesser document holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.near_dedup import (
    PERCENT,
    SHINGLE,
    band_keys,
    linked_components,
    signatures,
)
from tierflow.llm.shared import Workspace, by_shuffle, ragged_take, text_slices
from tierflow.llm.words import (
    MIX,
    SPACED,
    mapped,
    offsets_from,
    scrambled,
    shingle_hashes,
    split_words,
    word_hashes,
)

MIN_WORDS = 25
#: Bytes of text worked on at once; the arrays take some 150 bytes a word.
PIECE_BYTES = 4 << 20
#: Words of a seed.
SEED = 10
#: 3 rows in 12 bands miss a pair of similarity 0.75 once in 700, of 0.85 never.
ROWS, BANDS = 3, 12
#: Bits of a seed's place that break ties among equal hashes.
_PLACE = np.uint64((1 << 22) - 1)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


class _Lines:
    """A slice of texts as one array of word hashes, cut into lines and texts."""

    def __init__(self, piece: pa.RecordBatch):
        listed = pc.split_pattern(piece.column("text"), "\n")
        #: First line of every text, and behind the last one.
        self.tops = listed.offsets.to_numpy().astype(np.int64)
        self.tops = self.tops - self.tops[0]
        codes, self.words, self.ends = split_words(mapped(listed.flatten(), SPACED))
        self.codes = codes.astype(np.int64)
        known = word_hashes(self.words) if len(self.words) else np.empty(0, np.uint64)
        self.hashed = known[self.codes]

    @property
    def offsets(self) -> np.ndarray:
        """First word of every text."""
        return self.ends[self.tops]

    def units(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paragraphs: text, first line and the line behind the last one."""
        counts = np.diff(self.ends).tolist()
        rows, begins, stops = [], [], []
        for row, (top, bottom) in enumerate(zip(self.tops.tolist(), self.tops[1:].tolist())):
            first, held, joined = top, 0, False  # short lines as yet in no paragraph
            for k in range(top, bottom):
                own = counts[k]
                if own < min_words:
                    held += own
                    if held < min_words:
                        continue
                # What is left of short lines right behind joined ones goes with them.
                if own >= min_words and joined:
                    stops[-1] = k
                rows.append(row)
                begins.append(k if own >= min_words else first)
                stops.append(k + 1)
                first, held, joined = k + 1, 0, own < min_words
            if joined:
                stops[-1] = bottom
        return np.array(rows, np.int64), np.array(begins, np.int64), np.array(stops, np.int64)


def _of_units(lines: _Lines, begins: np.ndarray, stops: np.ndarray):
    """Word hashes of paragraphs one after another, and where each begins."""
    first, last = lines.ends[begins], lines.ends[stops]
    bounds = np.column_stack([first, last]).ravel()
    hashed, lengths = ragged_take(lines.hashed, bounds, 2 * np.arange(len(first)))
    return hashed, offsets_from(lengths)


@lru_cache(maxsize=2)
def _powers(count: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    made = []
    for factor in (base, pow(base, -1, 1 << 64)):
        power = np.full(count, factor, np.uint64)
        power[0] = 1
        made.append(np.cumprod(power, dtype=np.uint64))
    return made[0], made[1]


def range_hashes(
    hashed: np.ndarray, first: np.ndarray, last: np.ndarray, base: np.uint64 = MIX
) -> np.ndarray:
    """A hash of the words from ``first`` to before ``last``, wherever they lie.

    A polynomial of the words' hashes modulo 2**64, by differences of running sums.
    """
    up, down = _powers(1 << max(10, len(hashed).bit_length()), int(base))
    summed = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(hashed * down[: len(hashed)], out=summed[1:])
    return scrambled((summed[last] - summed[first]) * up[last])


def paragraphs(documents: DataFrame, min_words: int) -> DataFrame:
    """Paragraphs: place, words by line, 128-bit digest, bands and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=PIECE_BYTES):
                yield _marked_units(piece, min_words)

    return _rows(documents).mapInArrow(
        run,
        "doc_id long, row long, line int, sizes array<int>, d1 long, d2 long, "
        "bands array<bigint>, signature binary",
    )


def _marked_units(piece: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    lines = _Lines(piece)
    rows, begins, stops = lines.units(min_words)
    sizes = np.diff(lines.ends).astype(np.int32)
    bounds = np.column_stack([begins, stops]).ravel()
    flat, counts = ragged_take(sizes, bounds, 2 * np.arange(len(begins)))
    hashed, offsets = _of_units(lines, begins, stops)
    first, last = offsets[:-1], offsets[1:]
    length = (last - first).astype(np.uint64)
    shingles, starts = shingle_hashes(hashed, offsets, SHINGLE)
    signature = signatures(shingles, starts, ROWS * BANDS)
    keys = band_keys(signature, ROWS, BANDS)
    blobs = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(2 * ROWS * BANDS), len(rows), [None, pa.py_buffer(signature.astype("<u2").tobytes())]
    )
    wide = np.arange(len(rows) + 1, dtype=np.int32) * BANDS
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc_id").take(at),
            piece.column("row").take(at),
            pa.array((begins - lines.tops[rows]).astype(np.int32)),
            pa.ListArray.from_arrays(
                pa.array(offsets_from(counts), pa.int32()), pa.array(flat)
            ),
            *[
                pa.array((range_hashes(hashed, first, last, base) + length).view(np.int64))
                for base in (MIX, _OTHER)
            ],
            pa.ListArray.from_arrays(pa.array(wide), pa.array(keys.ravel())),
            blobs.cast(pa.binary()),
        ],
        names=["doc_id", "row", "line", "sizes", "d1", "d2", "bands", "signature"],
    )


def _paragraph_texts(documents: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """``(id, text)`` of the paragraphs ``wanted(id, doc_id, row, line)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=PIECE_BYTES):
                lines = _Lines(piece)
                rows, begins, stops = lines.units(min_words)
                names = piece.column("wanted").to_pylist()
                place = begins - lines.tops[rows]
                held = [{x["line"]: x["id"] for x in few} for few in names]
                ids = [held[r].get(k) for r, k in zip(rows.tolist(), place.tolist())]
                some = np.flatnonzero([i is not None for i in ids])
                bounds = np.column_stack(
                    [lines.ends[begins[some]], lines.ends[stops[some]]]
                ).ravel()
                codes, counts = ragged_take(lines.codes, bounds, 2 * np.arange(len(some)))
                listed = pa.ListArray.from_arrays(
                    pa.array(offsets_from(counts), pa.int32()), lines.words.take(pa.array(codes))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in some], pa.int64()), pc.binary_join(listed, " ")],
                    names=["id", "text"],
                )

    # A document's wanted paragraphs are no more than its paragraphs.
    per_text = wanted.groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("line", "id")).alias("wanted")
    )
    chosen = _rows(documents).join(by_shuffle(per_text), ["doc_id", "row"])
    return chosen.select("text", "wanted").mapInArrow(run, "id long, text string")


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, by doubling."""
    covered = 1
    while 2 * covered <= width:
        values = np.minimum(values[:-covered], values[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def seeds_of_runs(
    hashed: np.ndarray, offsets: np.ndarray, min_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every run of ``min_words`` words, first word and hash of its seed."""
    size = min(SEED, min_words)
    begin = np.arange(len(hashed) - min_words + 1)
    if not len(begin):
        nothing = np.empty(0, np.int64)
        return nothing, nothing, np.empty(0, np.uint64)
    grams = np.arange(len(hashed) - size + 1)
    value = range_hashes(hashed, grams, grams + size)
    # A gram's place in its own text, so that the choice does not depend on the slice.
    owner = np.searchsorted(offsets, grams, "right") - 1
    place = (grams - offsets[owner]).astype(np.uint64) & _PLACE
    least = _least_in_windows((value & ~_PLACE) | place, min_words - size + 1)
    begin = begin[begin + min_words <= offsets[owner[begin] + 1]]
    at = begin + (((least[begin] & _PLACE) - place[begin]) & _PLACE).astype(np.int64)
    return begin, at, value[at]


def seeds(documents: DataFrame, min_words: int) -> DataFrame:
    """Seeds of all runs: document, text, first word and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=PIECE_BYTES):
                lines = _Lines(piece)
                offsets = lines.offsets
                _, at, value = seeds_of_runs(lines.hashed, offsets, min_words)
                chosen = np.zeros(len(lines.hashed), bool)
                chosen[at] = True
                keys = np.zeros(len(lines.hashed), np.uint64)
                keys[at] = value
                at = np.flatnonzero(chosen)
                owner = np.searchsorted(offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(owner)),
                        piece.column("row").take(pa.array(owner)),
                        pa.array((at - offsets[owner]).astype(np.int32)),
                        pa.array(keys[at].view(np.int64)),
                    ],
                    names=["doc_id", "row", "at", "key"],
                )

    return _rows(documents).mapInArrow(run, "doc_id long, row long, at int, key long")


def runs_with(chosen: DataFrame, min_words: int) -> DataFrame:
    """Runs whose seeds are among ``seeds`` of their row and that do not lie wholly in the
    lines ``gone``: place, line, hash, and whether none of their words lies there; a text's
    first one has the words at which its lines begin and the text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=PIECE_BYTES):
                lines = _Lines(piece)
                offsets, ends, tops = lines.offsets, lines.ends, lines.tops
                begin, at, _ = seeds_of_runs(lines.hashed, offsets, min_words)
                wanted = np.zeros(len(lines.hashed), bool)
                wanted[_placed(piece.column("seeds"), offsets)] = True
                begin = begin[wanted[at]]
                gone = np.zeros(len(ends) - 1, np.int64)
                gone[_placed(piece.column("gone"), tops)] = 1
                inside = np.concatenate([[0], np.cumsum(np.repeat(gone, np.diff(ends)))])
                lost = inside[begin + min_words] - inside[begin]
                begin, lost = begin[lost < min_words], lost[lost < min_words]
                value = range_hashes(lines.hashed, begin, begin + min_words, _OTHER)
                owner = np.searchsorted(offsets, begin, "right") - 1
                line = np.searchsorted(ends, begin, "right") - 1 - tops[owner]
                starts: list = [None] * len(begin)
                for k in np.unique(owner, return_index=True)[1].tolist():
                    i = owner[k]
                    starts[k] = ends[tops[i] : tops[i + 1] + 1] - offsets[i]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(owner)),
                        piece.column("row").take(pa.array(owner)),
                        pa.array((begin - offsets[owner]).astype(np.int32)),
                        pa.array(line.astype(np.int32)),
                        pa.array(value.view(np.int64)),
                        pa.array(lost == 0),
                        pa.array(starts, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "row", "at", "line", "key", "free", "starts"],
                )

    return chosen.mapInArrow(
        run,
        "doc_id long, row long, at int, line int, key long, free boolean, "
        "starts array<int>",
    )


def _placed(listed: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Places in the slice of numbers listed per text; a null list has none."""
    counts = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
    numbers = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return numbers + np.repeat(offsets[:-1], counts)


def _rows(documents: DataFrame) -> DataFrame:
    """Texts with a hash that tells those of one id apart."""
    return (
        documents.filter("doc_id is not null and text is not null")
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
        .withColumn("row", F.xxhash64("text"))
    )


def _whole_lines(ws: Workspace, documents: DataFrame, min_words: int) -> DataFrame:
    """Lines of paragraphs that another document keeps, with the text's ``row``."""
    found = ws.keep(
        paragraphs(documents, min_words).withColumn("pid", F.monotonically_increasing_id())
    )
    # Equal paragraphs are one from here on, named by their first one.
    place = ("doc_id", "line", "row", "pid")
    distinct = ws.keep(
        found.groupBy("d1", "d2")
        .agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("id", F.col("first.pid"))
    )
    marks = ws.keep(
        found.select(F.col("pid").alias("id"), "bands", "signature").join(
            by_shuffle(distinct.select("id")), "id", "left_semi"
        )
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        at = distinct.select("id", "first.doc_id", "first.row", "first.line")
        at = at.join(by_shuffle(wanted), "id", "left_semi")
        return _paragraph_texts(documents, at, min_words)

    classes = linked_components(
        ws, marks, texts_of, ROWS, BANDS, SHINGLE, PERCENT, by_band=True
    )
    classes = ws.keep(classes)
    ws.drop(marks)
    named = ws.keep(
        distinct.join(by_shuffle(classes), "id", "left")
        .filter("n > 1 or component is not null")
        .select("d1", "d2", "n", "first", F.coalesce("component", "id").alias("cluster"))
    )
    ws.drop(distinct)
    clusters = ws.keep(
        named.groupBy("cluster")
        .agg(
            F.sum("n").alias("members"),
            F.min(F.struct("first.doc_id", "first.line")).alias("keep"),
        )
        .filter("members > 1")
    )
    repeated = ws.keep(
        named.join(by_shuffle(clusters), "cluster").select("d1", "d2", "keep")
    )
    whole = ws.keep(
        found.select("doc_id", "row", "line", "sizes", "d1", "d2")
        .join(by_shuffle(repeated), ["d1", "d2"])
        .filter(F.col("doc_id") != F.col("keep.doc_id"))
        .select(
            "doc_id", "row", "line", F.posexplode("sizes").alias("below", "words"), "keep"
        )
        .filter("words > 0")
        .select(
            "doc_id",
            "row",
            (F.col("line") + F.col("below")).alias("line"),
            F.lit(0).alias("first_word"),
            "words",
            F.col("keep.doc_id").alias("keep_doc_id"),
            F.col("keep.line").alias("keep_line"),
        )
        .distinct()
    )
    ws.drop(found, classes, named, clusters, repeated)
    return whole


def _repeated_runs(
    ws: Workspace, documents: DataFrame, whole: DataFrame, min_words: int
) -> DataFrame:
    found = ws.keep(seeds(documents, min_words))
    shared = ws.keep(
        found.groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("key")
    )
    places = ws.keep(
        found.join(by_shuffle(shared), "key")
        .groupBy("doc_id", "row")
        .agg(F.collect_set("at").alias("seeds"))
    )
    ws.drop(found, shared)
    gone = whole.groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone"))
    chosen = (
        _rows(documents)
        .join(by_shuffle(places), ["doc_id", "row"])
        .join(by_shuffle(gone), ["doc_id", "row"], "left")
    )
    grams = ws.keep(runs_with(chosen, min_words))
    ws.drop(places)
    firsts = ws.keep(
        grams.groupBy("key")
        .agg(
            F.min(F.when(F.col("free"), F.struct("doc_id", "line"))).alias("keep"),
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
        )
        .filter("low < keep.doc_id or high > keep.doc_id")
        .select("key", "keep")
    )
    repeats = ws.keep(
        grams.select("doc_id", "row", "at", "key")
        .join(by_shuffle(firsts), "key")
        .filter(F.col("doc_id") != F.col("keep.doc_id"))
        .select("doc_id", "row", "at", "keep")
        .distinct()
    )
    starts = ws.keep(
        grams.filter("starts is not null").select("doc_id", "row", "starts").distinct()
    )
    ws.drop(grams, firsts)
    text = Window.partitionBy("doc_id", "row").orderBy("at")
    gap = F.col("at") - F.lag("at").over(text)
    opens = F.when(gap <= min_words, 0).otherwise(1)
    spans = (
        repeats.withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(text))
        .groupBy("doc_id", "row", "run")
        .agg(
            F.min("at").alias("first"),
            (F.max("at") + min_words).alias("last"),
            F.min("keep").alias("keep"),
        )
    )
    parts = F.transform(
        F.sequence(F.lit(0), F.size("starts") - 2),
        lambda i: F.struct(
            i.alias("line"),
            F.get("starts", i).alias("start"),
            F.greatest("first", F.get("starts", i)).alias("first"),
            F.least("last", F.get("starts", i + 1)).alias("last"),
        ),
    )
    return (
        spans.join(by_shuffle(starts), ["doc_id", "row"])
        .withColumn("part", F.explode(F.filter(parts, lambda x: x["last"] > x["first"])))
        .select(
            "doc_id",
            "row",
            "part.line",
            (F.col("part.first") - F.col("part.start")).alias("first_word"),
            (F.col("part.last") - F.col("part.first")).alias("words"),
            F.col("keep.doc_id").alias("keep_doc_id"),
            F.col("keep.line").alias("keep_line"),
        )
        .distinct()
    )


def removals(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per span and line to remove: document, line, first word, number of words,
    and where the text stays.  A line removed whole is not reported by parts as well."""
    ws = Workspace(documents.sparkSession, "substring-dedup")
    whole = _whole_lines(ws, documents, min_words)
    runs = _repeated_runs(ws, documents, whole, min_words).join(
        by_shuffle(whole.select("doc_id", "row", "line").distinct()),
        ["doc_id", "row", "line"],
        "left_anti",
    )
    return whole.unionByName(runs.select(*whole.columns)).drop("row").distinct()
