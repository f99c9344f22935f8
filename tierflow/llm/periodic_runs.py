"""Stretches of words that repeat with a period, by basic factors (operator 12).

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends
keeping that period, of at least ``least_words`` words and ``least_periods`` periods.

The dictionary of basic factors names every factor of 1, 2, 4, ... words: equal factors
of a text have equal names, and the name of a longer one is that of the pair of its
halves, so names are exact.  A factor that occurs once cannot be part of a longer one that
occurs twice and is left out from there on.  At each length the next occurrence of a
factor, where it is near, proposes its distance as a period, and neighbouring places with
the same distance are an arithmetic progression.  A factor that is no shorter than the
period holds a whole one, so it does not occur again any sooner; hence the progression of
places with distance ``q`` is exactly as long as the run allows, and its ends are the
run's.  Distances between one and two lengths are proposed again, whole, by the next
length, and those of up to half a length were found before, so each run is taken once, at
the least length that is not below its period.

All texts of a slice are worked on at once; a document is one unit of work, as its text
is one value.  There is no shuffle.

Defined results: words are what lies between ASCII white space, compared byte by byte;
null and empty texts have no word and no run; every row is reported, repeated and null
ids included; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import text_slices
from tierflow.llm.words import WHITE, mapped, split_words

#: Bytes of text worked on at once; the arrays of all factors take some 60 bytes a word.
PIECE_BYTES = 4 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def _named(keys: np.ndarray, at: np.ndarray):
    """Name of every key, distance of each place to the next with its key (0: none),
    and which keys occur more than once; ``at`` ascends."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    gaps = np.zeros(len(keys), np.int64)
    gaps[order[:-1]] = np.where(same, np.diff(at[order]), 0)
    several = np.empty(len(keys), bool)
    several[order] = np.append(same, False) | np.insert(same, 0, False)
    return names, gaps, several


def _progressions(at: np.ndarray, gaps: np.ndarray):
    """First place, number of places and distance of stretches of equal distance."""
    near = np.flatnonzero(gaps)
    at, gaps = at[near], gaps[near]
    opens = np.ones(len(at), bool)
    opens[1:] = (np.diff(at) != 1) | (np.diff(gaps) != 0)
    first = np.flatnonzero(opens)
    return at[first], np.diff(np.append(first, len(at))), gaps[first]


def find_runs(
    codes: np.ndarray, offsets: np.ndarray, least_words: int, least_periods: int
) -> np.ndarray:
    """Rows of start in the flat array, length and period, by start and period.

    ``codes`` has a number per word, ``offsets`` where each text begins.
    """
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    longest = int(np.diff(offsets).max(initial=0))
    found = [np.empty((0, 3), np.int64)]
    at, size = np.arange(len(codes)), 1
    keys = owner * (int(codes.max(initial=0)) + 1) + codes
    while len(at) and least_periods * (size // 2 + 1) <= longest:
        names, gaps, several = _named(keys, at)
        covered = np.where((gaps <= size) & (gaps > size // 2), gaps, 0)
        start, places, period = _progressions(at, covered)
        length = places + period + size - 1
        long = length >= np.maximum(least_words, least_periods * period)
        found.append(np.column_stack([start, length, period])[long])
        # Two neighbouring factors are one of twice the size.
        at, names = at[several], names[several]
        place = np.full(len(codes), -1, np.int64)
        place[at] = np.arange(len(at))
        inside = np.flatnonzero(at + size < len(codes))
        right = place[at[inside] + size]
        paired = (right >= 0) & (owner[at[inside]] == owner[at[inside] + size])
        left, right = inside[paired], right[paired]
        keys = names[left] * (len(codes) + 1) + names[right]
        at, size = at[left], 2 * size
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _repeated_words(runs: np.ndarray, total: int) -> np.ndarray:
    """Words that lie in a run behind its first period."""
    depth = np.zeros(total + 1, np.int64)
    start, length, period = runs.T
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) > 0


def _worked(piece: pa.RecordBatch, least_words: int, least_periods: int) -> list:
    codes, words, offsets = split_words(mapped(piece.column("text"), WHITE))
    codes = codes.astype(np.int64)
    runs = find_runs(codes, offsets, least_words, least_periods)
    owner = np.searchsorted(offsets, runs[:, 0], "right") - 1
    listed = pa.StructArray.from_arrays(
        [
            pa.array(runs[:, 0] - offsets[owner]),
            pa.array(runs[:, 1]),
            pa.array(runs[:, 2]),
        ],
        fields=list(_RUN),
    )
    bounds = np.searchsorted(owner, np.arange(piece.num_rows + 1))
    kept = ~_repeated_words(runs, len(codes))
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    left = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), words.take(pa.array(codes[kept]))
    )
    return [
        piece.column("doc_id"),
        pa.array(np.diff(offsets)),
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), listed),
        pc.binary_join(left, " "),
    ]


def periodic_runs(
    documents: DataFrame, least_words: int = 6, least_periods: int = 4
) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, number of words, its runs by start and
    period, and its text less every word that lies in a run behind its first period,
    the words joined by single spaces.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods are not searched for")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=PIECE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    _worked(piece, least_words, least_periods),
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, _SCHEMA)
