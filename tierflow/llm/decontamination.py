"""Benchmark decontamination by one Aho-Corasick automaton (operator 5).

Test items are normalised to words; every run of ``window`` words, or a shorter item
whole, is a pattern over word numbers.  A document is mapped to the same numbers byte by
byte, so a word's place in the original text is known, and the automaton reads it once.
A word inside any match is hit; a match names the items that have its pattern.

The automaton is built in each Python worker from broadcast items.  Spark normalises the
items and cuts very long ones into overlapping pieces; the driver deals the pieces into
parts of bounded size, one automaton each, and groups of at most ``GROUP`` parts.  It holds
and broadcasts one group at a time (and reads the next).  A usual benchmark is one part of
one group, and texts are scanned once; each further group is another pass, which reads
what the pass before wrote: the texts with the words hit and the items found so far.

Defined results: a null or empty text has no words; an item without words, with a null
text or with a null id never occurs; items that share an id count once; repeated rows
count each; other columns are ignored; an empty benchmark contaminates nothing; an empty
table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.shared import Workspace, text_slices
from tierflow.llm.words import ALPHANUMERIC, mapped, split_words

WINDOW = 13
#: Bytes of item texts in one part, new words of one piece of an item, parts broadcast at once.
PART_BYTES = 4 << 20
PIECE_WORDS = 50_000
GROUP = 8
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_SUMMARY = (
    "n_words long, n_hit long, n_items long, items_sha256 string, "
    "spans array<struct<first:int,last:int>>"
)


class Automaton:
    """Patterns of one part of the items over numbers of their words."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        import ahocorasick

        self.numbers: dict[str, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            coded = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            size = min(window, len(coded))
            for k in range(len(coded) - size + 1 if size else 0):
                owners.setdefault(tuple(coded[k : k + size]), set()).add(item)
        self.patterns = [(len(p), tuple(sorted(i))) for p, i in owners.items()]
        self.shortest = min((n for n, _ in self.patterns), default=0)
        self.machine = ahocorasick.Automaton(
            ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE
        )
        for number, pattern in enumerate(owners):
            self.machine.add_word(pattern, number)
        if owners:
            self.machine.make_automaton()

    def matches(self, coded: list[int]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """First word, word after the last, and items of every match."""
        for last, number in self.machine.iter(tuple(coded)):
            size, items = self.patterns[number]
            yield last + 1 - size, last + 1, items


_BUILT: list[tuple[list, Automaton]] = []


def _automaton(shared, window: int) -> Automaton:
    """The worker's automaton of a broadcast part; the latest few are remembered."""
    for items, built in _BUILT:
        if items is shared.value:
            return built
    _BUILT[:] = [*_BUILT[1 - GROUP :], (shared.value, Automaton(shared.value, window))]
    return _BUILT[-1][1]


def item_words(text: str | None) -> list[str]:
    return (
        (text or "")
        .encode("utf-8", "surrogatepass")
        .translate(ALPHANUMERIC)
        .decode("utf-8", "surrogatepass")
        .split(" ")
    )


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """``(item_id, words)``: normalised items in pieces that hold every window of theirs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                ids, pieces = [], []
                for item, text in zip(*[c.to_pylist() for c in piece.columns]):
                    words = [w for w in item_words(text) if w]
                    for k in range(0, max(len(words) - window + 1, 1), PIECE_WORDS):
                        ids.append(item)
                        pieces.append(" ".join(words[k : k + PIECE_WORDS + window - 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(pieces, pa.string())],
                    names=["item_id", "words"],
                )

    given = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.col("text").cast("string").alias("text"),
    )
    return (
        given.filter("item_id is not null and text is not null")
        .mapInArrow(cut, "item_id string, words string")
        .filter("words <> ''")
    )


def item_parts(
    benchmark: DataFrame, window: int
) -> Iterator[list[tuple[str, list[str]]]]:
    """Pieces of items with their words, in parts of bounded size; one at least."""
    part, size = [], 0
    for row in item_pieces(benchmark, window).toLocalIterator():
        if size > PART_BYTES:
            yield part
            part, size = [], 0
        size += len(row.words)
        part.append((row.item_id, row.words.split(" ")))
    yield part


def _runs(known: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Longest run of known words in every text."""
    place = np.arange(len(known))
    breaks = np.where(known, -1, place)
    starts = np.repeat(offsets[:-1] - 1, np.diff(offsets))
    length = place - np.maximum(np.maximum.accumulate(breaks), starts)
    length = np.append(np.where(known, length, 0), 0)
    longest = np.zeros(len(offsets) - 1, np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        longest[full] = np.maximum.reduceat(length, offsets[:-1][full])
    return longest


def scan(
    texts: pa.Array,
    automata: list[Automaton],
    before: tuple[pa.Array, pa.Array] | None = None,
) -> Iterator[tuple]:
    """Per text: number of words, hit words as a mask or None, items found.

    ``before`` has the packed masks and the items of earlier passes.
    """
    codes, words, offsets = split_words(mapped(texts, ALPHANUMERIC))
    listed = words.to_pylist()
    found: dict[int, tuple[np.ndarray, set]] = {}
    for k in np.flatnonzero(before[0].is_valid()).tolist() if before else ():
        bits = np.frombuffer(before[0][k].as_py(), np.uint8)
        mask = np.unpackbits(bits, count=int(offsets[k + 1] - offsets[k])).astype(bool)
        found[k] = mask, set(before[1][k].as_py())
    for automaton in automata:
        if not automaton.patterns or not len(codes):
            continue
        numbers = np.fromiter(
            (automaton.numbers.get(w, 0) for w in listed), np.int64, len(listed)
        )[codes]
        longest = _runs(numbers > 0, offsets)
        for k in np.flatnonzero(longest >= automaton.shortest).tolist():
            own = numbers[offsets[k] : offsets[k + 1]].tolist()
            for first, last, items in automaton.matches(own):
                mask, held = found.setdefault(k, (np.zeros(len(own), bool), set()))
                mask[first:last] = True
                held.update(items)
    for k, n in enumerate(np.diff(offsets).tolist()):
        mask, held = found.get(k, (None, set()))
        yield n, mask, held


def original_spans(text: str, mask: np.ndarray) -> list[dict]:
    """Runs of hit words as character ranges of the text as it was."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    places = [m.span() for m in _WORD.finditer(text)]
    return [
        {"first": places[a][0], "last": places[b - 1][1]}
        for a, b in edges.reshape(-1, 2).tolist()
    ]


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """Whether a twentieth or more of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _state(found: list[tuple], texts: pa.Array) -> list[pa.Array]:
    masks = [None if mask is None else np.packbits(mask).tobytes() for _, mask, _ in found]
    items = [sorted(held) for _, _, held in found]
    return [pa.array(masks, pa.binary()), pa.array(items, pa.list_(pa.string()))]


_STATE = "__mask binary, __items array<string>"


def _pass(
    documents: DataFrame,
    shared: list,
    window: int,
    made: Callable[[list[tuple], pa.Array], list[pa.Array]],
    schema: str,
    without: list[str],
) -> DataFrame:
    """Texts scanned for a group of parts; ``made`` gives the added columns."""
    added = T.StructType.fromDDL(schema)
    resumed = "__mask" in documents.columns
    left_out = {*without, "__mask", "__items"}
    kept = [f for f in documents.schema.fields if f.name not in left_out]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [_automaton(part, window) for part in shared]
        for batch in batches:
            for piece in text_slices(batch):
                texts = piece.column("text").cast(pa.string())
                before = None
                if resumed:
                    before = piece.column("__mask"), piece.column("__items")
                columns = made(list(scan(texts, automata, before)), texts)
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(n) for n in names], *columns],
                    names=[*names, *added.names],
                )

    return documents.mapInArrow(run, T.StructType([*kept, *added.fields]))


def _scanned(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int,
    made: Callable[[list[tuple], pa.Array], list[pa.Array]],
    schema: str,
    without: list[str],
) -> DataFrame:
    """Columns of ``documents`` but ``without``, and those that ``made`` gives in the end."""
    spark = documents.sparkSession
    context = spark.sparkContext
    ws = None
    parts = item_parts(benchmark, window)
    group = list(islice(parts, GROUP))
    while True:
        following = list(islice(parts, GROUP))
        shared = [context.broadcast(part) for part in group]
        if not following:
            return _pass(documents, shared, window, made, schema, without)
        ws = ws or Workspace(spark, "decontamination")
        before = documents
        documents = ws.keep(_pass(before, shared, window, _state, _STATE, []))
        ws.drop(before)
        for part in shared:
            part.destroy()
        group = following


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> DataFrame:
    """Hit words and items of every document, with the hit ranges of its text."""

    def made(found: list[tuple], texts: pa.Array) -> list[pa.Array]:
        digests = [
            hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
            for _, _, held in found
        ]
        spans = [
            [] if mask is None else original_spans(texts[k].as_py(), mask)
            for k, (_, mask, _) in enumerate(found)
        ]
        return [
            *_counts(found, texts),
            pa.array([len(held) for _, _, held in found], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(spans, _SPANS),
        ]

    given = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    found = _scanned(given, benchmark, window, made, _SUMMARY, ["text"])
    return found.withColumn(
        "contaminated", contaminated(F.col("n_hit"), F.col("n_words"))
    )


def _counts(found: list[tuple], texts: pa.Array) -> list[pa.Array]:
    hits = [0 if mask is None else int(mask.sum()) for _, mask, _ in found]
    return [pa.array([n for n, _, _ in found], pa.int64()), pa.array(hits, pa.int64())]


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with their own columns."""
    schema = "__words long, __hit long"
    found = _scanned(documents, benchmark, window, _counts, schema, ["__words", "__hit"])
    dirty = contaminated(F.col("__hit"), F.col("__words"))
    return found.filter(~dirty).drop("__words", "__hit")
