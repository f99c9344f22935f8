"""Language identification by bit-sliced Bloom filters of character n-grams (operator 10).

Every language has a Bloom filter of its typical n-grams.  The filters are stored
bit-sliced: one row per filter position with a bit per language, so the rows at an
n-gram's positions, combined by AND, give all languages that contain it at once.  A text
is a run of such masks; the number of bits set per language, corrected for the rate at
which that filter gives false positives, decides.

Learning counts in how many texts of a language an n-gram occurs.  An n-gram belongs to
a language if it is in at least ``min_share`` of its texts and there at least
``relative`` times as frequent as in the language that has it most.

Defined results: a null text or one without a letter is ``und`` with score 0; a text
none of whose n-grams is known gets the language with most learned texts and score 0;
ties go to the language first in that order; without learned texts all is ``und``.
Repeated rows count each; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.learning import bounded_sample, held_out
from tierflow.llm.shared import offsets_of, per_document, text_slices
from tierflow.llm.words import scrambled

SIZES = (2, 3, 4)
PROBES = 3
#: An n-gram of every size and place takes some 50 bytes while a slice is worked on.
SLICE_BYTES = 2 << 20
#: Bits of a language's filter per n-gram it may hold.
BITS_PER_GRAM = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of every code point of the basic plane, a space for others."""
    table = np.full(0x10000, 32, np.uint32)
    for code in range(0x10000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all texts with 0 between them, where texts begin, letter counts."""
    joined = "\0".join(t or "" for t in texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    offsets = offsets_of(lengths)
    low = _letters()[np.minimum(codes, 0xFFFF)]
    beyond = codes > 0xFFFF
    if beyond.any():  # few distinct ones, so they are looked at one by one
        distinct, at = np.unique(codes[beyond], return_inverse=True)
        lowered = [chr(c).lower() for c in distinct.tolist()]
        low[beyond] = np.array(
            [ord(c) if c.isalpha() else 32 for c in lowered], np.uint32
        )[at]
    low[offsets[1:] - 1] = 0
    letters = np.add.reduceat((low > 32).astype(np.int64), offsets[:-1])
    return low, offsets, letters


def grams(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every n-gram; inner characters are letters."""
    hashes, owners = [], []
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    letter = low > 32
    wide = low.astype(np.uint64)
    for size in SIZES:
        n = len(low) - size + 1
        if n <= 0:
            continue
        valid = letter[: n] | letter[size - 1 : size - 1 + n]
        valid &= (low[:n] > 0) & (low[size - 1 : size - 1 + n] > 0)
        for k in range(1, size - 1):
            valid &= letter[k : k + n]
        at = np.flatnonzero(valid)
        value = np.full(len(at), size, np.uint64)
        for k in range(size):
            value = value * np.uint64(0x100000001B3) ^ wide[at + k]
        hashes.append(scrambled(value))
        owners.append(owner[at])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def gram_counts(sample: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: in how many texts of a language an n-gram occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=SLICE_BYTES):
                langs = np.array(piece.column("lang").to_pylist(), object)
                low, offsets, _ = characters(piece.column("text").to_pylist())
                hashes, owners = grams(low, offsets)
                order = np.lexsort([owners, hashes])
                hashes, owners = hashes[order], owners[order]
                fresh = np.ones(len(hashes), bool)
                fresh[1:] = (np.diff(hashes) != 0) | (np.diff(owners) != 0)
                hashes, owners = hashes[fresh], owners[fresh]
                for lang in sorted(set(langs)):
                    found, n = np.unique(
                        hashes[(langs == lang)[owners]], return_counts=True
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(found), pa.string()),
                            pa.array(found.view(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        names=["lang", "gram", "n"],
                    )

    partial = sample.select("lang", "text").mapInArrow(
        run, "lang string, gram long, n long"
    )
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Bit-sliced Bloom filters of all languages."""

    def __init__(self, langs: list[str], capacity: int):
        self.langs = langs
        self.bits = 1 << (max(1, capacity * BITS_PER_GRAM) - 1).bit_length()
        self.slices = np.zeros((-(-len(langs) // 64), self.bits), np.uint64)
        self.false_rate = np.zeros(len(langs))

    def _positions(self, grams_: np.ndarray) -> Iterator[np.ndarray]:
        step = (grams_ >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            yield (grams_ + step * np.uint64(k)) & np.uint64(self.bits - 1)

    def add(self, lang: int, grams_: np.ndarray) -> None:
        bit = np.uint64(1 << (lang % 64))
        for at in self._positions(grams_):
            self.slices[lang // 64, at] |= bit
        filled = np.count_nonzero(self.slices[lang // 64] & bit) / self.bits
        self.false_rate[lang] = filled**PROBES

    def counts(self, grams_: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
        """Corrected number of n-grams of each text that each language contains."""
        at = list(self._positions(grams_))
        total = np.bincount(owners, minlength=n)
        out = np.zeros((n, len(self.langs)))
        for s, rows in enumerate(self.slices):
            mask = rows[at[0]]
            for more in at[1:]:
                mask &= rows[more]
            known = np.flatnonzero(mask)
            mask, own = mask[known], owners[known]
            for lang in range(s * 64, min(len(self.langs), s * 64 + 64)):
                has = (mask >> np.uint64(lang % 64)) & np.uint64(1)
                seen = np.bincount(own, has, n)
                rate = self.false_rate[lang]
                out[:, lang] = np.maximum(0, (seen - total * rate) / (1 - rate))
        return out


def learn(
    documents: DataFrame,
    max_rows: int = 20_000,
    capacity: int = 10_000,
    min_share: float = 0.01,
    relative: float = 0.25,
) -> Filters:
    """Filters from labelled documents that are not held out.

    ``max_rows`` bounds the sample, ``capacity`` the n-grams of a language's filter,
    the most frequent first; so what reaches the driver is bounded too.
    """
    labelled = documents.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = bounded_sample(labelled, max_rows)
    sizes = {r.lang: r.n for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes, key=lambda lang: (-sizes[lang], lang))
    filters = Filters(langs, capacity)
    if not langs:
        return filters
    size_of = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    shares = gram_counts(sample).withColumn("share", F.col("n") / size_of[F.col("lang")])
    shares = shares.filter(F.col("share") >= min_share)
    best = F.max("share").over(Window.partitionBy("gram"))
    typical = shares.withColumn("best", best).filter(
        F.col("share") >= relative * F.col("best")
    )
    ranked = F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("share"), "gram")
    )
    kept = typical.withColumn("rank", ranked).filter(F.col("rank") <= capacity)
    found = kept.select("lang", "gram").toPandas()
    for k, lang in enumerate(langs):
        own = found.loc[found.lang == lang, "gram"].to_numpy(np.int64)
        filters.add(k, own.view(np.uint64))
    return filters


def predict(documents: DataFrame, filters: Filters) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(filters)

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        model = shared.value
        low, offsets, letters = characters(texts.to_pylist())
        if not model.langs:
            return [ids, pa.array(["und"] * len(ids)), pa.array(np.zeros(len(ids)))]
        counts = model.counts(*grams(low, offsets), len(ids))
        best = counts.argmax(axis=1)
        summed = counts.sum(axis=1)
        score = counts[np.arange(len(best)), best] / np.where(summed > 0, summed, 1)
        named = [
            model.langs[k] if n else "und" for k, n in zip(best.tolist(), letters)
        ]
        return [
            ids,
            pa.array(named, pa.string()),
            pa.array(np.where(letters > 0, score, 0.0)),
        ]

    found = per_document(
        documents,
        work,
        "doc_id long, lang_pred string, score double",
        slice_bytes=SLICE_BYTES,
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identify(documents: DataFrame, **limits) -> DataFrame:
    """Learn from the table's own labelled rows and predict all of it."""
    return predict(documents, learn(documents, **limits))
