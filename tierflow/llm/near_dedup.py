"""MinHash near-deduplication with sequential Bayesian verification (operator 8).

Every text has a MinHash signature over its word shingles.  Texts that agree on a band
of the signature are candidates.  Signatures of a candidate pair are compared batch by
batch: after each batch the posterior of the similarity given the matches so far tells
the chance that it reaches the threshold, and once that falls below ``miss`` the pair is
dropped.  What survives is verified on the full shingle sets, across components of a
band (see below) on the sets of 64-bit hashes of the shingles.  The classes are the
components of the verified links.

A band that many texts share is worked off in two steps, neither of which emits all its
pairs.  First every text is compared with the band's least id only, which joins a group
of copies in as many comparisons as it has members.  Then, in bands whose members still
lie in different components, all pairs across components are compared and verified
inside tasks, in blocks of bounded size, and only links leave.  None is lost.

Defined results: words are what lies between ASCII white space after lower-casing A-Z;
a text with fewer words than a shingle is one shingle; a null text or one without words
has no shingle and no link; rows with the same id are one node, linked if any of its
texts links; a null id is never linked, its component is null and it stays; other
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import (
    Workspace,
    annotated,
    by_shuffle,
    components,
    offsets_of,
    per_document,
    ragged_take,
    verified,
)
from tierflow.llm.words import (
    SPACED,
    mapped,
    scrambled,
    shingle_hashes,
    split_words,
    word_hashes,
)

SHINGLE, PERCENT = 5, 75
#: 4 rows in 32 bands miss a pair of similarity 0.75 five times in a million.
ROWS, BANDS = 4, 32
#: Chance to prune a pair that reaches the threshold, and matches per batch.
MISS, BATCH = 1e-7, 32
#: Texts of a block and the shingles they have together; a task compares two blocks.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 500_000
_SPAN = 1 << 15


def multipliers(count: int) -> np.ndarray:
    """Fixed odd multipliers; the upper bits of the product order the shingles."""
    seeds = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return scrambled(seeds) | np.uint64(1)


def signatures(hashed: np.ndarray, begins: np.ndarray, count: int) -> np.ndarray:
    """Least product per text and multiplier, for texts that all have a shingle.

    Texts are taken in runs whose shingles stay in the processor's cache.
    """
    n = len(begins) - 1
    out = np.empty((n, count), np.uint32)
    factors = multipliers(count)
    first = 0
    while first < n:
        last = max(
            first + 1,
            int(np.searchsorted(begins, begins[first] + _SPAN, "right")) - 1,
        )
        values = hashed[begins[first] : begins[last]]
        starts = begins[first:last] - begins[first]
        product = np.empty_like(values)
        for k, factor in enumerate(factors):
            np.multiply(values, factor, out=product)
            least = np.minimum.reduceat(product, starts)
            out[first:last, k] = least >> np.uint64(32)
        first = last
    return out


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit key per text and band."""
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for k in range(band * rows, band * rows + rows):
            key = scrambled(key ^ (signature[:, k] + np.uint64(0x9E3779B97F4A7C15)))
        keys[:, band] = key
    return keys.view(np.int64)


def distinct_counts(hashed: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Number of distinct values in each run."""
    return np.array(
        [len(np.unique(hashed[a:b])) for a, b in zip(begins, begins[1:])], np.int64
    )


def hashed_shingles(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every text, and where each text's begin."""
    codes, words, offsets = split_words(mapped(texts, SPACED))
    hashes = word_hashes(words) if len(words) else np.zeros(0, np.uint64)
    return shingle_hashes(hashes[codes], offsets, shingle)


def marked(hashed: np.ndarray, begins: np.ndarray, rows: int, bands: int):
    """Shingle counts, band keys and 16-bit signatures; both empty without words."""
    counts = distinct_counts(hashed, begins)
    full = np.flatnonzero(counts)
    some = np.append(begins[:-1][full], begins[-1])
    signature = signatures(hashed, some, rows * bands)
    keys = band_keys(signature, rows, bands)
    key_ends = offsets_of((counts > 0) * bands)
    listed = pa.ListArray.from_arrays(
        pa.array(key_ends, pa.int32()), pa.array(keys.ravel())
    )
    blobs: list[bytes] = [b""] * len(counts)
    for k, row in zip(full.tolist(), signature.astype("<u2")):
        blobs[k] = row.tobytes()
    return counts, listed, pa.array(blobs, pa.binary())


def signed(texts: pa.Array, shingle: int, rows: int, bands: int):
    """``marked`` of texts."""
    return marked(*hashed_shingles(texts, shingle), rows, bands)


def least_matches(hashes: int, batch: int, percent: int, miss: float) -> list[int]:
    """Fewest matches, after each batch, at which a pair goes on.

    With a flat prior the chance that the similarity is at least t, after m matches in n
    hashes, is that of at most m successes in n + 1 draws of chance t.
    """
    t = percent / 100
    least = []
    for n in range(batch, hashes + 1, batch):
        chance = 0.0
        for m in range(n + 1):
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                least.append(m)
                break
    return least


def surviving(left: np.ndarray, right: np.ndarray, least: list[int], batch: int):
    """Positions of the pairs of signature rows that no batch prunes."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, fewest in enumerate(least):
        part = slice(k * batch, (k + 1) * batch)
        same = left[alive, part] == right[alive, part]
        matches = matches + same.sum(axis=1)
        keep = matches >= fewest
        alive, matches = alive[keep], matches[keep]
    return alive


def _signature_rows(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    if not rows:
        return np.empty((0, 0), np.uint16)
    return np.frombuffer(b"".join(rows), "<u2").reshape(len(rows), -1)


def linked_components(
    ws: Workspace,
    marks: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    rows: int = ROWS,
    bands: int = BANDS,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    miss: float = MISS,
    by_band: bool = False,
) -> DataFrame:
    """``(id, component)`` of all ids with a link, the component being its least id.

    ``marks(id, bands, signature)`` describes the texts, and ``texts_of`` gives
    ``(id, text)`` of the ids in the frame it gets.  ``by_band`` suits short texts: a text
    is then copied for each of its bands that is compared across components, which is
    linear in the bands' members; else for each other block that its own one meets.
    """
    tuning = Tuning(rows, bands, shingle, percent, miss)
    banded = marks.select("id", F.explode("bands").alias("band"))
    shared = ws.keep(
        banded.groupBy("band")
        .agg(
            F.min("id").alias("first"),
            F.max("id").alias("last"),
            F.count(F.lit(1)).alias("members"),
        )
        .filter("first < last")
        .drop("last")
    )
    held = ws.keep(banded.join(by_shuffle(shared), "band"))
    stars = held.filter("id <> first").select(
        F.col("id").alias("a"), F.col("first").alias("b")
    )
    # Texts without a shared band are left behind here.
    wanted = ws.keep(held.select("id").distinct())
    texts = ws.keep(texts_of(wanted))
    marks = ws.keep(
        marks.select("id", "signature").join(by_shuffle(wanted), "id", "left_semi")
    )
    candidates = _pruned(ws, stars.distinct(), marks, tuning)
    links = verified(ws, candidates, texts, shingle, percent)
    # A text's least linked id stands for its component: equal ones mean the same.
    nearest = links.groupBy("a").agg(F.min("b").alias("component"))
    nearest = ws.keep(nearest.withColumnRenamed("a", "id"))

    # Bands that still hold several of them, other than pairs already compared.
    labelled = ws.keep(
        held.filter("members > 2")
        .join(by_shuffle(nearest), "id", "left")
        .select("band", "id", "first", F.coalesce("component", "id").alias("component"))
    )
    mixed = ws.keep(
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("band")
    )
    ws.drop(held, shared, wanted, marks, candidates, nearest)
    across = _across_in_bands if by_band else _across
    late = across(ws, labelled.join(by_shuffle(mixed), "band"), texts, tuning)
    ws.drop(texts, labelled, mixed)
    return components(ws, links.unionByName(late))


@dataclass(frozen=True)
class Tuning:
    """How texts are banded and compared."""

    rows: int
    bands: int
    shingle: int
    percent: int
    miss: float

    @property
    def batch(self) -> int:
        return min(BATCH, self.rows * self.bands)

    @property
    def least(self) -> list[int]:
        return least_matches(
            self.rows * self.bands, self.batch, self.percent, self.miss
        )


def _pruned(
    ws: Workspace, pairs: DataFrame, marks: DataFrame, tuning: Tuning
) -> DataFrame:
    """Pairs that the sequential comparison of their signatures lets through."""
    left = marks.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    right = marks.select(F.col("id").alias("b"), F.col("signature").alias("right"))
    joined = ws.keep(pairs).join(by_shuffle(left), "a").join(by_shuffle(right), "b")

    least, batch = tuning.least, tuning.batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                alive = surviving(
                    _signature_rows(rows.column("left")),
                    _signature_rows(rows.column("right")),
                    least,
                    batch,
                )
                yield rows.select(["a", "b"]).take(pa.array(alive))

    found = joined.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")
    return ws.keep(found.distinct())


def _sets(texts: DataFrame, tuning: Tuning) -> DataFrame:
    """Columns of ``texts(id, text, ...)`` but the text, bands, signature and hashed
    shingles."""

    def work(ids: pa.Array, given: pa.Array) -> list[pa.Array]:
        hashed, begins = hashed_shingles(given, tuning.shingle)
        sets = [np.unique(hashed[x:y]) for x, y in zip(begins, begins[1:])]
        ends = np.concatenate([[0], np.cumsum([len(one) for one in sets])])
        flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
        _, keys, signature = marked(hashed, begins, tuning.rows, tuning.bands)
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return [keys, signature, listed]

    return annotated(
        texts,
        work,
        "bands array<bigint>, signature binary, shingles array<bigint>",
        id_column="id",
    ).drop("text")


def _blocks() -> Column:
    """How many blocks of bounded size the grouped sets fill."""
    return F.ceil(
        F.greatest(
            F.count(F.lit(1)) / BLOCK_MEMBERS, F.sum("held") / BLOCK_SHINGLES
        )
    ).alias("blocks")


def _across_in_bands(
    ws: Workspace, members: DataFrame, texts: DataFrame, tuning: Tuning
) -> DataFrame:
    """As ``_across``, the blocks being those of each band by itself.

    Every two blocks of a band meet in one task, and a pair is compared in the first of
    the bands that it shares.
    """
    members = ws.keep(members.select("band", "id", "component"))
    wanted = members.select("id").distinct()
    sets = ws.keep(_sets(texts.join(by_shuffle(wanted), "id", "left_semi"), tuning))
    sized = members.join(
        by_shuffle(sets.select("id", F.size("shingles").alias("held"))), "id"
    )
    blocks = sized.groupBy("band").agg(_blocks())
    placed = ws.keep(members.join(by_shuffle(blocks), "band"))
    part = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    arrived = (
        placed.withColumn("part", part)
        .withColumn("other", other)
        .join(by_shuffle(sets), "id")
    )
    least, batch, percent = tuning.least, tuning.batch, tuning.percent

    def compare(table: pa.Table) -> pa.Table:
        return compared_blocks(table, least, batch, percent)

    low, high = F.least("part", "other"), F.greatest("part", "other")
    links = (
        arrived.select(
            "band",
            low.alias("low"),
            high.alias("high"),
            (F.col("part") == low).alias("in_low"),
            (F.col("part") == high).alias("in_high"),
            "id",
            "component",
            "bands",
            "signature",
            "shingles",
        )
        .groupBy("band", "low", "high")
        .applyInArrow(compare, "a long, b long")
    )
    return ws.keep(links.distinct())


def _across(
    ws: Workspace, members: DataFrame, texts: DataFrame, tuning: Tuning
) -> DataFrame:
    """Links between texts of different components that share a band.

    Every text has one home among its bands' least ids, and a home falls into blocks of
    bounded size.  Two blocks that meet in some band are compared once, in one task,
    where the pairs that share a band go through the sequential comparison and then
    through the exact one; only links that join two components leave the task.
    """
    homes = ws.keep(
        members.groupBy("id").agg(
            F.min("first").alias("home"), F.min("component").alias("component")
        )
    )

    sets = ws.keep(_sets(texts.join(by_shuffle(homes), "id"), tuning))
    sizes = ws.keep(
        sets.withColumn("held", F.size("shingles")).groupBy("home").agg(_blocks())
    )
    part = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = sets.join(by_shuffle(sizes), "home").withColumn(
        "block", F.struct("home", part.alias("part"))
    )
    present = ws.keep(
        members.select("band", "id")
        .join(by_shuffle(ws.keep(placed.select("id", "block"))), "id")
        .select("band", "block")
        .distinct()
    )
    meeting = present.select("band", F.col("block").alias("low")).join(
        by_shuffle(present.select("band", F.col("block").alias("high"))), "band"
    )
    tasks = ws.keep(meeting.filter("low <= high").select("low", "high").distinct())
    sides = tasks.select(F.col("low").alias("block"), "low", "high").union(
        tasks.filter("low <> high").select(F.col("high").alias("block"), "low", "high")
    )
    arrived = placed.join(by_shuffle(sides), "block")
    least, batch, percent = tuning.least, tuning.batch, tuning.percent

    def compare(table: pa.Table) -> pa.Table:
        return compared_blocks(table, least, batch, percent)

    found = arrived.select(
        "low",
        "high",
        (F.col("block") == F.col("low")).alias("in_low"),
        (F.col("block") == F.col("high")).alias("in_high"),
        "id",
        "component",
        "bands",
        "signature",
        "shingles",
    )
    links = found.groupBy("low", "high").applyInArrow(compare, "a long, b long")
    return ws.keep(links.distinct())


def compared_blocks(
    table: pa.Table, least: list[int], batch: int, percent: int
) -> pa.Table:
    """Verified links between two blocks, no more than it takes to join components.

    With a ``band`` the pairs are those of which it is the first shared band.
    """
    band = table.column("band")[0].as_py() if "band" in table.column_names else None
    ids = table.column("id").to_numpy()
    component = table.column("component").to_numpy().copy()
    bands = table.column("bands").combine_chunks().flatten().to_numpy()
    bands = bands.reshape(len(ids), -1)
    rows = _signature_rows(table.column("signature").combine_chunks())
    listed = table.column("shingles").combine_chunks()
    offsets = (listed.offsets.to_numpy() - listed.offsets[0].as_py()).astype(np.int64)
    values, coded = np.unique(listed.flatten().to_numpy(), return_inverse=True)
    sizes = np.diff(offsets)
    present = np.zeros(len(values), bool)
    left = np.flatnonzero(table.column("in_low").to_numpy(zero_copy_only=False))
    right = np.flatnonzero(table.column("in_high").to_numpy(zero_copy_only=False))
    same_block = len(left) == len(right) and (left == right).all()
    a, b = [], []
    for i in left.tolist():
        j = right[right > i] if same_block else right
        j = j[component[j] != component[i]]
        same = bands[j] == bands[i]
        shares = same.any(axis=1)
        if band is not None:
            shares &= bands[i][same.argmax(axis=1)] == band
        j = j[shares]
        if not len(j):
            continue
        own = np.broadcast_to(rows[i], (len(j), rows.shape[1]))
        j = j[surviving(own, rows[j], least, batch)]
        if not len(j):
            continue
        mine = coded[offsets[i] : offsets[i + 1]]
        present[mine] = True
        flat, lengths = ragged_take(coded, offsets, j)
        shared = np.add.reduceat(present[flat].astype(np.int64), offsets_of(lengths)[:-1])
        present[mine] = False
        for k in j[100 * shared >= percent * (sizes[i] + sizes[j] - shared)].tolist():
            if component[k] != component[i]:
                a.append(ids[i])
                b.append(ids[k])
                component[component == component[k]] = component[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_dedup(
    documents: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
    miss: float = MISS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    ws = Workspace(documents.sparkSession, "near-dedup")

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        counts, keys, signature = signed(texts, shingle, rows, bands)
        return [ids, pa.array(counts), keys, signature]

    marks = ws.keep(
        per_document(
            documents,
            work,
            "doc_id long, n_shingles long, bands array<bigint>, signature binary",
            slice_bytes=4 << 20,
        )
    )
    nodes = marks.filter("doc_id is not null and n_shingles > 0").withColumnRenamed(
        "doc_id", "id"
    )
    texts = documents.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        return texts.join(by_shuffle(wanted), "id", "left_semi")

    classes = ws.keep(
        linked_components(ws, nodes, texts_of, rows, bands, shingle, percent, miss)
    )
    return (
        marks.select(F.col("doc_id").alias("id"), "n_shingles")
        .join(by_shuffle(classes), "id", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        )
    )


def representatives(documents: DataFrame, **tuning) -> DataFrame:
    """The rows of ``documents`` that stay, one id of every class of near copies."""
    gone = near_dedup(documents, **tuning).filter(~F.col("kept")).select("doc_id")
    own = documents["doc_id"].cast("long")
    gone = gone.distinct().withColumnRenamed("doc_id", "__gone")
    return documents.join(by_shuffle(gone), own == F.col("__gone"), "left_anti")
