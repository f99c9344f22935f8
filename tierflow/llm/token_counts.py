"""Token counts by rank-synchronous merging of ragged arrays (operator 7).

The library's normaliser and pre-tokenizer cut a text into pre-tokens.  A batch of
distinct pre-tokens is one flat array of symbols.  Each round looks up the rank of all
adjacent pairs at once, merges in every sequence the pairs of its lowest rank, and sets
finished sequences aside; what is left of a sequence is its number of tokens.  Since no
two merges of a vocabulary give the same token, this equals merging pair after pair.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id stays null;
repeated rows are counted each; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import offsets_of, per_document
from tierflow.llm.tokens import Lexicon, by_runs, library, piece_values

_NO_RANK = np.iinfo(np.int64).max


class Merges:
    """A vocabulary's merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.width = max(vocabulary.values()) + 1
        self.symbols = vocabulary
        pairs = np.array(
            [(vocabulary[a], vocabulary[b]) for a, b in model["merges"]], np.int64
        ).reshape(-1, 2)
        keys = pairs[:, 0] * self.width + pairs[:, 1]
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.result = np.array(
            [vocabulary[a + b] for a, b in model["merges"]], np.int64
        )

    def start(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pre-tokens and where each begins."""
        flat = [
            self.symbols[c]
            for word in pretokens
            for c in (*word[:-1], word[-1] + self.suffix)
        ]
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        return np.array(flat, np.int64), offsets_of(lengths)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], _NO_RANK)


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def merged_lengths(table: Merges, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of symbols that are left of every non-empty sequence."""
    left_over = np.diff(offsets)
    active = np.arange(len(left_over))
    while len(flat) > 1:
        lengths = np.diff(offsets)
        rank = np.full(len(flat), _NO_RANK)
        rank[:-1] = table.ranks(flat[:-1], flat[1:])
        rank[offsets[1:] - 1] = _NO_RANK  # the last symbol has no right neighbour
        lowest = np.minimum.reduceat(rank, offsets[:-1])
        going = lowest < _NO_RANK
        left_over[active[~going]] = lengths[~going]
        if not going.any():
            return left_over
        hit = (rank == np.repeat(lowest, lengths)) & (rank < _NO_RANK)
        at = np.flatnonzero(hit)
        # Where equal symbols overlap, as in aaa, every second pair counts.
        fresh = np.concatenate([[True], np.diff(at) > 1])
        nth = np.arange(len(at))
        at = at[(nth - np.maximum.accumulate(np.where(fresh, nth, 0))) % 2 == 0]
        flat[at] = table.result[rank[at]]
        stays = np.repeat(going, lengths)
        stays[at + 1] = False
        counts = np.add.reduceat(stays.astype(np.int64), offsets[:-1])[going]
        flat, offsets, active = flat[stays], offsets_of(counts), active[going]
    left_over[active] = np.diff(offsets)
    return left_over


def counted(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of pieces of text, one value each."""
    tokenizer = library(path)
    special = _special(path)
    split, normal = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.normalizer
    counts = np.zeros(len(pieces), np.int64)
    pretokens, owner = [], []
    for i, piece in enumerate(pieces):
        for k, part in enumerate(special.split(piece) if special else [piece]):
            counts[i] += k > 0  # each special string is one token
            clean = normal.normalize_str(part) if normal else part
            for pretoken, _ in split(clean) if clean else ():
                if pretoken:
                    pretokens.append(pretoken)
                    owner.append(i)
    if pretokens:
        table = merges(path)
        lengths = merged_lengths(table, *table.start(pretokens))
        counts += np.bincount(owner, lengths, len(pieces)).astype(np.int64)
    return counts, np.arange(len(pieces) + 1, dtype=np.int64)


@lru_cache(maxsize=4)
def _special(path: str):
    added = library(path).get_added_tokens_decoder().values()
    names = sorted((t.content for t in added), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, names))) if names else None


@lru_cache(maxsize=4)
def _lexicon(path: str) -> Lexicon:
    return by_runs(lambda pieces: counted(path, pieces), np.int64)


def text_token_counts(texts: pa.Array, path: str) -> np.ndarray:
    """Number of tokens of every text."""
    codes, offsets, values, bounds = piece_values(texts, path, _lexicon(path))
    per_piece = np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])
    return np.diff(np.concatenate([[0], np.cumsum(per_piece[codes])])[offsets])


def token_counts(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than ``limit``."""

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return [ids, n_bytes, pa.array(text_token_counts(texts, path), pa.int64())]

    counts = per_document(documents, work, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
