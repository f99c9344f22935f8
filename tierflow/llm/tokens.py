"""Token ids of whole texts by the tokenizers library, each distinct piece once.

Both vocabularies split a text before they merge, and never across a single space
between two other characters.  So a text is cut there, and a piece that occurs many
times in a batch, or in an earlier one, goes through the library once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierflow.llm.shared import offsets_of, ragged_take
from tierflow.llm.words import SPACED, WHITE, mapped

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces remembered between batches, and how long they may be.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 32
#: Letters and marks of which every run is one pre-token in both vocabularies.
PLAIN = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r"!-/:-@\[-`{-~"
_PLAIN_PIECE = re.compile(f" ?[{PLAIN}]+")
#: Pieces that fall into such runs and single line breaks; no contraction is in them.
_RUNS = re.compile(rf" ?[{PLAIN}]+| ?[{MARKS}]+|(?<=\S)\n(?=\S)")
#: White space beside the single spaces at which a text may be cut.
_UNEVEN = r"^[\s\p{Z}]|[\s\p{Z}]$|[\s\p{Z}\x0B\x1C-\x1F\x85] | [\s\p{Z}\x0B\x1C-\x1F\x85]"
_CUT = re.compile(r"(?<=\S) (?=\S)")

Ragged = tuple[np.ndarray, np.ndarray]
Encoder = Callable[[list[str]], Ragged]


@lru_cache(maxsize=4)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def spaced(path: str) -> bool:
    """Whether the vocabulary keeps the space before a word as part of it."""
    return library(path).normalizer is None


@lru_cache(maxsize=4)
def _byte_letters(path: str) -> dict[int, str]:
    """What the vocabulary's byte level makes of a plain letter and of a space."""
    split = library(path).pre_tokenizer.pre_tokenize_str
    letters = [chr(i) for i in range(65, 256) if _PLAIN_PIECE.fullmatch(chr(i))]
    lowered = {c: c if spaced(path) else c.lower() for c in letters}
    table = {ord(c): split(low)[0][0] for c, low in lowered.items()}
    return table | ({32: split(" a")[0][0][0]} if spaced(path) else {})


def encoded(path: str, pieces: list[str]) -> Ragged:
    """Ids of every piece and where they begin, straight from the library.

    A plain piece is one pre-token and goes to the library's model at once, which
    takes half the time of the whole chain; any other piece goes through the chain.
    """
    tokenizer = library(path)
    merge, table = tokenizer.model.tokenize, _byte_letters(path)
    ids: list[list[int]] = []
    rest = []
    for i, piece in enumerate(pieces):
        if _PLAIN_PIECE.fullmatch(piece):
            ids.append([token.id for token in merge(piece.translate(table))])
        else:
            ids.append([])
            rest.append(i)
    if rest:
        found = tokenizer.encode_batch_fast(
            [pieces[i] for i in rest], add_special_tokens=False
        )
        for i, one in zip(rest, found):
            ids[i] = one.ids
    return ragged(ids, np.uint32)


def ragged(rows: list[list[int]], kind) -> Ragged:
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    offsets = offsets_of(lengths)
    return np.fromiter((x for row in rows for x in row), kind, offsets[-1]), offsets


class Lexicon:
    """Values of pieces that were seen before, bounded in count and in bytes."""

    def __init__(self, encode: Encoder, kind=np.uint32):
        self.encode = encode
        self.known: dict[str, int] = {}
        self.values = np.empty(0, kind)
        self.offsets = np.zeros(1, np.int64)

    def find(self, pieces: list[str]) -> Ragged:
        """Ragged values of distinct pieces; only new ones are encoded."""
        at = list(map(self.known.get, pieces))
        rows = [i for i, k in enumerate(at) if k is None]
        new = [pieces[i] for i in rows]
        values, offsets = self.encode(new)
        for k, i in enumerate(rows, len(self.offsets) - 1):
            at[i] = k
        flat = np.concatenate([self.values, values])
        bounds = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self._remember(new, values, offsets)
        taken, lengths = ragged_take(flat, bounds, np.array(at, np.int64))
        return taken, offsets_of(lengths)

    def _remember(self, new: list[str], values: np.ndarray, offsets: np.ndarray) -> None:
        room = max(0, REMEMBERED - len(self.known))
        rows = [i for i, p in enumerate(new) if len(p) <= REMEMBERED_LENGTH][:room]
        if rows:
            first = len(self.offsets) - 1
            self.known.update((new[i], first + k) for k, i in enumerate(rows))
            taken, lengths = ragged_take(values, offsets, np.array(rows, np.int64))
            self.values = np.concatenate([self.values, taken])
            self.offsets = np.concatenate(
                [self.offsets, self.offsets[-1] + np.cumsum(lengths)]
            )


def by_runs(encode: Encoder, kind=np.uint32) -> Lexicon:
    """A lexicon of pieces over one of the runs they fall into, so that a new piece
    made of known runs, such as a word before a full stop, is not encoded anew."""
    runs = Lexicon(encode, kind)

    def joined(pieces: list[str]) -> Ragged:
        parts = [_parts(piece) for piece in pieces]
        codes: dict[str, int] = {}
        rows = [codes.setdefault(p, len(codes)) for few in parts for p in few]
        values, offsets = runs.find(list(codes))
        taken, lengths = ragged_take(values, offsets, np.array(rows, np.int64))
        slots = offsets_of(np.fromiter(map(len, parts), np.int64, len(parts)))
        return taken, offsets_of(lengths)[slots]

    return Lexicon(joined, kind)


def _parts(piece: str) -> list[str]:
    """The runs of a piece where they are pre-tokens, else the piece itself."""
    if _PLAIN_PIECE.fullmatch(piece) or "'" in piece or "<|" in piece:
        return [piece]
    # One pass that may leave gaps: a pattern for the whole would try every split of a run.
    runs = _RUNS.findall(piece)
    return runs if sum(map(len, runs)) == len(piece) else [piece]


@lru_cache(maxsize=4)
def lexicon(path: str) -> Lexicon:
    """One per vocabulary and Python worker."""
    return by_runs(lambda pieces: encoded(path, pieces))


def _pieces(texts: pa.Array, keep_space: bool) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every piece, the pieces by code, where each text's pieces begin."""
    listed = pc.split_pattern(texts, " ")
    offsets = listed.offsets.to_numpy().astype(np.int64)
    flat = listed.flatten()
    offsets = offsets - offsets[0]
    if keep_space:
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        if uneven.any():
            rows = listed.to_pylist()
            for i in np.flatnonzero(uneven):
                rows[i] = _CUT.split(texts[int(i)].as_py())
            flat = pa.array([p for row in rows for p in row], pa.string())
            offsets = offsets_of(np.array([len(row) for row in rows], np.int64))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    pieces = coded.dictionary
    if keep_space:
        # The first piece of a text has no space before it, every other one has.
        first = offsets[:-1][np.diff(offsets) > 0]
        opening = flat.take(pa.array(first)).dictionary_encode()
        codes[first] = len(pieces) + opening.indices.to_numpy()
        pieces = pa.concat_arrays(
            [
                pc.binary_join_element_wise(" ", pieces, ""),
                opening.dictionary,
            ]
        )
    return codes, pieces, offsets


def piece_values(texts: pa.Array, path: str, words: Lexicon):
    """Codes of all pieces, where texts begin, and the ragged values by code."""
    texts = pc.fill_null(texts, "")
    keep_space = spaced(path)
    if not keep_space:
        # Special strings are found in the text as it is, before it is lower-cased.
        special = pc.match_substring(texts, "<|")
        texts = pc.if_else(special, mapped(texts, WHITE), mapped(texts, SPACED))
    codes, pieces, offsets = _pieces(texts, keep_space)
    values, bounds = words.find(pieces.to_pylist())
    return codes, offsets, values, bounds


def token_ids(texts: pa.Array, path: str) -> Ragged:
    """Ids of all texts in one array, and where each text's ids begin."""
    codes, offsets, values, bounds = piece_values(texts, path, lexicon(path))
    ids, lengths = ragged_take(values, bounds, codes)
    return ids, offsets_of(lengths)[offsets]
