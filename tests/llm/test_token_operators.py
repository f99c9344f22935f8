"""Packing, token files and token counts against the tokenizers library itself."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import EDGE_TEXTS, EDGES, text
from tierflow.llm import packing, token_counts, token_files
from tierflow.llm.tokens import token_ids

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(path, texts):
    found = Tokenizer.from_file(path).encode_batch(
        [t or "" for t in texts], add_special_tokens=False
    )
    return [e.ids for e in found]


def some_texts():
    rng = random.Random(3)
    return [*EDGE_TEXTS, *[text(rng, n) for n in (1, 3, 500, 4000)], "ab" * 3000, "é" * 500]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_the_library_s(path):
    texts = some_texts()
    ids, offsets = token_ids(pa.array(texts, pa.string()), path)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == library_ids(path, texts)


def test_counts_are_the_library_s():
    texts = some_texts()
    for path in (WORD, BYTE):
        got = token_counts.text_token_counts(pa.array(texts, pa.string()), path)
        assert got.tolist() == [len(ids) for ids in library_ids(path, texts)]


CASED = [
    "a <|ENDOFTEXT|> b",
    "A<|EndOfText|>B <|endoftext|> Hello WORLD",
    "<|STARTOFTEXT|>\tÜber <|startoftext|>É",
    "Plain Words\tHERE",
    "it'S <| NOT |> one <|END OFTEXT|>",
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_strings_are_found_in_the_text_as_it_is(path):
    texts = pa.array(CASED, pa.string())
    ids, offsets = token_ids(texts, path)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    want = library_ids(path, CASED)
    assert got == want
    assert token_counts.text_token_counts(texts, path).tolist() == list(map(len, want))


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize(
    "piece", ["a" * 10_000 + "1", "-" * 10_000 + "\u2026", "ab" * 5000 + "\u2019s", "é" * 9999 + "--7"]
)
def test_long_runs_take_linear_time(path, piece):
    texts = pa.array([f"see {piece} there"], pa.string())
    started = time.monotonic()
    ids, _ = token_ids(texts, path)
    count = token_counts.text_token_counts(texts, path)
    assert time.monotonic() - started < 30
    want = library_ids(path, texts.to_pylist())
    assert ids.tolist() == want[0] and count.tolist() == [len(want[0])]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_random_strings_are_the_library_s(path):
    rng = random.Random(11)
    parts = [*"abcXYZ019 .,-'!\n\t", "  ", "é", "Ü", "ß", "日本", "😀", "\u2026", "\u2019", "\u00a0", "<|", "'s", "don't", "<|endoftext|>", "\x1c", "\u0301"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    ids, offsets = token_ids(pa.array(texts, pa.string()), path)
    want = library_ids(path, texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
    counts = token_counts.text_token_counts(pa.array(texts, pa.string()), path)
    assert counts.tolist() == list(map(len, want))


def test_merging_equals_one_pair_after_the_other():
    table = token_counts.merges(WORD)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeaaa", k=rng.randint(1, 30))) for _ in range(200)]

    def slowly(word):
        symbols = [*word[:-1], word[-1] + "</w>"]
        names = {i: s for s, i in table.symbols.items()}
        while len(symbols) > 1:
            pair = [
                (int(table.ranks(*[np.array([table.symbols[x]]) for x in two])[0]), k)
                for k, two in enumerate(zip(symbols, symbols[1:]))
            ]
            rank, k = min(pair)
            if rank == np.iinfo(np.int64).max:
                break
            symbols[k : k + 2] = [names[int(table.result[rank])]]
        return len(symbols)

    got = token_counts.merged_lengths(table, *table.start(words))
    assert got.tolist() == [slowly(w) for w in words]


def test_token_counts_of_every_row(documents):
    rows = token_counts.token_counts(documents(EDGES), WORD, 3).collect()
    assert len(rows) == len(EDGES)
    want = library_ids(WORD, [t for _, t in EDGES])
    expected = sorted(
        (repr(i), len((t or "").encode()), len(ids), len(ids) > 3)
        for (i, t), ids in zip(EDGES, want)
    )
    assert sorted((repr(r[0]), *r[1:]) for r in rows) == expected
    assert token_counts.token_counts(documents([]), WORD, 3).count() == 0


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 1023, 1024, 1025, 4000])
@pytest.mark.parametrize("high", [1, 2, 300, 49408, 1 << 31, 1 << 59])
def test_word_coding_round_trip(n, high):
    rng = np.random.default_rng(n + high % 97)
    ids = rng.integers(0, high, n).astype(np.uint64)
    if n > 100:
        ids[rng.integers(0, n, 20)] = (1 << 60) - 1
        ids[n // 2 : n // 2 + 70] = 1
    words, offsets = token_files.encode_ids(ids)
    assert (token_files.decode_ids(words, offsets, n) == ids).all()


def test_too_wide_an_id_is_refused():
    with pytest.raises(ValueError):
        token_files.encode_ids(np.array([1 << 60], np.uint64))


def test_token_files_round_trip(spark, documents, path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(8)
    rows = [*EDGES, *[(100 + i, text(rng, 300)) for i in range(40)], (99, text(rng, 20000))]
    rng.shuffle(rows)
    token_files.write_token_files(documents(rows), path, WORD, end_id=2)
    back = token_files.read_token_files(spark, path).collect()
    checks = token_files.read_token_checks(spark, path).collect()
    assert len(back) == len(checks) == len(rows)
    held = {}
    for (i, t), ids in zip(rows, library_ids(WORD, [t for _, t in rows])):
        held.setdefault(i, []).append(ids + [2])
    start = 0
    for row in sorted(back, key=lambda r: r.start):
        assert row.start == start and row.ids in held[row.doc_id]
        held[row.doc_id].remove(row.ids)
        start += row.n_tokens
    ids_in_order = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert ids_in_order == sorted(ids_in_order, key=lambda i: (i is not None, i or 0))
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in checks}
    for row in back:
        packed = np.array(row.ids, "<u4").tobytes()
        assert crc[row.doc_id, row.start] == zlib.crc32(packed)


def test_token_files_of_an_empty_table(spark, documents, path):
    token_files.write_token_files(documents([]), path, WORD, end_id=2)
    assert token_files.read_token_checks(spark, path).count() == 0


def assert_packed(rows, own, capacity):
    """Every id lies in one piece, pieces do not overlap; the padding in tokens."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in own)
    for doc, ids in own:
        # Rows that repeat an id and a length have their pieces mixed up here.
        mine = [
            r
            for r in pieces[doc, len(ids)]
            if zlib.crc32(
                np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            )
            == r.ids_crc32
        ]
        covered = sorted({(r.start, r.length) for r in mine})
        assert sum(length for _, length in covered) == len(ids)
        assert [s for s, _ in covered] == np.cumsum([0, *[n for _, n in covered]])[
            :-1
        ].tolist()
    return padding


@pytest.mark.parametrize("capacity", [64, 1000, 1024])
def test_packing(documents, capacity):
    rng = random.Random(capacity)
    rows = [*EDGES, *[(100 + i, text(rng, rng.randint(1, 900))) for i in range(60)]]
    own = [
        (i, ids + [0])
        for (i, _), ids in zip(rows, library_ids(BYTE, [t for _, t in rows]))
    ]
    packed = packing.pack(documents(rows).repartition(3), BYTE, capacity, 0).collect()
    padding = assert_packed(packed, own, capacity)
    assert padding <= capacity + 0.03 * sum(len(ids) for _, ids in own)


def test_packing_nothing(documents):
    assert packing.pack(documents([]), BYTE).count() == 0


def test_cuts_are_slots_and_cover_the_document():
    slots = np.array(packing.slot_lengths(1024)[::-1])
    for n in range(1, 5000):
        made = packing.cuts(n, 1024, slots)
        assert sum(made) == n and set(made) <= set(slots.tolist())
        assert len(made) <= n // 1024 + 5
