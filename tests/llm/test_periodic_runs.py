"""Runs of words against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from __spark_entry__ import queries
from tests.llm.conftest import EDGES, text
from tierflow.llm import periodic_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow_runs(words, least_words=6, least_periods=4):
    """Every maximal stretch of every period, less those of a smaller period."""
    n, found = len(words), []
    for q in range(1, n // least_periods + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_words, least_periods * q):
                piece = words[i : i + length]
                smaller = (p for p in range(1, q) if piece[p:] == piece[:-p])
                if next(smaller, None) is None:
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for i, length, q in runs for k in range(i + q, i + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(rng):
    """Few letters, powers of words, powers of powers and broken repeats."""
    letters = "abc"[: rng.randint(1, 3)]
    made = []
    while len(made) < rng.randint(0, 90):
        block = rng.choices(letters, k=rng.randint(1, 6))
        made += block * rng.randint(1, 7)
        if rng.random() < 0.4:
            made += made[-rng.randint(1, 20) :] * rng.randint(1, 4)
        if rng.random() < 0.3:
            made.append(rng.choice("xyz"))
    return made[:150]


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_brute_force(documents, seed):
    rng = random.Random(seed)
    texts = [repetitive(rng) for _ in range(120)]
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(words)) for i, words in enumerate(texts)]
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(documents(rows)).collect()}
    assert len(found) == len(rows)
    assert sum(len(r.runs) for r in found.values()) > 100
    for i, words in enumerate(texts):
        want = slow_runs(words)
        assert [tuple(r) for r in found[i].runs] == want, words
        assert found[i].collapsed == collapsed(words, want)


@pytest.mark.parametrize("least_words, least_periods", [(1, 3), (3, 3), (12, 5)])
def test_other_bounds(least_words, least_periods):
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(100)]
    codes = np.array([ord(w) for words in texts for w in words], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(words) for words in texts])])
    got = periodic_runs.find_runs(codes, offsets, least_words, least_periods)
    want = [
        (int(first) + i, length, q)
        for words, first in zip(texts, offsets)
        for i, length, q in slow_runs(words, least_words, least_periods)
    ]
    assert [tuple(r) for r in got.tolist()] == want


def test_runs_of_few_periods_are_refused(documents):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(documents([]), least_periods=2)


def test_a_run_ends_with_its_document(documents):
    rows = [(1, "a b a b a b"), (2, "a b a b a b"), (3, "A a A a A a A a")]
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(documents(rows)).collect()}
    assert not found[1].runs and not found[2].runs
    assert [tuple(r) for r in found[3].runs] == [(0, 8, 2)]
    assert found[3].collapsed == "A a"


def test_edges_and_long_texts(spark, documents):
    rng = random.Random(6)
    long_one, long_block = ["x"] * 300_000, text(rng, 700).split()
    rows = [*EDGES, (50, " ".join(long_one)), (51, " ".join(long_block * 90 + ["end"]))]
    found = periodic_runs.periodic_runs(documents(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert [tuple(r) for r in by_id[50].runs] == [(0, 300_000, 1)]
    assert by_id[50].collapsed == "x"
    assert [tuple(r) for r in by_id[51].runs] == [(0, 63_000, 700)]
    assert by_id[51].collapsed == " ".join([*long_block, "end"])
    assert by_id[0].n_words == by_id[1].n_words == by_id[2].n_words == 0
    assert by_id[0].runs == [] and by_id[0].collapsed == ""
    assert by_id[11].collapsed == "a\x1cb c d e"
    assert periodic_runs.periodic_runs(documents([])).count() == 0


def expected(doc_id, body):
    """The contract's columns, straight from its words."""
    words = WORD.findall(body or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{i},{length},{q}\n" for i, length, q in runs)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (
        doc_id,
        len(runs),
        *four,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def test_the_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [*EDGES, *[(100 + i, text(rng, rng.randint(1, 150))) for i in range(150)]]
    rows += [(400 + i, " ".join(repetitive(rng))) for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries()["op12_periodic_runs"](spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        "runs_sha256", "collapsed_sha256",
    ]
    want = [expected(i, body) for i, body in rows]
    assert sum(w[1] > 0 for w in want) > 100
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
