"""Toxicity, language identification, decontamination and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.conftest import EDGES, prose, text
from tests.test_catalogue import SF_DIR
from tierflow.llm import decontamination, language_id, toxicity

BAD = ["vilest", "rotten", "hateful"]


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


# -- toxicity ----------------------------------------------------------------


def toxic_rows(rng, count):
    rows, labels = [], []
    for i in range(count):
        made, bad = prose(rng, rng.randint(20, 80)), i % 4 == 0
        for k in range(2 * bad):
            made.insert(rng.randrange(len(made)), BAD[(i // 4 + k) % 3])
        rows.append((i, " ".join(made)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents):
    rows, labels = toxic_rows(random.Random(1), 600)
    given = spark.createDataFrame(
        [*labels, (None, 1), (7, None), (8, 5), (10**9, 1)], "doc_id long, toxic int"
    )
    docs = documents([*rows, (10_000, None), (10_001, ""), (None, "rotten")])
    found = toxicity.toxicity(docs, given).collect()
    assert len(found) == 603
    truth = dict(labels)
    for row in found:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        assert row.held_out == is_held_out(row.doc_id)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 80 and right / len(held) > 0.97
    assert next(r for r in found if r.doc_id == 10_001).predicted == 0
    kept = toxicity.clean(docs, given)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in found)


def test_toxicity_repeats_and_shards(spark, documents):
    rows, labels = toxic_rows(random.Random(2), 300)
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(rows)
    one = toxicity.learn(docs.repartition(5), given, shard_rows=60)
    two = toxicity.learn(docs.repartition(3), given, shard_rows=60)
    assert abs(one - two).max() < 1e-6 and 0 < (one != 0).sum() < len(one) // 10


def test_toxicity_without_labels(spark, documents):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(documents(EDGES), nothing).collect()
    assert len(found) == len(EDGES)
    assert all(r.score < 0.5 and r.predicted == 0 for r in found)
    assert toxicity.toxicity(documents([]), nothing).count() == 0


@pytest.mark.parametrize(
    "given", [[], [(0, 1)], [(0, 0)], [(i, i % 2) for i in range(60)], [(i, 1) for i in range(9)]]
)
def test_texts_without_evidence_are_not_rejected(spark, documents, given):
    rng = random.Random(4)
    rows = [(i, " ".join([*prose(rng, 9), "rotten"] if i % 2 else prose(rng, 9))) for i in range(60)]
    plain = [(1000, None), (1001, ""), (1002, "qqq zzz"), (1003, "xxx")]
    labels = spark.createDataFrame(given, "doc_id long, toxic int")
    docs = documents([*rows, *plain])
    kept = {r.doc_id for r in toxicity.clean(docs, labels).collect()}
    assert {1000, 1001, 1002, 1003} <= kept
    found = toxicity.toxicity(docs, labels).collect()
    assert kept == {r.doc_id for r in found if not r.predicted}
    assert all(r.predicted == (r.score >= 0.5) for r in found)


def test_a_score_of_one_half_is_predicted_toxic(spark, documents):
    weights = np.zeros(toxicity.COORDINATES, np.float32)
    (row,) = toxicity.score(documents([(1, "even odds")]), weights).collect()
    assert (row.score, row.predicted) == (0.5, 1)


def test_weights_are_those_of_plain_ftrl(spark, documents):
    """One shard against the published update, a row and a coordinate at a time."""
    rows, labels = toxic_rows(random.Random(9), 80)
    truth = dict(labels)
    got = toxicity.learn(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    usable = [(i, t) for i, t in rows if not is_held_out(i)]
    ids = spark.createDataFrame(usable, "doc_id long, text string")
    order = F.xxhash64(F.lit("order"), "doc_id")
    ordered = [(r.doc_id, r.text) for r in ids.orderBy(order).collect()]
    z, n = {}, {}

    def weight(i):
        bias = i == 0
        l1 = 0.0 if bias else toxicity.L1
        held = z.get(i, 0.0)
        w = 0.0
        if abs(held) > l1:
            rate = (toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2
            w = -(held - math.copysign(l1, held)) / rate
        least = toxicity.LEAST_BIAS if bias else toxicity.LEAST_WEIGHT
        return max(min(w, toxicity.PRIOR) if bias else w, least)

    for _ in range(toxicity.EPOCHS):
        for doc_id, body in ordered:
            at = {int(i) for i in toxicity.features(pa.array([body]))[0]}
            own = {i: weight(i) for i in at}
            error = 1 / (1 + math.exp(-sum(own.values()))) - truth[doc_id]
            for i in at:
                before = n.get(i, 0.0)
                sigma = ((before + error**2) ** 0.5 - before**0.5) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + error - sigma * own[i]
                n[i] = before + error**2
    want = {i: weight(i) for i in z}
    assert {int(i) for i in np.flatnonzero(got)} == {i for i, w in want.items() if w}
    assert all(abs(got[i] - w) < 1e-5 for i, w in want.items())


def test_a_toxic_text_cannot_hide_among_harmless_words(spark, documents):
    """Words of clean texts only, however many, leave two toxic words their say."""
    rng = random.Random(11)
    rows, labels = toxic_rows(rng, 400)
    marks = [f"calm{k}" for k in range(30)]
    rows = [(i, t if i % 4 == 0 else f"{t} {' '.join(rng.sample(marks, 6))}") for i, t in rows]
    hidden = (10_000, f"{rows[0][1]} {' '.join(rng.sample(marks, 12))}")
    docs = documents([*rows, hidden])
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, given).collect()}
    assert found[10_000] == 1
    assert sum(found[i] for i, bad in labels if not bad) == 0


def test_the_pipeline_s_first_stage_without_labels(spark, documents, tmp_path):
    path = str(tmp_path / "labels.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(path)
    docs = documents([(1, "one two"), (2, ""), (3, None)])
    assert corpus_pipeline.without_toxic(spark, docs, str(tmp_path)).count() == 3


# -- language ----------------------------------------------------------------


def spoken(rng, syllables, words):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def test_languages_on_held_out_rows(spark):
    rng = random.Random(3)
    kinds = {
        "aa": ["the", "ing", "and", "er", "on"],
        "bb": ["sch", "ung", "ein", "er", "ö"],
        "cc": ["que", "eau", "oi", "on", "é"],
    }
    rows = [
        (i, spoken(rng, kinds[lang], rng.randint(6, 60)), lang)
        for i, lang in enumerate(rng.choices(list(kinds), k=500))
    ]
    extra = [(900, None, "aa"), (901, "12 !? 😀", "bb"), (902, "", None), (None, "theing and", "cc")]
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string")
    found = language_id.identify(docs).collect()
    assert len(found) == 504
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 60 and right / len(held) > 0.97
    named = {r.doc_id: r for r in found}
    assert all(named[i].lang_pred == "und" and named[i].score == 0 for i in (900, 901, 902))
    assert all(0 <= r.score <= 1 and r.held_out == is_held_out(r.doc_id) for r in found)


def test_languages_without_labels(documents):
    found = language_id.identify(documents(EDGES, extra=())).collect()
    assert len(found) == len(EDGES) and {r.lang_pred for r in found} == {"und"}
    assert language_id.identify(documents([], extra=())).count() == 0


def test_filters_of_more_languages_than_a_word_has_bits():
    import numpy as np

    from tierflow.llm.words import scrambled

    filters = language_id.Filters([f"l{k}" for k in range(70)], 100)
    for k in range(70):
        filters.add(k, scrambled(np.arange(100 * k, 100 * k + 100, dtype=np.uint64)))
    for k in (0, 63, 64, 69):
        own = scrambled(np.arange(100 * k, 100 * k + 100, dtype=np.uint64))
        counts = filters.counts(own, np.zeros(100, np.int64), 1)[0]
        assert counts.argmax() == k and counts[k] > 99
        assert np.delete(counts, k).max() < 5


# -- decontamination ---------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(value):
    return re.sub("[A-Z]", lambda m: m[0].lower(), value or "")


def brute(rows, items, window=13):
    for doc, value in rows:
        words = WORDS.findall(lowered(value))
        hit, names = set(), set()
        for item, item_text in items:
            own = WORDS.findall(lowered(item_text))
            size = min(window, len(own))
            for k in range(len(own) - size + 1 if size else 0):
                for i in range(len(words) - size + 1):
                    if words[i : i + size] == own[k : k + size]:
                        hit.update(range(i, i + size))
                        names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        yield (
            repr(doc),
            len(words),
            len(hit),
            len(names),
            digest,
            bool(hit) and 20 * len(hit) >= len(words),
        )


@pytest.mark.parametrize("part_bytes", [1 << 20, 50])
def test_decontamination_equals_brute_force(spark, documents, monkeypatch, part_bytes):
    monkeypatch.setattr(decontamination, "PART_BYTES", part_bytes)
    rng = random.Random(4)
    test = [prose(rng, n) for n in (40, 13, 14, 3, 1)]
    items = [(k + 8, " ".join(t)) for k, t in enumerate(test)]
    items += [(50, None), (51, "..."), (52, items[0][1].upper()), (53, "été À la")]
    rows = [
        *EDGES,
        (100, ", ".join(w.title() for w in prose(rng, 5) + test[0][3:30])),
        (101, " ".join(prose(rng, 300) + test[1])),
        (102, " ".join(test[2][1:] + test[2][:-1] + test[3])),
        (103, " ".join(test[0][:12] + prose(rng, 20))),
        (104, "x Été, À LA x été À la"),
        (105, "\n".join(test[4] * 3)),
        *[(200 + i, text(rng, 60)) for i in range(20)],
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(documents(rows), benchmark).collect()
    got = sorted(
        (repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in found
    )
    assert got == sorted(brute(rows, items))
    row = next(r for r in found if r.doc_id == 100)
    value = dict(rows)[100]
    (span,) = row.spans
    assert lowered(value[span.first : span.last]).split(", ") == test[0][3:30]
    kept = decontamination.clean(documents(rows), benchmark)
    assert kept.count() == sum(not r.contaminated for r in found)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(documents(rows), none).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(documents([]), benchmark).count() == 0


def test_decontamination_by_a_benchmark_of_many_groups(spark, documents, monkeypatch):
    """Passes over one part each, long items cut to pieces, equal one pass over all."""
    rng = random.Random(16)
    test = [prose(rng, n) for n in (30, 13, 14, 3, 200, 57)]
    items = [(k, " ".join(t)) for k, t in enumerate(test)] + [(9, None), (None, "ba ce")]
    rows = [
        *EDGES,
        (100, " ".join(prose(rng, 5) + test[0][3:30] + test[3] + test[1])),
        (101, " ".join(prose(rng, 300) + test[2])),
        (101, " ".join(test[4])),
        (102, " ".join(test[4][100:113] + test[5][7:20] + test[5][8:40])),
        (103, " ".join(test[0] + test[5])),
        *[(200 + i, text(rng, 60)) for i in range(10)],
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = documents(rows)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 20)
    monkeypatch.setattr(decontamination, "PART_BYTES", 150)
    monkeypatch.setattr(decontamination, "GROUP", 2)
    groups = len(list(decontamination.item_parts(benchmark, 13))) / 2
    assert groups > 3
    found = decontamination.decontaminate(docs, benchmark)
    assert found.columns[0] == "doc_id" and "__mask" not in found.columns
    got = sorted(
        (repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in found.collect()
    )
    assert got == sorted(brute(rows, [x for x in items if x[0] is not None]))
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not row[-1] for row in got)


# -- pipeline ----------------------------------------------------------------


def test_pipeline_stages_follow_each_other(spark, documents, tmp_path):
    rng = random.Random(9)
    rows, labels = toxic_rows(rng, 200)
    line = " ".join(prose(rng, 30))
    item = prose(rng, 30)
    rows += [
        (1000, f"{line}\n{text(rng, 30)}"),
        (1001, f"{text(rng, 25)}\n{line}"),
        (1002, " ".join(item)),
        (1003, None),
        (1004, ""),
        (None, text(rng, 20)),
    ]
    base = prose(rng, 100)
    rows += [(2000 + i, " ".join([*base, str(i)])) for i in range(5)]
    docs = documents(rows, extra=())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        held[name] = {r.doc_id: r for r in docs.collect()}
    assert 1001 in held["toxicity"] and len(held["toxicity"]) < 175
    assert line not in held["line_dedup"][1001].text
    edited = held["line_dedup"][1001]
    assert edited.n_chars == len(edited.text)
    assert {1003, 1004, None} <= set(held["decontamination"])
    assert [i for i in range(2000, 2005) if i in held["near_dedup"]] == [2000]
    assert 1002 in held["near_dedup"] and 1002 not in held["decontamination"]
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in final} == set(held["decontamination"])


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_toxicity", "op4_line_dedup", "op10_language_id"])
def test_queries_without_sql_cover_their_table(spark, name):
    found = queries()[name](spark, SF_DIR)
    count = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert found.count() == count or name.startswith("op1_")
