"""Exact, near, line and substring dedup against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter
from itertools import combinations

import pytest

from tests.llm.conftest import EDGES, prose, text
from tierflow.llm import exact_dedup, line_dedup, near_dedup, substring_dedup
from tierflow.llm.near_dedup import least_matches
from tierflow.llm.shared import Workspace, components, shingle_set, similar, words_of


def lower(value):
    return (value or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# -- exact -------------------------------------------------------------------


def test_exact_dedup_equals_grouping(documents):
    rng = random.Random(1)
    long = text(rng, 3000)
    rows = [
        *EDGES,
        *[(200 + i, long) for i in range(20)],
        (300, long.upper()),
        (301, long[:-1] + "q"),
        (302, long[:2000] + "q" + long[2001:]),
        (303, "É" + "A" * 1023),
        (304, "É" + "a" * 1023),
        (305, "é" + "a" * 1023),
        *[(400 + i, "a" * n) for i, n in enumerate((1023, 1024, 1025, 2048, 2049))],
    ]
    found = exact_dedup.exact_dedup(documents(rows)).collect()
    assert len(found) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    by_digest = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for row in found:
        ids = by_digest[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == max(known, default=None)
        if row.kept:
            assert row.doc_id == row.keep_id
    assert sum(r.kept for r in found) == len(groups)
    assert exact_dedup.exact_dedup(documents([])).count() == 0


# -- components --------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)]
    edges += [(500, 499), (7, 7), (499, 500)]
    ws = Workspace(spark, "test")
    got = dict(components(ws, spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {100 + k: 100 for k in range(50)}
    assert got == want | {499: 499, 500: 499}
    nothing = spark.createDataFrame([], "a long, b long")
    assert components(ws, nothing).count() == 0


# -- near --------------------------------------------------------------------


def near_by_brute_force(rows):
    sets = [(i, shingle_set(words_of(t), 5)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and similar(a, b, 75):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def variants(rng, base, count, edits):
    for _ in range(count):
        made = list(base)
        for _ in range(rng.randint(0, edits)):
            made[rng.randrange(len(made))] = prose(rng, 1)[0]
        yield " ".join(made)


@pytest.mark.parametrize("across", ["_across", "_across_in_bands"])
def test_near_dedup_equals_brute_force(documents, monkeypatch, across):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(near_dedup, "_across", getattr(near_dedup, across))
    rng = random.Random(2)
    rows = list(EDGES)
    for base in (prose(rng, 120), prose(rng, 200)):
        rows += [(len(rows) + 50, t) for t in variants(rng, base, 60, 6)]
    shared = prose(rng, 60)
    for _ in range(60):  # a common passage in texts that are otherwise apart
        own = prose(rng, 40)
        rows.append((len(rows) + 50, " ".join(shared + own)))
    rows += [(len(rows) + 50, text(rng, 80)) for _ in range(40)]
    rows += [(900 + i, rows[-1][1]) for i in range(30)]
    rng.shuffle(rows)
    found = near_dedup.near_dedup(documents(rows)).collect()
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in found)
    want = sorted((repr(i), n, repr(c)) for i, n, c in near_by_brute_force(rows))
    assert got == want
    assert all(
        r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found
    )


def test_near_dedup_of_an_empty_table(documents):
    assert near_dedup.near_dedup(documents([])).count() == 0


def test_sequential_bounds_let_similar_pairs_through():
    least = least_matches(128, 32, 75, 1e-7)
    assert least == sorted(least) and len(least) == 4
    # 96 of 128 is the threshold itself; the last bound is well below it.
    assert 40 < least[-1] < 85


def test_representatives_keep_the_columns(documents):
    docs = documents([(1, "a b c d e f g"), (2, "A b c d e f g"), (3, None), (None, "x")])
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


# -- lines -------------------------------------------------------------------


def links_between(later, earlier):
    """Links of numbered lines, as the operator makes them, of one document to another."""
    place, copies, seen, found = {}, Counter(earlier), Counter(), []
    for j, line in enumerate(earlier):
        place[line, seen[line]] = j
        seen[line] += 1
    seen.clear()
    for i, line in enumerate(later):
        if line in copies:
            found.append((i, place[line, seen[line] % copies[line]]))
        seen[line] += 1
    return found


@pytest.mark.parametrize(
    ("later", "earlier", "want"),
    [
        ("abc", "abc", ["abc"]),
        ("xabcy", "pabcq", ["abc"]),
        ("abxcd", "abycd", ["ab", "cd"]),
        ("xpypz", "qpr", ["p", "p"]),  # no line is an anchor by itself
        ("cdab", "abcd", ["ab", "cd"]),  # a moved block
        ("ababab", "ab", ["ab", "ab", "ab"]),
        ("cba", "abc", ["a", "b", "c"]),
        ("", "abc", []),
    ],
)
def test_patience_alignment(later, earlier, want):
    links = links_between(later, earlier)
    blocks = line_dedup.aligned_blocks(links)
    assert sorted(k for b in blocks for k in b) == list(range(len(links)))
    assert sorted("".join(later[links[k][0]] for k in b) for b in blocks) == want


@pytest.mark.parametrize("seed", range(20))
def test_longest_orders_and_chains(seed):
    rng = random.Random(seed)
    values = [rng.randint(0, 12) for _ in range(rng.randint(0, 14))]
    orders = [
        c for n in range(len(values) + 1) for c in combinations(range(len(values)), n)
        if all(values[a] < values[b] for a, b in zip(c, c[1:]))
    ]
    best = line_dedup.longest_order(values)
    assert tuple(best) in orders and len(best) == max(map(len, orders))
    chains = line_dedup.ascending_chains(values)
    assert sorted(k for c in chains for k in c) == list(range(len(values)))
    assert all(tuple(c) in orders for c in chains)
    # As many chains as the longest stretch that never ascends.
    falling = [1] * len(values)
    for b in range(len(values)):
        falling[b] += max((falling[a] for a in range(b) if values[a] >= values[b]), default=0)
    assert len(chains) == max(falling, default=0)


def test_chains_of_long_documents_are_made_in_linear_steps():
    began = time.monotonic()
    assert len(line_dedup.aligned_blocks([(i, 0) for i in range(60_000)])) == 60_000
    assert len(line_dedup.aligned_blocks([(i, -i) for i in range(60_000)])) == 60_000
    assert time.monotonic() - began < 20


def lines_by_brute_force(rows, least=line_dedup.BLOCK_CHARS):
    """Texts after deletion.  Needs distinct ids, and no line twice in one document."""
    texts = {i: t for i, t in rows if t}
    held = {
        i: [x.strip(" \t\r\x0b\f") for x in t.split("\n")] for i, t in texts.items()
    }
    solid = {i: [x for x in lines if x] for i, lines in held.items()}
    first = {}
    for i in sorted(solid):
        for line in solid[i]:
            first.setdefault(line, i)
    made = {}
    for i, text in texts.items():
        own = solid[i]
        if any(texts[j] == text for j in texts if j < i):
            made[i] = ""
            continue
        linked = [first[x] != i for x in own]
        gone, k = [False] * len(own), 0
        while k < len(own):  # a maximal run that stands so in the first holder
            m = k + 1
            if linked[k]:
                there = solid[first[own[k]]]
                at = there.index(own[k])
                while (
                    m < len(own) and first[own[m]] == first[own[k]]
                    and there[at + m - k : at + m - k + 1] == [own[m]]
                ):
                    m += 1
                gone[k:m] = [sum(map(len, own[k:m])) >= least] * (m - k)
            k = m
        done = list(gone)
        for k in range(len(own)):
            a = next((x for x in range(k, -1, -1) if gone[x] or not linked[x]), None)
            b = next((x for x in range(k, len(own)) if gone[x] or not linked[x]), None)
            done[k] = a is not None and b is not None and gone[a] and gone[b]
        stay, k = [], 0
        for line, shown in zip(held[i], text.split("\n")):
            if line:
                stay += [] if done[k] else [shown]
                k += 1
            else:
                sides = [done[x] for x in (k - 1, k) if 0 <= x < len(own)]
                stay += [] if sides and all(sides) else [shown]
        made[i] = "\n".join(stay)
    return made


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(documents, seed):
    rng = random.Random(seed)
    pool = [*"}{;", "Yes.", "No", "end", *[" ".join(prose(rng, 5)) for _ in range(60)]]
    passages = [rng.sample(pool, rng.randint(2, 7)) for _ in range(12)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(1, 4)):
            lines += rng.choice(passages) if rng.random() < 0.6 else [" ".join(prose(rng, 4))]
            lines += rng.sample(pool, rng.randint(0, 2))
        lines = [f"{x} " if rng.random() < 0.1 else x for x in dict.fromkeys(lines)]
        spaced = [y for x in lines for y in ([x, ""] if rng.random() < 0.2 else [x])]
        rows.append((i, "\n".join(spaced)))
    rows += [(1000 + i, rows[i][1]) for i in range(5)]
    found = line_dedup.line_dedup(documents(rows)).collect()
    assert {r.doc_id: r.text for r in found} == lines_by_brute_force(rows)
    before = dict(rows)
    for r in found:
        assert r.n_lines == before[r.doc_id].count("\n") + 1
        left = 0 if r.n_deleted == r.n_lines else r.text.count("\n") + 1
        assert r.n_lines - r.n_deleted == left


@pytest.mark.parametrize("seed", range(2))
def test_deleted_lines_stay_somewhere_and_left_ones_are_explained(documents, seed):
    """Also where documents repeat lines inside themselves."""
    rng = random.Random(seed)
    pool = ["}", "ok", "Yes.", *[" ".join(prose(rng, 4)) for _ in range(12)]]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 30)))) for i in range(60)]
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(rows)).collect()}
    for i, text in rows:
        left = Counter(found[i].split("\n"))
        lost = Counter(text.split("\n")) - left
        earlier = {x for j, t in rows if j < i for x in t.split("\n")}
        stays = {x for j in found if j < i for x in found[j].split("\n")}
        assert set(lost) <= stays
        assert all(len(x) < line_dedup.BLOCK_CHARS for x in left if x in earlier)


def test_lines_that_agree_by_chance_stay(documents):
    rng = random.Random(15)
    own = [" ".join(prose(rng, 8)) for _ in range(8)]
    shared = [" ".join(prose(rng, 8)) for _ in range(2)]
    rows = [
        (1, "\n".join([own[0], "}", own[1], "Yes."])),
        (2, "\n".join([own[2], "}", own[3]])),
        (3, "\n".join([shared[0], "}", shared[1], own[4]])),
        (4, "\n".join([own[5], shared[0], "}", shared[1], "Yes.", own[6]])),
    ]
    texts = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(rows)).collect()}
    assert [texts[i] for i in (1, 2, 3)] == [t for _, t in rows[:3]]
    assert texts[4] == "\n".join([own[5], "Yes.", own[6]])


def test_repeats_inside_and_moved_blocks_go(documents):
    line = [f"a line of its own, number {k}" for k in range(8)]
    rows = [
        (1, "\n".join([line[0], line[1], line[0]])),
        (2, line[0]),
        (3, "\n".join(["third", line[0]])),
        (4, "\n".join([line[2], line[3], "fourth", line[4]])),
        (5, "\n".join([line[4], "fifth", line[2], line[3], line[3]])),
    ]
    texts = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(rows)).collect()}
    assert texts[1] == rows[0][1] and texts[4] == rows[3][1]
    assert (texts[2], texts[3], texts[5]) == ("", "third", "fifth")


def test_a_first_holder_of_very_many_lines_and_partners(documents):
    """A link is one place on either side, so links grow with the lines of partners."""
    lines = [f"line number {k} of the first" for k in range(20_000)]
    rows = [(0, "\n".join(lines)), (1, "\n".join(lines[5:] + ["last"]))]
    rows += [(10 + i, f"own {i}\n{lines[i]}\n{lines[7]}") for i in range(3000)]
    docs = documents(rows, extra=())
    links = line_dedup.line_links(Workspace(docs.sparkSession, "links"), docs)
    assert links.count() == 19_995 + 2 * 3000
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(docs).collect()}
    assert found[0] == rows[0][1] and found[1] == "last"
    assert all(found[10 + i] == f"own {i}" for i in range(3000))


def test_line_dedup_of_edge_texts(documents):
    rows = [*EDGES, (40, "x" * 3_000_000), (41, "y\n" * 200_000), (42, "One two\tthree\nx")]
    found = line_dedup.line_dedup(documents(rows)).collect()
    assert len(found) == len(rows)
    before = {(i, t) for i, t in rows}
    texts = {(r.doc_id, r.text) for r in found}
    assert texts - before == {(42, "x")}


def test_line_dedup_deletes_from_the_later_document(documents):
    rng = random.Random(4)
    line = [" ".join(prose(rng, 12)) for _ in range(40)]
    copies = "\n".join(line[:5])
    rows = [
        (1, "\n".join([line[0], line[1], "", line[2], "own one"])),
        (2, "\n".join(["own two", line[1] + "  ", "", line[2]])),
        (3, "own three"),
        (4, ""),
        (5, None),
        (None, line[0]),
        *[(10 + i, "hello\nworld") for i in range(30)],  # copies of common short lines
        *[(50 + i, "\n".join(["short", line[20], f"mine {i} {line[21 + i % 9]}"])) for i in range(9)],
        (7, copies),
        (7, copies),
    ]
    found = line_dedup.line_dedup(documents(rows)).collect()
    assert len(found) == len(rows)
    texts = {}
    for row in found:
        texts.setdefault(row.doc_id, set()).add(row.text)
    assert texts[1] == {rows[0][1]}
    assert texts[2] == {"own two"}
    assert texts[3] == {"own three"} and texts[4] == {""} and texts[5] == {None}
    assert texts[None] == {line[0]}
    assert texts[10] == {"hello\nworld"} and texts[20] == {""}
    assert texts[7] == {"\n".join(line[3:5])}
    assert line_dedup.line_dedup(documents([])).count() == 0


def test_a_frequent_short_line_or_block_goes_from_all_but_its_first_holder(documents):
    rng = random.Random(5)
    own = [" ".join(prose(rng, 12)) for _ in range(60)]
    block = ["All rights reserved.", "", "See below."]
    rows = [(i, "\n".join([own[i], *block, own[i + 30]])) for i in range(30)]
    rows += [(100 + i, f"{own[i][:20]}{i}\nCommon.\n{i} {own[i][:9]}") for i in range(12)]
    texts = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(rows)).collect()}
    assert texts[0] == rows[0][1] and texts[100] == rows[30][1]
    assert all(texts[i] == f"{own[i]}\n{own[i + 30]}" for i in range(1, 30))
    assert all("Common." not in texts[100 + i] for i in range(1, 12))


# -- substrings --------------------------------------------------------------


def test_repeated_passages_are_removed_and_clean_texts_left(documents):
    rng = random.Random(6)
    passage = prose(rng, 70)
    near = list(passage)
    near[10] = "changed"
    common = " ".join(prose(rng, 12))  # too short to be a removal
    rows = [
        (1, "\n".join([text(rng, 60, 60), " ".join(passage)])),
        (2, "\n".join([text(rng, 60, 60), " ".join(near), common])),
        (3, " ".join(prose(rng, 80) + passage + prose(rng, 90))),
        (4, " ".join(prose(rng, 50) + [w.upper() for w in passage])),
        *[(10 + i, text(rng, 200, 50) + "\n" + common) for i in range(30)],
        (50, None),
        (51, ""),
        (None, " ".join(passage)),
    ]
    found = substring_dedup.removals(documents(rows)).collect()
    assert {r.doc_id for r in found} == {2, 3, 4}
    assert all(r.keep_doc_id in (1, 2, 3) and r.words >= 25 for r in found)
    spans = {r.doc_id: r for r in found}
    assert (spans[2].line, spans[2].first_word, spans[2].words) == (1, 0, 70)
    for doc, before in ((3, 80), (4, 50)):
        first, last = spans[doc].first_word, spans[doc].first_word + spans[doc].words
        assert before <= first and last <= before + 70


def test_many_copies_of_one_paragraph(documents):
    rng = random.Random(7)
    paragraph = text(rng, 40, 40)
    rows = [(i, paragraph) for i in range(40)] + [(90, paragraph), (90, paragraph)]
    found = substring_dedup.removals(documents(rows)).collect()
    assert sorted(r.doc_id for r in found) == [*range(1, 40), 90]
    assert {r.keep_doc_id for r in found} == {0}
    assert substring_dedup.removals(documents([])).count() == 0


def test_removals_cover_all_shared_runs_of_words(documents):
    rng = random.Random(8)

    def wrapped(words, per_line):
        lines = [words[i : i + per_line] for i in range(0, len(words), per_line)]
        return "\n".join(" ".join(x) for x in lines)

    rows = []
    for size in (25, 30, 51, 60, 75):  # inside lines that are otherwise apart
        passage = prose(rng, size)
        for _ in range(3):
            own = prose(rng, 90) + passage + prose(rng, 90)
            rows.append((len(rows), " ".join(own)))
    for size in (26, 60, 200):  # over lines of few words, broken at other places
        passage = prose(rng, size)
        for per_line in (5, 7, 12):
            own = prose(rng, 40) + passage + prose(rng, 40)
            rows.append((len(rows), wrapped(own, per_line)))
    rows += [(70 + i, wrapped(rows[0][1].split(), 9)) for i in range(2)]
    rows += [(80 + i, wrapped(prose(rng, 150), 6)) for i in range(5)]
    want, seen = set(), {}
    for i, value in rows:
        words = value.split()
        for k in range(len(words) - 24):
            if seen.setdefault(tuple(words[k : k + 25]), i) != i:
                want |= {(i, j) for j in range(k, k + 25)}
    got, places = set(), dict(rows)
    for r in substring_dedup.removals(documents(rows)).collect():
        before = [len(x.split()) for x in places[r.doc_id].split("\n")[: r.line]]
        first = sum(before) + r.first_word
        assert r.words > 0 and r.keep_doc_id < r.doc_id
        got |= {(r.doc_id, j) for j in range(first, first + r.words)}
    # A paragraph of short lines may be a near copy a few words beyond a shared run.
    assert want <= got and len(got - want) < 40
    assert {w for w in got if w[0] < 15} == {w for w in want if w[0] < 15}
    assert not [w for w in got if w[0] >= 80]


def test_near_copies_of_short_lines_are_paragraphs(documents):
    rng = random.Random(9)
    words = prose(rng, 24)
    near = list(words)
    near[2] = "changed"
    texts = ["\n".join(" ".join(x[i : i + 8]) for i in (0, 8, 16)) for x in (words, near)]
    rows = [(i, f"{x}\nlast") for i, x in enumerate(texts)]
    found = substring_dedup.removals(documents(rows)).collect()
    assert sorted((r.doc_id, r.line, r.words) for r in found) == [
        (1, 0, 8), (1, 1, 8), (1, 2, 8), (1, 3, 1)
    ]


def test_a_passage_stays_where_its_keeper_is_not_removed(documents):
    """Document 2 goes as a near copy of 1, so its end is kept by the third."""
    rng = random.Random(12)
    a, x, b, c = (prose(rng, n) for n in (300, 30, 120, 120))
    rows = [(1, " ".join(a)), (2, " ".join(a + x)), (3, " ".join(b + x + c))]
    found = substring_dedup.removals(documents(rows)).collect()
    assert [(r.doc_id, r.line, r.words, r.keep_doc_id) for r in found] == [(2, 0, 330, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_keepers_name_text_that_stays(documents, seed):
    """No removed line is named as the keeper's, and every passage is left somewhere."""
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(26, 90)) for _ in range(5)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 4)):
            own = prose(rng, rng.randint(5, 150))
            at = rng.randint(0, len(own))
            inside = rng.choice(passages) if rng.random() < 0.5 else []
            lines.append(" ".join(own[:at] + inside + own[at:]))
        if rng.random() < 0.3:
            lines.append(rng.choice(rows)[1].split("\n")[0] if rows else "x")
        rows.append((i, "\n".join(lines)))
    found = substring_dedup.removals(documents(rows)).collect()
    left = {i: [line.split() for line in body.split("\n")] for i, body in rows}
    gone = {(r.doc_id, r.line) for r in found if r.words == len(left[r.doc_id][r.line])}
    for r in found:
        assert (r.keep_doc_id, r.keep_line) not in gone
        words = left[r.doc_id][r.line]
        words[r.first_word : r.first_word + r.words] = [None] * r.words
    kept = [" ".join(w or "|" for line in lines for w in line) for lines in left.values()]
    for passage in passages:
        assert any(" ".join(passage) in body for body in kept) or not any(
            " ".join(passage) in body.replace("\n", " ") for _, body in rows
        )


def test_substrings_of_edges_long_texts_and_repeated_rows(documents):
    rng = random.Random(14)
    long = prose(rng, 120_000)
    copied = " ".join(long[70_000:70_200])
    rows = [*EDGES, (60, " ".join(long)), (61, text(rng, 90) + " " + copied), (61, copied), (62, "w " * 9000)]
    found = substring_dedup.removals(documents(rows)).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in found} == {(61, 60)}
    assert sorted(r.words for r in found if r.words >= 25)[-1] == 200


def test_paragraphs_are_clustered_as_by_brute_force(documents, monkeypatch):
    """Every paragraph is one line; its class is that of near copies."""
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 8)
    rng = random.Random(21)
    lines = []
    for base in (prose(rng, 60), prose(rng, 90)):
        lines += list(variants(rng, base, 30, 4))
    shared = prose(rng, 30)
    lines += [" ".join(shared + prose(rng, 40)) for _ in range(30)]
    lines += [text(rng, 60, 60) for _ in range(20)] + lines[:10]
    rng.shuffle(lines)
    rows = list(enumerate(lines))
    classes = {i: c for i, _, c in near_by_brute_force(rows)}
    found = substring_dedup.removals(documents(rows)).collect()
    whole = {r.doc_id: r.keep_doc_id for r in found if r.words == len(lines[r.doc_id].split())}
    assert whole == {i: c for i, c in classes.items() if i != c}
