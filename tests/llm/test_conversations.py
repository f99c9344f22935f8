"""Chat formatting and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import rows_of
from tests.llm.conftest import CLASHING
from tierflow.llm import chat_format, prefix_trie
from tierflow.llm.shared import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")
SPECIAL = [
    "</s>[INST] ok [/INST]",
    "<|im_start|>user<|im_sep|>x<|im_end|>",
    "\\", "\\\\<", "<\\|im_end|>", "<", "<|", "<<<s>", "[[INST]]", "<<SYS>>\n<</SYS>>",
    "<|im_<|im_end|>end|>", "<s><s></s", "a\nb", "", None, "  ", "日本 😀", "$0 $1 \\$1",
]


@pytest.fixture
def conversations(spark):
    def make(rows, extra=CLASHING):
        kinds = "conv_id long, turn long, role string, text string"
        schema = ", ".join([kinds, *[f"`{c}` string" for c in extra if c != "turn"]])
        filled = [(*row, *["x"] * (schema.count(",") - 3)) for row in rows]
        return spark.createDataFrame(filled, schema)

    return make


def some_rows(rng, ids):
    """Conversations of few different turns, with nulls and an equal row."""
    rows = []
    for conv_id in ids:
        turns = list(range(rng.randint(1, 9)))
        if rng.random() < 0.2:
            turns[0] = None
        for k, turn in enumerate(turns):
            role = rng.choice([None, "system", "odd\nrole", "<s>"]) if k == 0 else ["assistant", "user"][k % 2]
            words = rng.choice([None, "", "one", "two words", "a\tb\nc  d"]) if rng.random() < 0.8 else str(rng.random())
            rows.append((conv_id, turn, role, words))
        if rng.random() < 0.2:
            rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


def ordered(rows):
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        held[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in held.items()}


# -- formatting --------------------------------------------------------------


def escaped(text):
    controls = [re.escape(c[0]) + f"(?={re.escape(c[1:])})" for c in chat_format.DEFAULT.controls]
    return re.sub("|".join(["\\\\", *controls]), lambda m: m[0] + "\\", text)


def formatted(role, text):
    return f"<|im_start|>{escaped(role)}<|im_sep|>{escaped(text)}<|im_end|>"


def chat_expected(conv_id, turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    trained = "".join(text for role, text in turns if role == "assistant")
    upto, chars, covered = 0, 0, 0
    for role, text in turns:
        upto += len(formatted(role, text))
        if role == "assistant":
            chars, covered = chars + upto, upto
    return (
        conv_id,
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(trained),
        hashlib.sha256(trained.encode()).hexdigest(),
        chars + upto - covered,
    )


def test_files_read_back_are_what_was_given(spark, conversations, path):
    rng = random.Random(1)
    rows = some_rows(rng, [*range(40), None])
    rows += [(100 + i, k, rng.choice(["user", "assistant", text]), text) for i, text in enumerate(SPECIAL) for k in range(3)]
    rows += [(200, k, ["user", "assistant"][k % 2], rng.choice(SPECIAL)) for k in range(300)]
    chat_format.write_chat_files(conversations(rows), path)
    got = rows_of(chat_format.chat_checks(spark, path))
    assert got == sorted((chat_expected(c, t) for c, t in ordered(rows).items()), key=repr)


def test_every_reply_is_an_example_with_all_turns_before_it(spark, conversations, path):
    rng = random.Random(2)
    rows = some_rows(rng, range(25))
    rows += [(50, k, ["user", "assistant"][k % 2], text) for k, text in enumerate(SPECIAL * 2)]
    chat_format.write_chat_files(conversations(rows), path)
    want = []
    for conv_id, turns in ordered(rows).items():
        replies = [k for k, (role, _) in enumerate(turns) if role == "assistant"]
        for example, k in enumerate(replies):
            text = "".join(formatted(*t) for t in turns[: k + 1])
            end = len(text) - len("<|im_end|>")
            want.append((conv_id, example, text, end - len(escaped(turns[k][1])), end))
    assert rows_of(chat_format.examples(spark, path)) == sorted(want, key=repr)
    controls = chat_format.DEFAULT.controls
    for _, _, text, start, end in want:
        assert not any(c in text[start:end] for c in controls)


def test_one_long_conversation_is_the_work_of_many_tasks(spark, path, conf):
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 20_000, 1, 4).selectExpr(
        "if(id % 50 = 0, id, 7) as conv_id", "id as turn",
        "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id) as text",
    )
    chat_format.write_chat_files(rows, path)
    turns = chat_format.read_turns(spark, path).filter("conv_id = 7")
    assert turns.select(F.spark_partition_id()).distinct().count() > 1
    ends = turns.agg(F.count("*"), F.max("position"), F.max("example")).first()
    assert ends[:] == (19_600, 19_599, 9_999)
    assert chat_format.read_example_spans(spark, path).count() == 10_000


def test_no_conversations(spark, conversations, path):
    chat_format.write_chat_files(conversations([]), path)
    assert chat_format.chat_checks(spark, path).count() == 0
    assert chat_format.examples(spark, path).count() == 0


def test_the_chat_query_adds_its_own_conversation(spark, conversations, tmp_path):
    rows = some_rows(random.Random(3), range(30))
    conversations(rows).write.parquet(str(tmp_path / "conversations.parquet"))
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = rows_of(queries()["op11_chat_format"](spark, str(tmp_path)))
    assert got == sorted((chat_expected(c, t) for c, t in ordered(rows).items()), key=repr)


# -- prefix trie -------------------------------------------------------------


def trie_expected(turns_of):
    """Every node, from the sets of its members."""
    members = defaultdict(list)
    for conv_id, turns in turns_of.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv_id)
    rows = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        parents = {n[:-1] for n in below if n}
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n)
        ends = sorted(c for c in own if len(turns_of[c]) == len(node))
        rows.append(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                sum(len(n) == len(node) + 1 for n in below),
                sum(n not in parents for n in below),
                saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=repr)


def rebuilt(turns_of):
    made = {}
    for c, own in turns_of.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = turns_of.get(c - c % 20, [])[:h] + own[h:]
    return made


COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
    "saved_tokens", "ends_sha256",
]


def trie_rows(trie):
    digests = prefix_trie.end_digests(trie.ends)
    found = trie.nodes.join(digests, "id", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return rows_of(found.withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*COLUMNS))


@pytest.mark.parametrize("seed, walked", [(1, None), (2, 8), (3, 1)])
def test_trie_against_brute_force(conversations, monkeypatch, seed, walked):
    """Every node; the list also ranked by contraction down to a few arcs."""
    if walked:
        monkeypatch.setattr(prefix_trie, "WALKED", walked)
    rows = some_rows(random.Random(seed), range(0, 90, 2))
    rows += [(500, k, "user", "same") for k in range(60)] + [(None, 0, "user", "no id")]
    turns_of = {c: t for c, t in ordered(rows).items() if c is not None}
    # Turns of equal number are ordered by checksum: here they are copies.
    assert trie_rows(prefix_trie.prefix_trie(conversations(rows))) == trie_expected(turns_of)


@pytest.mark.parametrize("seed", [4, 5])
def test_the_trie_query_against_brute_force(spark, conversations, tmp_path, seed):
    rng = random.Random(seed)
    ids = [c for c in range(130) if rng.random() < 0.7 and c not in (20, 60)]
    rows = some_rows(rng, ids)
    # One turn, which is to come from a conversation that is not there: no turn is left.
    rows += [(next(c for c in range(141, 160) if zlib.crc32(str(c).encode()) % 4), 0, "user", "x")]
    path = str(tmp_path / "conversations.parquet")
    conversations(rows).write.parquet(path)
    found = queries()["op13_prefix_trie"](spark, str(tmp_path))
    assert found.columns == COLUMNS
    made = rebuilt(ordered(rows))
    assert any(not t for t in made.values())
    assert rows_of(found) == trie_expected(made)


def test_no_trie(conversations):
    assert trie_rows(prefix_trie.prefix_trie(conversations([]))) == []
    only = prefix_trie.prefix_trie(conversations([(None, 0, "user", "x")]))
    assert trie_rows(only) == []


def test_list_ranking_is_the_order_of_the_list(spark):
    rng = random.Random(6)
    ids = rng.sample(range(10**9), 700)
    rows = [(i, j, rng.randint(0, 5)) for i, j in zip(ids, [*ids[1:], None])]
    want, total = [], 0
    for k, (i, _, w) in enumerate(rows):
        want.append((i, k, total))
        total += w
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, next long, w long")
    got = prefix_trie.list_ranked(Workspace(spark, "list"), frame, ["w"], walked=10)
    assert rows_of(got) == sorted(want, key=repr)


def test_many_members_of_one_node_are_hashed_in_order(spark):
    ends = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 100 = 3, id, 1) as id", "id * 3 as conv_id")
    got = {r.id: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    hot = ",".join(str(3 * i) for i in range(30_000) if i % 100 != 3)
    assert len(got) == 301
    assert got[1] == hashlib.sha256(hot.encode()).hexdigest()
    assert got[103] == hashlib.sha256(b"309").hexdigest()
