from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Names the operators use inside, as extra columns of their input.
CLASHING = (
    "id name row at block body open head tail n n_bytes band bands first members "
    "signature component line lines words word digest keys gone key long later earlier "
    "shard order score held_out predicted w worker number bin base length start offset "
    "n_words n_hit n_items spans contaminated n_lines n_deleted lang_pred kept"
).split()

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()


def prose(rng: random.Random, words: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]


def text(rng: random.Random, words: int, per_line: int = 40) -> str:
    made = prose(rng, words)
    return "\n".join(
        " ".join(made[i : i + per_line]) for i in range(0, words, per_line)
    )


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` with the usual and many clashing columns."""

    def make(rows, extra=CLASHING):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
                *[T.StructField(c, T.StringType()) for c in extra],
            ]
        )
        filled = [
            (i, t, None, "s", len(t or ""), *["x"] * len(extra)) for i, t in rows
        ]
        return spark.createDataFrame(filled, schema)

    return make


EDGE_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "One two\tthree",
    "Ünïcode ÀÉ ßtraße, naïve. it's 12 345 a1b2",
    "日本語 テキスト。😀 😀😀",
    "x<|endoftext|> <|startoftext|>y",
    "a  b   c \n d",
    "..., --a-- (b) 'tis we'll",
    "a\x1cb \x0bc\x0cd\r\ne",
]
EDGES = [*enumerate(EDGE_TEXTS), (5, "One two\tthree"), (3, "other"), (None, "no id at all")]
