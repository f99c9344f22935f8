"""Chat formatting by prefix-target expansion (operator 11).

Every assistant turn becomes an example of its own: all turns before it are context, and
only its text is trained on.  The examples of a conversation are prefixes of one formatted
text, so that text is written once, a row per turn with its place, and an example is a row
that says where its text and its trainable part end.  What is written grows with the
input, not with its square; ``examples`` unfolds whole texts for a reader who wants them.

A turn is ``open role separator text close``.  Inside roles and texts every control string,
the template's own marks and other strings that models read as control, is broken by a
backslash behind its first character; a backslash is doubled.  So marks stand only where
the template puts them, and taking away each escaping backslash gives back the original.

Places and offsets come from running totals over range slices, so one long conversation
is the work of many tasks.  Only a digest over a whole conversation, which is sequential
by its nature, reads that conversation in one task, row after row.

Defined results: turns are ordered by ``turn``, null first, then by role and text; equal
rows are turns each; null roles and texts count as empty; only turns whose role is
``assistant`` are targets, an empty one too; turns after the last target, or all of a
conversation without one, are written but belong to no example; rows without a
``conv_id`` are one conversation; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.shared import by_shuffle
from tierflow.operators.ordinals import running_totals

TARGET_ROLE = "assistant"


@dataclass(frozen=True)
class Template:
    """Marks around a turn, and further strings that texts must not hold as they are."""

    open: str = "<|im_start|>"
    separator: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    reserved: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
        "<|startoftext|>", "<|endoftext|>",
    )

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.separator, self.close, *self.reserved)

    def escaped(self, value: Column) -> Column:
        """A backslash behind each backslash and each first character of a control."""
        begins = [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls]
        return F.regexp_replace(value, "|".join(["\\\\", *begins]), "$0\\\\")

    def formatted(self, role: Column, text: Column) -> Column:
        marks = (F.lit(x) for x in (self.open, self.separator, self.close))
        first, middle, last = marks
        return F.concat(first, self.escaped(role), middle, self.escaped(text), last)

    def text_begins(self, formatted: Column) -> Column:
        """Where the text begins in a formatted turn, counted from 0."""
        return F.instr(formatted, self.separator) - 1 + len(self.separator)

    def role_of(self, formatted: Column) -> Column:
        size = self.text_begins(formatted) - len(self.separator) - len(self.open)
        return unescaped(F.substr(formatted, F.lit(len(self.open) + 1), size))

    def text_of(self, formatted: Column) -> Column:
        begin = self.text_begins(formatted)
        size = F.char_length(formatted) - len(self.close) - begin
        return unescaped(F.substr(formatted, begin + 1, size))


def unescaped(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


DEFAULT = Template()


def write_chat_files(
    conversations: DataFrame, path: str, template: Template = DEFAULT
) -> None:
    """Write ``turns`` and ``examples`` under ``path``.

    ``turns``: ``conv_id, position, first_char, formatted``, the position from 0 and the
    offset of the turn in the conversation's formatted text in code points.
    ``examples``: ``conv_id, example, position, n_chars, loss_start, loss_end``, the first
    ``n_chars`` code points of that text and the span to train on in them.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Copies of a turn shrink to one row before the first shuffle.
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("copies")
    )
    made = template.formatted(F.col("role"), F.col("text"))
    sized = distinct.withColumn("formatted", made).withColumns(
        {
            "chars": F.char_length("formatted").cast("long"),
            "target": (F.col("role") == TARGET_ROLE).cast("long"),
        }
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = running_totals(
        sized,
        ["conv_id"],
        order,
        sums={
            "turns_before": F.col("copies"),
            "chars_before": F.col("copies") * F.col("chars"),
            "targets_before": F.col("copies") * F.col("target"),
        },
    )
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    turns = placed.withColumn("nth", nth).select(
        "conv_id",
        (F.col("turns_before") + F.col("nth")).alias("position"),
        (F.col("chars_before") + F.col("nth") * F.col("chars")).alias("first_char"),
        F.when(
            F.col("target") == 1, F.col("targets_before") + F.col("nth")
        ).alias("example"),
        "formatted",
    )
    turns.write.option("compression", "zstd").parquet(f"{path}/turns")
    written = conversations.sparkSession.read.schema(turns.schema).parquet(f"{path}/turns")
    end = F.col("first_char") + F.char_length("formatted")
    written.filter("example is not null").select(
        "conv_id",
        "example",
        "position",
        end.alias("n_chars"),
        (F.col("first_char") + template.text_begins(F.col("formatted"))).alias("loss_start"),
        (end - len(template.close)).alias("loss_end"),
    ).write.option("compression", "zstd").parquet(f"{path}/examples")


_TURNS = "conv_id long, position long, first_char long, example long, formatted string"
_EXAMPLES = (
    "conv_id long, example long, position long, n_chars long, loss_start long, "
    "loss_end long"
)


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_TURNS).parquet(f"{path}/turns")


def read_example_spans(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_EXAMPLES).parquet(f"{path}/examples")


def examples(spark: SparkSession, path: str) -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_end)`` with whole texts.

    A conversation's texts together have the square of its turns, which is what whole
    prefixes are; filter the conversations first, or train from the spans.
    """
    spans = read_example_spans(spark, path)
    turns = read_turns(spark, path).select(
        F.col("conv_id").alias("of"), F.col("position").alias("at"), "formatted"
    )
    context = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") <= F.col("position"))
    parts = F.array_sort(F.collect_list(F.struct("at", "formatted")))
    return (
        spans.join(by_shuffle(turns), context)
        .groupBy("conv_id", "example", "loss_start", "loss_end")
        .agg(F.array_join(parts["formatted"], "").alias("text"))
        .select("conv_id", "example", "text", "loss_start", "loss_end")
    )


def chat_checks(
    spark: SparkSession, path: str, template: Template = DEFAULT
) -> DataFrame:
    """What the written files say, per conversation: turns and trained text by digest.

    ``formatted_chars`` counts each example with its context, and the turns behind the
    last example once.
    """
    spans = read_example_spans(spark, path).select(
        F.col("conv_id").alias("of"), F.col("position").alias("at"),
        "n_chars", "loss_start", "loss_end",
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("position") == F.col("at"))
    formatted = F.col("formatted")
    trained = F.substr(
        formatted,
        (F.col("loss_start") - F.col("first_char") + 1).cast("int"),
        (F.col("loss_end") - F.col("loss_start")).cast("int"),
    )
    rows = (
        read_turns(spark, path)
        .join(by_shuffle(spans), same, "left")
        .select(
            "conv_id",
            "position",
            F.concat(
                template.role_of(formatted), F.lit("\n"), template.text_of(formatted), F.lit("\n")
            ).alias("turn"),
            unescaped(trained).alias("trained"),
            (F.col("first_char") + F.char_length(formatted)).alias("upto"),
            "n_chars",
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
    )
    return rows.mapInArrow(_checked, _CHECKS)


_CHECKS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation; turns arrive in order and are hashed one by one."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    begun, conv = False, None
    n = loss = chars = upto = covered = 0
    turns, losses = hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                if begun:
                    total = chars + upto - covered
                    done.append((conv, n, turns.hexdigest(), loss, losses.hexdigest(), total))
                begun, conv = True, row["conv_id"]
                n = loss = chars = upto = covered = 0
                turns, losses = hashlib.sha256(), hashlib.sha256()
            n, upto = n + 1, row["upto"]
            turns.update(row["turn"].encode())
            if row["trained"] is not None:
                losses.update(row["trained"].encode())
                loss += len(row["trained"])
                chars, covered = chars + row["n_chars"], row["n_chars"]
        if done:
            yield _rows(done, schema)
    if begun:
        total = chars + upto - covered
        yield _rows([(conv, n, turns.hexdigest(), loss, losses.hexdigest(), total)], schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
