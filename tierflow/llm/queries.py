"""The registered queries of this package; each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    periodic_runs,
    prefix_trie,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
)
from tierflow.llm.oracle import LLM_ORACLE as LLM_ORACLE
from tierflow.llm.shared import Workspace, by_shuffle
from tierflow.sinks.scratch import scratch_path
from tierflow.sources.scans import literal_rows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(_documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.pack(_documents(spark, sf_dir), path, 1024, 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    return toxicity.toxicity(_documents(spark, sf_dir), labels)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = line_dedup.line_dedup(_documents(spark, sf_dir))
    return edited.select(
        "doc_id",
        "n_lines",
        "n_deleted",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(_documents(spark, sf_dir), benchmark).drop(
        "spans"
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "token-files")
    path = vocabulary("word_bpe_49k.json")
    token_files.write_token_files(_documents(spark, sf_dir), target, path, end_id=2)
    return token_files.read_token_checks(spark, target)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    return token_counts.token_counts(_documents(spark, sf_dir), path, 2048)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


_TURN = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    extra = [
        {"conv_id": -1, "turn": turn, "role": role, "text": said}
        for turn, role in enumerate(["user", "assistant"])
    ]
    rows = given.select("conv_id", "turn", "role", "text").union(
        literal_rows(spark, extra, _TURN)
    )
    target = scratch_path(spark, "chat-files")
    chat_format.write_chat_files(rows, target)
    return chat_format.chat_checks(spark, target)


def _with_planted_runs(documents: DataFrame) -> DataFrame:
    """A tenth of the documents, by the id's checksum, end in a repeated block."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select(
        "doc_id",
        "text",
        F.when(h % 10 == 0, words).alias("words"),
        F.floor(h / 10).cast("long").alias("g"),
    )
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8)).cast("int")
    block = F.slice("words", a + 1, p)
    tail = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return chosen.select(
        "doc_id",
        F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_runs(_documents(spark, sf_dir)))
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"], -r["start"], -r["period"]).cast(
                "struct<length: long, start: long, period: long>"
            ),
        )
    )
    listed = F.transform(
        "runs",
        lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]),
    )
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period"))
        .cast("long")
        .alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def _rebuilt(ws: Workspace, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Named turns with their first ones taken from the conversation whose id is the
    next lower multiple of 20, and all conversations."""
    turns = ws.keep(turns)
    sizes = ws.keep(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    plan = sizes.select(
        "conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base")
    )
    held = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("held"))
    plan = ws.keep(
        plan.join(by_shuffle(held), "base", "left").select(
            "conv_id", "h", "base", F.least("h", F.coalesce("held", F.lit(0))).alias("taken")
        )
    )
    # Twenty conversations at most share a base, and three turns of it at most are taken.
    first = turns.filter("position <= 3").withColumnRenamed("conv_id", "base")
    heads = (
        plan.filter("taken > 0")
        .join(by_shuffle(first), "base")
        .filter("position <= taken")
        .select("conv_id", "position", "h1", "h2", "words")
    )
    own = (
        turns.join(by_shuffle(plan), "conv_id")
        .filter("position > h")
        .select(
            "conv_id",
            (F.col("taken") + F.col("position") - F.col("h")).alias("position"),
            "h1",
            "h2",
            "words",
        )
    )
    return heads.unionByName(own), sizes.select("conv_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "prefix-trie")
    named = prefix_trie.named_turns(_table(spark, sf_dir, "conversations"))
    trie = prefix_trie.trie_of(ws, *_rebuilt(ws, named))
    digests = prefix_trie.end_digests(trie.ends)
    return trie.nodes.join(by_shuffle(digests), "id", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


LLM_QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_near_dedup": op8_near_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_chat_format": op11_chat_format,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}
