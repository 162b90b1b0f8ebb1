"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the one before kept, as a written table, and its decisions take effect.
Nothing is fixed to one size: every stage covers all of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import decontaminate, ngram_join, packing, quality_rules, suffix_dedup
from tripweave.llm.common import kept, table
from tripweave.llm.vocab import default_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: five words, a similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand elsewhere too are taken out of the texts.

    A cut inside a character drops what is left of it. n_chars counts what stays, and is null where it was null.
    """
    done = suffix_dedup.without_repeats(docs, 200, into="__repeats")
    cut = F.when(F.col("__repeats.n_spans") > 0, suffix_dedup.as_text(F.col("__repeats.kept"))).otherwise(F.col("text"))
    done = done.withColumn("__text", cut)
    length = F.when(F.col("n_chars").isNotNull(), F.when(F.col("__repeats.n_spans") > 0, F.length("__text").cast("long")).otherwise(F.col("n_chars")))
    return done.withColumns({"text": F.col("__text"), "n_chars": length}).select(*[F.col(f"`{c}`") for c in docs.columns])


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and the sequences they lie in."""
    return packing.pack(docs, default_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", benchmarks),
    ("packing", packed),
]

#: SQL can state neither the estimates of the first stage nor the packing of the last.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
