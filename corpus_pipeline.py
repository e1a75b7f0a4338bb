"""From raw documents to token counts: the operators on training text, one after the other.

Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import decontaminate, language, line_dedup, near_dedup
from txflow.llm.common import fresh, quoted, stored, table
from txflow.llm.queries import ranks_file, token_rows

#: Least score of a language that counts as known.
LEAST_SCORE = 0.1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; those without letters or akin to none go."""
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    name = fresh(docs, "language")
    judged = docs.withColumn(name, language.predict(F.col("text").cast("string"), model))
    good = (F.col(f"{name}.lang") != language.UNDETERMINED) & (F.col(f"{name}.score") >= LEAST_SCORE)
    return judged.where(good).drop(name)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines taken out, and documents of which nothing is left; n_chars follows the text."""
    total, removed = fresh(docs, "lines"), fresh(docs, "removed")
    cut = line_dedup.line_dedup(docs, counts=(total, removed))
    cut = cut.where((F.col(removed) == 0) | (F.col(removed) < F.col(total)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[quoted(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.near_unique(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    name = fresh(docs, "found")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), name=name)
    return found.where(F.col(f"{name}.n_hit") == 0).drop(name)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of what they decode to."""
    return token_rows(docs, ranks_file())


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each),
    ("decontaminate", uncontaminated),
    ("byte_bpe", tokens),
]

#: Language profiles and signatures have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
