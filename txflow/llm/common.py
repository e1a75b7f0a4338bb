"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.session import scratch_dir

#: A run of white space, as the contracts of exact and substring dedup define it (fixed value).
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared scratch folder once and go on from the files.

    Later steps then neither repeat the plan behind it nor depend on the
    executors that computed it.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name that may hold dots or blanks, safe in F.col."""
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
