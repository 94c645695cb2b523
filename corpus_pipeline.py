"""A training corpus in five stages. Each stage is written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import decontaminate, minhash, mixing, sharding, toxicity
from tidemark.llm.common import stage, table, wrapped


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the clause grammar does not reject; it is fitted on the labelled ones."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id. Near means a similarity of 0.8."""
    return minhash.keep_first(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    # Rows that repeat doc_id, source and text are interchangeable: the mix says how many of them come twice or once.
    # Each part is told apart from null and from the next one.
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in ("doc_id", "source", "text")]
    key = F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32)).alias("key")
    taken = mixing.mix(docs.select("doc_id", "source", "text", key), columns=("doc_id", "source", "key")).where("taken > 0")
    copies = (F.col("taken") / F.col("size")).cast("int")
    picks = stage(taken.groupBy("key").agg(
        F.count_if(copies == 2).alias("twice"), F.count(F.lit(1)).alias("at_all")), "picks")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    times = F.when(nth <= F.col("twice"), 2).when(nth <= F.col("at_all"), 1).otherwise(0)
    rows = docs.select(wrapped(docs), key).join(picks, "key").withColumn("times", times)
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return sharding.reshard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# The stages' models, sketches and fits have no SQL form; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
