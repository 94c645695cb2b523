"""Exact dedup with a heavy-hitter split. DataFrame and SQL functions only.

Frequent digests come from a Misra-Gries type sketch (``approx_top_k``: bounded counters per task,
merged over tasks). Their exact sizes and winners are verified by a map-side combined aggregation
and broadcast, so the rows of large groups never meet in one task. All other digests go through an
ordinary shuffle, where the sketch's guarantee keeps every group below ``rows / counters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import document_key, lower_ascii, stage, wrapped

TOP = 1_000
COUNTERS = 4_096
HEAVY_ROWS = 64


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the text with A-Z lower-cased; a null text counts as empty."""
    return docs.select("doc_id", F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)).alias("digest"))


def heavy_winners(rows: DataFrame, top: int = TOP, counters: int = COUNTERS, least: int = HEAVY_ROWS) -> DataFrame:
    """At most ``top`` digests that the sketch calls frequent, with their verified winner and size.

    Sketches of the tasks (64-bit keys, at most ``counters`` of them each) are merged in two levels. Both levels have a
    key, so tasks without rows add no empty sketch (which ``approx_top_k_combine`` cannot merge).
    """
    keyed = rows.withColumn("key", F.xxhash64("digest"))
    found = keyed.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(key, {counters})").alias("state")).groupBy((F.col("part") * 0).alias("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(state, {counters}), {top})").alias("top")).select(
        F.explode("top").alias("t")).where(F.col("t.count") >= least).select(F.col("t.item").alias("key"))
    return keyed.join(F.broadcast(found), "key").groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_dedup(docs: DataFrame, top: int = TOP, counters: int = COUNTERS, least: int = HEAVY_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest doc_id stays. A row without doc_id stays only where its whole group has
    none (keep_id is then null). Rows that repeat the winning doc_id and text are all marked ``kept``;
    :func:`keep_one` leaves one of them. Null and empty texts form one group. Other columns are ignored.
    An empty table gives an empty result.
    """
    rows = stage(digests(docs), "digests")
    heavy = stage(heavy_winners(rows, top, counters, least), "heavy")
    # At most ``top`` rows of about 60 bytes.
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    large = marked.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    small = rows.join(F.broadcast(heavy), "digest", "left_anti").select(
        "digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"))
    return large.select(small.columns).unionByName(small).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents whose row stays, once each, with all their columns."""
    document = ["known_id", "no_id", "text_sha256"]
    kept = exact_dedup(docs).where("kept").select(*document_key(), "text_sha256").distinct()
    sha = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    rows = docs.select(wrapped(docs), *document_key(), sha.alias("text_sha256"))
    return rows.join(kept, document, "left_semi").dropDuplicates(document).select("row.*")
