"""Resharding by minimum-cost flow.

Old shards are sources of their bytes, new shards sinks of their capacity, and a byte that stays in
its shard costs nothing. The cheapest flow says how many bytes go from which old shard to which new
one. Documents then follow it by their byte position in their old shard: running sums inside blocks
of bounded size plus the offsets of the blocks, so no shard is ever ordered as a whole. The few
documents that lie across a cut (at most one a cut) go where most room is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stage, wrapped

SHARDS = 40
OLD_SHARDS = 32
BLOCK_ROWS = 50_000
OVERHEAD = 16


def cheapest_flow(old: list[int], new: list[int], cost: Callable[[int, int], int] = lambda i, j: int(i != j)
                  ) -> dict[tuple[int, int], int]:
    """The flow of least cost from ``old`` amounts to ``new`` capacities (their sum is at least the old sum).

    Successive shortest paths with potentials over the bipartite graph of shards.
    """
    n, m = len(old), len(new)
    source, sink = n + m, n + m + 1
    room: dict[tuple[int, int], int] = {}
    price: dict[tuple[int, int], int] = {}
    near: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(u, v, capacity, at):
        room[u, v], room[v, u], price[u, v], price[v, u] = capacity, 0, at, -at
        near[u].append(v)
        near[v].append(u)

    total = sum(old)
    for i, amount in enumerate(old):
        edge(source, i, amount, 0)
        for j in range(m):
            edge(i, n + j, total, cost(i, j))
    for j, capacity in enumerate(new):
        edge(n + j, sink, capacity, 0)
    potential, left = [0] * (n + m + 2), total
    while left > 0:
        best, came, queue = {source: 0}, {}, [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > best[u]:
                continue
            for v in near[u]:
                if room[u, v] > 0:
                    to = d + price[u, v] + potential[u] - potential[v]
                    if v not in best or to < best[v]:
                        best[v], came[v] = to, u
                        heapq.heappush(queue, (to, v))
        if sink not in best:
            raise ValueError("the new shards cannot hold the old ones")
        for v in range(n + m + 2):
            potential[v] += best.get(v, best[sink])
        path, v = [], sink
        while v != source:
            path.append((came[v], v))
            v = came[v]
        amount = min(left, *(room[e] for e in path))
        for u, v in path:
            room[u, v] -= amount
            room[v, u] += amount
        left -= amount
    return {(i, j): room[n + j, i] for i in range(n) for j in range(m) if room[n + j, i] > 0}


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def old_layout(shards: int = OLD_SHARDS) -> Column:
    """The layout before: documents dealt by a hash of doc_id (of the content where that is null)."""
    return F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id")),
                  F.lit(shards)).cast("int")


def reshard(docs: DataFrame, shards: int = SHARDS, old: Column | None = None, old_shards: int = OLD_SHARDS,
            columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: its columns, size, text_crc32, law, old_shard, shard, slot, grown_shard.

    Law ``bytes``: all shards hold nearly equal sums of sizes (UTF-8 bytes plus 16), and as many bytes as possible
    stay in the shard they were in. Null and empty texts have size 16. ``old`` gives the present shard, from 0 to
    ``old_shards`` - 1; without it documents lie by a hash of doc_id. Slots number the rows of a shard from 0 without
    gaps, larger documents first. Rows that repeat doc_id and text are interchangeable. Columns named like the added
    ones are replaced. An empty table gives an empty result.

    The driver sees one number for each old and each new shard and one row for each cut.
    """
    text = F.coalesce("text", F.lit(""))
    own = [c for c in columns if c not in ("size", "text_crc32", "law", "old_shard", "shard", "slot", "grown_shard")]
    rows = docs.select(wrapped(docs, own), "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), *([old.cast("int").alias("old_shard")] if old is not None else []))
    if old is None:
        rows = rows.withColumn("old_shard", old_layout(old_shards))
    # Larger size classes first, so that cuts fall among small documents. Rows without doc_id are told apart by place.
    rows = stage(rows.withColumns({
        "class": F.floor(-F.log2("size")).cast("int"),
        "tie": F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.col("doc_id"))}), "rows")
    # At most 64 classes a shard.
    parts = rows.groupBy("old_shard", "class").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).alias("parts"))
    block = ["old_shard", "class", "part"]
    dealt = rows.join(F.broadcast(parts), ["old_shard", "class"]).withColumn(
        "part", F.pmod(F.xxhash64("tie", "size"), F.col("parts"))).drop("parts")
    within = Window.partitionBy(*block).orderBy(F.desc("size"), F.xxhash64("tie"), "tie", "text_crc32").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = stage(dealt.withColumn("upto", F.sum("size").over(within)), "summed")
    blocks = summed.groupBy(*block).agg(F.sum("size").alias("bytes"))
    offsets = blocks.withColumn("begin", F.sum("bytes").over(Window.partitionBy("old_shard").orderBy("class", "part"))
                                - F.col("bytes")).drop("bytes")
    placed = stage(summed.join(offsets, block).withColumn("start", F.col("begin") + F.col("upto") - F.col("size")).drop(
        "begin", "upto"), "positions")

    held = {r.old_shard: r.bytes for r in placed.groupBy("old_shard").agg(F.sum("size").alias("bytes")).collect()}
    amounts = [held.get(i, 0) for i in range(old_shards)]
    capacities = even_capacities(sum(amounts), shards)
    ranges, at = [], [0] * old_shards
    for (i, j), amount in sorted(cheapest_flow(amounts, capacities).items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        ranges.append((i, at[i], at[i] + amount, j))
        at[i] += amount
    spark = docs.sparkSession
    cuts = spark.createDataFrame(ranges, "range_shard int, low long, high long, shard int")
    # One row for each positive flow, fewer than old plus new shards.
    flowing = placed.join(F.broadcast(cuts), (F.col("old_shard") == F.col("range_shard")) & (F.col("start") >= F.col("low"))
                          & (F.col("start") < F.col("high")))
    across = F.col("start") + F.col("size") > F.col("high")
    flowing = stage(flowing.withColumn("shard", F.when(~across, F.col("shard"))).drop("range_shard", "low", "high"), "flowing")
    filled = {r.shard: r.bytes for r in flowing.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    open_ = [(filled.get(j, 0) - capacities[j], j) for j in range(shards)]
    heapq.heapify(open_)
    settled = []
    # At most one document a cut.
    for r in flowing.where("shard is null").select("old_shard", "start", "size").orderBy(
            F.desc("size"), "old_shard", "start").collect():
        over, j = heapq.heappop(open_)
        heapq.heappush(open_, (over + r["size"], j))
        settled.append((r.old_shard, r.start, j))
    chosen = spark.createDataFrame(settled, "old_shard int, start long, chosen int")
    dealt = stage(flowing.join(F.broadcast(chosen), ["old_shard", "start"], "left").withColumn(
        "shard", F.coalesce("shard", "chosen")).drop("chosen"), "dealt")

    place = ["shard", *block]
    before = dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("class", "old_shard", "part")) - F.col("n")).drop("n")
    slot = F.row_number().over(Window.partitionBy(*place).orderBy("start")) - 1 + F.col("before")
    return dealt.join(before, place).select(
        "row.*", "size", "text_crc32", F.lit("bytes").alias("law"), "old_shard", "shard", slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def rewrite(docs: DataFrame, plan: DataFrame, folder: str) -> None:
    """Write the shards that gain or lose rows, each as a folder ``shard=N`` of ``folder`` ordered by slot.

    ``plan`` is the result of :func:`reshard` over the same rows (doc_id, text_crc32, shard, slot are used). Shards whose
    rows all stay, and which get none, keep their files. Folders of shards that lose all their rows are removed in the end.
    """
    moved = plan.where("shard <> old_shard")
    touched = moved.select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    copy = F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("shard", "slot"))
    rows = plan.select("doc_id", "text_crc32", "shard", "slot", copy.alias("_copy")).join(F.broadcast(touched), "shard", "left_semi")
    crc = F.crc32(F.coalesce("text", F.lit("")))
    own = docs.select(wrapped(docs, [c for c in docs.columns if c not in ("shard", "slot")]), "doc_id", crc.alias("crc")).withColumn(
        "copy", F.row_number().over(Window.partitionBy("doc_id", "crc").orderBy("doc_id")))
    wanted = rows.withColumnRenamed("doc_id", "id")
    own.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("crc") == F.col("text_crc32"))
             & (F.col("copy") == F.col("_copy"))).select("row.*", "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions(
        "shard", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(folder)
    # The overwrite replaces only the folders that get rows.
    left = {r.shard for r in plan.select("shard").distinct().collect()}
    gone = [r.shard for r in touched.collect() if r.shard not in left]
    path = docs.sparkSession._jvm.org.apache.hadoop.fs.Path
    for shard in gone:
        at = path(folder, f"shard={shard}")
        at.getFileSystem(docs.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
