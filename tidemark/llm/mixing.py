"""Mixing sources to target weights by fitting each source's budget exactly.

A source's documents are counted by length. Whole copies of the source are taken first; of the rest
an even share of every length class; what then remains of the budget is small and is filled by a
bounded knapsack over the counts that are left. Documents of a class are selected in seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import stage, text_of, unit_interval, word_count, wrapped

ship_with_tasks(__name__)

WEIGHTS = (3, 1, 2)
SLICE_ROWS = 50_000


# ------------------------------------------------------------------ inside tasks

def fit_budget(budget: int, classes: list[tuple[int, int]]) -> dict[int, int]:
    """How many documents of each length to take so that the lengths' sum comes closest to ``budget``
    from below; ``classes`` has (length, documents). Lengths of 0 are never taken.

    An even share of each class first (less one document, so that every length is left to fill with), then whole documents from the longest down while more than four times
    the longest length is open, then a bounded knapsack: reachable sums as the bits of one number, counts
    split into powers of two.
    """
    classes = [(length, n) for length, n in sorted(classes, reverse=True) if length > 0]
    whole = sum(length * n for length, n in classes)
    if budget >= whole:
        return dict(classes)
    taken = {length: max(0, n * budget // whole - 1) for length, n in classes}
    left = budget - sum(length * n for length, n in taken.items())
    room = 4 * classes[0][0] if classes else 0
    for length, n in classes:
        more = min(n - taken[length], max(0, left - room) // length)
        taken[length] += more
        left -= more * length
    steps, sums, mask = [], 1, (1 << (left + 1)) - 1
    for length, n in classes:
        rest, size = min(n - taken[length], left // length), 1
        while rest > 0:
            size = min(size, rest)
            steps.append((length, size, sums))
            sums = (sums | sums << (length * size)) & mask
            rest -= size
            size *= 2
        if sums >> left & 1:
            break
    at = sums.bit_length() - 1
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += size
            at -= length * size
    return taken


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(word_count(text_of(batch)))],
                                         names=["row", "size"])


def _fit(key, frame):
    """The class counts of one source to the number of documents taken of each length beyond whole copies."""
    classes = list(zip(frame["size"].tolist(), frame["n"].tolist()))
    whole = sum(length * n for length, n in classes)
    budget = int(round(frame["target"].iloc[0]))
    copies = min(budget // whole, 2) if whole else 0
    more = fit_budget(budget - copies * whole, classes) if copies < 2 else {}
    frame["copies"] = copies
    frame["more"] = [more.get(length, 0) for length, _ in classes]
    return frame[["source_key", "size", "copies", "more"]]


# ------------------------------------------------------------------ plans

def sized(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source")) -> DataFrame:
    """The given columns as ``row``, and the number of words between white space (null: 0)."""
    rows = docs.select(wrapped(docs, columns), *([] if "text" in columns else ["text"]))
    return rows.mapInArrow(_sizes, f"row {rows.schema['row'].dataType.simpleString()}, size long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> target: ``share`` of all words split by weight, no source above ``most`` times its size.

    Weights go round in the sources' order (code points, null last). The table has one row per source; its order
    and the sharing out are windows over it. The excess of sources at their limit goes to the others by weight
    until none is above: sources reach their limit in the order of limit over weight, so the level that all
    others share is found by running sums along that order.
    """
    ordered = sources.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rated = ordered.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(most))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stepped = rated.withColumns({
        "all": F.sum("source_size").over(everything) * F.lit(share),
        "full": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    # The level if exactly the sources before this one are at their limit; the first that stays below decides.
    level = (F.col("all") - F.col("full")) / F.col("open")
    below = F.col("limit") >= F.col("weight") * level
    first = F.min(F.when(below, F.struct(
        (F.col("limit") / F.col("weight")).alias("ratio"), "place", level.alias("level")))).over(everything)
    return stepped.withColumn("found", first["level"]).select(
        "source", "source_size", F.least("limit", F.col("weight") * F.col("found")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 20_240,
        columns: Sequence[str] = ("doc_id", "source")) -> DataFrame:
    """One row per row of ``docs``: its columns, size, source_size, target, taken.

    ``taken`` is 0, 1 or 2 times the size: the words the mix takes of the document, repeats counted. Each source's
    taken words are the sum closest to its target from below that the last step finds. Null is a source of its own,
    the last one. Null and empty texts have size 0 and are not taken. The same rows give the same result; rows that
    repeat a doc_id, source and size are interchangeable. Columns named like the added ones are replaced.
    A class of more than ``SLICE_ROWS`` documents is ranked in slices of about that many, so one large
    class never meets in one task. An empty table gives an empty result.
    """
    rows = stage(sized(docs, columns).select("row", F.col("row.source").alias("source"), "size",
                                             unit_interval(F.lit(seed), F.col("row.doc_id")).alias("draw")), "sized")
    # Null becomes a key of its own; another source keeps its text behind a mark.
    source_key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = rows.withColumn("source_key", source_key)
    counts = stage(rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    by_source = counts.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = stage(targets(by_source.withColumn("source", F.when(F.col("source_key") != "n", F.expr("substring(source_key, 2)"))),
                         weights, share, most).withColumn("source_key", source_key).drop("source"), "targets")
    fitted = counts.join(goal, "source_key").groupBy("source_key").applyInPandas(
        _fit, "source_key string, size long, copies long, more long")
    classes = stage(fitted.join(counts, ["source_key", "size"]).join(goal, "source_key"), "fitted")

    sliced = rows.select("row", "source_key", "size", "draw").join(classes, ["source_key", "size"]).withColumn(
        "slice", F.floor(F.col("draw") * F.ceil(F.col("n") / F.lit(SLICE_ROWS))))
    sliced = stage(sliced, "sliced")
    held = sliced.where(F.col("n") > SLICE_ROWS).groupBy("source_key", "size", "slice").agg(F.count(F.lit(1)).alias("held"))
    ahead = held.withColumn("ahead", F.coalesce(F.sum("held").over(
        Window.partitionBy("source_key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("held")
    rank = F.row_number().over(Window.partitionBy("source_key", "size", "slice").orderBy("draw", "row.doc_id"))
    ranked = sliced.withColumn("rank", rank).join(ahead, ["source_key", "size", "slice"], "left").withColumn(
        "rank", F.col("rank") + F.coalesce("ahead", F.lit(0)))
    taken = F.col("size") * (F.col("copies") + (F.col("rank") <= F.col("more")).cast("long"))
    own = [c for c in columns if c not in ("size", "source_size", "target", "taken")]
    return ranked.select(*[F.col("row").getField(c).alias(c) for c in own], "size", "source_size", "target",
                         taken.alias("taken"))
