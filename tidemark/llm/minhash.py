"""Near-duplicate documents by min-max hashing.

Every permutation gives two signature values, its minimum and its maximum over a document's word
shingles, so 96 values cost 48 hash evaluations a shingle. Bands take four values each, either minima
or maxima of four permutations, so the values of a band are independent. A pair at the threshold
meets in at least one of the 24 bands but for a chance of 2e-8 at 0.85 (op3) and 3e-6 at 0.8 (the pipeline).

Texts with equal shingle sets are one class (key: 128 bits of the set). Only classes are banded,
compared and linked; documents get their class's component at the end, whatever the class's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import (SPACED, constants, document_key, mixed, stage, text_blocks, word_hashes, word_spans,
                                 wrapped)
from tidemark.llm.components import components

ship_with_tasks(__name__)

SHINGLE = 5
PERMUTATIONS = 48
ROWS = 4
# A document among documents: its id and its text.
DOCUMENT = ["known_id", "no_id", "text_hash"]
SMALL_BUCKET = 6
# Values of the longer signature, for classes of large buckets.
SKETCH_VALUES = 1_024
# Stragglers and members of a large bucket are compared in blocks of about this many.
BLOCK = 256
# The bands are set for this similarity in percent; below it they would lose links.
LEAST_PERCENT = 80


# ------------------------------------------------------------------ inside tasks

def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block of rows: the sorted distinct shingle hashes of all rows, and each row's bounds in them."""
    weights = constants(width, 5)
    for first, last, data, offsets in text_blocks(column):
        starts, ends, bounds = word_spans(data, offsets, SPACED)
        words = word_hashes(data, starts, ends)
        n = max(0, len(words) - width + 1)
        sums = np.zeros(n, np.uint64)
        for k in range(width):
            sums += words[k:k + n] * weights[k]
        sums = mixed(sums)
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= width:
                sets.append(np.unique(sums[a:b - width + 1]))
            elif b > a:
                sets.append(mixed((words[a:b] * weights[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, last, np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def set_keys(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128 bits for each set: two sums of independently mixed members. An empty set has none."""
    sums = []
    for members in (mixed(shingles * np.uint64(3)), mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(members, dtype=np.uint64)))
        sums.append(running[bounds[1:]] - running[bounds[:-1]])
    packed = np.stack(sums, axis=1).astype(">u8").tobytes()
    return [packed[16 * i:16 * i + 16] if n else None for i, n in enumerate(np.diff(bounds))]


def min_max(shingles: np.ndarray, bounds: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Signature values of the non-empty sets: first the minima of all permutations, then the maxima."""
    firsts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((2 * permutations, len(firsts)), np.uint64)
    if len(firsts):
        for p, (factor, shift) in enumerate(zip(constants(permutations, 11), constants(permutations, 13))):
            values = (shingles ^ shift) * factor
            out[p] = np.minimum.reduceat(values, firsts)
            out[permutations + p] = np.maximum.reduceat(values, firsts)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and set; the band's number is part of the key."""
    bands = len(signature) // rows
    grouped = signature[:bands * rows].reshape(bands, rows, -1)
    weights = constants(rows, 17)[None, :, None]
    number = np.arange(1, bands + 1, dtype=np.uint64)[:, None]
    return mixed((mixed(grouped) * weights).sum(axis=1, dtype=np.uint64) + number)


def signature_bits(signature: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of every value, packed into 64-bit words (three for 96 values)."""
    bits = np.concatenate([(mixed(signature ^ np.uint64(k)) >> np.uint64(40)) & np.uint64(1) for k in (1, 2)])
    words = len(bits) // 64
    packed = np.packbits(bits[:words * 64].astype(np.uint8).reshape(words, 64, -1), axis=1)
    return np.ascontiguousarray(packed.transpose(0, 2, 1)).view(">u8")[:, :, 0].astype(np.uint64)


SIGNED = "doc_id long, text_hash long, n_shingles long, key binary, bands array<long>, bits array<long>"


def _sign(batches):
    for batch in batches:
        for first, last, shingles, bounds in shingle_sets(batch.column("text")):
            signature = min_max(shingles, bounds)
            keys = band_keys(signature).T.astype(np.int64, order="C")
            bits = signature_bits(signature).T.astype(np.int64, order="C")
            sizes = np.diff(bounds)
            held = sizes > 0

            def lists(values):
                width = values.shape[1]
                at = np.concatenate(([0], np.cumsum(np.where(held, width, 0)))).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(at), pa.array(values.reshape(-1)))

            rows = slice(first, last)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[rows], batch.column("text_hash")[rows], pa.array(sizes),
                 pa.array(set_keys(shingles, bounds), pa.binary()), lists(keys), lists(bits)],
                names=["doc_id", "text_hash", "n_shingles", "key", "bands", "bits"])


def _sets(batches):
    for batch in batches:
        for first, last, shingles, bounds in shingle_sets(batch.column("text")):
            found, wanted = set_keys(shingles, bounds), batch.column("key")[first:last].to_pylist()
            sets = [shingles[a:b].tobytes() if x == y else None
                    for a, b, x, y in zip(bounds[:-1], bounds[1:], found, wanted)]
            out = pa.RecordBatch.from_arrays([pa.array(wanted, pa.binary()), pa.array(sets, pa.binary())],
                                             names=["key", "shingles"])
            yield out.filter(out.column(1).is_valid())


def _postings(batches):
    """Every shingle of every set, with the set's key."""
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            members = [np.frombuffer(packed.as_buffer(), np.int64) for packed in part.column("shingles")]
            owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(owner)), pa.array(np.concatenate(members))],
                                             names=["key", "shingle"])


def _sketch(batches):
    """Sizes, bands and long signatures of whole sets, two bits a value."""
    half = SKETCH_VALUES // 2
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            members = [np.frombuffer(packed.as_buffer(), np.uint64) for packed in part.column("shingles")]
            bounds = np.concatenate(([0], np.cumsum([len(m) for m in members])))
            values = min_max(np.concatenate(members), bounds, half)
            # The permutations of the short signature are the first of these.
            bands = band_keys(np.concatenate((values[:PERMUTATIONS], values[half:half + PERMUTATIONS])))

            def lists(words):
                words = words.T.astype(np.int64, order="C")
                at = pa.array(np.arange(len(members) + 1, dtype=np.int32) * words.shape[1])
                return pa.ListArray.from_arrays(at, pa.array(words.reshape(-1)))

            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("n"), part.column("common"), lists(bands), lists(signature_bits(values))],
                names=["key", "n", "common", "bands", "sketch"])


def _across(percent: int):
    """Plausible pairs of a block of stragglers with a block of members, for rows that are sorted by pair of blocks."""
    limit = most_different(percent)

    def compared(rows: pa.Table) -> pa.RecordBatch:
        left = rows.column("left").to_numpy(zero_copy_only=False)
        keys = np.array(rows.column("key").to_pylist(), object)
        _, roots = np.unique(np.array(rows.column("root").to_pylist(), object), return_inverse=True)
        _, order = np.unique(keys, return_inverse=True)
        n, common = rows.column("n").to_numpy(), rows.column("common").to_numpy()
        straggler = rows.column("straggler").to_numpy(zero_copy_only=False)
        bands, bits = (rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(keys), -1)
                       for c in ("bands", "sketch"))
        x, y = np.flatnonzero(left), np.flatnonzero(~left)
        most = np.minimum(common[x][:, None], common[y][None, :])
        wanted = 100 * most >= percent * (n[x][:, None] + n[y][None, :] - most)
        wanted &= roots[x][:, None] != roots[y][None, :]
        # Two stragglers meet twice.
        wanted &= ~straggler[y][None, :] | (order[x][:, None] < order[y][None, :])
        i, j = np.nonzero(wanted)
        i, j = x[i], y[j]
        near = np.concatenate([np.bitwise_count(bits[i[k:k + BLOCK * BLOCK]] ^ bits[j[k:k + BLOCK * BLOCK]]).sum(axis=1) <= limit
                               for k in range(0, len(i), BLOCK * BLOCK)] or [np.zeros(0, bool)])
        i, j = i[near], j[near]
        # Once a pair: in the first bucket that both are in. If that is a small one, they were compared there.
        same = bands[i] == bands[j]
        once = bands[i, same.argmax(axis=1)] == np.uint64(rows.column("bucket")[0].as_py() & (2 ** 64 - 1))
        i, j = i[once], j[once]
        swap = order[i] > order[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return pa.RecordBatch.from_arrays([pa.array(list(keys[i]), pa.binary()), pa.array(list(keys[j]), pa.binary())], names=["a", "b"])

    def run(batches):
        held, now = [], None
        for batch in batches:
            bucket, i, j = (batch.column(c).to_numpy() for c in ("bucket", "i", "j"))
            new = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for first, last in zip([0, *new], [*new, batch.num_rows]):
                if first == last:
                    continue
                group = (bucket[first], i[first], j[first])
                if group != now and held:
                    yield compared(pa.Table.from_batches(held))
                    held = []
                now = group
                held.append(batch.slice(first, last - first))
        if held:
            yield compared(pa.Table.from_batches(held))

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


# ------------------------------------------------------------------ plans

def signed(docs: DataFrame) -> DataFrame:
    """Per document: its set's size, class key, band keys and signature bits (null or empty without words)."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sign, SIGNED)


def _plausible(n_a: Column, n_b: Column, bits_a: Column, bits_b: Column, percent: int) -> Column:
    """Set sizes that allow the similarity, and signatures that do not exclude it."""
    different = sum((F.bit_count(bits_a[k].bitwiseXOR(bits_b[k])) for k in range(3)), F.lit(0))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (different <= most_different(percent, 2 * PERMUTATIONS))


def _pairs(small: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs (a < b) of classes that share a bucket."""
    x, y = small.alias("x"), small.alias("y")
    wanted = _plausible(F.col("x.n"), F.col("y.n"), F.col("x.bits"), F.col("y.bits"), percent)
    return x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & F.expr("x.key < y.key") & wanted).select(
        F.col("x.key").alias("a"), F.col("y.key").alias("b"))


def _star_pairs(large: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of each member of a large bucket with the bucket's most central class."""
    weights = members.groupBy("key").agg(F.sum("held").alias("weight"))
    pivots = stage(large.join(weights, "key").groupBy("bucket").agg(
        F.max(F.struct("weight", "key", "n", "bits")).alias("pivot")).select("bucket", "pivot"), "pivots")
    wanted = _plausible(F.col("n"), F.col("pivot.n"), F.col("bits"), F.col("pivot.bits"), percent)
    return large.join(pivots, "bucket").where(F.expr("key <> pivot.key") & wanted).select(
        F.least("key", "pivot.key").alias("a"), F.greatest("key", "pivot.key").alias("b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""
    first = sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b").mapInArrow(
        _linked(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked where ``100 * shared shingles >= percent * all shingles`` of their whole sets;
    ``component_id`` is the smallest doc_id reachable, itself included. Texts without words (null, empty,
    white space) are linked with nothing. Rows that repeat a text share its component. A null doc_id takes
    part, but its id is never a component's; where all are null, ``component_id`` is null and the rows
    are kept. Other columns are ignored. An empty table gives an empty result.

    Buckets of up to ``SMALL_BUCKET`` classes are compared within; in a larger one each class is compared
    with the one that stands in the most and largest buckets, the likely origin of its copies. What is then
    still in different components of a bucket is compared too, where a longer signature allows it (see
    :func:`_straggler_pairs`), so no link is lost to the bucket's size, and large groups of copies cost a
    comparison a member. ``percent`` is 80 at least: the bands are set for that, and would lose links below. Very long texts are
    read whole; a text's signature and set (8 bytes a shingle) must fit in a task.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be {LEAST_PERCENT} to 100")
    rows = stage(signed(docs), "signed")
    classes = stage(rows.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash",
                       F.col("n_shingles").alias("n"), "bands", "bits")).alias("one")).select("key", "one.*"), "classes")
    spread = classes.select("key", F.explode("bands").alias("bucket"))
    buckets = stage(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "buckets")
    members = stage(
        spread.join(buckets, "bucket").join(classes.select("key", "n", "bits"), "key"), "members")

    small = members.where(F.col("held") <= SMALL_BUCKET)
    large = members.where(F.col("held") > SMALL_BUCKET)
    pairs = stage(_pairs(small, percent).unionByName(_star_pairs(large, members, percent)).distinct(), "pairs")
    sets = stage(_needed_sets(docs, classes, members.select("key").distinct()), "sets")
    links = stage(_verified(pairs, sets, percent), "links")
    roots = components(links, "a", "b")

    more = _straggler_pairs(large, sets, roots, percent)
    more = stage(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    if not more.isEmpty():
        links = stage(links.unionByName(_verified(more, sets, percent)), "all-links")
        roots = components(links, "a", "b")

    rooted = stage(classes.select("key", "doc_id").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc_id", F.coalesce("root", "key").alias("root")), "rooted")
    ids = stage(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ids")
    named = stage(rooted.join(ids, "root").select("key", "component_id", "root"), "named")
    found = rows.select("doc_id", "n_shingles", "key", "text_hash").join(named, "key", "left")
    return found.select(
        "doc_id", "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "root", "text_hash").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _needed_sets(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """Whole shingle sets of one document of each class that shares a bucket."""
    chosen = classes.join(keys, "key", "left_semi").select(
        *document_key(), "text_hash", "key")
    texts = docs.select(*document_key(), "text", F.xxhash64("text").alias("text_hash"))
    return texts.join(chosen, DOCUMENT).dropDuplicates(DOCUMENT).select("text", "key").mapInArrow(_sets, "key binary, shingles binary")


def _straggler_pairs(large: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs across the components of a large bucket, as far as set sizes and long signatures allow the similarity.

    Classes outside a bucket's largest component (stragglers) are paired with all its members. First those classes go
    that can have no partner: a set shares at most the shingles that also stand in another such class (``common``), so texts
    with a common passage and much of their own are never paired. The rest is compared by blocks of stragglers and blocks
    of members, a pair of blocks at a time, by the same bound and by signatures of 1,024 values (two bits each).
    """
    labelled = stage(large.select("bucket", "key").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "bucket", "key", F.coalesce("root", "key").alias("root")), "labelled")
    counts = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("held"))
    parted = counts.groupBy("bucket").agg(
        F.max(F.struct("held", "root")).alias("top"), F.sum("held").alias("members"), F.count(F.lit(1)).alias("parts")).where(
        "parts > 1").select("bucket", F.col("top.root").alias("main"), "members", (F.col("members") - F.col("top.held")).alias("stragglers"))
    open_ = stage(labelled.join(parted, "bucket").withColumn("straggler", F.expr("root <> main")), "open")

    own = sets.join(open_.select("key").distinct(), "key", "left_semi")
    alone = own.mapInArrow(_postings, "key binary, shingle long").groupBy("shingle").agg(
        F.count(F.lit(1)).alias("held"), F.min("key").alias("key")).where("held = 1").groupBy("key").agg(
        F.count(F.lit(1)).alias("alone"))
    n = (F.octet_length("shingles") / 8).cast("long")
    shared = own.join(alone, "key", "left").select("key", "shingles", n.alias("n"), (n - F.coalesce("alone", F.lit(0))).alias(
        "common")).where("100 * common >= {} * n".format(percent))
    known = stage(shared.mapInArrow(_sketch, "key binary, n long, common long, bands array<long>, sketch array<long>"), "crowded")

    rows = open_.join(known, "key")
    blocks = {side: F.ceil(F.col(held) / BLOCK).cast("int") for side, held in (("i", "stragglers"), ("j", "members"))}
    place = {side: F.pmod(F.xxhash64("key", F.lit(side)), n).cast("int") for side, n in blocks.items()}

    def dealt(frame: DataFrame, own_side: str, other: str, left: bool) -> DataFrame:
        return frame.select("bucket", place[own_side].alias(own_side),
                            F.explode(F.sequence(F.lit(0), blocks[other] - 1)).alias(other), F.lit(left).alias("left"),
                            "key", "n", "common", "root", "straggler", "bands", "sketch")

    both = dealt(rows.where("straggler"), "i", "j", True).unionByName(dealt(rows, "j", "i", False))
    group = ["bucket", "i", "j"]
    return both.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        _across(percent), "a binary, b binary")


def most_different(percent: int, values: int = SKETCH_VALUES) -> int:
    """Different bits of two signatures of so many values (two bits each) at the threshold, and six deviations more."""
    miss = 1 - percent / 100
    return int(values * miss + 6 * math.sqrt(values * (1.5 * miss - miss * miss))) + 1


def keep_first(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each component, all documents without words, with all their columns.

    Of rows that repeat doc_id and text one stays. A component without any doc_id keeps one row.
    """
    found = near_duplicates(docs, percent).where("kept").select(*document_key(), "text_hash", "root", "n_shingles")
    texts = found.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(*DOCUMENT)).alias("one")).select("one.*")
    chosen = stage(texts.unionByName(found.where("n_shingles = 0").select(*DOCUMENT).distinct()), "chosen")
    rows = docs.select(wrapped(docs), *document_key(), F.xxhash64("text").alias("text_hash"))
    return rows.join(chosen, DOCUMENT, "left_semi").dropDuplicates(DOCUMENT).select("row.*")
