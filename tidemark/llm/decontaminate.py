"""Benchmark decontamination with training suffix arrays.

Each block of training documents is a shard with its own suffix array over words: the positions
sorted by the words that follow. Every suffix of every benchmark item is looked up by binary search
in every shard, which gives the places of its verbatim matches and, by extending them, the longest
ones. Documents never move: the shards are built and searched where their rows are read.

Only positions followed by enough consecutive benchmark word pairs enter a suffix array; no other
position can begin a match, so this changes no result.

The benchmark is cut into parts of at most ``PART_BYTES`` of text. A part is read to the driver and
sent to the tasks; more parts are more passes over the same rows within the same stage, so the size
of the benchmark is not limited.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import ALPHANUMERIC, text_blocks, text_of, word_hashes, word_spans, wrapped

ship_with_tasks(__name__)

WINDOW = 10
PART_BYTES = 4 << 20


class Items:
    """The words and windows of a part of the benchmark, ready for the search."""

    def __init__(self, ids: list[str | None], texts: list[str], width: int = WINDOW):
        words, firsts = [np.zeros(0, np.uint64)], [0]
        for _, _, data, offsets in text_blocks(pa.array(texts, pa.string())):
            starts, ends, bounds = word_spans(data, offsets, ALPHANUMERIC)
            words.append(word_hashes(data, starts, ends))
            firsts += (firsts[-1] + bounds[1:]).tolist()
        words, firsts = np.concatenate(words), np.array(firsts)
        self.width = width
        self.ids = ids
        self.vocabulary = np.unique(words)
        # Code 0 is any word outside the benchmark.
        self.codes = (np.searchsorted(self.vocabulary, words) + 1).astype(np.uint32)
        self.item = np.repeat(np.arange(len(ids)), np.diff(firsts))
        item_end = np.repeat(firsts[1:], np.diff(firsts))
        self.item_start = np.repeat(firsts[:-1], np.diff(firsts))
        same = self.item[1:] == self.item[:-1]
        self.pairs = np.unique(self.pair(self.codes[:-1][same], self.codes[1:][same]))
        # Windows: every suffix of at least ``width`` words, and whole shorter items.
        at = np.arange(len(words))
        self.left = item_end - at
        starts = np.flatnonzero((self.left >= width) | (at == self.item_start))
        self.starts = starts
        self.lengths = np.minimum(self.left[starts], width)
        self.least = int(self.lengths.min()) if len(starts) else 0
        padded = np.concatenate((self.codes, np.zeros(width, np.uint32)))
        keys = padded[starts[:, None] + np.arange(width)]
        keys[np.arange(width) >= self.lengths[:, None]] = 0
        last = keys.copy()
        last[np.arange(len(starts)), self.lengths - 1] += 1
        self.from_key, self.to_key = as_bytes(keys), as_bytes(last)

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.astype(np.uint64) * np.uint64(len(self.vocabulary) + 1) + second.astype(np.uint64)


def as_bytes(codes: np.ndarray) -> np.ndarray:
    """Rows of codes as byte strings that sort like the rows."""
    codes = np.ascontiguousarray(codes, dtype=">u4")
    return codes.reshape(-1).view(f"S{4 * codes.shape[1]}") if len(codes) else np.zeros(0, f"S{4 * codes.shape[1]}")


def _member(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in a sorted array, and whether the value is there."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return at, sorted_values[at] == values


class Shard:
    """The suffix array of a block of documents, as far as the benchmark's words reach."""

    def __init__(self, items: Items, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.bounds = word_spans(data, offsets, ALPHANUMERIC)
        hashes = word_hashes(data, starts, ends)
        n, width = len(hashes), items.width
        # A small table of hash prefixes leaves few words for the binary search.
        low = np.zeros(1 << 16, bool)
        low[(items.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        likely = np.flatnonzero(low[(hashes >> np.uint64(48)).astype(np.int64)])
        at, known = _member(items.vocabulary, hashes[likely])
        self.codes = np.zeros(n + width, np.uint32)
        self.codes[likely[known]] = at[known] + 1
        self.ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        joined = np.zeros(n, bool)
        both = np.flatnonzero((self.codes[:n] > 0) & (self.codes[1:n + 1] > 0) & (np.arange(1, n + 1) < self.ends))
        joined[both] = _member(items.pairs, items.pair(self.codes[both], self.codes[both + 1]))[1]
        # Words from here on that follow each other in the benchmark too.
        breaks = np.flatnonzero(~joined)
        run = (breaks[np.searchsorted(breaks, np.arange(n))] - np.arange(n) + 1) if n else np.zeros(0, np.int64)
        places = np.flatnonzero((self.codes[:n] > 0) & (run >= items.least))
        window = np.arange(width)
        keys = self.codes[places[:, None] + window]
        keys[window >= np.minimum(run[places], width)[:, None]] = 0
        keys = as_bytes(keys)
        order = np.argsort(keys, kind="stable")
        self.keys, self.suffixes = keys[order], places[order]

    def search(self, items: Items) -> tuple[np.ndarray, np.ndarray]:
        """All matches of windows: the window's number and the word position in the shard."""
        low = np.searchsorted(self.keys, items.from_key, "left")
        high = np.searchsorted(self.keys, items.to_key, "left")
        counts = high - low
        window = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
        return window, self.suffixes[np.repeat(low, counts) + within]


def _scan(parts, number, keep_text):
    """Pass ``number`` over the rows: adds this part's hit words and items to each document."""
    def run(batches):
        items = Items(*parts.value[number])
        for batch in batches:
            texts = text_of(batch)
            for first, last, data, offsets in text_blocks(texts):
                shard = Shard(items, data, offsets)
                window, place = shard.search(items)
                bounds = shard.bounds
                length = items.lengths[window]
                edges = np.zeros(bounds[-1] + 1, np.int64)
                np.add.at(edges, place, 1)
                np.add.at(edges, place + length, -1)
                hit = np.cumsum(edges[:-1]) > 0
                doc = np.searchsorted(bounds, place, "right") - 1
                item = items.item[items.starts[window]]
                found = np.unique(np.stack((doc, item)), axis=1)
                bits, names = [], []
                carried_bits = batch.column("hits")[first:last].to_pylist()
                carried_names = batch.column("items")[first:last].to_pylist()
                of = np.searchsorted(found[0], np.arange(len(bounds)))
                for i in range(last - first):
                    own = hit[bounds[i]:bounds[i + 1]]
                    if carried_bits[i]:
                        own = own | np.unpackbits(np.frombuffer(carried_bits[i], np.uint8), count=len(own)).astype(bool)
                    bits.append(np.packbits(own).tobytes() if own.any() else None)
                    new = {items.ids[k] for k in found[1, of[i]:of[i + 1]]} - {None}
                    names.append(sorted(new | set(carried_names[i] or ())))
                    carried_bits[i] = int(own.sum())
                rows = slice(first, last)
                out = [batch.column("row")[rows], *([texts[rows]] if keep_text else []),
                       pa.array(bits, pa.binary()), pa.array(names, pa.list_(pa.string())),
                       pa.array(np.diff(bounds)), pa.array(carried_bits, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    out, names=["row", *(["text"] if keep_text else []), "hits", "items", "n_words", "n_hit"])
    return run


def benchmark_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> list[tuple[list, list]]:
    """The items with words, in parts of about ``part_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // part_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    parts = []
    for k in range(n):
        rows = items.where(part == k).orderBy("id", "text").collect()
        parts.append(([r.id for r in rows], [r.text for r in rows]))
    return parts


def contamination(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ten consecutive words of an item; an item of fewer words, but not none, is one window.
    A word inside any occurrence of a window is hit. Null and empty texts have no words. Repeated items
    count once by item_id; items without item_id hit words but are no named item. Other columns are
    ignored. An empty table gives an empty result; with an empty benchmark nothing is hit. A block holds
    whole texts: a task needs about 30 times the bytes of its longest text, or of 2 MB of shorter ones.
    """
    rows = _hit(docs, benchmark, ("doc_id",), part_bytes)
    return rows.select(
        "row.*", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _hit(docs: DataFrame, benchmark: DataFrame, columns: Sequence[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """row (the given columns), items, n_words, n_hit of every document, after a pass for each part of the benchmark."""
    parts = docs.sparkSession.sparkContext.broadcast(benchmark_parts(benchmark, part_bytes))
    inside = "text" in columns
    rows = docs.select(wrapped(docs, columns), *([] if inside else ["text"]), F.lit(None).cast("binary").alias("hits"),
                       F.lit(None).cast("array<string>").alias("items"))
    row_type = rows.schema["row"].dataType.simpleString()
    for k in range(len(parts.value)):
        keep_text = not inside and k + 1 < len(parts.value)
        rows = rows.mapInArrow(_scan(parts, k, keep_text), f"row {row_type}, {'text string, ' if keep_text else ''}"
                               "hits binary, items array<string>, n_words long, n_hit long")
    return rows


def _longest(parts, number):
    def run(batches):
        items = Items(*parts.value[number])
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column("text")):
                shard = Shard(items, data, offsets)
                window, place = shard.search(items)
                begin, reach = items.starts[window], items.lengths[window].copy()
                # Maximal matches only: the word before differs, or there is none.
                fresh = (begin == items.item_start[begin]) | (place == np.repeat(shard.bounds[:-1], np.diff(shard.bounds))[place]) \
                    | (shard.codes[place - 1] != items.codes[begin - 1])
                begin, reach, place = begin[fresh], reach[fresh], place[fresh]
                most = np.minimum(items.left[begin], shard.ends[place] - place)
                open_ = np.flatnonzero(reach < most)
                while len(open_):
                    same = shard.codes[place[open_] + reach[open_]] == items.codes[begin[open_] + reach[open_]]
                    open_ = open_[same]
                    reach[open_] += 1
                    open_ = open_[reach[open_] < most[open_]]
                doc = np.searchsorted(shard.bounds, place, "right") - 1
                ids = pa.array(items.ids, pa.string()).take(pa.array(items.item[begin]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(first + doc)), ids, pa.array(begin - items.item_start[begin]),
                     pa.array(place - shard.bounds[doc]), pa.array(reach)],
                    names=["doc_id", "item_id", "item_word", "doc_word", "n_words"])
    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Maximal verbatim matches of at least a window: doc_id, item_id, first words (from 0) and length in words."""
    parts = docs.sparkSession.sparkContext.broadcast(benchmark_parts(benchmark, part_bytes))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = [rows.mapInArrow(_longest(parts, k), "doc_id long, item_id string, item_word long, doc_word long, n_words long")
             for k in range(len(parts.value))]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns."""
    return _hit(docs, benchmark, docs.columns).where("n_hit = 0").select("row.*")
