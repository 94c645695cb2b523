"""Shared pieces: tables, written intermediate results, Arrow blocks, hashed words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.session import ensure_checkpoint_dir

ship_with_tasks(__name__)

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a reread of the written rows, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII texts take the fast built-in ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, A_TO_Z, A_TO_Z.lower()))


def unit_interval(*cols: Column) -> Column:
    """A reproducible number in [0, 1) from 52 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double") / F.lit(float(2 ** 52))


def wrapped(docs: DataFrame, columns=None) -> Column:
    """The given (or all) columns as one struct ``row``, so that no helper column can clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]).alias("row")


def document_key(id_name: str = "doc_id") -> list[Column]:
    """A nullable id as two columns without null, so that joins and groupings by it share a partitioning."""
    return [F.coalesce(id_name, F.lit(0).cast("long")).alias("known_id"), F.col(id_name).isNull().alias("no_id")]


# ------------------------------------------------------------------ inside tasks

def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: a column of its own, or a field of ``row``."""
    names = batch.schema.names
    return batch.column("text") if "text" in names else pc.struct_field(batch.column("row"), "text")


BLOCK_BYTES = 2 << 20


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole rows of about ``limit`` bytes.

    Yields first row, row after the last, their UTF-8 bytes, and row offsets into those bytes. Null is
    an empty text. A longer row is a block of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def byte_class(*excluded: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for low, high in excluded:
        out[low:high + 1] = False
    return out


# Words between white space, and words of letters and digits (after lower-casing A-Z).
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    """Byte starts and ends of the words, and the index of the first word of each row (one more at the end)."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))[:-1]
    after = np.concatenate((inside, [False]))[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def constants(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers, the same in every task."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1) + np.uint64(seed)) | np.uint64(1)


def _lowered_codes() -> np.ndarray:
    byte = np.arange(256)
    byte[0x41:0x5B] += 0x20
    return constants(256, 77)[byte]


_CODES = _lowered_codes()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES // 2)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))))
                          for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words with A-Z lower-cased, by a rolling polynomial over chunks of whole words."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES // 2, "right")))
        base, n = int(starts[i]), int(ends[j - 1] - starts[i])
        power, inverse = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data[base:base + n]] * power[:n], out=sums[1:])
        at = starts[i:j] - base
        out[i:j] = mixed((sums[ends[i:j] - base] - sums[at]) * inverse[at] + (ends[i:j] - starts[i:j]).astype(np.uint64))
        i = j
    return out


def word_count(column: pa.Array) -> np.ndarray:
    """Words between white space, per row; null has none."""
    out = np.zeros(len(column), np.int64)
    for first, last, data, offsets in text_blocks(column):
        starts, _, bounds = word_spans(data, offsets, SPACED)
        out[first:last] = np.diff(bounds)
    return out
