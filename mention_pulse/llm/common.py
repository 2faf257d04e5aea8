"""What the operators share: words as 64-bit fingerprints, slices of batches, the shared folder.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A text of null counts as
empty. Fingerprints are polynomial hashes of the bytes, computed for a whole slice at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mention_pulse.operators.skew import copy_to_slices, hot_keys, slice_rows

SLICE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LETTERS = LOWER.astype(np.uint64) + np.uint64(1)
_EXACT = np.arange(1, 257, dtype=np.uint64)
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# ASCII letters and digits, and every byte of other scripts, belong to a plain word
NOT_PLAIN = np.ones(256, dtype=bool)
NOT_PLAIN[128:] = False
for _first, _last in ((48, 57), (65, 90), (97, 122)):
    NOT_PLAIN[_first : _last + 1] = False


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of each batch with about `size` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch[text]), 0), dtype=np.int64))
        at = done = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another, and where each begins (with the end of the last)."""
    whole = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = whole.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if data is None or not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(whole) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.ones(1 << bits, dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread fingerprints over all 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_bounds(data: np.ndarray, starts: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; no word goes over the border of two texts."""
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = starts[:-1][(starts[:-1] < len(data))]
    first[borders] = inside[borders]
    borders = borders[borders > 0] - 1
    last[borders] = inside[borders]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def fingerprints(data: np.ndarray, begin: np.ndarray, end: np.ndarray, letters: np.ndarray = _LETTERS) -> np.ndarray:
    """64-bit fingerprint of each data[begin:end], A-Z lower-cased."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    if len(data) > 4 * SLICE_BYTES:  # one very long text: piece by piece
        out = np.empty(len(begin), np.uint64)
        at = 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + 2 * SLICE_BYTES)))
            a, b = int(begin[at]), int(end[to - 1])
            part = fingerprints if b - a <= 4 * SLICE_BYTES else _fingerprints
            out[at:to] = part(data[a:b], begin[at:to] - a, end[at:to] - a, letters)
            at = to
        return out
    return _fingerprints(data, begin, end, letters)


def exact_fingerprints(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each data[begin:end], byte by byte as it is."""
    return fingerprints(data, begin, end, _EXACT)


def _fingerprints(data: np.ndarray, begin: np.ndarray, end: np.ndarray, letters: np.ndarray) -> np.ndarray:
    bits = max(20, int(len(data)).bit_length())
    summed = np.zeros(len(data) + 1, np.uint64)
    weighted = letters[data]
    weighted *= _powers(_BASE, bits)[: len(data)]
    np.cumsum(weighted, out=summed[1:])
    return mix((summed[end] - summed[begin]) * _powers(_INVERSE, bits)[begin])


def word_hashes(column: pa.Array, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of a slice, and where each text's words begin (with the end of the last)."""
    data, starts = text_bytes(column)
    begin, end = word_bounds(data, starts, apart)
    return fingerprints(data, begin, end), np.searchsorted(begin, starts).astype(np.int64)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of values[at[i]:at[i+1]] for every i."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


class Membership:
    """Index of fingerprints in a sorted array, -1 for others; most others are told by one look."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.shift = np.uint64(64 - max(10, min(22, 4 + len(known).bit_length())))
        self.seen = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.seen[known >> self.shift] = True

    def index(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, dtype=np.int64)
        if len(self.known):
            maybe = np.flatnonzero(self.seen[h >> self.shift])
            at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
            same = self.known[at] == h[maybe]
            out[maybe[same]] = at[same]
        return out


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sliced_join(left: DataFrame, key: str, spread_by: str, right: DataFrame, right_key: str, hot_rows: int) -> DataFrame:
    """Inner join on a key of which some values may be very frequent on the left; one row a key on the right."""
    hot = hot_keys(left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", hot_rows)
    dealt = slice_rows(left, key, spread_by, hot)
    copies = copy_to_slices(right, right_key, hot).withColumnRenamed("_slice", "_copy")
    same = (F.col(key) == F.col(right_key)) & (F.col("_slice") == F.col("_copy"))
    return dealt.join(copies, same).drop("_slice", "_copy", right_key)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir names no shared folder")
    if "://" not in base and base.startswith("/"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """The rows as a Parquet table in a shared folder: lineage ends here."""
    (df.coalesce(partitions) if partitions else df).write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a shared folder that no later step reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
