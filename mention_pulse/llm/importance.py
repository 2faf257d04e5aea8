"""Target-distribution importance resampling: bucket gains, array-scored weights, distributed quickselect.

Words are runs of ASCII letters and digits and of all bytes above 127, with A-Z lower-cased. Features
are all runs of 1 to `orders` consecutive words joined by one space, repeats counted; a feature's bucket
is the CRC-32 of its bytes modulo `buckets`. The checksum of a run comes from the checksums of its words:
appending n bytes to a text is a linear step on its checksum, so tables give it for whole arrays of
words. Both corpora are counted per bucket; a bucket's gain is the log ratio of its smoothed shares in
the target and in the corpus, in thousandths, rounded down. A document's weight is the sum of the gains
of its features, and its score adds Gumbel noise drawn from its doc_id, so that the highest scores are
a draw without replacement by weight.

Of the documents with at least `min_words` words the best `percent` per cent (rounded down) are drawn.
The key of the last of them is found by quickselect over the written scores: some random keys are drawn
as pivots, rows below, at and above each are counted exactly, and the search goes on between the two
pivots around the wanted place. Only the drawn rows are sorted, over ranges, and numbered from the sizes
of the ranges. To the driver go the sums per bucket, the pivots and counts, and one size for each range.

Defined results: a null text, or one without words, has no features, weight 0, its noise as score, and
is never drawn. Equal scores go by smaller doc_id, null ids last; rows that repeat a doc_id and its score
go by more features, then by larger weight, and of entirely equal rows just as many as are needed are drawn.
A null doc_id draws its noise as an empty one. An empty table gives no rows; an empty target has zero
counts. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common

POLYNOMIAL = 0xEDB88320  # CRC-32, bits reversed
_NEAR = 64  # lengths with a table of their own
_WORDS = 1 << 17  # words worked on at once
PIVOTS = 16


@dataclass(frozen=True)
class Resampling:
    """Parameters of the draw."""

    buckets: int = 10_000
    orders: int = 3
    min_words: int = 20
    percent: int = 5
    seed: int = 42


# ---- checksums of runs of words ---------------------------------------------------------------
@cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _apply(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear step, as four tables by byte, on checksums."""
    out = step[0][crc & np.uint32(255)]
    for b in range(1, 4):
        out = out ^ step[b][(crc >> np.uint32(8 * b)) & np.uint32(255)]
    return out


def _one_byte() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    spread = np.stack([values << np.uint32(8 * b) for b in range(4)])
    return _byte_table()[spread & np.uint32(255)] ^ (spread >> np.uint32(8))


@cache
def _steps() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables that append n zero bytes: for each n up to _NEAR, flat; and for each power of two."""
    values = np.arange(256, dtype=np.uint32)
    same = np.stack([values << np.uint32(8 * b) for b in range(4)])
    near, one = [same], _one_byte()
    for _ in range(_NEAR):
        near.append(_apply(one, near[-1]))
    powers = [one]
    for _ in range(40):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(near).ravel(), powers


def appended(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksums moved on by as many bytes as `length` says; combine with those bytes' own by xor."""
    flat, powers = _steps()
    at = np.minimum(length, _NEAR) << 10
    out = flat[at | (crc & np.uint32(255))]
    for b in range(1, 4):
        out ^= flat[(at | (b << 8)) | ((crc >> np.uint32(8 * b)) & np.uint32(255))]
    for i in np.flatnonzero(length > _NEAR).tolist():
        one, n = crc[i : i + 1], int(length[i])
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                one = _apply(powers[bit], one)
        out[i] = one[0]
    return out


def word_sums(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each data[begin:end], byte by byte for all words side by side."""
    length = end - begin
    order = np.argsort(-length, kind="stable")
    falling, starts = -length[order], begin[order]
    table = _byte_table()
    crc = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(min(int(length.max(initial=0)), _NEAR)):
        n = int(np.searchsorted(falling, -k))
        now = crc[:n]
        crc[:n] = table[(now ^ data[starts[:n] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~crc
    for i in np.flatnonzero(length > _NEAR).tolist():
        out[i] = zlib.crc32(data[begin[i] : end[i]].tobytes())
    return out


def _runs(part: pa.RecordBatch, rules: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each word, bucket of the run that ends there, whether that run lies in one text) by order and piece."""
    data, starts = common.text_bytes(part["text"])
    data = common.LOWER[data]
    begin, end = common.word_bounds(data, starts, common.NOT_PLAIN)
    space = np.uint32(zlib.crc32(b" "))
    for at in range(0, len(begin), _WORDS):
        first = max(0, at - rules.orders + 1)  # runs may begin in the piece before
        b, e = begin[first : at + _WORDS], end[first : at + _WORDS]
        text = np.searchsorted(starts, b, side="right") - 1
        length = e - b
        word = word_sums(data, b, e)
        spaced = word ^ appended(np.full(len(word), space), length)
        run, new = word, at - first
        for order in range(rules.orders):
            if order:
                run = appended(run[:-1], length[order:] + 1) ^ spaced[order:]
            ends = text[order:]
            inside = ends == text[: len(text) - order]
            fresh = max(0, new - order)
            yield ends[fresh:], (run[fresh:] % np.uint32(rules.buckets)).astype(np.int64), inside[fresh:]


def bucket_counts(docs: DataFrame, rules: Resampling = Resampling()) -> DataFrame:
    """(bucket, n): features of all texts by bucket, summed up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rules.buckets, dtype=np.int64)
        for part in common.slices(batches):
            for _, bucket, inside in _runs(part, rules):
                total += np.bincount(bucket[inside], minlength=rules.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, rules: Resampling = Resampling()) -> np.ndarray:
    """Gain of each bucket, in thousandths; `buckets` numbers of each side come to the driver."""
    sides = []
    for frame in (docs, target):
        counts = np.zeros(rules.buckets, dtype=np.int64)
        for row in bucket_counts(frame, rules).collect():
            counts[row["bucket"]] = row["n"]
        sides.append(counts)
    s, t = ((counts + 1).astype(float) for counts in sides)
    whole_s, whole_t = (float(counts.sum() + rules.buckets) for counts in sides)
    return np.array([math.floor(1000 * math.log(r)) for r in (t * whole_s / (s * whole_t)).tolist()], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(docs: DataFrame, gain: np.ndarray, rules: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_words, n_features, weight and score, one row for each of the input."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            size = part.num_rows
            sizes, weight = np.zeros((rules.orders, size), dtype=np.int64), np.zeros(size, dtype=np.int64)
            for i, (text, bucket, inside) in enumerate(_runs(part, rules)):
                mine = text[inside]
                sizes[i % rules.orders] += np.bincount(mine, minlength=size)
                begins = np.searchsorted(mine, np.arange(size + 1))
                weight += common.sums(shared.value[bucket[inside]], begins)
            ids = part["doc_id"].to_pylist()
            draw = np.array([noise(i, rules.seed) for i in ids], dtype=np.int64)
            columns = [sizes[0], sizes.sum(axis=0), weight, weight + draw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c) for c in columns)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(score, _SCORED)


# ---- the draw ---------------------------------------------------------------------------------
KEY = ("score", "doc_id", "n_features", "weight")
Key = tuple[int, int | None, int, int]


def _key() -> Column:
    """Ascending in the order of the draw."""
    return F.struct(
        (-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.coalesce("doc_id", F.lit(0)).alias("c"),
        (-F.col("n_features")).alias("d"), (-F.col("weight")).alias("e"),
    )


def _literal(row: Key) -> Column:
    score, doc_id, n_features, weight = row
    parts = (F.lit(-score).cast("long"), F.lit(doc_id is None), F.lit(doc_id or 0).cast("long"),
             F.lit(-n_features).cast("long"), F.lit(-weight).cast("long"))
    return F.struct(*(p.alias(n) for p, n in zip(parts, "abcde")))


def _order(row: Key) -> tuple:
    score, doc_id, n_features, weight = row
    return -score, doc_id is None, doc_id or 0, -n_features, -weight


def quickselect(rows: DataFrame, k: int, pivots: int = PIVOTS) -> Key | None:
    """The k-th key (from 1) of the rows in the order of the draw; None if there are fewer rows.

    Each round draws `pivots` keys at random between the bounds known so far (by a hash of row and
    round, so that a repeated task draws the same) and counts the rows between them, and at them.
    """
    below: Key | None = None
    above: Key | None = None
    rounds = 0
    while k > 0:
        live = rows
        if below:
            live = live.filter(F.col("score") <= below[0]).filter(_key() > _literal(below))
        if above:
            live = live.filter(F.col("score") >= above[0]).filter(_key() < _literal(above))
        lot = F.xxhash64(F.lit(rounds), *KEY)
        drawn = live.select(*KEY, lot.alias("lot")).distinct().orderBy("lot", *KEY).limit(pivots).collect()
        keys = sorted({tuple(r[c] for c in KEY) for r in drawn}, key=_order)
        if not keys:
            return None
        past = sum(((_key() > _literal(p)).cast("int") for p in keys), F.lit(0))
        at = F.lit(False)
        for p in keys:
            at = at | (_key() == _literal(p))
        counted = live.groupBy(past.alias("past"), at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {(r["past"], r["at"]): r["n"] for r in counted}
        for i in range(len(keys) + 1):
            between = sizes.get((i, False), 0)
            if k <= between:
                below, above = (keys[i - 1] if i else below), (keys[i] if i < len(keys) else above)
                break
            k -= between
            if i < len(keys):
                same = sizes.get((i, True), 0)
                if k <= same:
                    return keys[i]
                k -= same
        else:
            return None
        rounds += 1
    return None


def ranked(rows: DataFrame, folder: str) -> DataFrame:
    """The rows with `rank`, from 1 in the order of the draw: sorted over ranges, numbered from their sizes."""
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("weight")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # a range's number in the upper bits, the place within it in the 33 lower ones
    placed = common.written(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), folder)
    which = F.shiftright("_place", 33)
    sizes = placed.groupBy(which.alias("_range")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r["_range"]):
        offsets.append((r["_range"], before))
        before += r["n"]
    table = spark.createDataFrame(offsets, "_range long, _before long")  # one row for each range
    numbered = placed.withColumn("_range", which).join(F.broadcast(table), "_range")
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    return numbered.withColumn("rank", F.col("_before") + place + 1).drop("_place", "_range", "_before")


def resample(docs: DataFrame, target: DataFrame, rules: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_features, weight, score and `rank` (null where not drawn), one row for each of the input."""
    folder = common.shared_folder(docs.sparkSession, "importance")
    rows = common.written(scored(docs, gains(docs, target, rules), rules), f"{folder}/scores")
    eligible = rows.filter(F.col("n_words") >= rules.min_words)
    k = rules.percent * eligible.count() // 100
    last = quickselect(eligible, k)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    won = (F.col("n_words") >= rules.min_words) & (F.col("score") >= last[0]) & (_key() <= _literal(last))
    drawn = ranked(rows.filter(won), f"{folder}/drawn")
    # more rows than are wanted only where rows equal the last one in every column of the key
    rank = F.when(F.col("rank") <= k, F.col("rank"))
    return rows.filter(~won).select(*columns, F.lit(None).cast("long").alias("rank")).union(
        drawn.select(*columns, rank.alias("rank"))
    )
