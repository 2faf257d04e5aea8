"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two fingerprints of 8 bytes that differ in at most 4 bits agree in at least 4 byte positions. Posting
lists are kept for every four positions together (70 of them) with the 4 bytes found there: what four
single-byte lists would give when intersected, without reading lists that hold a 256th of the corpus.
Two fingerprints that share m positions meet in as many lists as there are fours of m, so a pair is
in some list exactly if its tally of shared bytes reaches 4: the list's key is the count filter, a pair
that falls short of it never meets, and the tally taken of those that meet can turn none away. What
meets is verified bit by bit.

Exact copies share a fingerprint and are one entry. A list's entries are compared at growing distances
in sorted order, and stop once they are all known to hang together. Links found in a task are reduced
to a forest, so no list gives more links than entries. Lists beyond `max_list` entries are worked on
without any pairs: entries are spread to all values within 2 bits of theirs; two entries within 4 bits
have such a value in common, and all that have one in common are within 4 bits.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any
other. Repeated rows come back one for one. Rows of a null doc_id take part and can be no component's
id unless all its rows are null. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common
from mention_pulse.llm.components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
LEAST_BYTES = 8 - MAX_BITS
FOURS = list(combinations(range(8), LEAST_BYTES))
MAX_LIST = 4096
HOT = 4096
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist())
    return _majority(np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64))


def _majority(h: np.ndarray) -> int:
    """Bits that are set in over half the hashes; eight bits are counted side by side in bytes."""
    counts = np.zeros(64, dtype=np.int64)
    for shift in range(8):
        lanes = (h >> np.uint64(shift)) & _LANES
        for at in range(0, len(lanes), 255):
            total = int(lanes[at : at + 255].sum())
            for byte in range(8):
                counts[8 * byte + shift] += (total >> (8 * byte)) & 255
    set_bits = np.flatnonzero(2 * counts > len(h))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, `fp`, the fingerprint as a signed long, and `content`, a hash of the text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            fps = np.array([fingerprint((t.as_py() or "").encode("utf-8", "replace")) for t in part["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(fps.view(np.int64)), part["content"]], names=["doc_id", "fp", "content"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("content"))
    return texts.mapInArrow(count, f"doc_id {kind}, fp long, content long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, fp) for each four of byte positions; the list's number holds the four and its bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fp = np.asarray(batch["fp"][at : at + 4096]).view(np.uint64)
            for k, four in enumerate(FOURS):
                key = np.full(len(fp), k, dtype=np.uint64)
                for position in four:
                    key = (key << np.uint64(8)) | ((fp >> np.uint64(8 * position)) & np.uint64(255))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["list", "fp"])


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """Byte positions in which two fingerprints agree, from their difference."""
    return (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


class Forest:
    """Union-find over arrays: the smallest member stands for each set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))

    def find(self, a: np.ndarray) -> np.ndarray:
        root = self.root
        at = root[a]
        while True:
            up = root[at]
            if (up == at).all():
                root[a] = at
                return at
            at = up


def _links_of_lists(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest links between entries of whole lists, sorted by list and fingerprint."""
    entry, where = np.unique(fp, return_inverse=True)
    forest = Forest(len(entry))
    bits = fp.view(np.uint64)
    live = np.arange(len(fp))  # entries that still may have a partner `step` further on
    step = 1
    while True:
        live = live[live + step < len(fp)]
        live = live[key[live] == key[live + step]]
        if not len(live):
            break
        apart = bits[live] ^ bits[live + step]
        near = _shared_bytes(apart) >= LEAST_BYTES
        near[near] = np.bitwise_count(apart[near]) <= MAX_BITS
        forest.join(where[live[near]], where[live[near] + step])
        step += 1
        if step in (3, 8, 32, 128, 512, 2048):  # leave out lists that already hang together
            root = forest.find(where)
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            whole = np.minimum.reduceat(root, begin) == np.maximum.reduceat(root, begin)
            live = live[~whole[np.searchsorted(begin, live, side="right") - 1]]
    root = forest.find(np.arange(len(entry)))
    linked = np.flatnonzero(root != np.arange(len(entry)))
    return entry[linked], entry[root[linked]]


_FOUND = "u long, v long, list long"


def _rows(u: np.ndarray, v: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    keys = pa.nulls(len(u), pa.int64()) if key is None else pa.array(key)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), keys], names=["u", "v", "list"])


def _compare(max_list: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of sorted lists; entries of lists that are too long go on by themselves, with their list."""
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        long_list: int | None = None

        def close(end: int) -> Iterator[pa.RecordBatch]:
            begin = np.flatnonzero(np.append(True, key[1:end] != key[: end - 1])) if end else np.zeros(0, np.int64)
            size = np.diff(np.append(begin, end))
            which = np.repeat(size, size)
            useful = (which > 1) & (which <= max_list)
            if useful.any():
                u, v = _links_of_lists(key[:end][useful], fp[:end][useful])
                yield _rows(u, v)
            if (which > max_list).any():
                yield _rows(fp[:end][which > max_list], fp[:end][which > max_list], key[:end][which > max_list])

        for batch in batches:
            key = np.concatenate([key, np.asarray(batch["list"])])
            fp = np.concatenate([fp, np.asarray(batch["fp"])])
            if long_list is not None:  # the rest of a list whose first part has gone on
                more = int(np.searchsorted(key, long_list, side="right"))
                yield _rows(fp[:more], fp[:more], key[:more])
                key, fp = key[more:], fp[more:]
                if len(key):
                    long_list = None
            if len(key) < 1 << 17:
                continue
            end = int(np.searchsorted(key, key[-1]))
            yield from close(end)
            key, fp = key[end:], fp[end:]
            if len(key) > max_list:
                long_list = int(key[-1])
                yield _rows(fp, fp, key)
                key, fp = key[:0], fp[:0]
        yield from close(len(key))

    return compare


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp, near) for every value within 2 bits of an entry, in the bytes that its list leaves open."""
    fours = np.array([sum(255 << (8 * p) for p in four) for four in FOURS], dtype=np.uint64)
    for batch in batches:
        lists, fps = np.asarray(batch["list"]).view(np.uint64), np.asarray(batch["u"])
        four = (lists >> np.uint64(32)).astype(np.int64)
        for k in np.unique(four).tolist():
            open_bits = [1 << b for b in range(64) if not int(fours[k]) >> b & 1]
            masks = np.array([0, *open_bits, *(a | b for a, b in combinations(open_bits, 2))], dtype=np.uint64)
            mine = fps[four == k]
            for at in range(0, len(mine), 128):
                part = mine[at : at + 128]
                near = (part.view(np.uint64)[:, None] ^ masks).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part, len(masks))), pa.array(near)], names=["fp", "near"])


def links(fps: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """(u, v): links that join just the fingerprints which chains of at most MAX_BITS bits join."""
    spark = fps.sparkSession
    entries = fps.select("fp").distinct()
    folder = common.shared_folder(spark, "simhash-lists")
    posted = entries.mapInArrow(_postings, "list long, fp long").repartition("list").sortWithinPartitions("list", "fp")
    found = common.written(posted.mapInArrow(_compare(max_list), _FOUND), folder)
    pairs = found.filter("list IS NULL").select("u", "v")
    spread = found.filter("list IS NOT NULL").select("list", "u").mapInArrow(_spread, "fp long, near long").distinct()
    low = spread.groupBy("near").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = spread.join(low, "near").select(F.col("fp").alias("u"), F.col("low").alias("v")).filter("u != v").distinct()
    return pairs.union(starred)


def _grouped(docs: DataFrame, max_list: int) -> DataFrame:
    """doc_id, fp, content, `component` (a fingerprint of the group) and its `component_id`, one row for each of the input."""
    folder = common.shared_folder(docs.sparkSession, "simhash-fingerprints")
    prints = common.written(fingerprints(docs), folder)
    joined = components(links(prints, max_list))
    own = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = own.join(joined, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    ids = linked.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    # a group of very many fingerprints, and a fingerprint of very many rows, are cut into slices
    classes = common.sliced_join(linked.select("fp", "component"), "component", "fp", ids, "of", HOT)
    return common.sliced_join(prints, "fp", "doc_id", classes.withColumnRenamed("fp", "of_fp"), "of_fp", HOT)


def near_duplicates(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """doc_id, `fingerprint` (16 hex digits) and `component_id`, one row for each of the input."""
    return _grouped(docs.select("doc_id", "text"), max_list).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """One document of each group, the one of the smallest doc_id, with all its columns.

    Where this doc_id has several texts in the group, the one of the smallest fingerprint stays; texts
    of one doc_id that are no near copies of each other are groups of their own, and stay both. Of rows that
    repeat doc_id and text one is kept. Rows without a doc_id are all kept: none of them can be named as
    another's copy.
    """
    found = _grouped(docs.select("doc_id", "text"), max_list).filter("doc_id = component_id")
    kept = found.groupBy("component").agg(F.min(F.struct("fp", "content", "doc_id")).alias("head"))
    kept = kept.select(F.col("head.doc_id").alias("kept_id"), F.col("head.content").alias("kept_content")).distinct()
    content = common.free_name(docs, "content")
    named = docs.withColumn(content, F.xxhash64(F.col("text").cast("string")))
    same = (named["doc_id"] == kept["kept_id"]) & (named[content] == kept["kept_content"])
    one = named.join(kept, same, "left_semi").dropDuplicates(["doc_id", content]).drop(content)
    return one.union(docs.filter(F.col("doc_id").isNull()))
