"""SuperMinHash near-duplicates: level-wise signatures, bands, full-set verification, union-find.

A document's set holds the 64-bit fingerprints of its distinct runs of SHINGLE words (A-Z lower-cased); with
fewer words the whole sequence is its one member. Each member walks through a random permutation of the
signature's positions; at step j it offers j plus a random fraction to the position it stands on, and a
position keeps its least offer. As an offer of step j is below all of step j+1, all members of a
document take a step together, and the document stops once every position has an offer. Positions are
without replacement within a member, which makes the estimate of the similarity vary less than that
of independent minima. `bands` groups of `rows` positions are hashed; two documents at the limit of 85 %
share no band in 1 of 4 million cases (with 32 bands of 6 positions), more similar ones in fewer.

Documents with the same set are one class, named by its first row. Bands that several classes share are
compared in two rounds, the second only between classes that no chain of links joins by then:
  1. every class with the first class of the band, so a large group of near copies costs one pair a class;
     the two full sets, of which 48 bits a member are kept, meet by a join, pivots of very many pairs in slices;
  2. in bands still not joined, by signature: pairs that agree in far fewer positions than linked sets do (5.5
     standard deviations), or whose sizes forbid a link, are out. The others make clusters, from a spanning
     forest of each band. A cluster's sets meet in one task, which verifies what is not joined yet and gives a
     spanning forest of the links. So neither round gives more rows than classes in its bands.
A band or cluster too large for a task is cut into blocks, and any two blocks meet in one task. Links are joined
by rounds of minima (see `components`).

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing, not
even its like; its component is its own doc_id. Repeated rows come back one for one. Rows of a null doc_id
take part, can name no component unless all its rows are null, and are kept only then. An empty table
gives no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mention_pulse.llm import common
from mention_pulse.llm.components import components
from mention_pulse.operators.skew import copy_to_slices, hot_keys, is_small, slice_rows

SHINGLE = 3
HOT = 4096
FEW = 1_000_000  # ids that are broadcast, a few MB
BATCH_BYTES = 4 << 20
_PIECE = 1 << 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Bands:
    """Parameters: `percent` is the least similarity of a link; sizes bound what one task compares."""

    bands: int = 32
    rows: int = 6
    percent: int = 85
    block: int = 1024
    block_bytes: int = 4 << 20

    @property
    def positions(self) -> int:
        return self.bands * self.rows

    @property
    def agreeing(self) -> int:
        """Positions that two linked sets agree in, but for 5.5 standard deviations."""
        p = self.percent / 100
        return math.floor(self.positions * p - 5.5 * math.sqrt(self.positions * p * (1 - p)))


# ---- sets and signatures ------------------------------------------------------------------------
def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of all texts, and where each text's begin (with the end)."""
    h, at = common.word_hashes(texts)
    n = np.diff(at)
    sizes = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    begins = np.append(0, np.cumsum(sizes))
    out = np.empty(begins[-1], dtype=np.uint64)
    if len(h) >= SHINGLE:
        run = common.mix(common.mix(h[:-2] * _A + h[1:-1]) * _B + h[2:])
        text = np.repeat(np.arange(len(n)), n)
        whole = text[:-2] == text[2:]
        out[np.repeat(n >= SHINGLE, sizes)] = run[whole]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)).tolist():
        words = h[at[i] : at[i + 1]]
        out[begins[i]] = common.mix(words[:1] * _C + (words[1:] if n[i] == 2 else np.uint64(0)) + np.uint64(n[i]))[0]
    new = np.ones(len(out), dtype=bool)
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
            new[a + 1 : b] = out[a + 1 : b] != out[a : b - 1]
    return out[new], np.append(0, np.cumsum(new))[begins]


def _offer(h: np.ndarray, step: int, left: int) -> tuple[np.ndarray, np.ndarray]:
    """Random fraction (56 bits, the step above them) and random choice among `left` of each member at a step."""
    r = common.mix(h + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    choice = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(left)) >> np.uint64(32)
    value = (common.mix(r + _C) >> np.uint64(8)) | np.uint64(step << 56)
    return value, choice.astype(np.int64)


def signatures(members: np.ndarray, at: np.ndarray, positions: int) -> np.ndarray:
    """SuperMinHash signature of each set members[at[i]:at[i+1]]; an empty set keeps the highest value."""
    size = len(at) - 1
    out = np.full(size * positions, _NONE, dtype=np.uint64)
    owner = np.repeat(np.arange(size), np.diff(at))
    base = owner * positions
    first = np.empty(len(members), dtype=np.int64)
    for a in range(0, len(members), _PIECE):  # step 0, with which most long documents are done
        piece = slice(a, a + _PIECE)
        value, first[piece] = _offer(members[piece], 0, positions)
        np.minimum.at(out, base[piece] + first[piece], value)
    open_ = (out.reshape(size, positions) == _NONE).any(axis=1)
    open_ &= np.diff(at) > 0
    rest = np.flatnonzero(open_[owner])
    # documents side by side, as many as a table of their members' permutations has room for
    done = 0
    while done < len(rest):
        to = int(np.searchsorted(owner[rest], owner[rest[min(done + _PIECE, len(rest)) - 1]], side="right"))
        _further_steps(members, base, first, out, rest[done:to], positions)
        done = to
    return out.reshape(size, positions)


def _further_steps(members, base, first, out, live: np.ndarray, positions: int) -> None:
    """Steps from 1 on of the members `live`, whole documents each, until their documents have all positions."""
    kind = np.uint8 if positions <= 256 else np.uint16
    walk = np.tile(np.arange(positions, dtype=kind), (len(live), 1))
    row = np.arange(len(live))
    walk[row, first[live]] = 0  # position 0 changes places with the one taken
    for step in range(1, positions):
        value, choice = _offer(members[live], step, positions - step)
        choice += step
        place = walk[row, choice]
        walk[row, choice] = walk[row, step]
        np.minimum.at(out, base[live] + place, value)
        starts = np.flatnonzero(np.append(True, base[live[1:]] != base[live[:-1]]))
        documents = base[live[starts]]
        still = (out[documents[:, None] + np.arange(positions)] == _NONE).any(axis=1)
        keep = np.repeat(still, np.diff(np.append(starts, len(live))))
        if not keep.all():
            live, row = live[keep], row[keep]
            if not len(live):
                return


def _packed(members: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each member, six bytes each."""
    return np.ascontiguousarray(members.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _sets(bands: Bands):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            members, at = shingle_sets(part["text"])
            n = np.diff(at)
            signature = signatures(members, at, bands.positions)
            keys = np.zeros((len(n), 2), dtype=np.uint64)
            raw = members.tobytes()
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                key = xxhash.xxh3_128_intdigest(raw[8 * a : 8 * b]) >> 2  # 126 bits fit a decimal of 38 digits
                keys[i] = key & 0xFFFFFFFFFFFFFFFF, key >> 64
            band = np.full((len(n), bands.bands), 0, dtype=np.uint64)
            grouped = signature.reshape(len(n), bands.bands, bands.rows)
            for r in range(bands.rows):
                band = common.mix(band * _A + grouped[:, :, r])
            band = common.mix(band + np.arange(1, bands.bands + 1, dtype=np.uint64) * _B)
            sketch = common.mix(signature).astype(np.uint8)
            rows = len(n)
            offsets = np.arange(rows + 1)
            columns = [
                part["doc_id"],
                pa.array(n, pa.int64()),
                pa.Array.from_buffers(pa.decimal128(38, 0), rows, [None, pa.py_buffer(keys.tobytes())]),
                pa.ListArray.from_arrays(pa.array(offsets * bands.bands, pa.int32()), pa.array(band.ravel().view(np.int64))),
                _binary(sketch, offsets * bands.positions),
                _binary(_packed(members), 6 * at),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "key", "bands", "sketch", "members"])

    return gather


# ---- pairs ----------------------------------------------------------------------------------------
_PAIRS = "a long, b long"


def _similar(x: bytes, y: bytes, x_size: int, y_size: int, percent: int) -> bool:
    """Whether two full sets are linked."""
    one, other = _unpacked(x), _unpacked(y)
    if len(one) > len(other):
        one, other = other, one
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    shared = int((other[at] == one).sum())
    return 100 * shared >= percent * (x_size + y_size - shared)


def _in_cells(bands: Bands, verify: bool):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each cell a spanning forest of its pairs that may be linked, or that are (`verify`)."""
        held: list[pa.RecordBatch] = []
        now: int | None = None

        def close() -> Iterator[pa.RecordBatch]:
            size = sum(b.num_rows for b in held)
            if size < 2:
                return
            ids, n, group = (np.concatenate([b[c].to_numpy() for b in held]) for c in ("id", "n", "group"))
            sketches = np.frombuffer(b"".join(x for b in held for x in b["sketch"].to_pylist()), dtype=np.uint8).reshape(size, -1)
            sets = [x for b in held for x in b["members"].to_pylist()] if verify else []
            # links join groups; what only may be linked makes trees of classes, and groups stay as they are
            tree = group.copy() if verify else np.arange(size)
            pairs: list[tuple[int, int]] = []
            for i in range(size - 1):
                low, high = np.minimum(n[i + 1 :], n[i]), np.maximum(n[i + 1 :], n[i])
                apart = (group[i + 1 :] != group[i]) & (tree[i + 1 :] != tree[i])
                near = i + 1 + np.flatnonzero(apart & (100 * low >= bands.percent * high))
                near = near[(sketches[near] == sketches[i]).sum(axis=1) >= bands.agreeing]
                for j in near.tolist():
                    if tree[j] != tree[i] and (not verify or _similar(sets[i], sets[j], int(n[i]), int(n[j]), bands.percent)):
                        pairs.append((i, j))
                        tree[tree == tree[j]] = tree[i]
            if pairs:
                a, b = ids[np.array(pairs).T]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch["cell"].to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell)).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                if int(cell[a]) != now:
                    yield from close()
                    held, now = [], int(cell[a])
                held.append(batch.slice(a, b - a))
        yield from close()

    return compare


def _cells(rows: DataFrame, bands: Bands) -> DataFrame:
    """Rows of (key, blocks, id) with their `cell`: the key itself, or for each two blocks of it a cell of theirs."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    cut = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return cut.withColumn("cell", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).drop("own", "other", "key", "blocks")


def _forests(cells: DataFrame, bands: Bands, verify: bool) -> DataFrame:
    ordered = cells.repartition("cell").sortWithinPartitions("cell")
    return ordered.mapInArrow(_in_cells(bands, verify), _PAIRS)


def _checked(bands: Bands):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets are similar enough."""
        for batch in batches:
            a_size, b_size = batch["a_n"].to_numpy(), batch["b_n"].to_numpy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in np.flatnonzero(100 * np.minimum(a_size, b_size) >= bands.percent * np.maximum(a_size, b_size)).tolist():
                sets = (batch[c][i].as_py() for c in ("a_members", "b_members"))
                keep[i] = _similar(*sets, int(a_size[i]), int(b_size[i]), bands.percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return check


def _needed(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of some classes: filtered where they lie if the ids are few, else by shuffle."""
    ids = ids.toDF("_needed").distinct()
    ids = F.broadcast(ids) if is_small(ids, FEW) else ids
    return sets.join(ids, F.col("id") == F.col("_needed"), "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, bands: Bands, folder: str) -> DataFrame:
    """The pairs that are linked, as a written table."""
    pairs = common.written(pairs.filter("a != b").distinct(), f"{folder}-pairs")
    side = {s: _needed(sets.select("id", "n", "members"), pairs.select(s)).toDF(f"{s}_id", f"{s}_n", f"{s}_members") for s in "ab"}
    joined = pairs.join(side["b"], F.col("b") == F.col("b_id")).drop("b_id")
    joined = common.sliced_join(joined, "a", "b", side["a"], "a_id", HOT)
    return common.written(joined.mapInArrow(_checked(bands), _PAIRS), f"{folder}-links")


def links(classes: DataFrame, sets: DataFrame, bands: Bands, folder: str) -> DataFrame:
    """(a, b): links that join just those classes which chains of linked pairs join.

    `classes` has id and bands, one row a class; `sets` has id, n, sketch and members of these and maybe more.
    """
    posted = classes.select("id", F.explode("bands").alias("band"))
    sizes = posted.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first")).filter("size > 1")
    sizes = common.written(sizes, f"{folder}/bands")
    shared = sizes.select(F.col("band").alias("of_band"), "first")
    hot = hot_keys(sizes, "band", "size", HOT)
    dealt = slice_rows(posted, "band", "id", hot)
    copies = copy_to_slices(shared, "of_band", hot).withColumnRenamed("_slice", "_copy")
    met = dealt.join(copies, (F.col("band") == F.col("of_band")) & (F.col("_slice") == F.col("_copy")))
    members = common.written(met.select("band", "id", "first"), f"{folder}/members")
    found = _verified(members.select(F.col("first").alias("a"), F.col("id").alias("b")), sets, bands, f"{folder}/first")
    # classes by what joins them so far, in the bands that hold several such groups
    grouped = _joined(members.select(F.col("band").alias("key"), "id"), components(found, "a", "b"))
    grouped = common.written(grouped, f"{folder}/grouped")
    apart = grouped.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("group").alias("low"), F.max("group").alias("high"))
    apart = apart.filter("low < high").select(F.col("key").alias("of_key"), "size", F.ceil(F.col("size") * 2 / F.lit(bands.block)).alias("blocks"))
    apart = common.written(apart, f"{folder}/apart")
    if apart.isEmpty():
        return found
    open_ = _of_keys(grouped, apart, "size").drop("size")
    open_ = common.written(open_, f"{folder}/open")
    facts = _needed(sets.select("id", "n", "sketch"), open_.select("id"))
    near = common.written(_forests(_cells(open_.join(facts, "id"), bands), bands, False), f"{folder}/near")
    # clusters of what may be linked; its classes once each, whatever the number of bands they share
    clusters = components(near, "a", "b").select(F.col("component").alias("key"), F.col("node").alias("id"))
    groups = open_.select(F.col("id").alias("_id"), "group").distinct()
    facts = _needed(sets.select("id", "n", "sketch", "members"), clusters.select("id"))
    gathered = clusters.join(groups, F.col("id") == F.col("_id")).drop("_id").join(facts, "id")
    gathered = common.written(gathered, f"{folder}/clusters")
    room = F.greatest(F.count(F.lit(1)) * 2 / F.lit(bands.block), F.sum("n") * 12 / F.lit(bands.block_bytes))
    sizes = gathered.groupBy(F.col("key").alias("of_key")).agg(F.count(F.lit(1)).alias("size"), F.ceil(room).alias("blocks"))
    cells = _cells(_of_keys(gathered, sizes, "size").drop("size"), bands)
    return common.written(found.union(_forests(cells, bands, True)), f"{folder}/links")


def _joined(members: DataFrame, joined: DataFrame) -> DataFrame:
    """The members with `group`: the component of a class that has one, else itself."""
    member = members.join(joined.select(F.col("node").alias("_node"), "component"), F.col("id") == F.col("_node"), "left")
    return member.withColumn("group", F.coalesce("component", "id")).drop("_node", "component")


def _of_keys(rows: DataFrame, keys: DataFrame, size: str) -> DataFrame:
    """The rows of some keys, with what is known of these (one row each, `size` rows in all); large ones in slices."""
    hot = hot_keys(keys, "of_key", size, HOT)
    dealt = slice_rows(rows, "key", "id", hot)
    copies = copy_to_slices(keys, "of_key", hot).withColumnRenamed("_slice", "_copy")
    return dealt.join(copies, (F.col("key") == F.col("of_key")) & (F.col("_slice") == F.col("_copy"))).drop("of_key", "_slice", "_copy")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches to Python bounded by bytes as well as by rows: long documents have long texts and large sets."""
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


# ---- documents ------------------------------------------------------------------------------------
def near_duplicates(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id, `n_shingles`, `component_id` and `kept`, one row for each of the input."""
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, bands)


def _near_duplicates(docs: DataFrame, bands: Bands) -> DataFrame:
    folder = common.shared_folder(docs.sparkSession, "superminhash")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {kind}, n long, key decimal(38,0), bands array<long>, sketch binary, members binary"
    rows = texts.mapInArrow(_sets(bands), schema).withColumn("id", F.monotonically_increasing_id())
    rows = common.written(rows, f"{folder}/sets")
    full = rows.filter("n > 0")
    classes = full.groupBy("key").agg(F.min("id").alias("class"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = common.written(classes, f"{folder}/classes")
    chosen = classes.select(F.col("class").alias("_class"))
    heads = full.select("id", "bands").join(chosen, F.col("id") == F.col("_class"), "left_semi")
    heads = common.written(heads, f"{folder}/heads")
    joined = components(links(heads, full.select("id", "n", "sketch", "members"), bands, folder), "a", "b")
    linked = classes.join(joined, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
    linked = common.written(linked.select("key", "class", "least", "copies", "component"), f"{folder}/linked")
    least = linked.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = common.sliced_join(linked.select("key", "class", "copies", "component"), "component", "class", least, "of", HOT)
    # a class of very many copies is cut into slices of its rows
    hot = hot_keys(classes, "key", "copies", HOT)
    dealt = slice_rows(full.select("id", "doc_id", "n", "key"), "key", "id", hot)
    copies = copy_to_slices(named.select(F.col("key").alias("of_key"), "component_id"), "of_key", hot).withColumnRenamed("_slice", "_copy")
    same = (F.col("key") == F.col("of_key")) & (F.col("_slice") == F.col("_copy"))
    found = dealt.join(copies, same).select("doc_id", "n", "component_id")
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
