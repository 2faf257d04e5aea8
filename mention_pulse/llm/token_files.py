"""Token ids in Simple-8b files, in the order of doc_id.

A 64-bit word holds a selector in its 4 upper bits and as many ids as the selector says in the other
60, the first id lowest. Selector 15 is an escape: the next word is one whole id that needs more than
60 bits. Ids are packed in blocks of BLOCK; the last word of a block may have room left over. Word
offsets of the blocks are stored, so that all blocks of a chunk are packed and unpacked side by side,
by arrays: packing takes one step for the n-th word of every block, unpacking one step per selector.

A file is a row of chunks, each of whole documents:
    magic, documents, ids, blocks, words (5 x uint64)
    doc_id is null (uint8 per document, filled up to 8 bytes), doc_id (int64), ids of each (int64)
    first word of each block, and the end (int64 per block and one), words (uint64)

Documents are dealt by ranges of doc_id, sorted, encoded and written where they are; the files of the
ranges follow each other. Defined results: a null or empty text has the end id only; a null doc_id comes
first; repeated doc_ids follow each other by text; an empty table gives no files and no rows.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = 0x5338425F49445331
BLOCK = 256
ESCAPE = 15
# ids in a word and bits of each, by selector: fixed values of the coding
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1, 1], dtype=np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60, 64], dtype=np.int64)
KEPT_PARTS = 1 << 20
CHUNK_IDS = 1 << 18
_LOOSE = re.compile(r"\s \s")
_CUT = re.compile(r"(?<=.)(?= \S)", re.DOTALL)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits each id needs, 1 at least."""
    out = np.ones(len(ids), dtype=np.int8)
    for b in range(1, 64):
        more = ids >> np.uint64(b) > 0
        if not more.any():
            break
        out += more
    return out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the first word of each block with the end of the last."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    # each block in a row of its own; beyond its end there are ids of no bits
    size = BLOCK + int(COUNTS[0])
    grid = np.zeros((blocks, size), dtype=np.uint64)
    need = np.zeros((blocks, size), dtype=np.int8)
    whole = np.arange(n)
    grid[whole // BLOCK, whole % BLOCK] = ids
    need[whole // BLOCK, whole % BLOCK] = _bits(ids)
    selector = np.full((blocks, BLOCK), ESCAPE, dtype=np.int8)
    widest, span = need, 1  # widest[i]: the most bits among the next `span` ids
    for s in range(13, -1, -1):
        count = int(COUNTS[s])
        while span < count:
            step = min(span, count - span)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            span += step
        fits = widest[:, :BLOCK] <= WIDTHS[s]
        selector[fits] = s
    ends = np.full(blocks, BLOCK)
    ends[-1] = n - (blocks - 1) * BLOCK
    at = np.zeros(blocks, dtype=np.int64)
    live = np.arange(blocks)
    rows, starts = [], []
    while len(live):
        rows.append(live)
        starts.append(at[live].copy())
        at[live] += COUNTS[selector[live, at[live]]]
        live = live[at[live] < ends[live]]
    row, start = np.concatenate(rows), np.concatenate(starts)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    chosen = selector[row, start].astype(np.int64)
    room = np.where(chosen == ESCAPE, 2, 1)
    place = np.zeros(len(row) + 1, dtype=np.int64)
    np.cumsum(room, out=place[1:])
    words = np.zeros(place[-1], dtype=np.uint64)
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[mine]] = np.uint64(ESCAPE << 60)
            words[place[mine] + 1] = grid[row[mine], start[mine]]
            continue
        word = np.full(len(mine), s << 60, dtype=np.uint64)
        for i in range(int(COUNTS[s])):
            word |= grid[row[mine], start[mine] + i] << np.uint64(i * int(WIDTHS[s]))
        words[place[mine]] = word
    return words, np.append(place[np.searchsorted(row, np.arange(blocks))], place[-1])


def unpack(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The ids packed in the words."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():
        # a raw word may look like any other: walk the escapes of all blocks, the first of each left first
        raw = np.zeros(len(words), dtype=bool)
        previous = -2
        for i in np.flatnonzero(selector == ESCAPE).tolist():
            if i != previous + 1:
                raw[i + 1] = True
                previous = i
        lead = np.flatnonzero(~raw)
    else:
        lead = np.arange(len(words))
    chosen = selector[lead]
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    block = np.searchsorted(first, lead, side="right") - 1
    begins = np.searchsorted(lead, first[:-1])
    start = ends - counts
    start += block * BLOCK - start[begins][block]
    stop = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[start[mine]] = words[lead[mine] + 1]
            continue
        word, mask = words[lead[mine]], np.uint64((1 << int(WIDTHS[s])) - 1)
        for i in range(int(COUNTS[s])):
            there = start[mine] + i
            inside = there < stop[mine]
            out[there[inside]] = (word[inside] >> np.uint64(i * int(WIDTHS[s]))) & mask
    return out


def chunk_bytes(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, first = pack(ids)
    flags = np.zeros(-(-len(nulls) // 8) * 8, dtype=np.uint8)
    flags[: len(nulls)] = nulls
    head = np.array([MAGIC, len(doc_ids), len(ids), len(first) - 1, len(words)], dtype="<u8")
    parts = (head, flags, doc_ids.astype("<i8"), lengths.astype("<i8"), first.astype("<i8"), words.astype("<u8"))
    return b"".join(p.tobytes() for p in parts)


def chunks(read) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, which are null, ids of each, and all ids, chunk by chunk; `read` gives so many bytes."""
    while head := read(40):
        magic, docs, n, blocks, words = np.frombuffer(head, dtype="<u8").tolist()
        if magic != MAGIC:
            raise ValueError("not a token file")
        nulls = np.frombuffer(read(-(-docs // 8) * 8), dtype=np.uint8)[:docs].astype(bool)
        doc_ids, lengths = (np.frombuffer(read(8 * docs), dtype="<i8") for _ in range(2))
        first = np.frombuffer(read(8 * (blocks + 1)), dtype="<i8")
        yield doc_ids, nulls, lengths, unpack(np.frombuffer(read(8 * words), dtype="<u8"), first, n)


class Encoder:
    """Ids of texts by the tokenizers library.

    The byte-level pre-tokenizer never joins a space to what stands before it, unless white space is on
    both of its sides, so texts are cut before spaces and the library encodes each distinct part once:
    many parts, one after another, as one text, whose ids are told apart by the bytes they stand for.
    Texts with a space inside white space are cut only before a space and a visible character; texts
    that hold an added token's string are handed over whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark runs a task on each core already; the library's own threads would only wait for one another
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}  # of parts that follow a space
        self.heads: dict[str, bytes] = {}  # of other parts
        kind = type(self.library.pre_tokenizer).__name__
        self.cuts = kind == "ByteLevel" and self.library.normalizer is None and not self.library.pre_tokenizer.add_prefix_space
        vocabulary = self.library.get_vocab()
        self.spelled = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.spelled[i] = len(token)  # a letter of a token stands for a byte

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32).tobytes() for x in found]

    def _learn(self, missing: list[str]) -> None:
        joined = [p for p in missing if p and not p[0].isspace()]
        single = [p for p in missing if not p or p[0].isspace()]
        self.parts.update(zip(single, self._ids([" " + p for p in single])))
        groups = [joined[i : i + 500] for i in range(0, len(joined), 500)]
        for group, raw in zip(groups, self._ids([" " + " ".join(g) for g in groups])):
            ids = np.frombuffer(raw, dtype=np.uint32)
            ends = np.cumsum([len(p.encode()) + 1 for p in group])
            to = 4 * np.searchsorted(np.cumsum(self.spelled[ids]), ends, side="right")
            marks = [0, *to.tolist()]
            self.parts.update((p, raw[x:y]) for p, x, y in zip(group, marks, marks[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if max(len(self.parts), len(self.heads)) >= KEPT_PARTS:
            self.parts.clear()
            self.heads.clear()
        plans: list[tuple[str, list[bytes | None], list[tuple[int, str]]] | None] = []
        missing: dict[str, None] = {}
        get = self.parts.get
        for text in texts:
            if not self.cuts or any(a in text for a in self.added):
                plans.append(None)
                continue
            if _LOOSE.search(text):
                head, *parts = _CUT.split(text)
                parts = [p[1:] for p in parts]
            else:
                head, *parts = text.split(" ")
            found = list(map(get, parts))
            gaps = [(i, parts[i]) for i, got in enumerate(found) if got is None] if None in found else []
            missing.update((p, None) for _, p in gaps)
            plans.append((head, found, gaps))
        if missing:
            self._learn(list(missing))
        if heads := [h for h in {p[0] for p in plans if p is not None} if h not in self.heads]:
            self.heads.update(zip(heads, self._ids(heads)))
        whole = iter(self._ids([t for t, plan in zip(texts, plans) if plan is None]))
        out = []
        for plan in plans:
            if plan is None:
                out.append(next(whole))
                continue
            head, found, gaps = plan
            for i, part in gaps:
                found[i] = self.parts[part]
            out.append(b"".join([self.heads[head], *found]))
        return out


@cache
def encoder(path: str) -> Encoder:
    """The encoder of a file, made once in each process."""
    return Encoder(path)


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> list[tuple[str, int]]:
    """Write the files; gives each one's address and how many ids stand before it, in order."""
    spark = docs.sparkSession
    fs, at = _filesystem(folder)
    fs.create_dir(at, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, number = encoder(path), TaskContext.get().partitionId()
        fs, at = _filesystem(folder)
        name = f"{number:08d}.s8b"
        attempt = f"{at}/.{name}.{uuid.uuid4().hex}"
        out, total = None, 0
        end = np.uint32(end_id).tobytes()
        held: list[tuple[int | None, bytes]] = []
        room = 0

        def flush() -> None:
            nonlocal total, room
            ids = np.frombuffer(b"".join(x for _, x in held), dtype="<u4")
            keys = np.array([k or 0 for k, _ in held], dtype=np.int64)
            nulls = np.array([k is None for k, _ in held])
            out.write(chunk_bytes(keys, nulls, np.array([len(x) // 4 for _, x in held], dtype=np.int64), ids))
            total += len(ids)
            room = 0
            held.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = [t or "" for t in part["text"].to_pylist()]
                out = out or fs.open_output_stream(attempt)
                for key, ids in zip(part["doc_id"].to_pylist(), own.encode(texts)):
                    held.append((key, ids + end))
                    room += len(ids) // 4 + 1
                    if room >= CHUNK_IDS:
                        flush()
        if out:
            if held:
                flush()
            out.close()
            fs.move(attempt, f"{at}/{name}")  # a repeated task writes the same again
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([total], pa.int64())], names=["name", "n"])

    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    files = sorted((r["name"], r["n"]) for r in dealt.mapInArrow(write, "name string, n long").collect())  # one row a file
    placed, before = [], 0
    for name, n in files:
        placed.append((f"{folder}/{name}", before))
        before += n
    return placed


def read_files(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    shape = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], shape)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch["uri"].to_pylist(), batch["start"].to_pylist()):
                fs, at = _filesystem(uri)
                with fs.open_input_stream(at) as stream:
                    for keys, nulls, lengths, ids in chunks(stream.read):
                        ends = np.cumsum(lengths)
                        raw = memoryview(ids.astype("<u4").tobytes())
                        marks = [0, *(4 * ends).tolist()]
                        crc = [zlib.crc32(raw[a:b]) for a, b in zip(marks, marks[1:])]
                        columns = (pa.array(keys, mask=nulls), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64()))
                        yield pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])

    listed = spark.createDataFrame(files, "uri string, start long").repartition(len(files))
    return listed.mapInArrow(read, shape)


def read_ids(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of one file."""
    fs, at = _filesystem(uri)
    with fs.open_input_stream(at) as stream:
        for keys, nulls, lengths, ids in chunks(stream.read):
            for key, null, part in zip(keys.tolist(), nulls.tolist(), np.split(ids, np.cumsum(lengths)[:-1])):
                yield (None if null else key), part
