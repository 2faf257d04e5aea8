"""Phrase collocations per language: phrases counted in burst tries, runs merged per prefix, scored in Spark.

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and into words `[^\\x20\\x09]+`. A word's
id is the 64-bit fingerprint of its bytes; that no two words share one is checked, and refused if so. A task
counts phrases in a trie for each language: the root leads from the first word's id to a hash container
of the words after it; a container of more than `burst` entries bursts into sixteen, by the lowest
four bits of the second word's id. When the trie holds more than `held` entries, whole subtrees, the
largest first, are spilled as sorted runs until half is left. A run belongs to a prefix partition, which its
first word's id and those four bits of the second name, so the subtrees of a frequent first word lie in
sixteen partitions. Runs of one partition meet in one task and are merged, sums of at most `held` entries at a time.

Phrases are counted in three passes: words; pairs of frequent words; then runs of three and four words
whose every pair is frequent. A phrase that occurs `min_count` times has only parts that do, so nothing is
lost. Tasks know the frequent parts by a bitmap of hashes with at most 2^27 bits (16 MB); a wrong hit in it
adds a phrase that its exact count drops again. Each pass writes its frequent phrases; cuts are
scored by joins on them, in decimals. The first `top` of a language are found among the first of each of its slices.

Defined results: a null or empty text has no words; a null `lang` is `und`; documents are counted as often as
they are repeated; a null or repeated doc_id makes no difference; a piece may be of any length. A language
without candidates, and an empty table, give no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mention_pulse.llm import common

UNKNOWN = "und"
SLICE = 1 << 20
MAX_BITS = 27
_DIGITS = np.uint64(15)
# fixed values: bytes that end a piece, and those between words
_CUTS = np.zeros(256, dtype=bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _CUTS.copy()
_APART[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Mining:
    """Parameters of the count and the report."""

    min_count: int = 30
    longest: int = 4
    inside_percent: int = 80
    scale: int = 2_000_000
    top: int = 2000
    burst: int = 4096
    held: int = 1 << 19


# ---- words and runs of words --------------------------------------------------------------------
def _keyed(ids: np.ndarray) -> np.ndarray:
    """Bytes of each row of word ids: the key of a phrase, its parts being slices of it."""
    return np.ascontiguousarray(ids.astype(">u8")).view(f"V{8 * ids.shape[1]}").ravel()


def _hash(ids: np.ndarray, lang: int) -> np.ndarray:
    """Hash of a language and each row of word ids."""
    h = np.full(len(ids), lang & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for i in range(ids.shape[1]):
        h = common.mix(h * np.uint64(0x9FB21C651E98DF25) + ids[:, i])
    return h


def _lang_seed(lang: str) -> int:
    data = np.frombuffer(lang.encode("utf-8", "replace") or b"\0", dtype=np.uint8)
    return int(common.fingerprints(data, np.array([0]), np.array([len(data)]))[0])


def _pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, begin and end of the words, their ids, and the number of the piece that each lies in."""
    data, starts = common.text_bytes(texts)
    data = common.LOWER[data]
    begin, end = common.word_bounds(data, starts, _APART)
    ids = common.fingerprints(data, begin, end)
    cuts = np.cumsum(_CUTS[data], dtype=np.int64)
    # a new piece after a cut and with each text
    piece = cuts[begin] + np.searchsorted(starts, begin, side="right") if len(begin) else begin
    return data, begin, end, ids, piece


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    for part in common.slices(batches, size=SLICE):
        langs = part["lang"].to_pylist()
        for lang in sorted(set(langs)):
            yield lang, part["text"].filter(pa.array([x == lang for x in langs]))


def _windows(ids: np.ndarray, piece: np.ndarray, size: int) -> np.ndarray:
    """Where `size` words of one piece follow each other."""
    n = len(ids) - size + 1
    return np.flatnonzero(piece[: max(n, 0)] == piece[size - 1 :]) if n > 0 else np.zeros(0, np.int64)


def _stacked(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    return np.stack([ids[at + i] for i in range(size)], axis=1)


class Bitmap:
    """Hashes of frequent phrases as bits: what is not in it is not frequent."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.bits = np.uint64(64 - bits), words.view(np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


# ---- the trie -----------------------------------------------------------------------------------
class Trie:
    """Counts of phrases of one length: first word id -> container, or sixteen containers once burst."""

    def __init__(self, size: int, burst: int):
        self.size, self.burst = size, burst
        self.rest = 8 * (size - 1)
        self.root: dict[int, Counter | list[Counter]] = {}
        self.entries = 0

    def add(self, ids: np.ndarray) -> None:
        """Count rows of word ids."""
        if not len(ids):
            return
        first = ids[:, 0]
        if not self.rest:
            values, n = np.unique(first, return_counts=True)
            for value, count in zip(values.tolist(), n.tolist()):
                held = self.root.setdefault(value, Counter())
                self.entries += not held
                held[b""] += count
            return
        order = np.argsort(first, kind="stable")
        ids = ids[order]
        rests = _keyed(ids[:, 1:]).tolist()
        begin = np.flatnonzero(np.append(True, ids[1:, 0] != ids[:-1, 0]))
        heads = ids[begin, 0].tolist()
        for head, a, b in zip(heads, begin.tolist(), [*begin[1:].tolist(), len(ids)]):
            self._count(head, rests[a:b])

    def _count(self, head: int, rests: list[bytes]) -> None:
        node = self.root.get(head)
        if node is None:
            node = self.root[head] = Counter()
        if isinstance(node, list):
            for rest in rests:
                child = node[rest[7] & 15]  # lowest four bits of the second word's id
                before = len(child)
                child[rest] += 1
                self.entries += len(child) - before
            return
        before = len(node)
        node.update(rests)
        self.entries += len(node) - before
        if len(node) > self.burst:
            children = [Counter() for _ in range(16)]
            for rest, n in node.items():
                children[rest[7] & 15][rest] = n
            self.root[head] = children

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take whole subtrees out, the largest first, until at most `keep` entries are left."""
        weight = {h: sum(map(len, n)) if isinstance(n, list) else len(n) for h, n in self.root.items()}
        heads, rests, counts, sizes = [], [], [], []
        for head in sorted(weight, key=weight.get, reverse=True):
            if self.entries <= keep:
                break
            node = self.root.pop(head)
            self.entries -= weight[head]
            for container in node if isinstance(node, list) else (node,):
                heads.append(head)
                sizes.append(len(container))
                rests.append(b"".join(container))
                counts.append(np.fromiter(container.values(), np.int64, len(container)))
        if heads:
            first = np.repeat(np.array(heads, dtype=np.uint64), sizes)[:, None]
            n = len(first)
            others = np.frombuffer(b"".join(rests), dtype=">u8").reshape(n, self.size - 1).astype(np.uint64)
            yield np.hstack([first, others]), np.concatenate(counts)


def _sorted_sum(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ids in order, each once, with the sum of its counts."""
    if not len(ids):
        return ids, n
    order = np.lexsort(ids.T[::-1])
    ids, n = ids[order], n[order]
    begin = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1)))
    return ids[begin], np.add.reduceat(n, begin)


def partition_of(ids: np.ndarray, lang: int, partitions: int) -> np.ndarray:
    """Prefix partition: by language, first word and four bits of the second."""
    head = ids[:, :1]
    if ids.shape[1] > 1:
        head = np.hstack([head, ids[:, 1:2] & _DIGITS])
    return (_hash(head, lang) % np.uint64(partitions)).astype(np.int32)


_RUN = "part int, lang string, size int, run binary"


def _runs(lang: str, ids: np.ndarray, n: np.ndarray, partitions: int) -> Iterator[pa.RecordBatch]:
    """A spill as sorted runs, one row for each prefix partition: ids column by column, then counts."""
    part = partition_of(ids, _lang_seed(lang), partitions)
    order = np.lexsort((*ids.T[::-1], part))
    ids, n, part = ids[order], n[order], part[order]
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = np.append(begin[1:], len(part))
    blobs = [ids[a:b].T.tobytes() + n[a:b].tobytes() for a, b in zip(begin.tolist(), ends.tolist())]
    rows = len(begin)
    columns = [pa.array(part[begin]), pa.array([lang] * rows, pa.string()), pa.array([ids.shape[1]] * rows, pa.int32()),
               pa.array(blobs, pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["part", "lang", "size", "run"])


def _unpacked(run: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(run) // (8 * (size + 1))
    whole = np.frombuffer(run, dtype=np.uint64).reshape(size + 1, n)
    return whole[:size].T, whole[size].view(np.int64)


_COUNTED = "lang string, size int, key binary, n long, hash long"


def _merged(min_count: int, held: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sum up the runs of each partition, language and length, which come one after another."""
        now: tuple | None = None
        ids: list[np.ndarray] = []
        n: list[np.ndarray] = []
        waiting = 0

        def close() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            keys, sums = _sorted_sum(np.concatenate(ids), np.concatenate(n))
            lang, size = now[1], now[2]
            if size == 1:  # all occurrences, for the total
                yield _counted_rows(lang, 0, [b""], sums.sum()[None], np.zeros(1, np.uint64))
            often = sums >= min_count
            keys, sums = keys[often], sums[often]
            if len(keys):
                yield _counted_rows(lang, size, [k.tobytes() for k in _keyed(keys)], sums, _hash(keys, _lang_seed(lang)))

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["part"], row["lang"], row["size"])
                if key != now:
                    yield from close()
                    now, ids, n, waiting = key, [], [], 0
                more, counts = _unpacked(row["run"], row["size"])
                ids.append(more)
                n.append(counts)
                waiting += len(counts)
                if waiting > held:
                    total = _sorted_sum(np.concatenate(ids), np.concatenate(n))
                    ids, n = [total[0]], [total[1]]
                    waiting = 0
        yield from close()

    return merge


def _counted_rows(lang: str, size: int, keys: list[bytes], n: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    rows = len(keys)
    columns = [pa.array([lang] * rows, pa.string()), pa.array([size] * rows, pa.int32()), pa.array(keys, pa.binary()),
               pa.array(n, pa.int64()), pa.array(h.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "size", "key", "n", "hash"])


def _gather(sizes: tuple[int, ...], rules: Mining, partitions: int, known=None):
    """Runs of the phrases of some lengths; `known` holds the frequent words, or the frequent pairs."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[tuple[str, int], Trie] = {}
        entries = 0
        for lang, texts in _by_language(batches):
            _, _, _, ids, piece = _pieces(texts)
            seed = _lang_seed(lang)
            for size in sizes:
                at = _windows(ids, piece, size)
                if known is not None and len(at):
                    part = 1 if size == 2 else 2  # words of a pair, pairs of a longer run
                    fine = np.zeros(len(ids), dtype=bool)
                    places = _windows(ids, piece, part)
                    fine[places] = known.value.has(_hash(_stacked(ids, places, part), seed))
                    for i in range(size - part + 1):
                        at = at[fine[at + i]]
                trie = tries.get((lang, size))
                if trie is None:
                    trie = tries[lang, size] = Trie(size, rules.burst)
                before = trie.entries
                trie.add(_stacked(ids, at, size) if len(at) else np.zeros((0, size), np.uint64))
                entries += trie.entries - before
                if entries > rules.held:
                    for (name, _), full in tries.items():
                        for keys, n in full.spill(full.entries // 2):
                            yield from _runs(name, keys, n, partitions)
                    entries = sum(t.entries for t in tries.values())
        for (name, _), trie in tries.items():
            for keys, n in trie.spill(0):
                yield from _runs(name, keys, n, partitions)

    return gather


_WORDS = "lang string, key binary, word binary, last binary"


def _word_texts(known):
    """(lang, key, word) of the words that may be frequent, each once in a task as far as memory allows."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, set[int]] = {}
        for lang, texts in _by_language(batches):
            data, begin, end, ids, _ = _pieces(texts)
            values, first = np.unique(ids, return_index=True)
            often = known.value.has(_hash(values[:, None], _lang_seed(lang)))
            values, first = values[often], first[often]
            done = seen.setdefault(lang, set())
            fresh = [(v, i) for v, i in zip(values.tolist(), first.tolist()) if v not in done]
            if not fresh:
                continue
            words = [data[begin[i] : end[i]].tobytes() for _, i in fresh]
            keys = [v.to_bytes(8, "big") for v, _ in fresh]
            columns = [pa.array([lang] * len(fresh), pa.string()), pa.array(keys, pa.binary()), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, columns[-1]], names=["lang", "key", "word", "last"])
            done.update(v for v, _ in fresh)
            if sum(map(len, seen.values())) > 1 << 20:
                seen.clear()

    return gather


# ---- passes -------------------------------------------------------------------------------------
def _count(docs: DataFrame, sizes: tuple[int, ...], rules: Mining, folder: str, known=None) -> DataFrame:
    """Frequent phrases of some lengths, counted exactly, as a written table."""
    spark = docs.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = 8 * max(shuffled, 128)
    runs = docs.mapInArrow(_gather(sizes, rules, partitions, known), _RUN)
    # a run holds at most a few thousand entries, so few rows fill a batch
    met = runs.repartition("part").sortWithinPartitions("part", "lang", "size")
    return common.written(met.mapInArrow(_merged(rules.min_count, rules.held), _COUNTED), folder)


def bitmap(spark: SparkSession, phrases: DataFrame):
    """Broadcast bitmap of the phrases' hashes, of at most 2^MAX_BITS bits whatever their number."""
    bits = min(MAX_BITS, max(16, (32 * phrases.count()).bit_length()))
    at = F.shiftrightunsigned("hash", 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    rows = phrases.groupBy(F.shiftrightunsigned(at, 6).alias("place")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.int64)
    words[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return spark.sparkContext.broadcast(Bitmap(bits, words))


def frequent_phrases(docs: DataFrame, rules: Mining = Mining(), folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, size, key, n) of all phrases with `min_count` occurrences (size 0: all words), and (lang, key, word)."""
    spark = docs.sparkSession
    folder = folder or common.shared_folder(spark, "collocations")
    texts = docs.select(
        F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    )
    words = _count(texts, (1,), rules, f"{folder}/words")
    known = bitmap(spark, words.filter("size = 1"))
    named = texts.mapInArrow(_word_texts(known), _WORDS).groupBy("lang", "key").agg(F.min("word").alias("word"), F.max("last").alias("last"))
    named = common.written(named.join(words.filter("size = 1").select("lang", "key"), ["lang", "key"], "left_semi"), f"{folder}/names")
    clash = named.filter("word != last").first()
    if clash is not None:
        raise ValueError(f"two words share a fingerprint: {clash['word']!r}, {clash['last']!r}")
    found = words
    if rules.longest > 1:
        pairs = _count(texts, (2,), rules, f"{folder}/pairs", known)
        found = found.union(pairs)
        if rules.longest > 2:
            longer = tuple(range(3, rules.longest + 1))
            found = found.union(_count(texts, longer, rules, f"{folder}/longer", bitmap(spark, pairs)))
    return found.select("lang", "size", "key", "n"), named.select("lang", "key", "word")


def _part(first: int | str, words: int | str) -> str:
    return f"substring(key, 8 * ({first}) + 1, 8 * ({words}))"


def collocations(docs: DataFrame, rules: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the first `top` phrases of each language."""
    spark = docs.sparkSession
    folder = common.shared_folder(spark, "collocations")
    found, named = frequent_phrases(docs, rules, folder)
    candidates = found.filter("size >= 2").withColumnRenamed("n", "a")
    counts = found.filter("size >= 1")
    part = {side: counts.select(F.col("lang").alias(f"{side}_lang"), F.col("key").alias(f"{side}_key"), F.col("n").alias(side)) for side in "lr"}
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumn("left", F.expr(_part(0, "k"))).withColumn("right", F.expr(_part("k", "size - k")))
    cuts = cuts.join(part["l"], (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_key")))
    cuts = cuts.join(part["r"], (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_key")))
    exact = f"CAST({rules.scale} * CAST(a AS DECIMAL(19, 0)) AS DECIMAL(38, 0)) DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))"
    scored = cuts.withColumn("score", F.expr(exact).cast("long"))
    lowest = scored.groupBy("lang", "size", "key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # the count of the most frequent longer candidate around each, from the parts of all candidates
    parts = candidates.filter("size > 2").withColumn("m", F.explode(F.expr("sequence(2, size - 1)")))
    parts = parts.withColumn("at", F.explode(F.expr("sequence(0, size - m)"))).select(
        F.col("lang").alias("in_lang"), F.expr(_part("at", "m")).alias("in_key"), F.col("a").alias("longer")
    )
    around = parts.groupBy("in_lang", "in_key").agg(F.max("longer").alias("longer"))
    kept = lowest.join(around, (F.col("lang") == F.col("in_lang")) & (F.col("key") == F.col("in_key")), "left").filter(
        f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(19, 0)) < {rules.inside_percent} * CAST(a AS DECIMAL(19, 0))"
    )
    kept = kept.select("lang", "size", "key", "a", "cut.l", "cut.r", "cut.score")
    # only what may be among the first of its slice of the language needs its words
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = [F.desc("score"), F.desc("a")]
    ahead = Window.partitionBy("lang", "slice").orderBy(*best)
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices)))
    first = common.written(sliced.withColumn("place", F.rank().over(ahead)).filter(F.col("place") <= rules.top).drop("place"), f"{folder}/first")
    spelled = first.withColumn("at", F.explode(F.expr("sequence(0, size - 1)"))).withColumn("one", F.expr(_part("at", 1)))
    names = named.select(F.col("lang").alias("of_lang"), F.col("key").alias("of_key"), "word")
    spelled = spelled.join(names, (F.col("lang") == F.col("of_lang")) & (F.col("one") == F.col("of_key")))
    columns = ["lang", "slice", "key", "a", "l", "r", "score"]
    phrase = F.expr("array_join(transform(array_sort(collect_list(struct(at, word))), x -> decode(x.word, 'UTF-8')), ' ')")
    whole = spelled.groupBy(*columns).agg(phrase.alias("phrase"))
    best.append(F.asc("phrase"))
    by_slice = Window.partitionBy("lang", "slice").orderBy(*best)
    whole = whole.withColumn("place", F.row_number().over(by_slice)).filter(F.col("place") <= rules.top)
    by_lang = Window.partitionBy("lang").orderBy(*best)
    whole = whole.withColumn("rank", F.row_number().over(by_lang).cast("long")).filter(F.col("rank") <= rules.top)
    total = found.filter("size = 0").groupBy(F.col("lang").alias("all_lang")).agg(F.sum("n").alias("n"))
    return whole.join(total, F.col("lang") == F.col("all_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
