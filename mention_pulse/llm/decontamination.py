"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most `window` words. Passages are weighted by TF-IDF, with
document frequencies from all documents, and a randomised SVD of the passage matrix, whose rows Spark
tasks hold, gives a latent space. Windows of every document are folded into it, of the few sizes that
hold passages of up to so many words wherever they begin. Those whose cosine to a
passage reaches `cosine` (less for a passage that is short for its window, as the words around it turn the
window away: times the root of its share of the words), and that hold `contained` of the passage's own length in its direction (windows of
a few common words point anywhere, but are short), are candidates. So are the windows where the passage's
rarest run of `min_words` words stands as it is: no verbatim copy depends on the latent space. A candidate's words
and half a window around are aligned with the passage by their longest common subsequence. A share of `same` or more is a leak; a share of `paraphrase` or more is one
if the passage's rarer words are there too (`weighted` of all its words' weight) and the item's answer (its
last sentence, or last quarter if there is but one) is found nearby.

The benchmark is the stated query set: it is searched in blocks of BLOCK items, one pass over the
documents each. Words are runs of letters, digits and other scripts, A-Z lower-cased; punctuation does
not count.

Defined results: null or empty texts and items, and items of fewer than `min_words` words, match
nothing. Repeated documents give repeated rows, an item that occurs twice in the benchmark a row for
each of its item_ids. With an empty benchmark nothing is a leak. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common

BLOCK = 5000
STRIDE = 8
BAND = 64  # passages that are compared at once
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_SEED = 20240
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Search:
    """Parameters; window is a multiple of STRIDE."""

    window: int = 32
    rank: int = 96
    oversample: int = 16
    power_rounds: int = 2
    cosine: float = 0.5
    contained: float = 0.4
    same: float = 0.7
    paraphrase: float = 0.5
    weighted: float = 0.6
    answer: float = 0.6
    min_words: int = 5


def _hashes(text: str) -> np.ndarray:
    return common.word_hashes(pa.array([text]), common.NOT_PLAIN)[0]


@dataclass(frozen=True)
class Item:
    item_id: object
    words: np.ndarray
    answer: np.ndarray


def _items(rows: list, how: Search) -> list[Item]:
    out = []
    for row in rows:
        words = _hashes(row["text"] or "")
        if len(words) >= how.min_words:
            answer = _hashes(_SENTENCE.split(row["text"].strip())[-1])
            if not 0 < len(answer) < len(words):
                answer = words[-max(3, len(words) // 4) :]
            out.append(Item(row["item_id"], words, answer))
    return out


def _passages(items: list[Item], window: int) -> list[tuple[int, np.ndarray]]:
    """(item, words) of each passage: whole items, or windows of half overlap with the last at the end."""
    out = []
    for i, item in enumerate(items):
        n = len(item.words)
        starts = sorted({*range(0, max(1, n - window + 1), window // 2), max(0, n - window)})
        out += [(i, item.words[s : s + window]) for s in starts]
    return out


def _span(length: int, window: int) -> int:
    """Blocks of the windows for passages of so many words."""
    return min(window // STRIDE, -(-(length - 1) // STRIDE) + 1)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of each `size` words in a row."""
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        rolled = rolled * _STEP + words[i : i + n]
    return common.mix(rolled)


def _document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each word of the benchmark occurs, and how many documents there are."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of one block of items

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.Membership(sent.value)
        n = len(sent.value)
        df, rows = np.zeros(n, dtype=np.int64), 0
        for part in common.slices(batches):
            h, at = common.word_hashes(part["text"], common.NOT_PLAIN)
            word = known.index(h)
            there = np.flatnonzero(word >= 0)
            text = np.repeat(np.arange(len(at) - 1), np.diff(at))[there]
            df += np.bincount(np.unique(text * n + word[there]) % n, minlength=n) if n else 0
            rows += part.num_rows
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], rows))], names=["word", "n"])

    found = docs.mapInArrow(gather, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in found}
    df = np.array([counts.get(i, 0) for i in range(len(vocabulary))], dtype=float)
    return df, counts.get(-1, 0)


def _vector(words: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector of length 1."""
    index, n = np.unique(words, return_counts=True)
    value = n * weight[index]
    return index, value / max(np.sqrt((value**2).sum()), 1e-12)


def _gram(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'A times a basis, A being the matrix of sparse rows: sums over tasks, block by block of terms."""
    sent = rows.sparkSession.sparkContext.broadcast(basis)
    block = 4096

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        total = np.zeros_like(q)
        for batch in batches:
            for index, value in zip(batch["index"], batch["value"]):
                i, v = (np.asarray(x.values) for x in (index, value))
                total[i] += np.outer(v, v @ q[i])
        for k in range(0, len(q), block):
            part = total[k : k + block]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()])], names=["block", "part"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in group["part"])
        return pa.table({"block": group["block"][:1], "part": pa.array([total.tobytes()])})

    out = np.zeros_like(basis)
    shape = "block long, part binary"
    for r in rows.mapInArrow(product, shape).groupBy("block").applyInArrow(add, shape).collect():
        part = np.frombuffer(r["part"]).reshape(-1, basis.shape[1])
        out[r["block"] : r["block"] + len(part)] = part
    return out


def latent_terms(rows: DataFrame, terms: int, how: Search) -> np.ndarray:
    """Right singular vectors (terms x rank) of the matrix of rows (index, value), by randomised SVD."""
    width = min(terms, how.rank + how.oversample)
    basis = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((terms, width)))[0]
    for _ in range(how.power_rounds):
        basis = np.linalg.qr(_gram(rows, basis))[0]
    inner = basis.T @ _gram(rows, basis)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(value)[::-1][: how.rank]
    best = best[value[best] > 1e-10 * max(value.max(), 1e-300)]
    return basis @ vector[:, best]


def common_subsequence(masks: dict[int, int], length: int, words: list[int], least: float = 0.0) -> int:
    """Longest common subsequence with the text of `masks` (positions of each word as bits); 0 where too few
    words are shared for a share of `least`."""
    shared = [m for m in map(masks.get, words) if m]
    if len(shared) < least * length:
        return 0
    full = (1 << length) - 1
    row = full
    for m in shared:
        both = row & m
        row = ((row + both) | (row - both)) & full
    return length - row.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Index:
    """What a task needs of a block of items; its size follows the block, not the documents."""

    how: Search
    items: list[Item]
    passages: list[tuple[int, np.ndarray]]
    vocabulary: np.ndarray
    terms: np.ndarray  # latent vector of each word, weighted
    latent: np.ndarray  # passages, of length 1
    length: np.ndarray  # of the passages in the latent space before that
    weight: np.ndarray  # inverse document frequency of each word

    def prepared(self) -> "Index":
        self.known = common.Membership(self.vocabulary)
        self.passage_masks = [_masks(w) for _, w in self.passages]
        self.answer_masks = [_masks(i.answer) for i in self.items]
        self.passage_weights = []
        for _, words in self.passages:
            distinct = np.unique(words)
            weight = self.weight[np.searchsorted(self.vocabulary, distinct)]
            self.passage_weights.append(dict(zip(distinct.tolist(), (weight / weight.sum()).tolist())))
        spans = np.array([_span(len(w), self.how.window) for _, w in self.passages])
        self.classes = {int(s): np.flatnonzero(spans == s) for s in np.unique(spans)}
        share = np.minimum(1.0, np.array([len(w) for _, w in self.passages]) / (spans * STRIDE))
        self.cosine = (self.how.cosine * np.sqrt(share)).astype(np.float32)
        self.anchors = {s: self._anchors(own) for s, own in self.classes.items()}
        return self

    def _anchors(self, own: np.ndarray) -> tuple[common.Membership, np.ndarray, np.ndarray, np.ndarray]:
        """Rarest run of each passage: distinct runs, where each one's passages begin, places in `own`, words before the run."""
        size = self.how.min_words
        runs, places, before = [], [], []
        for k, p in enumerate(own.tolist()):
            words = self.passages[p][1]
            weight = np.append(0.0, np.cumsum(self.weight[np.searchsorted(self.vocabulary, words)]))
            if len(words) >= size:
                j = int(np.argmax(weight[size:] - weight[:-size]))
                runs.append(_runs(words[j : j + size], size)[0])
                places.append(k)
                before.append(j)
        order = np.argsort(np.array(runs, dtype=np.uint64), kind="stable")
        keys, first = np.unique(np.array(runs, dtype=np.uint64)[order], return_index=True)
        ends = np.append(first, len(order)).astype(np.int64)
        return common.Membership(keys), ends, np.array(places, dtype=np.int64)[order], np.array(before, dtype=np.int64)[order]

    def _anchored(self, span: int, runs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where passages of a class would begin by their anchors: text, word, place in the class."""
        known, ends, places, before = self.anchors[span]
        run = known.index(runs)
        there = np.flatnonzero(run >= 0)
        text = np.searchsorted(at, there, side="right") - 1
        inside = there + self.how.min_words <= at[text + 1]
        there, text = there[inside], text[inside]
        first, n = ends[run[there]], ends[run[there] + 1] - ends[run[there]]
        each = np.repeat(np.arange(len(there)), n)
        of = first[each] + np.arange(len(each)) - (np.cumsum(n) - n)[each]
        return text[each], np.maximum(at[text[each]], there[each] - before[of]), places[of]

    def matches(self, column: pa.Array) -> list[dict]:
        """Leaks of a slice of texts: row, item, cosine, shares, kind and word bounds; the best for each row and item."""
        how = self.how
        h, at = common.word_hashes(column, common.NOT_PLAIN)
        if not len(h):
            return []
        term = self.known.index(h)
        known = np.flatnonzero(term >= 0)  # words that the benchmark has; others add nothing to a window
        lengths = np.diff(at)
        blocks = -(-lengths // STRIDE)
        first_block = np.append(0, np.cumsum(blocks))
        owner = np.repeat(np.arange(len(lengths)), blocks)
        begin = at[owner] + STRIDE * (np.arange(len(owner)) - first_block[owner])
        sums = self._block_sums(term[known], np.searchsorted(begin, known, side="right") - 1, len(owner))
        vectors = sums.copy()
        runs = _runs(h, how.min_words)
        words = (h[known], np.append(0, np.cumsum(term >= 0)))
        best: dict[tuple[int, int], dict] = {}
        for span in range(1, how.window // STRIDE + 1):
            if span > 1:
                same = owner[span - 1 :] == owner[: 1 - span]
                vectors[: 1 - span][same] += sums[span - 1 :][same]
            if span not in self.classes:
                continue
            own = self.classes[span]
            # windows that would begin in the last blocks of a text are parts of others, unless it is short
            whole = (np.arange(len(owner)) + span <= first_block[owner + 1]) | (np.arange(len(owner)) == first_block[owner])
            windows = np.flatnonzero(whole)
            norm = np.sqrt((vectors[windows] ** 2).sum(axis=1))
            found = self._near(vectors, windows, norm, own)
            text, start, place = self._anchored(span, runs, at)
            block = first_block[text] + (start - at[text]) // STRIDE
            block = np.minimum(block, np.maximum(first_block[text], first_block[text + 1] - span))
            pairs = np.unique(np.append(found, np.searchsorted(windows, block) * len(own) + place))
            window, place = pairs // len(own), pairs % len(own)
            cosines = np.einsum("ij,ij->i", vectors[windows[window]], self.latent[own[place]]) / np.maximum(norm[window], 1e-9)
            self._align(words, at, owner, begin, windows[window], own[place], cosines, span * STRIDE, best)
        return list(best.values())

    def _block_sums(self, term: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
        """Sum of the latent vectors of the words of each block; the first words of all blocks, then the second, and so on."""
        count = np.bincount(block, minlength=blocks)
        most = np.argsort(-count, kind="stable")
        first = (np.cumsum(count) - count)[most]
        out = np.zeros((blocks, self.terms.shape[1]), dtype=self.terms.dtype)
        for i, n in enumerate(np.searchsorted(-count[most], -np.arange(1, count.max(initial=0) + 1), side="right").tolist()):
            out[:n] += self.terms.take(term[first[:n] + i], axis=0)
        back = np.empty_like(most)
        back[most] = np.arange(blocks)
        return out.take(back, axis=0)

    def _near(self, vectors: np.ndarray, windows: np.ndarray, norm: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Pairs of near windows and passages of a class, as place of the window x passages + place of the passage.

        A window holds at most its own norm in any direction, so a band of passages of like lengths is compared
        with the windows only whose norm reaches what the shortest of them asks for.
        """
        falling = np.argsort(norm)[::-1]
        least = self.how.contained * self.length[own]
        by_length = np.argsort(least)
        enough = np.searchsorted(-norm[falling], -least[by_length] * np.float32(1 - 1e-5), side="right")
        falling = falling[: enough[0]]
        rows, size = vectors[windows[falling]], norm[falling]
        out = [np.zeros(0, dtype=np.int64)]
        for k in range(0, len(own), BAND):
            band, n = by_length[k : k + BAND], int(enough[k])
            near = rows[:n] @ self.latent[own[band]].T
            window, place = np.nonzero(near >= np.maximum(self.cosine[own[band]] * size[:n, None], least[band]))
            out.append(falling[window] * len(own) + band[place])
        return np.concatenate(out)

    def _align(self, words, at, owner, begin, blocks, passages, cosines, window: int, best: dict[tuple[int, int], dict]) -> None:
        """Align candidates (first block and passage of each) and keep the best for each row and item.

        `words`: the words that the benchmark has, and how many of them come before each word; others match nothing.
        """
        how = self.how
        h, before = words[0], words[1].tolist()
        for block, p, cosine in zip(*(x.tolist() for x in (blocks, passages, cosines))):
            row, start = int(owner[block]), int(begin[block])
            low, high = int(at[row]), int(at[row + 1])
            a, b = max(low, start - window // 2), min(high, start + window + window // 2)
            item, length = self.passages[p][0], len(self.passages[p][1])
            if before[b] - before[a] < how.paraphrase * length:
                continue
            region = h[before[a] : before[b]].tolist()
            share = common_subsequence(self.passage_masks[p], length, region, how.paraphrase) / length
            if share < how.paraphrase:
                continue
            there = set(region)
            if share < how.same and sum(x for word, x in self.passage_weights[p].items() if word in there) < how.weighted:
                continue
            around = h[before[max(low, a - 2 * how.window)] : before[min(high, b + 2 * how.window)]].tolist()
            answer = len(self.items[item].answer)
            answered = common_subsequence(self.answer_masks[item], answer, around) / answer
            if share < how.same and answered < how.answer:
                continue
            found = {
                "row": row,
                "item": item,
                "cosine": cosine,
                "lcs_share": share,
                "answer_share": answered,
                "kind": "same" if share >= how.same else "paraphrase",
                "first_word": a - low,
                "end_word": b - low,
            }
            old = best.get((row, item))
            if old is None or (share, round(cosine, 4)) > (old["lcs_share"], round(old["cosine"], 4)):  # else the first place
                best[row, item] = found


def _indexes(docs: DataFrame, benchmark: DataFrame, how: Search) -> Iterator[Index]:
    """An index for each block of items."""
    spark = docs.sparkSession
    own = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    parts = max(1, -(-own.count() // BLOCK))
    texts = docs.select(F.col("text").cast("string").alias("text"))
    for k in range(parts):
        block = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()  # about BLOCK items
        items = _items(block, how)
        if not items:
            continue
        passages = _passages(items, how.window)
        vocabulary = np.unique(np.concatenate([w for _, w in passages]))
        df, n = _document_frequencies(texts, vocabulary)
        weight = np.log((n + 1) / (df + 1)) + 0.01
        vectors = [_vector(np.searchsorted(vocabulary, w), weight) for _, w in passages]
        table = spark.createDataFrame([(i.tolist(), v.tolist()) for i, v in vectors], "index array<long>, value array<double>")
        rows = common.written(table.repartition(max(1, len(vectors) // 1000)), common.shared_folder(spark, "passages"))
        v = latent_terms(rows, len(vocabulary), how)
        terms = (v * weight[:, None]).astype(np.float32)
        latent = np.stack([(v[i] * x[:, None]).sum(axis=0) for i, x in vectors])
        share = np.maximum(np.sqrt((latent**2).sum(axis=1)), 1e-12)
        full = [np.sqrt(((np.unique(w, return_counts=True)[1] * weight[i]) ** 2).sum()) for (_, w), (i, _) in zip(passages, vectors)]
        latent = (latent / share[:, None]).astype(np.float32)
        yield Index(how, items, passages, vocabulary, terms, latent, (share * full).astype(np.float32), weight)


_KINDS = {"cosine": "double", "lcs_share": "double", "answer_share": "double", "kind": "string", "first_word": "long", "end_word": "long"}


def leaks(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """A row for each document and item it leaks: doc_id, item_id, cosine, shares, kind, words of the place."""
    spark = docs.sparkSession
    doc, item = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    shape = f"doc_id {doc}, item_id {item}, " + ", ".join(f"{k} {t}" for k, t in _KINDS.items())
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], shape)
    for index in _indexes(docs, benchmark, how):
        out = out.union(own.mapInArrow(_searches(spark.sparkContext.broadcast(index)), shape))
    return out


def _searches(sent):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value.prepared()
        for part in common.slices(batches):
            if found := index.matches(part["text"]):
                ids = part["doc_id"].take(pa.array([f["row"] for f in found]))
                items = pa.array([index.items[f["item"]].item_id for f in found])
                columns = [pa.array([f[k] for f in found]) for k in _KINDS]
                yield pa.RecordBatch.from_arrays([ids, items, *columns], names=["doc_id", "item_id", *_KINDS])

    return search


def without_leaks(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    out = docs
    for index in _indexes(docs, benchmark, how):
        out = out.mapInArrow(_keeps(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return out


def _keeps(sent):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value.prepared()
        for part in common.slices(batches):
            clean = np.ones(part.num_rows, dtype=bool)
            clean[[f["row"] for f in index.matches(part["text"])]] = False
            yield part.filter(pa.array(clean))

    return keep
