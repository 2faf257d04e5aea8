"""Language model in an Elias-Fano n-gram trie, and scores of texts by it.

Words have ids in the order of their fingerprints. A level holds all n-grams of one length as pairs of a
context (the place of the shorter n-gram in the level before) and a last word, in order; the place in
this order is the n-gram's own number. A level is cut into shards of bounded numbers of tokens, a context
with very many tokens into several. Each shard is a file of arrays that tasks map into memory:

* pointers: where each context's children begin, a monotone sequence in Elias-Fano coding;
* children: (context - first context) * V + word, monotone too, in Elias-Fano coding; a child is looked
  for between its context's pointers by the low parts, by which few children differ, and first inside its bucket
  where there are many (as its successor where the low parts do not tell words apart);
* quantised log10 probabilities of the n-grams, and for each context the quantised log10 weight with
  which the shorter context comes in.

Elias-Fano: of each value the low bytes are kept as they are, the rest as a row of bits, where every value
is a one behind as many zeros as its high part says. The low part is rounded up to whole bytes.

Smoothing is by interpolated absolute discounting: P(w|c) = (n(cw) - D) / n(c) + D t(c) / n(c) P(w|c'), with t(c)
distinct words behind c and D = n1 / (n1 + 2 n2) from the level's n-grams of count 1 and 2, down to (n(w) + 1) /
(N + V + 1). The end of the text before stands as context of a first word. Of a context that is cut over
several shards the sums are put together before probabilities are written.

Counts are summed up per task before they are dealt to shards, so a frequent word or n-gram is one row
of each task. All n-grams of all training texts are kept. Model files stay in the shared folder, and may be
written again by a task that is repeated.

Defined results: a null or empty text is one end token; a null doc_id counts as an empty one and is
trained on; without training texts every score is 0. Rows come back one for one. Other columns are not
looked at.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mention_pulse.llm import common

END = np.uint64(0x5BD1E995A5A5F00D)  # stands for the end of a text among the words
SHARD_TOKENS = 6_000_000
FLUSH = 3_000_000
SLICE_BYTES = 1 << 21  # many look-ups at once share the work of a shard
FLOOR = -16.0  # of quantised values
_STEP = -FLOOR / 65535


@dataclass(frozen=True)
class Model:
    """Where the levels are. Shards are told by first word fingerprint bits (level 1) or first keys."""

    folder: str
    order: int
    n_tokens: int
    n_words: int
    end_id: int
    bits: int
    word_starts: tuple[int, ...]  # first id of each shard of words
    levels: tuple["Shards", ...]


@dataclass(frozen=True)
class Shards:
    """A level's shards: their first context and word, and the place of their first n-gram."""

    contexts: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    split: np.ndarray  # contexts over several shards, and the log10 weight behind each
    behind: np.ndarray

    def begins(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where each shard's n-grams begin among these, which are in order (with the end of the last); a word of -1 is
        in its context's first shard."""
        out = np.searchsorted(context, self.contexts)
        for k in np.flatnonzero(self.words > 0):
            end = np.searchsorted(context, self.contexts[k], side="right")
            out[k] += np.searchsorted(word[out[k] : end], self.words[k])
        return np.append(out, len(context))

    def of_place(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1


# ---- Elias-Fano ----------------------------------------------------------------------------
SHORT_RANGE = 64  # values searched by their low parts without asking for a bucket
_ONE, _EACH, _TOPS = np.uint64(1), np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_PAIRS, _FOURS, _EIGHTS = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))


def _byte_places() -> np.ndarray:
    """Place of the k-th one in a byte b, at 256 k + b."""
    out = np.zeros(8 * 256, dtype=np.int64)
    for b in range(256):
        for k, place in enumerate(i for i in range(8) if b >> i & 1):
            out[256 * k + b] = place
    return out


_IN_BYTE = _byte_places()


def _planes_of(shift: int) -> list[tuple[int, int]]:
    """First bit and bytes of the arrays that hold so many low bits."""
    out, at = [], 0
    for size in (4, 4, 2, 1):
        if shift - at >= 8 * size:
            out.append((at, size))
            at += 8 * size
    return out


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """Place of the k-th one or zero (from 0); before: ones or zeros in front of each word."""
    at = np.searchsorted(before, k, side="right") - 1
    word = words[at] if ones else ~words[at]
    rest = (k - before[at]).astype(np.uint64)
    count = word - ((word >> np.uint64(1)) & _PAIRS)
    count = (count & _FOURS) + ((count >> np.uint64(2)) & _FOURS)
    count = ((count + (count >> np.uint64(4))) & _EIGHTS) * _EACH  # byte i: ones in the bytes up to i
    byte = np.bitwise_count(((rest * _EACH) | _TOPS) - count & _TOPS).astype(np.uint64)  # bytes that end before the k-th
    shift = byte << np.uint64(3)
    rest -= ((count << np.uint64(8)) >> shift) & np.uint64(255)
    return at * 64 + shift.astype(np.int64) + _IN_BYTE[(rest << np.uint64(8)) | ((word >> shift) & np.uint64(255))]


def _next(words: np.ndarray, before: np.ndarray, place: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """Place of the one or zero after the k-th, which is at `place`; most lie in the same word."""
    word = words[place >> 6]
    rest = (word if ones else ~word) >> (place & 63).astype(np.uint64) >> _ONE
    out = place + 1 + np.bitwise_count(~rest & (rest - _ONE))
    far = np.flatnonzero(rest == 0)
    if len(far):
        out[far] = _select(words, before, k[far] + 1, ones)
    return out


class EliasFano:
    """A sequence of values that never fall."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str, shift: int, n: int):
        self.n, self.shift = n, shift
        self.low = [(8 * size, arrays[f"{name}.low{at}"]) for at, size in _planes_of(shift)][::-1]
        self.bits = arrays[f"{name}.bits"]
        self.ones = arrays[f"{name}.ones"]
        self.zeros = arrays[f"{name}.zeros"]

    @staticmethod
    def build(values: np.ndarray, universe: int, name: str) -> tuple[dict[str, np.ndarray], int]:
        n = len(values)
        shift = 8 * math.ceil(max(0.0, math.log2(max(1, universe) / max(1, n))) / 8)
        values = values.astype(np.uint64)
        arrays = {f"{name}.low{at}": (values >> np.uint64(at)).astype(f"u{size}") for at, size in _planes_of(shift)}
        high = (values >> np.uint64(shift)).astype(np.int64)
        size = n + (universe >> shift) + 2
        flags = np.zeros(-(-size // 64) * 64, dtype=bool)
        flags[high + np.arange(n)] = True
        bits = np.packbits(flags, bitorder="little").view(np.uint64)
        count = np.bitwise_count(bits).astype(np.int64)
        ones = np.cumsum(count) - count
        arrays |= {f"{name}.bits": bits, f"{name}.ones": ones, f"{name}.zeros": np.arange(len(bits)) * 64 - ones}
        return arrays, shift

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        return self._with_low(_select(self.bits, self.ones, i, True) - i, i)

    def between(self, first: int, end: int) -> np.ndarray:
        """The values at places first to end, read in a row."""
        if first >= end:
            return np.zeros(0, dtype=np.int64)
        a, b = (int(np.searchsorted(self.ones, x, side="right")) - 1 for x in (first, end - 1))
        place = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.bits[a : b + 1]).view(np.uint8), bitorder="little"))
        skip = first - int(self.ones[a])
        return self._with_low(64 * a + place[skip : skip + end - first] - np.arange(first, end), slice(first, end))

    def _with_low(self, out: np.ndarray, i: np.ndarray | slice) -> np.ndarray:
        for bits, low in self.low:
            out = (out << bits) | low[i]
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        return self._with_low(np.zeros(len(i), dtype=np.int64), i)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at places i and i + 1."""
        place = _select(self.bits, self.ones, i, True)
        after = _next(self.bits, self.ones, place, i, True)
        return self._with_low(place - i, i), self._with_low(after - i - 1, i + 1)

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values with this high part begin and end."""
        inner = np.maximum(high - 1, 0)
        place = _select(self.bits, self.zeros, inner, False)
        after = _next(self.bits, self.zeros, place, inner, False)
        return np.where(high > 0, place - inner, 0), np.where(high > 0, after - high, place)

    def _short_low(self, i: np.ndarray) -> np.ndarray:
        """Low parts in as few bytes as they take."""
        whole = np.uint32 if self.shift <= 32 else np.uint64
        if not self.low:
            return np.zeros(len(i), dtype=whole)
        out = self.low[0][1][i].astype(whole)
        for bits, low in self.low[1:]:
            out <<= whole(bits)
            out |= low[i]
        return out

    def child(self, base: np.ndarray, step: np.ndarray, bound: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted values base + step are there, and their places. The values in [begin, end) are those from
        base to base + bound, not included. Where so many differ in their low parts, short ranges are searched by these alone."""
        value = base + step
        equal = np.zeros(len(value), dtype=bool)
        if bound > 1 << self.shift:
            at, equal[:] = self.successor(value, begin, end)
            return at, equal
        whole = np.uint32 if self.shift <= 32 else np.uint64
        mask = whole((1 << self.shift) - 1)
        a, b = begin.copy(), end.copy()
        long = np.flatnonzero(end - begin > SHORT_RANGE)
        if len(long):  # the bucket of the value
            first, last = self._bucket((value[long] >> np.uint64(self.shift)).astype(np.int64))
            a[long] = np.maximum(first, a[long])
            b[long] = np.minimum(last, b[long])
        base, sought = base.astype(whole), step.astype(whole)
        live = np.flatnonzero(b - a > 1)
        left, right, low, own = a[live], b[live], base[live], sought[live]
        while len(live):  # the last one that is not larger
            mid = (left + right) >> 1
            larger = ((self._short_low(mid) - low) & mask) > own
            left, right = np.where(larger, left, mid), np.where(larger, mid, right)
            more = np.flatnonzero(right - left > 1)
            if 4 * len(more) < 3 * len(live):  # until then, those that are done stay as they are
                a[live] = left
                live, left, right, low, own = live[more], left[more], right[more], low[more], own[more]
            elif not len(more):
                break
        a[live] = left
        there = np.flatnonzero(a < b)
        equal[there] = ((self._short_low(a[there]) - base[there]) & mask) == sought[there]
        return a, equal

    def successor(self, value: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value that is not smaller, within [begin, end), and whether it is equal."""
        high = (value >> np.uint64(self.shift)).astype(np.int64)
        low = (value & np.uint64((1 << self.shift) - 1)).astype(np.int64)
        first, last = self._bucket(high)
        first = np.maximum(first, begin)
        stop = last if end is None else np.minimum(last, end)
        a, b = first, np.maximum(stop, first)
        live = np.flatnonzero(a < b)
        left, right, sought = a[live], b[live], low[live]
        while len(live):
            mid = (left + right) >> 1
            less = self._low(mid) < sought
            left, right = np.where(less, mid + 1, left), np.where(less, right, mid)
            more = left < right
            if not more.all():
                a[live] = left
                more = np.flatnonzero(more)
                live, left, right, sought = live[more], left[more], right[more], sought[more]
        inside = a < stop
        equal = inside.copy()
        equal[inside] = self._low(a[inside]) == low[inside]
        return a, equal


# ---- files ---------------------------------------------------------------------------------
def _write_arrays(uri: str, arrays: dict[str, np.ndarray], meta: dict) -> None:
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    places, at = {}, 0
    for name, array in arrays.items():
        places[name] = (str(array.dtype), at, len(array))
        at += -(-array.nbytes // 8) * 8
    head = json.dumps({"arrays": places, "meta": meta}).encode()
    head += b" " * (-(len(head) + 8) % 8)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for array in arrays.values():
            raw = np.ascontiguousarray(array).view(np.uint8)
            out.write(raw.data if len(raw) else b"")
            out.write(b"\0" * (-array.nbytes % 8))
    fs.move(attempt, path)


@lru_cache(maxsize=512)
def _read_arrays(uri: str) -> tuple[dict[str, np.ndarray], dict]:
    """Arrays of a file, mapped into memory where the shared folder is mounted."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        data = np.asarray(np.memmap(path, dtype=np.uint8, mode="r"))
    else:
        with fs.open_input_file(path) as stream:
            data = np.frombuffer(stream.read(), dtype=np.uint8)
    size = int(data[:8].view("<u8")[0])
    head = json.loads(bytes(data[8 : 8 + size]))
    arrays = {}
    for name, (dtype, at, n) in head["arrays"].items():
        begin = 8 + size + at
        arrays[name] = data[begin : begin + n * np.dtype(dtype).itemsize].view(dtype)
    return arrays, head["meta"]


def _quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((log10 - FLOOR) / _STEP), 0, 65535).astype(np.uint16)


def _value(code: np.ndarray) -> np.ndarray:
    return code * _STEP + FLOOR


# ---- look-ups ------------------------------------------------------------------------------
def _shard_order(shard: np.ndarray) -> np.ndarray:
    """Places in the order of shards, else as they are; short numbers are sorted by their digits."""
    return np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and the places of its queries."""
    order = _shard_order(shard)
    begin = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1])) if len(order) else []
    for a, b in zip(begin, [*begin[1:], len(order)]):
        yield int(shard[order[a]]), order[a:b]


def word_ids(model: Model, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id of each word, -1 for others, and its count in training."""
    coded = pa.array(h).dictionary_encode()
    distinct, where = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(distinct)  # in order, neighbours read the same parts of the file
    found = np.empty((2, len(order)), dtype=np.int64)
    found[:, order] = _distinct_ids(model, distinct[order])
    return found[0][where], found[1][where]


def _distinct_ids(model: Model, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = np.full(len(h), -1, dtype=np.int64), np.zeros(len(h), dtype=np.int64)
    if not model.n_words:
        return ids, counts
    shard = (h >> np.uint64(64 - model.bits)).astype(np.int64) if model.bits else np.zeros(len(h), np.int64)
    rest = np.uint64((1 << (64 - model.bits)) - 1)
    for k, mine in _by_shard(shard):
        start = model.word_starts[k]
        if model.word_starts[k + 1] == start:
            continue
        arrays, meta = _read_arrays(f"{model.folder}/1-{k}.trie")
        known = EliasFano(arrays, "words", meta["shift"], meta["n"])
        # the last bit of a fingerprint is left out of the sequence, and compared by itself
        at, equal = known.successor((h[mine] & rest) >> np.uint64(1))
        hit = np.flatnonzero(equal)
        found = at[hit]
        odd = (h[mine[hit]] & np.uint64(1)).astype(np.uint8)
        other = arrays["odd"][found] != odd
        if other.any():  # both words of a pair that differs in this bit may be there
            more = np.minimum(found + 1, meta["n"] - 1)
            same = (known.at(more) == known.at(found)) & (arrays["odd"][more] == odd) & (more > found)
            found = np.where(other & same, more, found)
            keep = ~other | same
            hit, found = hit[keep], found[keep]
        ids[mine[hit]] = start + found
        counts[mine[hit]] = arrays["counts"][found]
    return ids, counts


def _in_order(context: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of (context, word) pairs, words from -1 on, and which in this order differ from the one before."""
    bits = ((int(context.max()) + 1) * (n_words + 1)).bit_length()
    if bits > 64:
        order = np.lexsort((word, context))
        context, word = context[order], word[order]
        return order, np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1]))
    key = context.astype(np.uint64) * np.uint64(n_words + 1) + (word + 1).astype(np.uint64)
    room = len(key).bit_length()
    if bits + room <= 64:  # with its place behind it a key is sorted by itself
        key <<= np.uint64(room)
        key |= np.arange(len(key), dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << room) - 1)).astype(np.int64)
        key >>= np.uint64(room)
    else:
        order = np.argsort(key)
        key = key[order]
    return order, np.append(True, key[1:] != key[:-1])


def _there(arrays: dict, meta: dict, n_words: int, local: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a shard of n-grams (context in the shard, word), in order and each once, and which are there."""
    new = np.append(True, local[1:] != local[:-1])
    of_new = np.cumsum(new) - 1
    pointers = EliasFano(arrays, "pointers", meta["pointer_shift"], meta["contexts"] + 1)
    begin, end = (x[of_new] for x in pointers.pair(local[np.flatnonzero(new)]))
    children = EliasFano(arrays, "children", meta["shift"], meta["n"])
    base = local.astype(np.uint64) * np.uint64(n_words)
    at, equal = children.child(base, np.maximum(word, 0).astype(np.uint64), n_words, begin, end)
    return at, equal & (word >= 0)


def _find(
    model: Model, level: int, context: np.ndarray, word: np.ndarray, probs: bool = True, weights: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Place of each n-gram of a level, -1 for others; with `probs`, its log10 probability, and with `weights`, of
    others the log10 weight behind their context."""
    place, value = np.full(len(word), -1, dtype=np.int64), np.zeros(len(word))
    shards = model.levels[level - 2] if len(model.levels) > level - 2 else None
    known = np.flatnonzero(context >= 0)
    if shards is None or not len(known):
        return place, value
    order, first = _in_order(context[known], word[known], model.n_words)
    known = known[order]
    once = known[np.flatnonzero(first)]  # each n-gram is looked up once
    asked, last = context[once], word[once]
    own, worth = np.full(len(once), -1, dtype=np.int64), np.zeros(len(once))
    begins = shards.begins(asked, last)
    for k in np.flatnonzero((np.diff(begins) > 0) & (shards.sizes > 0)).tolist():
        arrays, meta = _read_arrays(f"{model.folder}/{level}-{k}.trie")
        a, b = int(begins[k]), int(begins[k + 1])
        b = a + int(np.searchsorted(asked[a:b], meta["first"] + meta["contexts"]))
        if a == b:
            continue
        local = asked[a:b] - meta["first"]
        at, equal = _there(arrays, meta, model.n_words, local, last[a:b])
        there = np.flatnonzero(equal)
        own[a + there] = int(shards.starts[k]) + at[there]
        if probs:
            scores, _ = _read_arrays(f"{model.folder}/{level}-{k}.prob")
            worth[a + there] = _value(scores["prob"][at[there]])
            if weights:
                lost = np.flatnonzero(~equal)
                worth[a + lost] = _value(scores["behind"][local[lost]])
    if probs and weights and len(shards.split):
        at = np.minimum(np.searchsorted(shards.split, asked), len(shards.split) - 1)
        worth = np.where((shards.split[at] == asked) & (own < 0), shards.behind[at], worth)
    back = np.cumsum(first) - 1
    place[known], value[known] = own[back], worth[back]
    return place, value


def _last_words(model: Model, level: int, place: np.ndarray) -> np.ndarray:
    """Last word of n-grams by their place."""
    word = np.zeros(len(place), dtype=np.int64)
    shards = model.levels[level - 2]
    for k, mine in _by_shard(shards.of_place(place)):
        arrays, meta = _read_arrays(f"{model.folder}/{level}-{k}.trie")
        at = place[mine] - int(shards.starts[k])
        word[mine] = EliasFano(arrays, "children", meta["shift"], meta["n"]).at(at) % model.n_words
    return word


def _unigram(model: Model, counts: np.ndarray) -> np.ndarray:
    return np.log10((counts + 1) / (model.n_tokens + model.n_words + 1))


def _counts_of_words(model: Model, ids: np.ndarray) -> np.ndarray:
    """Counts of known words by id."""
    out = np.zeros(len(ids), dtype=np.int64)
    for k, mine in _by_shard(np.searchsorted(np.array(model.word_starts), ids, side="right") - 1):
        out[mine] = _read_arrays(f"{model.folder}/1-{k}.trie")[0]["counts"][ids[mine] - model.word_starts[k]]
    return out


@dataclass
class Tokens:
    """Tokens of some texts in a row: fingerprints, and where each text begins (with the end of the last)."""

    h: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> "Tokens":
        h, at = common.word_hashes(column)
        ends = at[1:] + np.arange(1, len(at))
        out = np.empty(len(h) + len(ends), dtype=np.uint64)
        is_end = np.zeros(len(out), dtype=bool)
        is_end[ends - 1] = True
        out[is_end], out[~is_end] = END, h
        return cls(out, np.append(0, ends))

    def past(self, level: int) -> np.ndarray:
        """Which tokens have a context for n-grams of this level."""
        where = np.arange(len(self.h)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        return where >= level - 2

    def shifted(self, values: np.ndarray, level: int, end_id: int) -> np.ndarray:
        """The context of each token: what the token before it has, -1 where there is none."""
        out = np.full(len(values), -1, dtype=np.int64)
        out[1:] = values[:-1]
        if level == 2:
            out[self.starts[:-1]] = end_id
        else:
            out[~self.past(level)] = -1
        return out


def _scores(model: Model, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: log10 probability by the model and by counts alone, count in training."""
    ids, counts = word_ids(model, tokens.h)
    base = _unigram(model, counts)
    score, place = base.copy(), ids
    for level in range(2, model.order + 1):
        context = tokens.shifted(place, level, model.end_id)
        place, value = _find(model, level, context, ids)
        score = np.where(place >= 0, value, score + value)
    return score, base, counts


# ---- building ------------------------------------------------------------------------------
def _planes(values: np.ndarray) -> bytes:
    """Sorted values as differences, byte after byte: what is zero goes together."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unplaned(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")  # the keys are sorted runs
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begin], np.add.reduceat(counts, begin)


_PARTS = "shard long, keys binary, counts binary"


def _parts(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of summed counts; keys sorted within shards."""
    begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    for a, b in zip(begin, [*begin[1:], len(shard)]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(shard[a])]), pa.array([_planes(keys[a:b])]), pa.array([_planes(np.cumsum(counts[a:b].astype(np.uint64)))])],
            names=["shard", "keys", "counts"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shard by shard: all keys, sorted, and their counts."""
    shard, held, room = None, [], 0

    def folded() -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

    for batch in batches:
        for row in range(batch.num_rows):
            k = batch["shard"][row].as_py()
            if shard is not None and k != shard:
                yield (shard, *folded())
                held, room = [], 0
            shard = k
            keys = _unplaned(batch["keys"][row].as_py())
            held.append((keys, np.diff(_unplaned(batch["counts"][row].as_py()).astype(np.int64), prepend=0)))
            room += len(keys)
            if room > 2 * len(held[0][0]) + FLUSH:
                held = [folded()]
                room = len(held[0][0])
    if shard is not None:
        yield (shard, *folded())


def _dealt(parts: DataFrame, shards: int) -> DataFrame:
    return parts.repartition(shards, "shard").sortWithinPartitions("shard")


def _counted_words(docs: DataFrame, bits: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        fresh: list[np.ndarray] = []

        def fold() -> None:
            keys, n = np.unique(np.concatenate(fresh), return_counts=True)
            held.append((keys, n))
            fresh.clear()
            if len(held) > 1:
                both = _summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
                held[:] = [both]

        def flush() -> Iterator[pa.RecordBatch]:
            (keys, n), = held
            held.clear()
            shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            yield from _parts(shard, keys, n)

        for part in common.slices(batches, size=SLICE_BYTES):
            fresh.append(Tokens.of(part["text"]).h)
            if sum(map(len, fresh)) >= FLUSH:
                fold()
                if len(held[0][0]) >= FLUSH:
                    yield from flush()
        if fresh:
            fold()
        if held:
            yield from flush()

    return docs.mapInArrow(count, _PARTS)


def _cuts(first: int, counts: np.ndarray, size: int, n_words: int) -> tuple[list[int], list[int]]:
    """First keys (context, word) of shards of about `size` tokens each, for contexts from `first` on."""
    contexts, words = [first], [0]
    room = 0
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        to = int(np.searchsorted(ends, room + size, side="right"))
        if to > at:
            at = to
        else:  # one context with more than a shard's tokens: cut by words
            pieces = -(-int(counts[at]) // size)
            for p in range(1, pieces):
                contexts.append(first + at)
                words.append(p * n_words // pieces)
            at += 1
        if at < len(counts):
            contexts.append(first + at)
            words.append(0)
            room = int(ends[at - 1])
    return contexts, words


def _written_words(parts: DataFrame, folder: str, shards: int, bits: int) -> list[dict]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, h, counts in _merged(batches):
            rest = h & np.uint64((1 << (64 - bits)) - 1)
            arrays, shift = EliasFano.build(rest >> np.uint64(1), 1 << (63 - bits), "words")
            arrays |= {"odd": (rest & np.uint64(1)).astype(np.uint8), "counts": counts.astype(np.int64)}
            _write_arrays(f"{folder}/1-{shard}.trie", arrays, {"shift": shift, "n": len(h)})
            there = np.searchsorted(h, END)
            end_at = int(there) if there < len(h) and h[there] == END else -1
            yield pa.RecordBatch.from_pylist([{"shard": shard, "n": len(h), "total": int(counts.sum()), "end_at": end_at}])

    rows = _dealt(parts, shards).mapInArrow(write, "shard long, n long, total long, end_at long")
    return [r.asDict() for r in rows.collect()]  # a row for each shard


def _level_cuts(spark: SparkSession, model: Model, level: int, size: int) -> Shards:
    """Where to cut the next level, from the counts of this one; each shard of this level is cut by itself."""
    spark_rows = len(model.word_starts) - 1 if level == 1 else len(model.levels[level - 2].starts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch["k"].to_pylist():
                if level == 1:
                    if model.word_starts[k] == model.word_starts[k + 1]:
                        continue
                    first = model.word_starts[k]
                    counts = _read_arrays(f"{model.folder}/1-{k}.trie")[0]["counts"]
                else:
                    if not model.levels[level - 2].sizes[k]:
                        continue
                    first = int(model.levels[level - 2].starts[k])
                    counts = _counts(_read_arrays(f"{model.folder}/{level}-{k}.trie")[0])
                contexts, words = _cuts(first, np.asarray(counts), size, model.n_words)
                yield pa.RecordBatch.from_arrays([pa.array(contexts), pa.array(words)], names=["context", "word"])

    tasks = max(1, min(spark_rows, spark.sparkContext.defaultParallelism * 4))
    rows = spark.range(0, spark_rows, 1, tasks).withColumnRenamed("id", "k").mapInArrow(cut, "context long, word long").collect()
    first = sorted((r["context"], r["word"]) for r in rows)  # about a row for each `size` tokens
    none = np.zeros(len(first), dtype=np.int64)
    return Shards(np.array([c for c, _ in first], dtype=np.int64), np.array([w for _, w in first], dtype=np.int64), none, none, none[:0], none[:0])


def _tallied(context: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, in order, and how often it is there."""
    if (int(context.max()) + 1) * n_words <= 1 << 64:  # as one number a pair is sorted by itself
        key = context.astype(np.uint64) * np.uint64(n_words) + word.astype(np.uint64)
        key.sort()
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        context, word = (x.astype(np.int64) for x in np.divmod(key[begin], np.uint64(n_words)))
        return context, word, np.diff(np.append(begin, len(key)))
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    begin = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])))
    return context[begin], word[begin], np.diff(np.append(begin, len(order)))


def _counted_ngrams(docs: DataFrame, model: Model, level: int, shards: Shards) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((model, shards))  # bounds of shards only

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shards = sent.value
        contexts, words = [], []

        def flush() -> Iterator[pa.RecordBatch]:
            context, word = np.concatenate(contexts), np.concatenate(words)
            contexts.clear()
            words.clear()
            context, word, counts = _tallied(context, word, model.n_words)
            shard = np.repeat(np.arange(len(shards.contexts)), np.diff(shards.begins(context, word)))
            key = (context - shards.contexts[shard]).astype(np.uint64) * np.uint64(model.n_words) + word.astype(np.uint64)
            yield from _parts(shard, key, counts)

        for part in common.slices(batches, size=SLICE_BYTES):
            tokens = Tokens.of(part["text"])
            ids, _ = word_ids(model, tokens.h)
            place = ids
            for k in range(2, level + 1):
                context = tokens.shifted(place, k, model.end_id)
                if k < level:
                    place, _ = _find(model, k, context, ids, probs=False)
            there = np.flatnonzero(context >= 0)
            contexts.append(context[there])
            words.append(ids[there])
            if sum(map(len, words)) >= FLUSH:
                yield from flush()
        if any(map(len, words)):
            yield from flush()

    return docs.mapInArrow(count, _PARTS)


def _counts(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Counts of a shard's n-grams: a byte each, those that need more besides."""
    out = arrays["counts"].astype(np.int64)
    out[arrays["large_at"]] = arrays["large"]
    return out


_SHARD = "shard long, n long, ones long, twos long, first long, first_t long, first_n long, last long, last_t long, last_n long"


def _written_level(parts: DataFrame, model: Model, level: int, shards: Shards) -> Model:
    """Write a level's shards: first the n-grams with their counts, then, with all sums known, what they weigh."""
    spark = parts.sparkSession
    sent = spark.sparkContext.broadcast((model, shards))  # addresses and bounds of shards only

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shards = sent.value
        for shard, keys, counts in _merged(batches):
            local = (keys // np.uint64(model.n_words)).astype(np.int64)
            first, contexts = int(shards.contexts[shard]), int(local[-1]) + 1
            begins = np.searchsorted(local, np.arange(contexts + 1))
            pointers, pointer_shift = EliasFano.build(begins, len(keys), "pointers")
            children, shift = EliasFano.build(keys, contexts * model.n_words, "children")
            large = np.flatnonzero(counts > 255)
            own = {"counts": np.minimum(counts, 255).astype(np.uint8), "large_at": large, "large": counts[large]}
            meta = {"first": first, "contexts": contexts, "n": len(keys), "shift": shift, "pointer_shift": pointer_shift}
            _write_arrays(f"{model.folder}/{level}-{shard}.trie", pointers | children | own, meta)
            row = {"shard": shard, "n": len(keys), "ones": int((counts == 1).sum()), "twos": int((counts == 2).sum())}
            for name, c in (("first", 0), ("last", contexts - 1)):
                a, b = int(begins[c]), int(begins[c + 1])
                row |= {name: first + c, f"{name}_t": b - a, f"{name}_n": int(counts[a:b].sum())}
            yield pa.RecordBatch.from_pylist([row])

    rows = _dealt(parts, len(shards.contexts)).mapInArrow(write, _SHARD).collect()  # a row for each shard
    sizes = np.zeros(len(shards.contexts), dtype=np.int64)
    sums: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        sizes[r["shard"]] = r["n"]
        for name in {("first"), ("last")} if r["first"] != r["last"] else {"first"}:
            sums.setdefault(r[name], []).append((r[f"{name}_t"], r[f"{name}_n"]))
    ones, twos = sum(r["ones"] for r in rows), sum(r["twos"] for r in rows)
    discount = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))
    whole = {c: (sum(t for t, _ in x), sum(n for _, n in x)) for c, x in sums.items() if len(x) > 1}
    split = np.array(sorted(whole), dtype=np.int64)
    behind = np.array([math.log10(discount * whole[c][0] / whole[c][1]) for c in split.tolist()])
    placed = Shards(shards.contexts, shards.words, np.cumsum(sizes) - sizes, sizes, split, behind)
    grown = Model(**{**model.__dict__, "levels": (*model.levels, placed)})
    known = spark.sparkContext.broadcast(grown)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in batches:
            for shard in batch["k"].to_pylist():
                if sizes[shard]:
                    _weigh(model, level, shard, discount, whole)
        yield from ()

    spark.range(0, len(sizes), 1, len(sizes)).withColumnRenamed("id", "k").mapInArrow(weigh, "k long").count()
    return grown


def _weigh(model: Model, level: int, shard: int, discount: float, whole: dict[int, tuple[int, int]]) -> None:
    """Write a shard's probabilities and the weights behind its contexts."""
    arrays, meta = _read_arrays(f"{model.folder}/{level}-{shard}.trie")
    counts = _counts(arrays)
    begins = EliasFano(arrays, "pointers", meta["pointer_shift"], meta["contexts"] + 1).between(0, meta["contexts"] + 1)
    distinct = np.diff(begins)
    total = np.append(0, np.cumsum(counts))
    in_all = total[begins[1:]] - total[begins[:-1]]
    for c, (t, n) in whole.items():
        if meta["first"] <= c < meta["first"] + meta["contexts"]:
            distinct[c - meta["first"]], in_all[c - meta["first"]] = t, n
    some = in_all > 0
    behind = np.zeros(len(in_all))
    behind[some] = np.log10(discount * distinct[some] / in_all[some])
    children = EliasFano(arrays, "children", meta["shift"], meta["n"])
    codes = []
    for at in range(0, meta["n"], 1 << 18):
        key = children.between(at, min(meta["n"], at + (1 << 18)))
        local, word = key // model.n_words, key % model.n_words
        if level == 2:
            shorter = _unigram(model, _counts_of_words(model, word))
        else:
            shorter = _find(model, level - 1, _last_words(model, level - 1, meta["first"] + local), word, weights=False)[1]
        own = (counts[at : at + len(key)] - discount) / in_all[local]
        codes.append(_quantised(np.log10(own + 10 ** (behind[local] + shorter))))
    _write_arrays(f"{model.folder}/{level}-{shard}.prob", {"prob": np.concatenate(codes), "behind": _quantised(behind)}, {})


# ---- the operator --------------------------------------------------------------------------
def train(docs: DataFrame, order: int = 3, shard_tokens: int = SHARD_TOKENS) -> Model:
    """A model of all texts of docs (column `text`), of n-grams up to `order` (1 to 3) words."""
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    spark = docs.sparkSession
    folder = common.shared_folder(spark, "ngram-trie")
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, n_bytes / (16 * shard_tokens)))))  # words are far fewer than tokens
    shards = sorted(_written_words(_counted_words(texts, bits), folder, 1 << bits, bits), key=lambda r: r["shard"])
    sizes = np.zeros(1 << bits, dtype=np.int64)
    for r in shards:
        sizes[r["shard"]] = r["n"]
    starts = np.append(0, np.cumsum(sizes))
    end_id = next((int(starts[r["shard"]]) + r["end_at"] for r in shards if r["end_at"] >= 0), -1)
    total = sum(r["total"] for r in shards)
    model = Model(folder, order, total, int(starts[-1]), end_id, bits, tuple(starts.tolist()), ())
    for level in range(2, order + 1 if total else 0):
        cuts = _level_cuts(spark, model, level - 1, shard_tokens)
        model = _written_level(_counted_ngrams(texts, model, level, cuts), model, level, cuts)
    return model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (and the columns of `keep`), n_tokens, n_known, train_tokens, base_score and score of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # addresses and bounds of shards only
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in common.slices(batches, size=SLICE_BYTES):
            tokens = Tokens.of(part["text"])
            by_model, base, counts = _scores(model, tokens)
            begin = tokens.starts[:-1]
            columns = [
                pa.array(np.diff(tokens.starts), pa.int64()),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64), begin)),
                pa.array(np.full(len(begin), model.n_tokens), pa.int64()),
                pa.array(np.add.reduceat(base, begin)),
                pa.array(np.add.reduceat(by_model, begin)),
            ]
            own = [part[c] for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*own, *columns], names=[*(c for c in part.schema.names if c != "text"), *names])

    picked = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))
    shape = picked.drop("text")
    for name in names:
        shape = shape.withColumn(name, F.lit(0).cast("double" if name.endswith("score") else "long"))
    return picked.mapInArrow(scored, shape.schema)


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def held_out_scores(docs: DataFrame, modulus: int = 7, held: int = 2, order: int = 3) -> DataFrame:
    """Scores of all documents by a model of those outside the fold `held`."""
    own = docs.select("doc_id", "text", (fold(modulus) == held).alias("held_out"))
    return score(own, train(own.filter("NOT held_out"), order), keep=("held_out",))
