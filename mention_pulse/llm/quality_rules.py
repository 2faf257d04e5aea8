"""Quality rules: plain counts, and how far a text's make-up is from that of its language.

A text's characters fall into classes (by Unicode category, and letters beyond ASCII by script as well), and
its common words, of any length, are counted by their fingerprints; both histograms are compared
by Jensen-Shannon distance (base 2, so 0 to 1) to references taken from all texts of each language.
A text is near a reference if both distances are within their limits; it is rejected if it is near
none. Histograms of short texts say little, so the character test needs `min_chars` characters and
the word test `min_words` words; below, that test passes.

Defined results: a null or empty text has no words and fails the base rule. Texts of a null `lang` form
a language of their own. Languages with fewer than `min_reference` words in all give no reference;
with no reference at all, only the base rule decides. Words lie between ASCII white space, so in scripts
that put none between words the word test says little and the classes decide. Rows come back one for one, in any order; other
columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mention_pulse.llm import common

WINDOW = 8
HELD_WORDS = 1 << 20  # distinct words of a language that a task sums up before it hands them on
SCRIPTS = (
    *("LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "GEORGIAN", "HEBREW", "ARABIC", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI"),
    *("ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "THAI", "LAO", "TIBETAN", "MYANMAR", "KHMER"),
    *("ETHIOPIC", "HANGUL", "HIRAGANA", "KATAKANA", "CJK", "other script"),
)
CLASSES = (
    *("lower", "upper", "digit", "white", "stop", "mark", "other space"),
    *(f"{script} {kind}" for script in SCRIPTS for kind in ("letter", "upper", "sign")),
)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_CLASS = np.full(128, 5, dtype=np.int64)
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 2, 1, 0
_STARTS = np.ones(256, dtype=bool)  # bytes that begin a code point
_STARTS[128:192] = False
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Limits; a distance above its limit rejects."""

    min_total_words: int = 20
    max_repeat_percent: int = 30
    max_char_distance: float = 0.30
    max_word_distance: float = 0.50
    min_chars: int = 400
    min_words: int = 50
    common_words: int = 50
    min_reference: int = 1000


@cache
def _wide_classes() -> np.ndarray:
    """Class of each code point below 0x20000, and at the end of ideographs beyond and of all others."""
    out = np.full(0x20002, 5, dtype=np.int64)
    out[:128] = _CLASS
    kinds = {"N": 2, "P": 4, "Z": 6}
    for code in range(128, 0x20000):
        char = chr(code)
        category = unicodedata.category(char)
        if category[0] in "LM":
            name = unicodedata.name(char, "").removeprefix("FULLWIDTH ").removeprefix("HALFWIDTH ").split(" ")[0]
            script = SCRIPTS.index(name) if name in SCRIPTS else len(SCRIPTS) - 1
            out[code] = 7 + 3 * script + (2 if category[0] == "M" else 1 if category in ("Lu", "Lt") else 0)
        else:
            out[code] = kinds.get(category[0], 5)
    out[0x20000] = 7 + 3 * SCRIPTS.index("CJK")
    return out


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points that begin at these bytes, none of them ASCII."""
    code = data[at].astype(np.int64)
    size = 2 + (code >= 0xE0) + (code >= 0xF0)
    code &= 0x7F >> size
    for i in range(1, 4):
        more = size > i
        code[more] = (code[more] << 6) | (data[at[more] + i] & 0x3F)
    return code


def _classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Characters of each class, a row for each text."""
    first = np.flatnonzero(_STARTS[data])
    text = np.searchsorted(starts, first, side="right") - 1
    lead = data[first]
    kind = _CLASS[lead & 0x7F]
    wide = np.flatnonzero(lead >= 128)
    if len(wide):
        code = _code_points(data, first[wide])
        far = np.where((code >= 0x20000) & (code < 0x40000), 0x20000, 0x20001)
        kind[wide] = _wide_classes()[np.where(code < 0x20000, code, far)]
    flat = text * len(CLASSES) + kind
    return np.bincount(flat, minlength=(len(starts) - 1) * len(CLASSES)).reshape(-1, len(CLASSES))


_STATS = "lang string, is_word boolean, key long, n long"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task, per language: characters by class and words in all (key -1), words by fingerprint."""
    chars: dict[str | None, np.ndarray] = {}
    words: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
    totals: dict[str | None, int] = {}

    def folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
        return keys, n

    for part in common.slices(batches):
        data, starts = common.text_bytes(part["text"])
        begin, end = common.word_bounds(data, starts, common.WHITE)
        at = np.searchsorted(begin, starts)
        key = common.fingerprints(data, begin, end).view(np.int64)
        histogram, n_words = _classes(data, starts), np.diff(at)
        owner = np.repeat(np.arange(len(n_words)), n_words)
        langs = np.array(part["lang"].to_pylist(), dtype=object)
        for lang in set(langs.tolist()):
            mine = np.array([x == lang for x in langs])
            chars[lang] = chars.get(lang, 0) + histogram[mine].sum(axis=0)
            totals[lang] = totals.get(lang, 0) + int(n_words[mine].sum())
            keys, n = np.unique(key[mine[owner]], return_counts=True)
            held = words.setdefault(lang, [])
            held.append((keys, n))
            if len(held) >= 64:
                words[lang] = [folded(held)]
                if len(words[lang][0][0]) > HELD_WORDS:
                    yield _stats_rows(lang, True, *words[lang].pop())
    for lang in chars:
        yield _stats_rows(lang, False, np.append(np.arange(len(CLASSES)), -1), np.append(chars[lang], totals[lang]))
        if words[lang]:
            yield _stats_rows(lang, True, *folded(words[lang]))


def _stats_rows(lang: str | None, is_word: bool, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(keys)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * size, pa.string()), pa.array([is_word] * size, pa.bool_()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())],
        names=["lang", "is_word", "key", "n"],
    )


@dataclass(frozen=True)
class References:
    """Per language: shares of the classes, its common words (sorted keys) and their shares, the rest last."""

    chars: tuple[np.ndarray, ...]
    words: tuple[tuple[np.ndarray, np.ndarray], ...]


def references(docs: DataFrame, rules: Rules = Rules()) -> References:
    """References from all texts; what comes to the driver is a few numbers for each language."""
    counted = (
        docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_gather, _STATS)
        .groupBy("lang", "is_word", "key")
        .agg(F.sum("n").alias("n"))
    )
    # the most frequent words; the classes and the total, which are fewer than the limit, all stay
    order = Window.partitionBy("lang", "is_word").orderBy(F.col("n").desc(), "key")
    limit = max(rules.common_words, len(CLASSES) + 1)
    kept = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    by_lang: dict[str | None, tuple[dict, dict]] = {}
    for row in kept.collect():
        by_lang.setdefault(row["lang"], ({}, {}))[row["is_word"]][row["key"]] = row["n"]
    chars, words = [], []
    for lang in sorted(by_lang, key=lambda x: (x is not None, x or "")):
        classes, common_words = by_lang[lang]
        total = classes.pop(-1, 0)
        common_words = dict(sorted(common_words.items(), key=lambda x: (-x[1], x[0]))[: rules.common_words])
        if total >= rules.min_reference:
            counts = np.array([classes.get(i, 0) for i in range(len(CLASSES))], dtype=float)
            keys = np.array(sorted(common_words), dtype=np.int64)
            n = np.array([common_words[k] for k in keys.tolist()], dtype=float)
            chars.append(counts / counts.sum())
            words.append((keys, np.append(n, total - n.sum()) / total))
    return References(tuple(chars), tuple(words))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p to q, base 2."""
    m = (p + q) / 2

    def half(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=1)

    return np.sqrt(np.clip((half(p) + half(np.broadcast_to(q, p.shape))) / 2, 0.0, 1.0))


def _repeated(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text: words in windows of WINDOW words that occur twice or more in the text."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(at) - 1, dtype=np.int64)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        rolled = rolled * _STEP + h[i : i + n]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    keyed = common.mix(rolled[whole] + common.mix(text[whole].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    twice = np.zeros(len(whole), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(edge, whole[twice], 1)
    np.add.at(edge, whole[twice] + WINDOW, -1)
    return common.sums(np.cumsum(edge)[:-1] > 0, at)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _measure(part: pa.RecordBatch, known: References, rules: Rules) -> dict[str, np.ndarray]:
    data, starts = common.text_bytes(part["text"])
    begin, end = common.word_bounds(data, starts, common.WHITE)
    at = np.searchsorted(begin, starts)
    h = common.fingerprints(data, begin, end)
    histogram = _classes(data, starts)
    raw = data.tobytes()
    n_words = np.diff(at)
    out = {
        "n_words": n_words,
        "word_chars": histogram.sum(axis=1) - histogram[:, 3],
        "n_symbols": common.sums(_SYMBOL[data], starts),
        "n_dup_lines": np.array([_dup_lines(raw[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())], dtype=np.int64),
        "n_repeat_words": _repeated(common.exact_fingerprints(data, begin, end), at),
    }
    failed = (n_words < rules.min_total_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * n_words)
    n_chars = histogram.sum(axis=1)
    shares = histogram / np.maximum(n_chars, 1)[:, None]
    key = h.view(np.int64)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    best = np.full((3, len(n_words)), np.inf)  # what it is beyond the limits, the two distances
    for chars, (keys, word_shares) in zip(known.chars, known.words):
        by_char = distance(shares, chars)
        where = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        is_common = keys[where] == key if len(keys) else np.zeros(len(key), dtype=bool)
        width = len(keys) + 1
        counts = np.bincount(owner[is_common] * width + where[is_common], minlength=len(n_words) * width)
        counts = counts.reshape(-1, width).astype(float)
        counts[:, -1] = n_words - counts.sum(axis=1)
        by_word = distance(counts / np.maximum(n_words, 1)[:, None], word_shares)
        beyond = np.maximum(
            np.where(n_chars >= rules.min_chars, by_char - rules.max_char_distance, -1.0),
            np.where(n_words >= rules.min_words, by_word - rules.max_word_distance, -1.0),
        )
        nearer = (beyond < best[0]) | ((beyond == best[0]) & (by_char + by_word < best[1] + best[2]))
        best = np.where(nearer, [beyond, by_char, by_word], best)
    far = (best[0] > 0) if known.chars else np.zeros(len(n_words), dtype=bool)
    return out | {"base_failed": failed, "kept": ~failed & ~far, "char_distance": best[1], "word_distance": best[2]}


_MEASURES = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, char_distance double, word_distance double"
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id with the counts, `base_failed`, `kept` and both distances (null where there is no reference)."""
    known = docs.sparkSession.sparkContext.broadcast(references(docs, rules))  # at most a few KB for each language

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            got = _measure(part, known.value, rules)
            columns = [pa.array(v, t, mask=~np.isfinite(v) if t == pa.float64() else None) for v, t in zip(got.values(), _TYPES)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names=["doc_id", *got])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(judge, f"doc_id {kind}, {_MEASURES}")


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    known = docs.sparkSession.sparkContext.broadcast(references(docs, rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            yield part.filter(pa.array(_measure(part, known.value, rules)["kept"]))

    return docs.mapInArrow(judge, docs.schema)

