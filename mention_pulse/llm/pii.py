"""Personal data: four plain kinds, and identifiers found by bootstrapped contexts.

Spans of the plain kinds are the seeds. What stands before a seed (the last word, and the last two)
are candidate patterns. All their places in the corpus are counted, and what follows them there, if it
looks like an identifier (a token with a digit or an @, of MIN_TOKEN characters or more). On the graph
of patterns and instances, instances and patterns then score each other by turns: a pattern is worth the
trusted share of all places where it stands, if enough distinct trusted instances follow it; an instance
is trusted through its best pattern. Tokens behind patterns that end above `confidence` are spans of the
kind `context`. A pattern that many other words follow, as every common word, gets no weight.

Scores need two passes over the texts, and the spans one more; what goes to tasks is the set of
candidate patterns, in blocks of PATTERN_BLOCK, one pass each.

Defined results: a null or empty text has no spans. Rows come back one for one; repeated rows get the
same spans. Offsets are code points, ends exclusive. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
PATTERN_BLOCK = 1 << 20
MIN_TOKEN = 5

# fixed values: the patterns of the contract
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# the contract's pattern for ip, begun only where digits begin: a later digit of a run ends as the first does
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?()[]{}<>\"'"
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, str]


@dataclass(frozen=True)
class Bootstrap:
    """Parameters of the search for further identifiers."""

    min_instances: int = 5
    confidence: float = 0.5
    rounds: int = 3


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As finditer of the pattern, but looked for around each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _EMAIL.match(text, begin) if begin < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the plain kinds, by start, then kind as listed."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def _hash(*words: str) -> int:
    """Fingerprint of words as `common` gives it, of two words from both."""
    return int(_pair(*[_word(w) for w in words])) if len(words) == 2 else int(_word(words[0]))


def _word(word: str) -> np.uint64:
    data = np.frombuffer(word.encode("utf-8", "replace"), dtype=np.uint8)
    return common.fingerprints(data, np.array([0]), np.array([len(data)]))[0]


def _pair(first, second):
    with np.errstate(over="ignore"):
        return common.mix(np.atleast_1d(first * np.uint64(0x9FB21C651E98DF25) + second))[0] if np.isscalar(first) else common.mix(
            first * np.uint64(0x9FB21C651E98DF25) + second
        )


def _before(text: str, places: list[int]) -> Iterator[list[str]]:
    """For each place the last two words before it, the nearest last; none if it is within a word."""
    spans = [m.span() for m in _TOKEN.finditer(text)] if places else []
    ends = [b for _, b in spans]
    for at in places:
        i = bisect_right(ends, at)
        whole = at and text[at - 1] in " \t\n\r\x0b\x0c"
        yield [text[a:b] for a, b in spans[max(0, i - 2) : i]] if whole else []


def seeds(docs: DataFrame) -> DataFrame:
    """(pattern, instance, n): what stands before each seed, per task summed up."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pattern, instance = [], []
            for text in batch["text"]:
                t = text.as_py() or ""
                found = base_spans(t)
                for (a, b, _), words in zip(found, _before(t, [a for a, _, _ in found])):
                    if words:
                        value = int(_word(t[a:b]))
                        for key in [_hash(words[-1]), *([_hash(*words)] if len(words) == 2 else [])]:
                            pattern.append(key)
                            instance.append(value)
            keys = np.array(pattern, dtype=np.uint64).view(np.int64)
            values = np.array(instance, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], names=["pattern", "instance"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "pattern long, instance long")
    return found.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"))


def _token_at(text: str) -> str:
    return text.strip(_EDGE)


def _is_identifier(token: str) -> bool:
    return len(token) >= MIN_TOKEN and ("@" in token or _DIGIT.search(token) is not None)


def _places(part: pa.RecordBatch, known: common.Membership):
    """Of a slice: data, words' bounds, and the known patterns that end before each word (pattern, next word)."""
    data, starts = common.text_bytes(part["text"])
    begin, end = common.word_bounds(data, starts, common.WHITE)
    at = np.searchsorted(begin, starts)
    h = common.fingerprints(data, begin, end)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(at))
    follows = text[1:] == text[:-1] if len(text) else np.zeros(0, dtype=bool)
    one = known.index(h[:-1]) if len(h) > 1 else np.zeros(0, np.int64)
    hit = np.flatnonzero((one >= 0) & follows)
    found = [(one[hit], hit + 1)]
    if len(h) > 2:
        two = known.index(_pair(h[:-2], h[1:-1]))
        hit = np.flatnonzero((two >= 0) & (text[:-2] == text[2:]))
        found.append((two[hit], hit + 2))
    pattern, word = (np.concatenate(x) for x in zip(*found))
    return data, starts, begin, end, text, pattern, word


def _maybe(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words long enough, with an ASCII digit or an @."""
    mark = np.zeros(256, dtype=bool)
    mark[48:58] = True
    mark[64] = True
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(mark[data], out=total[1:])
    return (total[end] > total[begin]) & (end - begin >= MIN_TOKEN)


def _counts(docs: DataFrame, patterns: np.ndarray) -> DataFrame:
    """(pattern, instance, n) of all places of the patterns; instance is null for the total."""
    sent = docs.sparkSession.sparkContext.broadcast(patterns)  # one block of PATTERN_BLOCK at most

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.Membership(sent.value)
        totals = np.zeros(len(sent.value), dtype=np.int64)
        for part in common.slices(batches):
            data, starts, begin, end, _, pattern, word = _places(part, known)
            totals += np.bincount(pattern, minlength=len(totals))
            good = np.flatnonzero(_maybe(data, begin[word], end[word]))
            keys, values = [], []
            for p, w in zip(pattern[good].tolist(), word[good].tolist()):
                token = _token_at(bytes(data[begin[w] : end[w]]).decode("utf-8", "replace"))
                if _is_identifier(token):
                    keys.append(int(sent.value[p]))
                    values.append(int(_word(token)))
            if keys:
                yield _count_rows(np.array(keys, np.uint64), np.array(values, np.uint64), np.ones(len(keys), np.int64))
        seen = np.flatnonzero(totals)
        yield _count_rows(sent.value[seen], None, totals[seen])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "pattern long, instance long, n long")
    return found.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))


def _count_rows(keys: np.ndarray, values: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    instance = pa.nulls(len(keys), pa.int64()) if values is None else pa.array(values.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), instance, pa.array(n)], names=["pattern", "instance", "n"])


def _blocks(patterns: DataFrame) -> Iterator[np.ndarray]:
    """Sorted fingerprints of all patterns, at most about PATTERN_BLOCK at a time."""
    n = patterns.count()
    parts = -(-n // PATTERN_BLOCK) if n else 0
    for i in range(parts):
        rows = patterns.filter(F.pmod(F.col("pattern"), F.lit(parts)) == i).select("pattern").toPandas()["pattern"]
        yield np.sort(rows.to_numpy(dtype=np.int64).view(np.uint64))


def score(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, score) of patterns above the confidence, after `rounds` rounds over the graph."""
    spark = docs.sparkSession
    found = common.written(seeds(docs), common.shared_folder(spark, "pii-seeds"))
    candidates = found.groupBy("pattern").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= how.min_instances)
    counted: DataFrame | None = None
    for block in _blocks(candidates.select("pattern")):
        more = _counts(docs, block)
        counted = more if counted is None else counted.union(more)
    if counted is None:
        return spark.createDataFrame([], "pattern long, score double")
    counted = common.written(counted, common.shared_folder(spark, "pii-counts"))
    totals = counted.filter("instance IS NULL").select("pattern", F.col("n").alias("places"))
    seeded = found.join(candidates.select("pattern"), "pattern").withColumn("trust", F.lit(1.0))
    others = counted.filter("instance IS NOT NULL").join(
        found.select("instance").distinct(), "instance", "left_anti"
    )
    trusted = None
    for i in range(how.rounds):
        near = seeded.select("pattern", "n", "trust")
        if trusted is not None:
            near = near.union(others.join(trusted, "instance").select("pattern", "n", "trust"))
        patterns = (
            near.groupBy("pattern")
            .agg(F.sum(F.col("n") * F.col("trust")).alias("good"), F.sum("trust").alias("k"))
            .join(totals, "pattern")
            .filter(F.col("k") >= how.min_instances)
            .select("pattern", F.least(F.lit(1.0), F.col("good") / F.col("places")).alias("score"))
            .filter(F.col("score") >= how.confidence)
        )
        patterns = patterns.checkpoint()
        if i + 1 < how.rounds:
            trusted = others.join(patterns, "pattern").groupBy("instance").agg(F.max("score").alias("trust"))
    return patterns


def _context_spans(part: pa.RecordBatch, known: common.Membership) -> dict[int, list[tuple[int, int]]]:
    """By row of the slice: spans of identifier-like tokens behind known patterns."""
    data, _, begin, end, text, _, word = _places(part, known)
    starts = common.text_bytes(part["text"])[1]
    out: dict[int, list[tuple[int, int]]] = {}
    word = np.unique(word)
    characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    for w in word[_maybe(data, begin[word], end[word])].tolist():
        row = int(text[w])
        raw = bytes(data[begin[w] : end[w]]).decode("utf-8", "replace")
        token = _token_at(raw)
        if _is_identifier(token):
            at = int(characters[begin[w]] - characters[starts[row]]) + raw.index(token)
            out.setdefault(row, []).append((at, at + len(token)))
    return out


def find(docs: DataFrame, how: Bootstrap = Bootstrap(), spans: str = "spans") -> DataFrame:
    """The rows of docs with `spans`: array of (begin, end, kind), in order; a column of that name is replaced."""
    spark = docs.sparkSession
    trusted = score(docs.select("text"), how)
    docs = docs.drop(spans)
    shape = docs.select("*", F.lit(None).cast("array<struct<begin:long,end:long,kind:string>>").alias(spans)).schema
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            found = [[dict(zip(("begin", "end", "kind"), s)) for s in base_spans(t.as_py() or "")] for t in part["text"]]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*part.schema.names, spans])

    out = docs.mapInArrow(plain, shape)
    for block in _blocks(trusted.select("pattern")):
        out = out.mapInArrow(_adds(spark.sparkContext.broadcast(block), kind), shape)
    return out


def _adds(sent, kind: pa.DataType):
    def adds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.Membership(sent.value)
        for part in common.slices(batches):
            rows = part.column(part.num_columns - 1).to_pylist()
            for row, more in _context_spans(part, known).items():
                # of the spans in order: where each begins, and the furthest end so far
                begins = [s["begin"] for s in rows[row]]
                reach = list(accumulate((s["end"] for s in rows[row]), max))
                for a, b in more:
                    i = bisect_left(begins, b)
                    if not i or reach[i - 1] <= a:
                        rows[row].append({"begin": a, "end": b, "kind": CONTEXT})
                order = [*KINDS, CONTEXT]
                rows[row].sort(key=lambda s: (s["begin"], order.index(s["kind"])))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(rows, kind)], names=part.schema.names)

    return adds


def find_digests(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, counts of the plain kinds, base_sha256 of their spans, and all spans as text."""
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = find(own, how).select("doc_id", "spans")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[(s["kind"], f"{s['kind']}:{s['begin']}:{s['end']}") for s in spans] for spans in batch["spans"].to_pylist()]
            counts = [pa.array([sum(k == kind for k, _ in r) for r in rows], pa.int64()) for kind in KINDS]
            base = [hashlib.sha256(",".join(s for k, s in r if k != CONTEXT).encode()).hexdigest() for r in rows]
            spans = [",".join(s for _, s in r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *counts, pa.array(base, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(digests, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of spans that overlap, the whole stretch once."""
    out, done = [], 0
    for a, b, kind in sorted(spans):
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """The rows with all found spans masked; null texts stay null, other columns stay whatever their names."""
    found = find(docs, how, common.free_name(docs, "spans"))

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            spans = part.column(part.num_columns - 1).to_pylist()
            texts = [
                None if t is None else masked(t, [(s["begin"], s["end"], s["kind"]) for s in r]) if r else t
                for t, r in zip(part["text"].to_pylist(), spans)
            ]
            at = part.schema.names.index("text")
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return found.mapInArrow(hide, docs.schema)
