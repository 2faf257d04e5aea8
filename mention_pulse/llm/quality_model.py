"""Quality classifier: random-indexing vectors pooled per document, and a small network.

Tokens are runs of letters (with their case: lower, capital, upper), of digits, or of other signs; they fall
into BUCKETS by fingerprint. Each bucket has a fixed sparse index vector, and a context vector: the sum
of the index vectors of its neighbours in all documents. A document is the mean of its tokens' context
and index vectors. A network of two layers, in numpy, is fitted on at most `bound` labelled rows, and a
temperature on rows kept apart turns its output into calibrated probabilities.

Defined results: a null or empty text has a zero vector and a score as any other. Without labelled rows
of both kinds the score is the share of good rows (0 without any). Rows come back one for one; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common
from mention_pulse.llm.lm import fold
from mention_pulse.llm.samples import labelled

BOUND = 20_000
BUCKETS = 1 << 14
WIDTH = 64
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 30

_KIND = np.full(256, 3, dtype=np.int8)  # other signs
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_ROWS = 512  # buckets in a row of sums


def index_vectors() -> np.ndarray:
    """Places (BUCKETS x NONZERO) of each bucket's ones, and their signs."""
    rng = np.random.default_rng(11)
    places = np.argsort(rng.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1, 1], (BUCKETS, NONZERO))


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token of a slice, and where each text's tokens begin (with the end of the last)."""
    data, starts = common.text_bytes(column)
    kind = _KIND[data]
    new = np.ones(len(data), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts[:-1][starts[:-1] < len(data)]] = True
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(data))
    own = kind[begin] > 0 if len(begin) else np.zeros(0, dtype=bool)
    begin, end = begin[own], end[own]
    h = common.fingerprints(data, begin, end)
    upper = common.sums(_UPPER[data], np.arange(len(data) + 1)) if not len(begin) else np.add.reduceat(
        np.append(_UPPER[data], False), np.stack([begin, end], axis=1).ravel().clip(max=len(data))
    )[::2].astype(np.int64)
    shape = np.where(upper == 0, 0, np.where((upper > 1) & (upper >= (end - begin) / 2), 2, 1)).astype(np.uint64)
    h = common.mix(h + shape * np.uint64(0x9E3779B97F4A7C15))
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(begin, starts)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Sum of the index vectors around each bucket over all documents, scaled to length 1."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for part in common.slices(batches):
            own, at = buckets(part["text"])
            text = np.repeat(np.arange(len(at) - 1), np.diff(at))
            for step in range(1, REACH + 1):
                pair = np.flatnonzero(text[step:] == text[:-step]) if len(text) > step else np.zeros(0, np.int64)
                for a, b in ((own[pair], own[pair + step]), (own[pair + step], own[pair])):
                    for i in range(NONZERO):
                        total += np.bincount(a * WIDTH + places[b, i], weights=signs[b, i], minlength=len(total))
        for k in range(0, BUCKETS, _ROWS):
            rows = total[k * WIDTH : (k + _ROWS) * WIDTH].astype(np.int64)
            if rows.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([rows.tobytes()])], names=["first", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype=np.int64) for x in group["sums"])
        return pa.table({"first": group["first"][:1], "sums": pa.array([total.tobytes()])})

    shape = "first long, sums binary"
    out = np.zeros((BUCKETS, WIDTH))
    for r in docs.select("text").mapInArrow(gather, shape).groupBy("first").applyInArrow(add, shape).collect():
        out[r["first"] : r["first"] + _ROWS] = np.frombuffer(r["sums"], dtype=np.int64).reshape(-1, WIDTH)
    return out / np.maximum(np.sqrt((out**2).sum(axis=1)), 1e-9)[:, None]


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Context and index vector of each bucket side by side."""
    places, signs = index_vectors()
    index = np.zeros((BUCKETS, WIDTH))
    np.put_along_axis(index, places, signs, axis=1)
    return np.hstack([context, index / np.sqrt(NONZERO)]).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each text of a slice, with the log of its length."""
    own, at = buckets(column)
    n = np.diff(at)
    out = np.zeros((len(n), vectors.shape[1] + 1), dtype=np.float32)
    some = np.flatnonzero(n)
    if len(some):
        out[some, :-1] = np.add.reduceat(vectors[own], at[:-1][some], axis=0) / n[some, None]
    out[:, -1] = np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers; input is shifted and scaled, output divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> Network:
    """A network fitted on the rows that are not `apart`, its temperature on those that are."""
    rng = np.random.default_rng(3)
    own_x, own_y = x[~apart].astype(float), y[~apart].astype(float)
    mean, scale = own_x.mean(axis=0), own_x.std(axis=0) + 1e-3
    z = (own_x - mean) / scale
    shapes = {"w1": (x.shape[1], HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN,), "b2": ()}
    p = {k: rng.standard_normal(s) * (0 if k[0] == "b" else np.sqrt(2 / s[0])) for k, s in shapes.items()}
    p["b2"] = np.asarray(np.log((own_y.mean() + 1e-3) / (1 - own_y.mean() + 1e-3)))
    m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = order[at : at + 128]
            a, t = z[rows], own_y[rows]
            hidden = np.maximum(a @ p["w1"] + p["b1"], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ p["w2"] + p["b2"], -40, 40))) - t) / len(rows)
            back = np.outer(error, p["w2"]) * (hidden > 0)
            slope = {"w1": a.T @ back + 1e-4 * p["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ error + 1e-4 * p["w2"], "b2": error.sum()}
            step += 1
            for k, g in slope.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.002 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p["w1"], p["b1"], p["w2"], float(p["b2"]))
    if apart.any():
        logits, t = net.logits(x[apart].astype(float)), y[apart]
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, -np.where(t == 1, 1, -1) * logits / c)) for c in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


def scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, bound: int = BOUND) -> DataFrame:
    """doc_id, held_out, score and predicted of all documents; labels of the fold `held` are not learned from."""
    spark = docs.sparkSession
    own = docs.select("doc_id", fold(modulus).eqNullSafe(held).alias("held_out"), F.col("text").cast("string").alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(context_vectors(own)))  # BUCKETS rows, whatever the input

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            rows = [x.tobytes() for x in pooled(part["text"], vectors.value)]
            yield pa.RecordBatch.from_arrays([part["label"], part["part"], pa.array(rows, pa.binary())], names=["label", "part", "vector"])

    # at most `bound` rows of a few hundred bytes come to the driver
    rows = labelled(docs, labels, "quality", modulus, held, bound).mapInArrow(pool, "label int, part long, vector binary").collect()
    y = np.array([r["label"] for r in rows], dtype=int)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        scored = own.select("doc_id", "held_out", F.lit(share).alias("score"))
    else:
        x = np.stack([np.frombuffer(r["vector"], dtype=np.float32) for r in rows])
        order = np.lexsort((*x.T[:3], y))  # rows arrive in any order
        apart = np.array([r["part"] >= 8 for r in rows])
        if apart.all() or len(set(y[~apart].tolist())) < 2:
            apart[:] = False
        net = spark.sparkContext.broadcast(fit(x[order], y[order], apart[order]))
        shape = own.drop("text").withColumn("score", F.lit(0.0)).schema

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in common.slices(batches):
                chance = net.value.chance(pooled(part["text"], vectors.value).astype(float))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(chance)], names=["doc_id", "held_out", "score"])

        scored = own.mapInArrow(judge, shape)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
