"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings that stand out in toxic texts is learned from labelled rows; with
it each text becomes a row of numbers: densities of lexicon words, how near they stand to a second person,
capitals, punctuation, and tokens that hide words behind digits and signs. Spark ML fits the trees and the
isotonic curve. The sample of labelled rows (at most `bound`) is split: lexicon, trees and curve never see
the same row, so none rests on what another has learned by heart.

Defined results: a null or empty text has zero features and a score as any other. Without labelled rows
of both kinds the score is the share of toxic rows (0 without any). Rows come back one for one; other
columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common
from mention_pulse.llm.lm import fold
from mention_pulse.llm.samples import labelled

BOUND = 20_000
LEXICON = 2000
MIN_TOXIC = 6
KEPT_WORDS = 1 << 19
SHORTEST, LONGEST = 4, 6
NEAR = 5
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?()[]{}<>\"'*"
# fixed values: signs that stand for letters, and pronouns of the second person in four languages
_HIDDEN = str.maketrans("013457@$!|", "oieastasil")
_SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen euch euer ihr "
    "tu te toi ton ta tes vous votre vos ti tus tuyo usted ustedes vosotros vuestro".split()
)
FEATURES = (
    "words", "hits", "density", "weight", "mean_weight", "strongest", "distinct", "near_second", "second",
    "hidden_hits", "hidden", "upper", "all_caps", "exclaim", "question", "marks", "digits", "long_runs", "word_length",
)
_RUN = re.compile(r"(.)\1\1")


def _plain(token: str) -> str:
    return token.strip(_EDGE)


def _seen_through(word: str) -> str:
    """The word with hiding signs read as letters, and with signs between letters left out."""
    return "".join(c for c in word.translate(_HIDDEN) if c.isalpha())


def _is_hidden(word: str) -> bool:
    return len(word) > 3 and not word.isalpha() and not word[0].isdigit() and sum(c.isalpha() for c in word) >= 2 and "-" not in word and "'" not in word and "@" not in word[1:-1]


def _terms(word: str) -> list[str]:
    """The word itself, and its beginnings (marked by a star)."""
    return [word, *(word[:n] + "*" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log odds of terms that stand out in toxic rows, at most LEXICON of them."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            terms, label = [], []
            for text, y in zip(part["text"].to_pylist(), part["label"].to_pylist()):
                words = {_seen_through(_plain(t)) for t in _WORD.findall((text or "").lower())}
                own = {t for w in words if len(w) > 2 for t in _terms(w)}
                terms += own
                label += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(label, pa.int64())], names=["term", "label"])

    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    clean, toxic = n - (toxic or 0), toxic or 0
    if not clean or not toxic:
        return {}
    counted = sample.mapInArrow(gather, "term string, label long").groupBy("term").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("bad") + 0.1) / (toxic + 0.2)) - F.log((F.col("n") - F.col("bad") + 0.5) / (clean + 1.0))
    kept = counted.filter(F.col("bad") >= MIN_TOXIC).withColumn("odds", odds).filter("odds > 1.5")
    rows = kept.orderBy(F.desc(F.col("odds") * F.log("bad")), "term").limit(LEXICON).collect()
    return {r["term"]: r["odds"] for r in rows}


class Featurizer:
    """Features of texts; what a token means is kept in a table of bounded size."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.kept: dict[str, tuple[float, bool, bool]] = {}

    def _look(self, token: str) -> tuple[float, bool, bool]:
        """Weight of a token, whether it hides a word, whether it names the second person."""
        word = _plain(token.lower())
        open_word = _seen_through(word)
        weight = max((self.lexicon.get(t, 0.0) for t in _terms(open_word)), default=0.0) if len(open_word) > 2 else 0.0
        return weight, _is_hidden(word), word in _SECOND

    def row(self, text: str) -> list[float]:
        tokens = _WORD.findall(text)
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        if len(self.kept) >= KEPT_WORDS:
            self.kept.clear()
        found = list(map(self.kept.get, tokens))
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    token = tokens[i]
                    found[i] = self.kept.get(token) or self.kept.setdefault(token, self._look(token))
        hits = [i for i, (w, _, _) in enumerate(found) if w]
        weights = [found[i][0] for i in hits]
        second = [i for i, f in enumerate(found) if f[2]]
        near, at = 0, 0
        for i in hits:
            while at < len(second) and second[at] < i - NEAR:
                at += 1
            near += at < len(second) and second[at] <= i + NEAR
        hidden = sum(f[1] for f in found)
        length = len(text)
        upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks = sum(map(text.count, "#*$%&|<>@!?"))
        caps = sum(map(str.isupper, tokens))
        return [
            math.log1p(n), math.log1p(len(hits)), len(hits) / n, sum(weights), sum(weights) / n, max(weights, default=0.0),
            float(len({tokens[i].lower() for i in hits})), float(near), len(second) / n,
            float(sum(found[i][1] for i in hits)), hidden / n, upper / length, caps / n,
            text.count("!") / length, text.count("?") / length, marks / length, sum(map(text.count, "0123456789")) / length,
            len(_RUN.findall(text)) / length, length / n,
        ]


def features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """The rows of docs with `features` (array of double) in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON terms
    shape = docs.drop("text").withColumn("features", F.lit(None).cast("array<double>")).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Featurizer(sent.value)
        for part in common.slices(batches):
            rows = pa.array([own.row(t or "") for t in part["text"].to_pylist()], pa.list_(pa.float64()))
            names = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in names), rows], names=[*names, "features"])

    return docs.mapInArrow(measure, shape)


def scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, bound: int = BOUND) -> DataFrame:
    """doc_id, held_out, score and predicted of all documents; labels of the fold `held` are not learned from."""
    spark = docs.sparkSession
    sample = common.written(labelled(docs, labels, "toxic", modulus, held, bound), common.shared_folder(spark, "toxic-sample"))
    lexicon = learn_lexicon(sample.filter("part < 5").select("text", "label"))
    own = docs.select("doc_id", fold(modulus).eqNullSafe(held).alias("held_out"), F.col("text").cast("string").alias("text"))
    known = common.written(features(sample.filter("part >= 5"), lexicon), common.shared_folder(spark, "toxic-features"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = [known.filter(c).select("label").distinct().count() for c in ("part < 8", "part >= 8")]
    if classes != [2, 2]:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        scored = own.select("doc_id", "held_out", F.lit(float(share)).alias("score"))
    else:
        vectors = known.select("part", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
        trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, maxBins=64, seed=7, cacheNodeIds=False).fit(vectors.filter("part < 8").coalesce(4))

        def chance(frame: DataFrame) -> DataFrame:
            out = trees.transform(frame)
            return out.withColumn("chance", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction", "features")

        curve = IsotonicRegression(featuresCol="chance", labelCol="label").fit(chance(vectors.filter("part >= 8")))
        scored = chance(features(own, lexicon).withColumn("features", array_to_vector("features")))
        scored = curve.setPredictionCol("score").transform(scored).select("doc_id", "held_out", "score")
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.withColumn("score", bounded).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
