"""Sentiment of texts by a lexicon table, or by a scorer the caller brings."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mention_pulse.functions.text import label
from mention_pulse.operators.skew import MAX_LITERALS, is_small, join_dimension
from mention_pulse.schemas import SCORED_TEXT

# Fixed value: the constant of s / sqrt(s*s + alpha), as published with the rule-based scorer
# whose score range this follows.
ALPHA = 15.0
WORD = r"[\p{L}\p{M}]+"
# Words of a lexicon literal that share one small map, on average.
WORDS_PER_MAP = 4

SCORE_FIELDS = ("sentiment", "total", "positive", "negative")


def words(text: Column) -> Column:
    """Lower-case words of a text: runs of letters, and marks on them, of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _scores(valence: Column, pos: Column, neg: Column, n: Column, alpha: float) -> dict[str, Column]:
    total = valence / F.sqrt(valence * valence + F.lit(alpha))
    share = lambda hits: F.coalesce(F.try_divide(hits, n), F.lit(0.0))
    return {
        "sentiment": label(total),
        "total": total,
        "positive": share(pos),
        "negative": share(neg),
    }


def one_valence(table: DataFrame) -> DataFrame:
    """(token, valence) with each token once: the largest of its valences; nulls are no entries."""
    valence = F.col("valence").cast("double")
    known = table.filter(F.col("token").isNotNull() & valence.isNotNull())
    return known.groupBy("token").agg(F.max(valence).alias("valence"))


class Lexicon:
    """A word list of checked size, ready to be used inside expressions.

    The words become one literal, an array of small maps with a word's map found by its checksum,
    so looking a word up costs a few comparisons in the row itself, whatever the number of words
    and valences: scoring needs no shuffle and works on a stream. A word under several valences
    has the largest.
    """

    def __init__(self, words_by_valence: dict[float, Sequence[str]]):
        self.words = {w: float(v) for v, listed in sorted(words_by_valence.items()) for w in listed}

    @classmethod
    def of(cls, table: DataFrame, max_rows: int = MAX_LITERALS) -> Lexicon:
        """From a (token, valence) table; raises if it has more than `max_rows` rows."""
        if not is_small(table, max_rows):
            raise ValueError(f"lexicon has more than {max_rows} rows, use score_by_join or pack_scores_by_join")
        lexicon = cls({})
        lexicon.words = {row["token"]: row["valence"] for row in one_valence(table).collect()}
        return lexicon

    def _maps(self) -> tuple[Column, int]:
        """The literal, which Spark parses once while planning, and the number of its maps."""
        maps: list[dict[str, float]] = [{} for _ in range(len(self.words) // WORDS_PER_MAP + 1)]
        for word, value in self.words.items():
            maps[zlib.crc32(word.encode()) % len(maps)][word] = value
        return F.from_json(F.lit(json.dumps(maps)), "array<map<string,double>>"), len(maps)

    def valence(self, word: Column) -> Column:
        """Valence of a word, 0 for a word not listed."""
        maps, n = self._maps()
        near = F.get(maps, (F.crc32(word) % F.lit(n)).cast("int"))
        return F.coalesce(F.try_element_at(near, word), F.lit(0.0))

    def struct(self, text: Column, alpha: float = ALPHA) -> Column:
        """struct(text, sentiment, total, positive, negative) of a text; null scores of null."""

        def sums(valences: Column) -> Column:
            return F.struct(
                F.aggregate(valences, F.lit(0.0), lambda acc, v: acc + v).alias("s"),
                F.size(F.filter(valences, lambda v: v > 0)).alias("pos"),
                F.size(F.filter(valences, lambda v: v < 0)).alias("neg"),
                F.size(valences).alias("n"),
            )

        def scored(found: Column) -> Column:
            fields = _scores(found["s"], found["pos"], found["neg"], found["n"], alpha)
            return F.struct(text.alias("text"), *(fields[f].alias(f) for f in SCORE_FIELDS))

        # an array of one value goes through the steps, so that each step is evaluated once
        valences = F.array(F.transform(words(text), self.valence))
        named = F.transform(F.transform(valences, sums), scored)
        return F.when(text.isNotNull(), F.get(named, F.lit(0))).otherwise(unscored(text))


def unscored(text: Column) -> Column:
    """The struct of a text without scores."""
    nulls = (F.lit(None).cast(f.dataType).alias(f.name) for f in SCORED_TEXT.fields[1:])
    return F.struct(text.alias("text"), *nulls)


def score_sentiment(
    df: DataFrame, text: str, lexicon: DataFrame | Lexicon, out: str = "scores", alpha: float = ALPHA
) -> DataFrame:
    """Add a struct of scores of a text column.

    A lexicon of checked size is used row by row, without a shuffle; a larger one needs
    `score_by_join`, which has to know the rows' id.
    """
    lexicon = lexicon if isinstance(lexicon, Lexicon) else Lexicon.of(lexicon)
    return df.withColumn(out, lexicon.struct(F.col(text), alpha))


def score_by_join(
    df: DataFrame, text: str, lexicon: DataFrame, post_id: str, alpha: float = ALPHA, **limits: int
) -> DataFrame:
    """(post_id, sentiment, total, positive, negative) by joining words to a lexicon of any size.

    One row per row of `df`, with the scores `score_sentiment` gives it: null for a null text, and
    each text on its own where posts share an id (texts are told apart by their SHA-256). Words
    and hits of a post are combined before they are shuffled by its id; texts are not shuffled at
    all.
    """
    scored = _text_scores(df, text, lexicon, post_id, alpha, **limits)
    keyed = df.select(F.col(post_id), F.sha2(F.col(text), 256).alias("_text"))
    return keyed.join(scored, _scores_of(F.col(post_id), F.col("_text")), "left").select(post_id, *SCORE_FIELDS)


def _scores_of(post_id: Column, digest: Column) -> Column:
    return post_id.eqNullSafe(F.col("_id")) & (digest == F.col("_scored"))


def _text_scores(
    df: DataFrame, text: str, lexicon: DataFrame, post_id: str, alpha: float, **limits: int
) -> DataFrame:
    """(_id, _scored, scores) of the texts of each post, told apart by their SHA-256 `_scored`."""
    keyed = df.select(F.col(post_id), F.col(text), F.sha2(F.col(text), 256).alias("_text"))
    tokens = keyed.filter(F.col(text).isNotNull()).select(
        F.col(post_id).alias("_id"), "_text", F.posexplode_outer(words(F.col(text))).alias("_at", "word")
    )
    hits = join_dimension(tokens, one_valence(lexicon), "word", "token", "_id", "left", **limits)
    sums = hits.groupBy("_id", "_text").agg(
        F.coalesce(F.sum("valence"), F.lit(0.0)).alias("_s"),
        F.count_if(F.col("valence") > 0).alias("_pos"),
        F.count_if(F.col("valence") < 0).alias("_neg"),
        F.count("word").alias("_n"),
        F.count_if(F.coalesce(F.col("_at"), F.lit(0)) == 0).alias("_copies"),
    )
    # copies of a post add up alike: shares stay as they are, the sum is divided
    valence = F.col("_s") / F.col("_copies")
    fields = _scores(valence, F.col("_pos"), F.col("_neg"), F.col("_n"), alpha)
    return sums.select("_id", F.col("_text").alias("_scored"), *(fields[f].alias(f) for f in SCORE_FIELDS))


Scorer = Callable[[str], tuple[str, float, float, float]]


def scorer_udf(score: Scorer) -> Callable[[Column], Column]:
    """An Arrow-batched column function of a scorer text -> (label, total, positive, negative).

    A text on which the scorer raises gets null scores, so one bad record fails alone; it is never
    called on a null text.
    """

    @F.pandas_udf(SCORED_TEXT)
    def scored(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            if text is None:
                rows.append((None,) * len(SCORED_TEXT))
                continue
            try:
                rows.append((text, *score(text)))
            except Exception:  # noqa: BLE001 - whatever the caller's scorer raises
                rows.append((text, None, None, None, None))
        return pd.DataFrame(rows, columns=SCORED_TEXT.fieldNames())

    return scored


def score_with(df: DataFrame, text: str, score: Scorer, out: str = "scores") -> DataFrame:
    """Add a struct of scores of a text column by the caller's own scorer."""
    return df.withColumn(out, scorer_udf(score)(F.col(text)))


def pack_scores(
    posts: DataFrame, score: Lexicon | Callable[[Column], Column], when: Column | None = None
) -> DataFrame:
    """Move the post's text, and its parent's, into a struct beside its scores.

    Where `when` is false the text is moved but not scored.
    """
    struct = score.struct if isinstance(score, Lexicon) else score
    when = F.lit(True) if when is None else when
    return _packed(posts, lambda text, _: F.when(when, struct(text)).otherwise(unscored(text)))


def pack_scores_by_join(
    posts: DataFrame,
    lexicon: DataFrame,
    when: Column | None = None,
    post_id: str = "tweet_id",
    alpha: float = ALPHA,
    **limits: int,
) -> DataFrame:
    """`pack_scores` by a lexicon of any size, joined word by word: for frames, or the batches of a stream.

    Own texts and parents' texts are scored in one pass and joined back by post and text.
    """
    when = F.lit(True) if when is None else when
    texts = F.array("text", "reference_tweets.text")
    told = posts.filter(when).select(post_id, F.explode(texts).alias("_told")).filter("_told IS NOT NULL")
    scored = _text_scores(told, "_told", lexicon, post_id, alpha, **limits)
    joined = posts.withColumn("_when", when)
    for name, text in (("_own", F.col("text")), ("_parents", F.col("reference_tweets.text"))):
        side = scored.select("_id", "_scored", F.struct(*SCORE_FIELDS).alias(name))
        same = _scores_of(F.col(post_id), F.sha2(text, 256)) & F.col("_when")
        joined = joined.join(side, same, "left").drop("_id", "_scored")

    def moved(text: Column, found: str) -> Column:
        scores = F.struct(text.alias("text"), *(F.col(found)[f].alias(f) for f in SCORE_FIELDS))
        return F.when(F.col(found).isNotNull(), scores).otherwise(unscored(text))

    return _packed(joined, moved).drop("_when", "_own", "_parents")


def _packed(posts: DataFrame, moved: Callable[[Column, str], Column]) -> DataFrame:
    """Posts with their texts, and their parents', as the structs that `moved` makes of them."""
    parent = F.col("reference_tweets")
    packed = F.struct(
        parent["tweet_id"].alias("tweet_id"),
        parent["tweet_type"].alias("tweet_type"),
        parent["hashcashtags"].alias("hashcashtags"),
        moved(parent["text"], "_parents").alias("tweet_text"),
    )
    return posts.withColumns(
        {
            "tweet_text": moved(F.col("text"), "_own"),
            "reference_tweets": F.when(parent.isNotNull(), packed),
        }
    ).drop("text")
