"""The test tables in the shapes of this library: posts, mentions, replies, tickers, lexicon.

Every adapter reads its tables whole. Events become posts; the text of post i is document
i modulo the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mention_pulse.functions.columns import to_epoch, with_date_parts
from mention_pulse.functions.text import clean_text, extract_tags
from mention_pulse.operators.tags import tag_mentions, top_tickers
from mention_pulse.schemas import POSTS_RAW

N_TICKERS = 20

# Frequent words of the documents, with valences set by hand.
LEXICON = [
    ("the", 1.0),
    ("of", -1.0),
    ("and", 0.5),
    ("in", -0.5),
    ("is", 2.0),
    ("that", -2.0),
    ("de", 1.0),
    ("la", -1.0),
    ("le", 0.5),
    ("que", -0.5),
    ("des", 2.0),
    ("der", 1.0),
    ("die", -1.0),
    ("und", -2.0),
    ("zu", 0.5),
    ("el", -0.5),
    ("thatin", 3.0),
    ("ononst", -3.0),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a small table over the cores before costly work on each row, texts above all.

    A table of few bytes may be a single row group, hence a single task. One that has a split of
    full size for every core is left as it lies. Sizes come from the file listing; no job runs.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df if size >= split * cores else df.repartition(cores, key)


def tag_of(number: Column) -> Column:
    return F.concat(F.lit("T"), number.cast("string"))


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the ticker dimension."""
    return table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("sno"),
        tag_of(F.col("n_nationkey")).alias("ticker"),
        F.col("n_name").alias("ticker_name"),
    )


def tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_tickers(tickers(spark, sf_dir), N_TICKERS)


def sentiment_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin("purchase", "signup"), "POSITIVE")
        .when(event_type == "error", "NEGATIVE")
        .otherwise("NEUTRAL")
    )


def _with_document(
    spark: SparkSession, sf_dir: str, events: DataFrame, *columns: str | Column
) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = docs.count()
    picked = spread(docs, "doc_id").select(F.col("doc_id").alias("_doc"), *columns)
    # a sorted merge: both sides grow with the data, and what is computed of a document is
    # computed before the join, once
    same = F.col("event_id") % size == F.col("_doc")
    return events.join(picked.hint("merge"), same, "inner").drop("_doc")


def with_texts(spark: SparkSession, sf_dir: str, recent: DataFrame) -> DataFrame:
    """Rows of the recent-posts table, chosen by key, with the text of their posts put in."""
    docs = table(spark, sf_dir, "documents")
    size = docs.count()
    keyed = recent.drop("TEXT", "CLEANTEXT")
    same = F.col("ID").cast("bigint") % size == F.col("_doc")
    found = keyed.join(docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("TEXT")), same)
    return found.drop("_doc").withColumn("CLEANTEXT", clean_text("TEXT"))


def posts(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Events as flat, scored posts with two tag lists; most have no parent."""
    events = table(spark, sf_dir, "events")
    if with_text:
        # each document is cleaned once, not once per event
        clean = clean_text("text").alias("clean")
        events = _with_document(spark, sf_dir, events, "text", clean)
    quarter = F.col("event_id") % 4 == 0
    out = events.select(
        F.col("event_id").alias("tweet_id"),
        F.col("user_id").alias("author_id"),
        to_epoch("ts").alias("tweet_meta_created_at"),
        sentiment_of(F.col("event_type")).alias("tweet_text_sentiment"),
        F.array(tag_of(F.col("user_id") % 20)).alias("tweet_meta_hashcashtags"),
        F.when(quarter, F.array(tag_of(F.col("event_id") % 30))).alias(
            "reference_tweets_hashcashtags"
        ),
        *([F.col("text").alias("tweet_text_text")] if with_text else []),
        *([F.col("clean").alias("tweet_text_clean")] if with_text else []),
    )
    return with_date_parts(out, "tweet_meta_created_at")


def mentions(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Posts by tracked ticker: some tags miss, some posts have two tickers."""
    return tag_mentions(posts(spark, sf_dir, with_text), tracked(spark, sf_dir))


def doc_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts of one tag each."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("tweet_id"),
        F.col("text").alias("tweet_text_text"),
        F.array(tag_of(F.col("doc_id") % 20)).alias("tweet_meta_hashcashtags"),
        F.lit(None).cast("array<string>").alias("reference_tweets_hashcashtags"),
    )


def tagged_text(kind: Column) -> Column:
    """Text of a made-up post: views carry no tag, purchases start with a number of their own."""
    buy = F.concat(
        F.lit("Buy $T"), (F.col("user_id") % 20).cast("string"),
        F.lit(" #t"), (F.col("event_id") % 30).cast("string"),
        F.lit(" "), kind, F.lit(" "), "props",
    )
    return (
        F.when(kind == "view", F.concat(F.lit("holding "), "props"))
        .when(kind == "purchase", F.concat(F.col("event_id").cast("string"), F.lit(" "), buy))
        .otherwise(buy)
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested, unscored posts: errors are sensitive, signups answer a tagged post."""
    kind = F.col("event_type")
    text = tagged_text(kind)
    parent_text = F.concat(F.lit("about #T"), (F.col("event_id") % 25).cast("string"))
    parent = F.struct(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.lit("original").alias("tweet_type"),
        parent_text.alias("text"),
        extract_tags(parent_text).alias("hashcashtags"),
    )
    built = spread(table(spark, sf_dir, "events"), "event_id").select(
        F.col("event_id").alias("tweet_id"),
        F.col("user_id").alias("author_id"),
        text.alias("text"),
        F.struct(
            to_epoch("ts").alias("created_at"),
            F.when(kind == "signup", "replied_to").otherwise("original").alias("tweet_type"),
            F.when(kind != "click", kind == "error").alias("sensitive"),
            extract_tags(text).alias("hashcashtags"),
        ).alias("tweet_meta"),
        F.when(kind == "signup", parent).alias("reference_tweets"),
    )
    return built.to(POSTS_RAW)


def doc_lines(spark: SparkSession, sf_dir: str, where: Column) -> DataFrame:
    """Documents as lines of JSON posts; some have no text, a parent, a flag or a repeat, some lines are no JSON."""
    doc = F.col("doc_id")
    parent = F.struct(
        doc.cast("string").alias("tweet_id"),
        F.element_at(F.array(*(F.lit(w) for w in ("the", "of", "nothing"))), (doc % 3 + 1).cast("int")).alias("text"),
    )
    post = F.to_json(
        F.struct(
            doc.alias("tweet_id"),
            F.when(doc % 7 != 3, F.col("text")).alias("text"),
            F.struct(
                (F.lit(1_700_000_000) + doc).alias("created_at"),
                F.when(doc % 13 == 0, True).alias("sensitive"),
                F.array(tag_of(doc % 20)).alias("hashcashtags"),
            ).alias("tweet_meta"),
            F.when(doc % 5 == 0, parent).alias("reference_tweets"),
        )
    )
    again = F.array_repeat(post, F.when(doc % 11 == 0, 2).otherwise(1))
    line = F.when(doc % 17 == 1, F.array(F.concat(F.lit("no post "), doc.cast("string")))).otherwise(again)
    return table(spark, sf_dir, "documents").filter(where).select(F.explode(line).alias("value"))


def stream_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts before capture, in the language of their document."""
    kind = F.col("event_type")
    events = _with_document(spark, sf_dir, table(spark, sf_dir, "events"), "lang")
    return events.select(
        F.col("event_id").alias("tweet_id"),
        tagged_text(kind).alias("text"),
        "lang",
        F.when(kind == "click", "retweeted").otherwise("original").alias("tweet_type"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a forest of reply threads; every third event answers the one of half its id."""
    answers = (F.col("event_id") % 3 == 0) & (F.col("event_id") > 0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tweet_id"),
        F.when(answers, F.floor(F.col("event_id") / 2).cast("bigint")).alias("parent_id"),
        F.concat(F.lit("root #"), "event_type").alias("text"),
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, valence double")
