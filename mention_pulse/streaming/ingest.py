"""Continuous ingest, and incremental runs over newly landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mention_pulse.functions.columns import with_date_parts
from mention_pulse.functions.keys import PARTS
from mention_pulse.operators.capture import FAILED, OK, is_relevant, with_status
from mention_pulse.operators.sentiment import Lexicon, pack_scores, pack_scores_by_join
from mention_pulse.plans import jobs
from mention_pulse.schemas import POSTS_RAW, POSTS_SCORED
from mention_pulse.session import configure
from mention_pulse.sources import batches
from mention_pulse.sources.files import CORRUPT, incremental

# Fixed value: the pace of the capture cycle.
PACE = "30 seconds"


# A lexicon of checked size, a scorer of texts, or a lexicon table of any size.
Scoring = Lexicon | Callable[[Column], Column] | DataFrame


def score_posts(posts: DataFrame, scorer: Scoring) -> DataFrame:
    """Relevant posts, scored, with their `result`.

    Row by row, so fit for a stream, unless the scorer is a table, which is joined: for frames and
    the batches of a stream. Where the source keeps bad lines (`_corrupt_record`), they and posts without
    an id stay, as failed, with the line.
    """
    pack = pack_scores_by_join if isinstance(scorer, DataFrame) else pack_scores
    if CORRUPT not in posts.columns:
        scored = pack(posts.filter(is_relevant()), scorer)
        return with_status(scored).select(*POSTS_SCORED.fieldNames(), "result")
    unread = F.col(CORRUPT).isNotNull() | F.col("tweet_id").isNull()
    scored = with_status(pack(posts.filter(unread | is_relevant()), scorer, when=~unread))
    result = F.when(unread, FAILED).otherwise(F.col("result")).alias("result")
    return scored.select(*POSTS_SCORED.fieldNames(), CORRUPT, result)


def start_ingest(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    scorer: Scoring,
    pace: str | None = PACE,
    max_files: int | None = None,
) -> StreamingQuery:
    """Stream JSON posts into Parquet by result, year, month, day and hour.

    Posts without a score and lines that cannot be read land too, marked as failed; `landed` tells
    them apart. With `pace=None` the query takes what is there and ends. With a lexicon table the words
    of each batch are joined to it, whatever its size, and `out` is a table of batches
    (`sources.batches`): a batch that Spark repeats replaces itself.
    """
    configure(spark)
    posts = incremental(spark, src, POSTS_RAW, "json", max_files, True)
    keys = ["result", *PARTS]
    if isinstance(scorer, DataFrame):

        def handle(batch: DataFrame, n: int) -> None:
            batch = batch.persist()  # read for the words and again for the posts
            try:
                scored = with_date_parts(score_posts(batch, scorer), "tweet_meta.created_at")
                batches.write_batch(scored, out, f"{n:012d}", keys)
            finally:
                batch.unpersist()

        writer = posts.writeStream.foreachBatch(handle)
    else:
        parted = with_date_parts(score_posts(posts, scorer), "tweet_meta.created_at")
        writer = parted.writeStream.format("parquet").option("path", out).partitionBy(*keys)
        writer = writer.option("compression", "snappy")
    writer = writer.option("checkpointLocation", checkpoint)
    timed = writer.trigger(availableNow=True) if pace is None else writer.trigger(processingTime=pace)
    return timed.start()


def landed(spark: SparkSession, out: str, result: str = OK) -> DataFrame:
    """Posts of one result from where `start_ingest` wrote them: a pruned scan.

    Failed ones have their unreadable line, if that was the reason, in `_corrupt_record`.
    """
    wanted = F.col("result") == result
    if batches.is_batched(spark, out):
        rows = batches.read_batches(spark, out, wanted).drop(batches.BATCH, batches.ATTEMPT)
    else:
        rows = spark.read.parquet(out).filter(wanted)
    rows = rows.drop("result")
    return rows.drop(CORRUPT) if result == OK else rows


def run_incremental(
    stream: DataFrame, handle: Callable[[DataFrame, str], None], checkpoint: str
) -> None:
    """Hand everything new to `handle(batch, batch id)` and end; one commit per batch.

    A batch that failed comes again with the same id, so `handle` should replace, not append.
    """
    query = (
        stream.writeStream.foreachBatch(lambda batch, n: handle(batch, f"{n:012d}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_new(
    spark: SparkSession, src: str, out: str, checkpoint: str, max_files: int | None = None
) -> None:
    """Newly landed scored JSON posts to Parquet by year, month, day and hour.

    A line that cannot be read lands as a row of nulls with the line in `_corrupt_record`.
    """
    configure(spark)
    stream = incremental(spark, src, POSTS_SCORED, "json", max_files, keep_corrupt=True)
    posts = with_date_parts(stream, "tweet_meta.created_at")
    query = (
        posts.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTS)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def clean_new(
    spark: SparkSession,
    src: str,
    tickers: str,
    base: str,
    checkpoint: str,
    max_files: int | None = None,
    **options: object,
) -> None:
    """Newly landed Parquet posts to clean and spam mentions; the ticker list is read whole.

    `src` is what `start_ingest` or `land_new` wrote. Batches of a table of batches are cleaned one by one,
    those that were written again since once more; no checkpoint is needed for them.
    """
    configure(spark)
    parted = T.StructType([*POSTS_SCORED.fields, *(T.StructField(p, T.StringType()) for p in PARTS)])

    def handle(batch: DataFrame, batch_id: str) -> None:
        if batch.isEmpty():
            return
        dim = spark.read.parquet(tickers)
        flagged = jobs.clean_posts(batch, dim, staged_as=f"clean/{batch_id}", **options)
        jobs.write_clean(flagged, base, batch_id)

    if not batches.is_batched(spark, src):
        run_incremental(incremental(spark, src, parted, "parquet", max_files), handle, checkpoint)
        return
    is_ok = F.col("result") == OK
    for batch_id, attempt in batches.stale(spark, src, base):
        dim = spark.read.parquet(tickers)
        posts = batches.read_batches(spark, src, is_ok & (F.col(batches.BATCH) == batch_id)).select(*parted.fieldNames())
        flagged = jobs.clean_posts(posts, dim, staged_as=f"clean/{batch_id}", **options)
        jobs.write_clean(flagged, base, batch_id, attempt)
