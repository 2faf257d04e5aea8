"""The three batch jobs: land, clean, aggregate. These run actions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.functions.columns import flatten, resolve_long, with_date_parts, with_original_flag
from mention_pulse.functions.keys import PARTS
from mention_pulse.operators import rollup, serve
from mention_pulse.operators.spam import flag_spam, with_clean_text
from mention_pulse.operators.tags import tag_mentions, top_tickers
from mention_pulse.schemas import (
    LEVEL_METRICS,
    RECENT_POSTS,
    RECENT_POSTS_KEPT,
    TABLE_KEYS,
    TEXTS_AT,
    TICKER_ROLLUP,
    TICKER_ROLLUP_KEPT,
)
from mention_pulse.session import configure
from mention_pulse.sources import batches, files, tables

BATCH, SPAM = batches.BATCH, "possible_spam"
# text columns of the clean mentions
TEXTS = ("tweet_text_text", "tweet_text_clean")
# partition columns of the clean mentions, below batch and attempt
CLEAN_KEYS = [SPAM, *PARTS]


def day_of() -> Column:
    """yyyy-MM-dd of a row, from its partition columns alone."""
    return F.concat_ws("-", *PARTS[:3])


def part_of(columns: Sequence[str]) -> Column:
    """yyyy-MM-dd/batch/attempt of a clean mention, from its partition columns; what is absent counts as ''."""
    named = [F.coalesce(F.col(c), F.lit("")) if c in columns else F.lit("") for c in (BATCH, batches.ATTEMPT)]
    return F.concat_ws("/", day_of(), *named)


# ---- land ----------------------------------------------------------------------------------
def land_posts(posts: DataFrame, path: str, mode: str = "append") -> None:
    """Scored posts as Parquet by year, month, day and hour (taken from created_at if absent)."""
    tables.write_partitioned(with_date_parts(posts, "tweet_meta.created_at"), path, mode=mode)


def land_tickers(spark: SparkSession, csv: str, path: str) -> None:
    """Ticker CSV as Parquet."""
    tables.write_table(files.read_tickers(spark, csv), path, files=1)


# ---- clean ---------------------------------------------------------------------------------
def clean_mentions(
    posts: DataFrame, tickers: DataFrame, n_tickers: int = 100, url_mode: str = "greedy"
) -> DataFrame:
    """Landed posts to flat mentions with cleaned text and spam key."""
    flat = with_original_flag(flatten(with_date_parts(posts, "tweet_meta.created_at")))
    flat = flat.withColumn("author_id", resolve_long(flat, "author_id"))
    # cleaned once per post, before the fan-out over its tickers
    cleaned = with_clean_text(flat, url_mode=url_mode)
    return tag_mentions(cleaned, top_tickers(tickers, n_tickers))


def clean_posts(
    posts: DataFrame,
    tickers: DataFrame,
    n_tickers: int = 100,
    threshold: int = 1,
    count_unit: str = "mention",
    url_mode: str = "greedy",
    staged_as: str | None = None,
) -> DataFrame:
    """Landed posts to flat, flagged mentions; see `flag_spam` for `count_unit`.

    With `staged_as` the cleaned mentions are staged under that name, so that counting and
    flagging share one pass over the texts.
    """
    mentions = clean_mentions(posts, tickers, n_tickers, url_mode)
    if staged_as is not None:
        mentions = tables.stage(mentions, staged_as)
    return flag_spam(mentions, threshold, count_unit)


def write_clean(mentions: DataFrame, base: str, batch: str, source: str | None = None) -> dict[str, int]:
    """Clean and spam mentions of a batch, made from an attempt `source` of it where that is known; gives the rows of each.

    A batch written again is replaced as a whole: readers see the rows of its last write only, be
    they on the other side, in other hours, or none at all. Read it with `read_clean`.
    """
    spam = F.count_if(F.col(SPAM))
    watched, seen = tables.counted(mentions, f"clean_{batch}", n_spam=spam)
    batches.write_batch(watched, base, batch, CLEAN_KEYS, source, TEXTS)
    try:
        return seen.get
    except Py4JJavaError:  # an empty frame is planned away, with what was to be counted
        if not mentions.isEmpty():
            raise
        return {"n_rows": 0, "n_spam": 0}


def read_clean(
    spark: SparkSession, base: str, spam: bool = False, where: Column | None = None, with_texts: bool = True
) -> DataFrame:
    """Clean (or spam) mentions of all batches as they were written last.

    `base` is where `write_clean` wrote, or a plain Parquet table of mentions by year, month, day
    and hour. `where` holds for partition columns only, and prunes before files are listed. For `with_texts` see
    `batches.read_batches`.
    """
    if not batches.is_batched(spark, base):
        return files.read_table(spark, base, where)
    side = F.col(SPAM) == str(spam).lower()
    return batches.read_batches(spark, base, side if where is None else side & where, with_texts).drop(SPAM)


def clean_parts(spark: SparkSession, base: str) -> DataFrame:
    """(year, month, day, part) of all clean mentions there are, from the manifest where there is one."""
    if batches.is_batched(spark, base):
        found = batches.live_files(spark, base, CLEAN_KEYS).filter(F.col(SPAM) == "false")
    else:
        found = files.read_table(spark, base)
    return found.select(*PARTS[:3], part_of(found.columns).alias("part")).distinct()


# one row per post and ticker: TABLE_KEYS and the whole id, of which the time key holds ten digits
RECENT_KEYS = [*TABLE_KEYS["recent_posts"], "ID"]


# ---- aggregate -----------------------------------------------------------------------------
INDEX_KEYS = ("TickerDetail", "TIMESTAMP")
# one row per file of the index, see `tables.write_bounds`
INDEX_BOUNDS = T.StructType(
    [T.StructField(f, T.StringType()) for f in ("file", *(f"{m}_{c}" for c in INDEX_KEYS for m in ("min", "max")), tables.RUN)]
)


@dataclass(frozen=True)
class Serving:
    """Folders of the serving side under one base."""

    base: str

    @property
    def rollup(self) -> str:
        return f"{self.base}/ticker_rollup"

    @property
    def recent(self) -> str:
        return f"{self.base}/recent_posts"

    @property
    def texts(self) -> str:
        return f"{self.base}/recent_texts"

    @property
    def replaced(self) -> str:
        return f"{self.base}/recent_replaced"

    @property
    def twice(self) -> str:
        return f"{self.base}/recent_twice"

    @property
    def metrics(self) -> str:
        return f"{self.base}/level_metrics"

    @property
    def indexes(self) -> str:
        return f"{self.base}/ticker_rollup_by_ticker"

    def index(self, run_id: str) -> str:
        return f"{self.indexes}/{tables.RUN}={run_id}"

    @property
    def bounds(self) -> str:
        return f"{self.base}/ticker_rollup_by_ticker_bounds"

    @property
    def manifest(self) -> str:
        return f"{self.base}/runs"


def _merged_parts(spark: SparkSession, manifest: str) -> DataFrame:
    """Parts that make up the current state: those of a rebuilt day from its last rebuild on."""
    runs = tables.read_manifest(spark, manifest)
    rebuilt = _rebuilt_days(runs)
    parts = runs.select("committed_at", F.explode("parts").alias("part"))
    own = (F.substring("part", 1, 10) == F.col("rebuilt_day")) & (F.col("committed_at") < F.col("rebuilt_at"))
    return parts.join(F.broadcast(rebuilt), own, "left_anti").select("part").distinct()


def _rebuilt_days(runs: DataFrame) -> DataFrame:
    """(rebuilt_day, rebuilt_at) of the last rebuild of each day: at most one row a calendar day."""
    days = runs.select("committed_at", F.explode("rebuilt").alias("rebuilt_day"))
    return days.groupBy("rebuilt_day").agg(F.max("committed_at").alias("rebuilt_at"))


def new_parts(spark: SparkSession, clean_path: str, manifest: str, run_date: dt.date | None) -> list[str]:
    """Batches of closed days no committed run has merged yet, late ones of merged days included.

    The list is bounded by the batches landed since the last run, times their days.
    """
    parts = files.closed_days(clean_parts(spark, clean_path), run_date).select("part")
    return sorted(row["part"] for row in parts.join(_merged_parts(spark, manifest), "part", "left_anti").collect())


def stale_days(spark: SparkSession, clean_path: str, base: str) -> list[str]:
    """Days of which a merged batch has been written again since, or taken away: to be rebuilt."""
    merged = _merged_parts(spark, Serving(base).manifest)
    gone = merged.join(clean_parts(spark, clean_path).select("part"), "part", "left_anti")
    return sorted(row["day"] for row in gone.select(F.substring("part", 1, 10).alias("day")).distinct().collect())


def refuse_committed(spark: SparkSession, manifest: str, run_id: str) -> None:
    """A run id names one run: writing under a committed one would undo what it serves."""
    if not tables.read_manifest(spark, manifest).filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is committed already")


def _mentions_of(spark: SparkSession, clean_path: str, parts: Sequence[str]) -> DataFrame:
    """Clean mentions of some parts: a scan that lists just their days and batches, and leaves texts that lie apart there."""
    if not batches.is_batched(spark, clean_path):
        clean = files.read_table(spark, clean_path)
        return clean.filter(part_of(clean.columns).isin(list(parts)))
    keys = [BATCH, batches.ATTEMPT, *PARTS]
    return read_clean(spark, clean_path, where=part_of(keys).isin(list(parts)), with_texts=False)


def _write_rollup(rows: DataFrame, out: Serving, run_id: str) -> None:
    """Roll-up rows of a run, by level for leaderboards and by ticker for trends."""
    tables.write_snapshot(rows, out.rollup, run_id, order=TABLE_KEYS["ticker_rollup"])
    written = tables.read_snapshot(rows.sparkSession, out.rollup, run_id, TICKER_ROLLUP_KEPT)
    tables.write_index(written.drop(tables.RUN), out.index(run_id))
    bounds = f"{out.bounds}/{tables.RUN}={run_id}"
    tables.write_bounds(rows.sparkSession, out.index(run_id), bounds, INDEX_KEYS, TICKER_ROLLUP_KEPT)


def _delivered_once(recent: DataFrame, out: Serving, run_id: str) -> DataFrame:
    """Of posts delivered twice within a run one each, the same whenever the run is repeated.

    Their keys are found over keys alone, and written; only posts of these keys are sorted, texts and all.
    """
    twice = recent.groupBy(*RECENT_KEYS).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    tables.write_snapshot(twice, out.twice, run_id)
    kept = T.StructType([f for f in RECENT_POSTS.fields if f.name in (*RECENT_KEYS, tables.RUN)])
    twice = tables.read_snapshot(recent.sparkSession, out.twice, run_id, kept)
    if twice.isEmpty():
        return recent
    named = twice.select(*(F.col(k).alias(f"_{k}") for k in RECENT_KEYS))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in RECENT_KEYS))
    chosen = recent.join(named, same, "left_semi")
    # by the whole row: texts that are kept apart are read for that, and left again
    whole = [c for c in recent.columns if c != TEXTS_AT]
    if TEXTS_AT in recent.columns:
        at = F.col(TEXTS_AT).alias("_at")
        chosen = tables.with_texts(chosen.select("*", at), tables.TEXTS, out.texts).withColumnRenamed("_at", TEXTS_AT)
        whole += tables.TEXTS
    chosen = chosen.withColumn("_order", F.xxhash64(*whole)).select(*recent.columns, "_order")
    order = Window.partitionBy(*RECENT_KEYS).orderBy("_order")
    chosen = chosen.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1")
    return recent.join(named, same, "left_anti").unionByName(chosen.select(*recent.columns))


def _write_recent(
    mentions: DataFrame, clean_path: str, out: Serving, run_id: str, n_keys: int, rebuilt: Sequence[str] = ()
) -> tuple[str | None, str | None]:
    """Recent posts of a run, and the keys of earlier runs' posts that it replaces; gives the bounds of its keys.

    Where the mentions have their texts apart, the serving side takes a copy of these files and never moves a text.
    """
    spark = mentions.sparkSession
    recent = serve.recent_table(mentions, n_keys)
    if TEXTS_AT in recent.columns:
        recent = tables.take_texts(recent, clean_path, out.texts)
    once = _delivered_once(recent, out, run_id)
    tables.write_snapshot(tables.recency_layout(once), out.recent, run_id, compression="zstd")
    mine = tables.read_snapshot(spark, out.recent, run_id, RECENT_POSTS)
    first, last = mine.agg(F.min("TIMESTAMP"), F.max("TIMESTAMP")).first()
    if first is not None:
        earlier = _live_recent(spark, out, bounds=(first, last))
        again = earlier.select(*RECENT_KEYS).join(mine.select(*RECENT_KEYS), RECENT_KEYS, "left_semi")
        if rebuilt:
            again = again.filter(~F.substring("TIMESTAMP", 1, 10).isin(list(rebuilt)))
        tables.write_snapshot(again, out.replaced, run_id)
    return first, last


def aggregate(
    spark: SparkSession,
    clean_path: str,
    base: str,
    run_id: str,
    run_date: dt.date | None = None,
    n_keys: int = 5,
) -> bool:
    """Merge the new batches of closed days into the serving tables; False if there are none.

    A run writes what its own batches add, at all levels, and nothing of history: readers sum up the
    runs since the last whole one (see `compact`). A post that lands late for a merged day comes in a
    batch of its own, and so joins its day. A merged batch that was written again makes its days stale:
    they are rebuilt first, as run `<run_id>.rebuild`. All tables are written under the new run id first; the
    manifest row, which names the run and what it merged, comes last. A run that fails before has no
    effect, and running it again replaces what it left.
    """
    configure(spark)
    out = Serving(base)
    stale = stale_days(spark, clean_path, base)
    if stale:
        rebuild_days(spark, clean_path, base, f"{run_id}.rebuild", stale, n_keys)
    parts = new_parts(spark, clean_path, out.manifest, run_date)
    if not parts:
        return bool(stale)
    refuse_committed(spark, out.manifest, run_id)
    mentions = _mentions_of(spark, clean_path, parts)
    chain = tables.current_chain(spark, out.manifest)

    hours = rollup.hour_partials(mentions).persist()
    try:
        _write_rollup(rollup.stored_rollup(hours), out, run_id)
        tables.write_snapshot(rollup.metrics_from_hours(hours), out.metrics, run_id)
    finally:
        hours.unpersist()
    bounds = _write_recent(mentions, clean_path, out, run_id, n_keys)
    tables.commit_run(spark, out.manifest, run_id, parts, chain=[*chain, run_id], bounds=bounds)
    return True


def compact(spark: SparkSession, base: str, run_id: str, longest: int = 16) -> bool:
    """Make one run of the chain that readers sum up, once it has more than `longest` runs; False before.

    Recent posts are not touched. Runs that the new one stands for stay where they are.
    """
    configure(spark)
    out = Serving(base)
    chain = tables.current_chain(spark, out.manifest)
    if len(chain) <= longest:
        return False
    refuse_committed(spark, out.manifest, run_id)
    rows = tables.read_snapshots(spark, out.rollup, chain, TICKER_ROLLUP_KEPT)
    _write_rollup(rollup.merge_stored(rows), out, run_id)
    metrics = tables.read_snapshots(spark, out.metrics, chain, LEVEL_METRICS)
    tables.write_snapshot(rollup.merge_metrics_of(metrics), out.metrics, run_id)
    tables.commit_run(spark, out.manifest, run_id)
    return True


def rebuild_days(
    spark: SparkSession, clean_path: str, base: str, run_id: str, days: list[str], n_keys: int = 5
) -> None:
    """Redo some days whose posts were landed again, merged before or not, as a new run.

    The run owns what the days hold now, so no later run merges it again; batches that land for
    them afterwards are merged as usual. Recent posts of the days are written anew, and those of
    earlier runs are void: posts that the days no longer hold are served no more.
    """
    configure(spark)
    out = Serving(base)
    refuse_committed(spark, out.manifest, run_id)
    chain = tables.current_chain(spark, out.manifest)
    # exactly what is committed is read, should more batches land meanwhile
    held = clean_parts(spark, clean_path).filter(F.substring("part", 1, 10).isin(list(days)))
    parts = sorted(row["part"] for row in held.select("part").collect())
    mentions = _mentions_of(spark, clean_path, parts)
    fresh = rollup.stored_rollup(rollup.hour_partials(mentions))
    old = rollup.merge_stored(tables.read_snapshots(spark, out.rollup, chain, TICKER_ROLLUP_KEPT))
    _write_rollup(rollup.replace_days(old, fresh, days), out, run_id)
    rebuilt = tables.read_snapshot(spark, out.rollup, run_id, TICKER_ROLLUP)
    tables.write_snapshot(rollup.metrics_of_rollup(rebuilt), out.metrics, run_id)
    bounds = _write_recent(mentions, clean_path, out, run_id, n_keys, days)
    tables.commit_run(spark, out.manifest, run_id, parts, rebuilt=days, bounds=bounds)


# ---- serving reads -------------------------------------------------------------------------
def _summed_up(rows: DataFrame, chain: Sequence[str]) -> DataFrame:
    """Roll-up rows of a chain of runs as those of its last: one run as it lies, several merged by key.

    Filters on the keys reach the scan of each run either way.
    """
    if len(chain) == 1:
        return rows.drop("FIRST").withColumn(tables.RUN, F.lit(chain[-1]))
    return rollup.merge_stored(rows).drop("FIRST").withColumn(tables.RUN, F.lit(chain[-1]))


def read_rollup(spark: SparkSession, base: str) -> DataFrame:
    """Ticker roll-up as of the current run, clustered by DetailLevel: for `at_level`, `leaderboard`."""
    out = Serving(base)
    chain = tables.current_chain(spark, out.manifest)
    if not chain:
        return spark.createDataFrame([], TICKER_ROLLUP)
    rows = tables.read_snapshots(spark, out.rollup, chain, TICKER_ROLLUP_KEPT)
    return _summed_up(rows, chain).select(*TICKER_ROLLUP.fieldNames())


def _index_paths(
    spark: SparkSession, out: Serving, chain: Sequence[str], details: Sequence[str], start: str | None, end: str | None
) -> list[str]:
    """Files of the index that may hold rows of some `TickerDetail`s and times; a run without bounds is taken whole."""
    wanted = reduce(or_, (tables.may_hold("TickerDetail", d, d) for d in details))
    if len(chain) == 1:
        # with more runs the time of a row is the earliest over all of them
        wanted = wanted & tables.may_hold("TIMESTAMP", start, end)
    try:
        bounds = tables.read_snapshots(spark, out.bounds, chain, INDEX_BOUNDS)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [out.index(run) for run in chain]
    # what comes to the driver is a run's name and the names of the files that the answer is in
    found = bounds.groupBy(tables.RUN).agg(F.collect_list(F.when(wanted, F.col("file"))).alias("files")).collect()
    by_run = {row[tables.RUN]: row["files"] for row in found}
    return [p for run in chain for p in ([f"{out.index(run)}/{f}" for f in by_run[run]] if run in by_run else [out.index(run)])]


def read_index(
    spark: SparkSession,
    base: str,
    details: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The same clustered by TickerDetail and time: for `trend`, `latest_periods`, `compare`.

    With `details` only files that may hold one of these `TickerDetail`s are listed and opened, and of a
    single run only those that may hold a time between the ends; rows beside the wanted ones remain, to be filtered.
    """
    out = Serving(base)
    chain = tables.current_chain(spark, out.manifest)
    paths = [out.index(run) for run in chain]
    if chain and details:
        paths = _index_paths(spark, out, chain, details, start, end)
    if not paths:
        return spark.createDataFrame([], TICKER_ROLLUP).drop(tables.RUN)
    # whole folders of runs and single files of others go together under one base
    rows = spark.read.schema(TICKER_ROLLUP_KEPT).option("basePath", out.indexes).parquet(*paths)
    return _summed_up(rows, chain).select(*TICKER_ROLLUP.fieldNames()[:-1])


def read_trend(
    spark: SparkSession, base: str, ticker: str, level: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """`serve.trend` from the files of the index that may hold it."""
    details = [serve.ticker_detail_of(ticker, level)]
    return serve.trend(read_index(spark, base, details, start, end), ticker, level, start, end)


def read_comparison(
    spark: SparkSession, base: str, first: str, second: str, level: str, days: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """`serve.compare` from the files of the index that may hold either ticker."""
    details = [serve.ticker_detail_of(ticker, level) for ticker in (first, second)]
    return serve.compare(read_index(spark, base, details), first, second, level, days)


def read_metrics(spark: SparkSession, base: str) -> DataFrame:
    """Level metrics as of the current run, with the counters of the previous periods."""
    out = Serving(base)
    chain = tables.current_chain(spark, out.manifest)
    rows = tables.read_snapshots(spark, out.metrics, chain, LEVEL_METRICS)
    if len(chain) > 1:
        rows = rollup.merge_metrics_of(rows).withColumn(tables.RUN, F.lit(chain[-1]))
    return rollup.with_previous(rows)


def _live_recent(
    spark: SparkSession, out: Serving, run_ids: Sequence[str] | None = None, bounds: tuple[str, str] | None = None
) -> DataFrame:
    """Recent posts that stand, of all committed runs or of some, RUN_ID being the run that wrote each.

    Void are those of days rebuilt since, and those whose key a later run wrote again. Both are known
    by small tables, so posts themselves are only filtered: nothing sorts or shuffles them. Texts that lie apart
    are left there; see `_with_texts`.
    """
    runs = tables.read_manifest(spark, out.manifest)
    stamps = runs.select(F.col("run_id").alias(tables.RUN), "committed_at")
    if runs.isEmpty():
        return spark.createDataFrame([], RECENT_POSTS_KEPT)
    rows = spark.read.schema(RECENT_POSTS_KEPT).parquet(out.recent)
    if run_ids is not None:
        rows = rows.filter(F.col(tables.RUN).isin(list(run_ids)))
    if bounds is not None:
        rows = rows.filter(F.col("TIMESTAMP").between(*bounds))
    rows = rows.join(F.broadcast(stamps), tables.RUN)  # one row a run
    own = (F.substring("TIMESTAMP", 1, 10) == F.col("rebuilt_day")) & (F.col("committed_at") < F.col("rebuilt_at"))
    rows = rows.join(F.broadcast(_rebuilt_days(runs)), own, "left_anti")
    again = _replaced_keys(spark, out, stamps, bounds)
    if again is not None:
        same = [F.col(k) == F.col(f"_{k}") for k in RECENT_KEYS]
        rows = rows.join(again, [*same, F.col("committed_at") < F.col("replaced_at")], "left_anti")
    return rows.select(*RECENT_POSTS_KEPT.fieldNames())


def _with_texts(recent: DataFrame, out: Serving, run: str | None) -> DataFrame:
    """Rows of `_live_recent` as they are served by a run, texts and all."""
    return tables.open_texts(recent.withColumn(tables.RUN, F.lit(run)), RECENT_POSTS, tables.TEXTS, out.texts)


def _replaced_keys(spark: SparkSession, out: Serving, stamps: DataFrame, bounds: tuple[str, str] | None) -> DataFrame | None:
    """Keys written again, with the time of the last write; None if there are none."""
    columns = [f for f in RECENT_POSTS.fields if f.name in RECENT_KEYS or f.name == tables.RUN]
    try:
        found = spark.read.schema(T.StructType(columns)).parquet(out.replaced)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if bounds is not None:
        found = found.filter(F.col("TIMESTAMP").between(*bounds))
    # a key is replaced rarely, and each time from the run on that wrote it again
    found = found.join(F.broadcast(stamps), tables.RUN)
    named = found.select(*(F.col(k).alias(f"_{k}") for k in RECENT_KEYS), F.col("committed_at").alias("replaced_at"))
    return named.groupBy(*(f"_{k}" for k in RECENT_KEYS)).agg(F.max("replaced_at").alias("replaced_at"))


def read_recent(spark: SparkSession, base: str) -> DataFrame:
    """Recent posts of all committed runs as of the current one; a post delivered again is shown as it came last."""
    out = Serving(base)
    run = tables.current_run(spark, out.manifest)
    return _with_texts(_live_recent(spark, out), out, run) if run else spark.createDataFrame([], RECENT_POSTS)


def read_newest(
    spark: SparkSession,
    base: str,
    n: int = 100,
    start: str | None = None,
    end: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """The n newest recent posts, as `serve.recent_posts` of `read_recent`, from as few runs as will do.

    Runs are asked from the one with the newest post on, twice as many each time, for the keys of
    their n newest posts; once n are found that are all newer than whatever the other runs hold, these are left
    alone. Texts are read last, for the time span that the n posts cover.
    """
    out = Serving(base)
    runs = tables.read_manifest(spark, out.manifest).filter("last_key IS NOT NULL")
    waiting = [(r["last_key"], r["run_id"]) for r in runs.select("last_key", "run_id").collect()]  # one row a run
    waiting = sorted((w for w in waiting if start is None or w[0] >= start), reverse=True)
    keys = [*RECENT_KEYS, tables.RUN]
    best: list[tuple[str, ...]] = []
    step = 1
    while waiting and (len(best) < n or waiting[0][0] >= best[-1][RECENT_KEYS.index("TIMESTAMP")]):
        asked, waiting, step = [run for _, run in waiting[:step]], waiting[step:], 2 * step
        rows = serve.recent_posts(_live_recent(spark, out, asked).select(*keys), n, start, end, ticker)
        best += [tuple(r[k] for k in keys) for r in rows.collect()]  # n rows at most
        best = sorted(best, key=lambda r: _newness(dict(zip(keys, r))), reverse=True)[:n]
    current = tables.current_run(spark, out.manifest)
    if not best:
        return spark.createDataFrame([], RECENT_POSTS)
    times = [r[RECENT_KEYS.index("TIMESTAMP")] for r in best]
    found = _live_recent(spark, out, sorted({r[-1] for r in best}), (min(times), max(times)))
    chosen = spark.createDataFrame(best, T.StructType([RECENT_POSTS[k] for k in keys]))
    newest = serve.recent_posts(found.join(F.broadcast(chosen), keys, "left_semi"), n, start, end, ticker)
    return _with_texts(newest, out, current)


def _newness(row: dict[str, str]) -> tuple[str, str, str]:
    return row["TIMESTAMP"], row["TICKER"], row["ID"]
