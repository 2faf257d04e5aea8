import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mention_pulse.functions.keys import PARTS
from mention_pulse.operators import rollup, serve, tags
from mention_pulse.operators.sentiment import Lexicon, scorer_udf
from mention_pulse.plans import jobs
from mention_pulse.schemas import POSTS_RAW, POSTS_SCORED, TICKER_ROLLUP_KEPT
from mention_pulse.sources import batches, files, tables
from mention_pulse.streaming import ingest

LEXICON_WORDS = {2.0: ["good"], -2.0: ["bad"]}
LEXICON = Lexicon(LEXICON_WORDS)
DAY0 = 1666915200.0  # 2022-10-28 00:00:00 UTC


def post(i, text, tags_, day=0, sensitive=False, parent=None):
    meta = {"created_at": DAY0 + 86400 * day + i, "tweet_type": "original", "sensitive": sensitive, "hashcashtags": tags_}
    out = {"tweet_id": i, "author_id": i, "text": text, "tweet_meta": meta}
    if parent:
        out["reference_tweets"] = parent
    return out


FIRST = [
    post(1, "good one here", ["A"]),
    post(2, "bad two there", ["B", "X"], 1),
    post(3, "hidden good", ["A"], 1, True),
    post(4, "same start of a text and more", ["A"]),
    post(5, "same start of a text and more again", ["C"]),
    post(6, "untracked", ["X"]),
    post(7, "reply plain", [], 1, parent={"tweet_id": "1", "tweet_type": "original", "text": "good", "hashcashtags": ["C"]}),
]
SECOND = [post(8, "late good", ["A"], 1), post(9, "later bad words", ["B"], 2), post(10, "today good", ["C"], 3)]


def drop(folder, name, posts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in posts))


@pytest.fixture
def dim(spark, tmp_path):
    path = tmp_path / "tickers.csv"
    path.write_text("#,Symbol,Company,Weight\n1,A,Aa,3\n2,B,Bb,2\n3,C,Cc,1\n4,X,Xx,0\n")
    jobs.land_tickers(spark, str(path), str(tmp_path / "dim"))
    return str(tmp_path / "dim")


def take_in(spark, tmp_path):
    query = ingest.start_ingest(spark, str(tmp_path / "raw"), str(tmp_path / "landed"), str(tmp_path / "ck1"), LEXICON, None)
    query.awaitTermination()
    return ingest.landed(spark, str(tmp_path / "landed"))


def test_two_drops_equal_one_batch_and_a_rerun_adds_nothing(spark, tmp_path):
    drop(tmp_path / "raw", "a.json", FIRST)
    assert take_in(spark, tmp_path).count() == 6
    drop(tmp_path / "raw", "b.json", SECOND)
    got = take_in(spark, tmp_path)
    once = ingest.score_posts(files.read_posts(spark, str(tmp_path / "raw")), LEXICON).drop("result")
    assert rows(got.select(*POSTS_SCORED.fieldNames())) == rows(once.select(*POSTS_SCORED.fieldNames()))
    assert take_in(spark, tmp_path).count() == got.count() == 9
    days = {(r["year"], r["month"], r["day"]) for r in got.collect()}
    assert ("2022", "10", "28") in days and len(days) == 4


def test_paced_ingest_with_own_scorer_keeps_failures_apart(spark, tmp_path):
    def score(text):
        if "bad" in text:
            raise ValueError
        return "NEUTRAL", 0.0, 0.0, 0.0

    drop(tmp_path / "raw", "a.json", FIRST)
    drop(tmp_path / "raw", "b.json", SECOND)
    query = ingest.start_ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck"),
                                scorer_udf(score), "1 second", max_files=1)
    try:
        query.processAllAvailable()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    finally:
        query.stop()
    assert rows(ingest.landed(spark, str(tmp_path / "out"), "ProcessingFailed"), "tweet_id") == [(2,), (9,)]
    assert ingest.landed(spark, str(tmp_path / "out")).count() == 7


def test_a_lexicon_of_any_size_scores_a_stream(spark, tmp_path, dim):
    """200,000 words, joined batch by batch, give the scores of a small literal with the words that occur."""
    listed = {w: v for v, ws in LEXICON_WORDS.items() for w in ws}
    large = spark.range(200_000).selectExpr("concat('w', id) AS token", "1.0 AS valence")
    large = large.unionByName(spark.createDataFrame(list(listed.items()), "token string, valence double"))
    with pytest.raises(ValueError, match="more than"):
        Lexicon.of(large)
    raw, out, clean = (str(tmp_path / name) for name in ("raw", "landed", "clean"))
    words_ = [post(20, "good w7 w199999 nothing", ["A"], 2), post(21, None, ["A"], 2), post(22, "", ["B"], 2)]
    drop(tmp_path / "raw", "a.json", FIRST)
    (tmp_path / "raw" / "bad.json").write_text("{no json")
    run = lambda: ingest.start_ingest(spark, raw, out, str(tmp_path / "ck"), large, None).awaitTermination()
    run()
    jobs_args = (spark, out, dim, clean, str(tmp_path / "unused"))
    ingest.clean_new(*jobs_args, n_tickers=3)
    drop(tmp_path / "raw", "b.json", SECOND + words_ + FIRST[:1])
    run()
    run()
    literal = Lexicon(LEXICON_WORDS)
    literal.words |= {"w7": 1.0, "w199999": 1.0}
    once = ingest.score_posts(files.read_posts(spark, raw, keep_corrupt=True), literal)
    columns = POSTS_SCORED.fieldNames()
    for result in ("Ok", "ProcessingFailed"):
        got = ingest.landed(spark, out, result)
        assert rows(got.select(*columns)) == rows(once.filter(once.result == result).select(*columns))
    assert rows(ingest.landed(spark, out, "ProcessingFailed"), "tweet_id", "_corrupt_record") == [(21, None), (None, "{no json")]
    # cleaned batch by batch: new ones, and one that was written again
    posts = once.filter("result = 'Ok'").drop("result", "_corrupt_record")
    wanted = rows(jobs.clean_posts(posts, spark.read.parquet(dim), 3), "tweet_id", "ticker")

    def cleaned():
        return sorted((r["tweet_id"], r["ticker"]) for spam in (False, True) for r in jobs.read_clean(spark, clean, spam).collect())
    ingest.clean_new(*jobs_args, n_tickers=3)
    assert cleaned() == sorted(wanted)
    assert batches.stale(spark, out, clean) == []
    first = ingest.landed(spark, out).filter("tweet_id = 1").limit(1)
    batches.write_batch(first.withColumn("result", F.lit("Ok")), out, "000000000000", ["result", *PARTS])
    assert [name for name, _ in batches.stale(spark, out, clean)] == ["000000000000"]
    ingest.clean_new(*jobs_args, n_tickers=3)
    left = [1, 1] + [p["tweet_id"] for p in SECOND + words_ if p["text"] is not None]
    assert sorted(i for i, _ in cleaned()) == sorted(left)


def test_stream_static_ticker_join(spark, tmp_path, dim):
    drop(tmp_path / "raw", "a.json", FIRST)
    stream = files.incremental(spark, str(tmp_path / "raw"), POSTS_RAW)
    exploded = stream.select("tweet_id", F.explode("tweet_meta.hashcashtags").alias("tag"))
    matched = tags.match_tickers(exploded, tags.top_tickers(spark.read.parquet(dim), 3))
    query = matched.writeStream.format("memory").queryName("matched").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("matched"), "tweet_id", "ticker") == [(1, "A"), (2, "B"), (3, "A"), (4, "A"), (5, "C")]


def test_land_new_reads_each_file_once(spark, tmp_path):
    drop(tmp_path / "raw", "a.json", FIRST)
    scored = ingest.score_posts(files.read_posts(spark, str(tmp_path / "raw")), LEXICON).drop("result")
    scored.coalesce(1).write.mode("append").json(str(tmp_path / "scored"))
    for _ in range(2):
        ingest.land_new(spark, str(tmp_path / "scored"), str(tmp_path / "stage1"), str(tmp_path / "ck"))
        assert spark.read.parquet(str(tmp_path / "stage1")).count() == 6
    scored.limit(1).write.mode("append").json(str(tmp_path / "scored"))
    ingest.land_new(spark, str(tmp_path / "scored"), str(tmp_path / "stage1"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "stage1")).count() == 7


def test_a_failed_batch_is_replaced_by_its_repeat(spark, tmp_path, dim):
    drop(tmp_path / "raw", "a.json", FIRST)
    scored = ingest.score_posts(files.read_posts(spark, str(tmp_path / "raw")), LEXICON).drop("result")
    flagged = jobs.clean_posts(scored, spark.read.parquet(dim), 3)
    for _ in range(2):
        assert jobs.write_clean(flagged, str(tmp_path / "clean"), "b1") == {"n_rows": 5, "n_spam": 2}
    clean = str(tmp_path / "clean")
    assert rows(jobs.read_clean(spark, clean), "tweet_id", "ticker") == [(1, "A"), (2, "B"), (7, "C")]
    assert rows(jobs.read_clean(spark, clean, spam=True), "tweet_id", "ticker") == [(4, "A"), (5, "C")]


@pytest.fixture
def pipeline(spark, tmp_path, dim):
    """Both drops through all three jobs, each in its own run."""
    def step(name, posts):
        drop(tmp_path / "raw", name, posts)
        take_in(spark, tmp_path)
        ingest.clean_new(spark, str(tmp_path / "landed"), dim, str(tmp_path / "clean"), str(tmp_path / "ck2"), n_tickers=3)
        return str(tmp_path / "clean")

    return step


def test_runs_merge_closed_days_once(spark, tmp_path, pipeline):
    base = str(tmp_path / "serving")
    clean = pipeline("a.json", FIRST)
    assert jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 29))
    assert rows(jobs.read_rollup(spark, base), "DetailLevel", "TICKER", "NUM_MENTIONS", "RUN_ID") == [
        (level, "A", 1, "r1") for level in ("2022", "2022-10", "2022-10-28", "2022-10-28-00")
    ]
    assert not jobs.aggregate(spark, clean, base, "r1b", dt.date(2022, 10, 29))
    pipeline("b.json", SECOND)
    assert jobs.aggregate(spark, clean, base, "r2", dt.date(2022, 10, 31))
    whole = files.closed_days(jobs.read_clean(spark, clean), dt.date(2022, 10, 31))
    assert rows(jobs.read_rollup(spark, base)) == rows(rollup.ticker_rollup(whole, "r2"))
    want = rollup.with_previous(rollup.level_metrics(whole, "r2"))
    got = jobs.read_metrics(spark, base)
    assert rows(got.select(*want.columns)) == rows(want)
    recent = jobs.read_recent(spark, base)
    assert rows(recent) == rows(serve.recent_table(whole, 5, "r2").select(*recent.columns))
    assert {r["ID"] for r in recent.collect()} == {"1", "2", "7", "8", "9"}
    assert rows(jobs.read_index(spark, base)) == rows(jobs.read_rollup(spark, base).drop("RUN_ID"))


def test_late_posts_join_their_merged_day(spark, tmp_path, pipeline):
    base = str(tmp_path / "serving")
    clean = pipeline("a.json", FIRST)
    assert jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 30))
    pipeline("b.json", [post(11, "late good words", ["A"]), post(12, "another late one", ["B"], 1)])
    # a day rebuilt before the late batch is merged owns it; the other late batch is merged afterwards
    jobs.rebuild_days(spark, clean, base, "r2", ["2022-10-28"])
    assert jobs.aggregate(spark, clean, base, "r3", dt.date(2022, 10, 30))
    assert not jobs.aggregate(spark, clean, base, "r4", dt.date(2022, 10, 30))
    whole = jobs.read_clean(spark, clean)
    assert rows(jobs.read_rollup(spark, base)) == rows(rollup.ticker_rollup(whole, "r3"))
    metrics = rollup.with_previous(rollup.level_metrics(whole, "r3"))
    assert rows(jobs.read_metrics(spark, base).select(*metrics.columns)) == rows(metrics)
    recent = jobs.read_recent(spark, base)
    assert rows(recent) == rows(serve.recent_table(whole, 5, "r3").select(*recent.columns))
    with pytest.raises(ValueError, match="committed"):
        pipeline("c.json", [post(13, "later still", ["C"])])
        jobs.aggregate(spark, clean, base, "r3", dt.date(2022, 10, 30))


def test_a_post_delivered_again_is_served_once(spark, tmp_path, pipeline):
    base = str(tmp_path / "serving")
    clean = pipeline("a.json", FIRST)
    jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 30))
    pipeline("b.json", [post(1, "edited since then", ["A"])])
    jobs.aggregate(spark, clean, base, "r2", dt.date(2022, 10, 30))
    served = rows(jobs.read_recent(spark, base).filter("TICKER = 'A'"), "ID", "TEXT", "RUN_ID")
    assert served == [("1", "edited since then", "r2")]


def test_unreadable_lines_are_kept_as_failed(spark, tmp_path):
    drop(tmp_path / "raw", "a.json", FIRST[:2])
    (tmp_path / "raw" / "b.json").write_text('{"tweet_id": 20, "text": \n\n{"text": "no id"}')
    take_in(spark, tmp_path)
    assert rows(ingest.landed(spark, str(tmp_path / "landed")), "tweet_id") == [(1,), (2,)]
    failed = ingest.landed(spark, str(tmp_path / "landed"), "ProcessingFailed")
    assert rows(failed, "tweet_id", files.CORRUPT) == [(None, '{"tweet_id": 20, "text": '), (None, None)]
    (tmp_path / "scored").mkdir()
    (tmp_path / "scored" / "a.json").write_text('{"tweet_id": 21}\nnot json')
    ingest.land_new(spark, str(tmp_path / "scored"), str(tmp_path / "stage1"), str(tmp_path / "ck"))
    assert rows(spark.read.parquet(str(tmp_path / "stage1")), "tweet_id", files.CORRUPT) == [(21, None), (None, "not json")]


def test_a_run_that_never_committed_has_no_effect(spark, tmp_path, pipeline, monkeypatch):
    base = str(tmp_path / "serving")
    clean = pipeline("a.json", FIRST)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "commit_run", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 30))
    assert files.is_empty(jobs.read_rollup(spark, base))
    assert jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 30))
    assert rows(jobs.read_rollup(spark, base)) == rows(rollup.ticker_rollup(jobs.read_clean(spark, clean), "r1"))


def test_rebuild_of_a_day_landed_again(spark, tmp_path, pipeline):
    base = str(tmp_path / "serving")
    clean = pipeline("a.json", FIRST)
    jobs.aggregate(spark, clean, base, "r1", dt.date(2022, 10, 30))
    pipeline("b.json", SECOND)  # adds a mention to a merged day
    jobs.rebuild_days(spark, clean, base, "r2", ["2022-10-29"])
    merged = files.closed_days(jobs.read_clean(spark, clean), dt.date(2022, 10, 30))
    assert rows(jobs.read_rollup(spark, base)) == rows(rollup.ticker_rollup(merged, "r2"))
    # the late post is served, and days that were rebuilt before any run merged them are not merged again
    served = rows(jobs.read_recent(spark, base), "ID", "TICKER")
    assert len(served) == len(set(served)) and {i for i, _ in served} >= {
        str(r["tweet_id"]) for r in merged.filter("day = '29'").select("tweet_id").collect()
    }
    open_days = sorted({f"{r['year']}-{r['month']}-{r['day']}" for r in jobs.read_clean(spark, clean).collect()})
    jobs.rebuild_days(spark, clean, base, "r3", open_days)
    before = rows(jobs.read_rollup(spark, base).drop("RUN_ID"))
    assert not jobs.aggregate(spark, clean, base, "r4", dt.date(2022, 12, 1))
    assert rows(jobs.read_rollup(spark, base).drop("RUN_ID")) == before
    with pytest.raises(ValueError, match="committed"):
        jobs.rebuild_days(spark, clean, base, "r3", open_days)


def test_stage_counts_come_with_the_write(spark, tmp_path):
    df, seen = tables.counted(spark.range(10), "range", top=F.max("id"))
    tables.write_table(df, str(tmp_path / "o"))
    assert seen.get == {"n_rows": 10, "top": 9}


def mention(i, ticker, hour, day="28", spam=False, text="some text"):
    stamp = DAY0 + 86400 * (int(day) - 28) + 3600 * int(hour) + i
    return (i, ticker, "POSITIVE", stamp, f"{text} {i}", text, spam, "2022", "10", day, hour)


def clean_frame(spark, rows_):
    names = "tweet_id long, ticker string, tweet_text_sentiment string, tweet_meta_created_at double, tweet_text_text string, tweet_text_clean string"
    return spark.createDataFrame(rows_, names + ", possible_spam boolean, year string, month string, day string, hour string")


def test_a_batch_written_again_is_replaced_as_a_whole(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "clean")
    with pytest.raises(ValueError, match="no batch"):
        batches.read_batches(spark, base)
    first = [mention(1, "A", "01"), mention(2, "B", "01"), mention(3, "A", "02"), mention(4, "C", "03", spam=True)]
    assert jobs.write_clean(clean_frame(spark, first), base, "b1") == {"n_rows": 4, "n_spam": 1}
    jobs.write_clean(clean_frame(spark, [mention(9, "A", "01")]), base, "b2")
    # 1 turns into spam, hour 02 vanishes, 4 is cleared
    second = [mention(1, "A", "01", spam=True), mention(2, "B", "01"), mention(4, "C", "03")]
    jobs.write_clean(clean_frame(spark, second), base, "b1")
    assert rows(jobs.read_clean(spark, base), "tweet_id") == [(2,), (4,), (9,)]
    assert rows(jobs.read_clean(spark, base, spam=True), "tweet_id") == [(1,)]
    one_hour = jobs.read_clean(spark, base, where=F.col("hour") == "03")
    assert rows(one_hour, "tweet_id", "batch", "hour") == [(4, "b1", "03")] and len(one_hour.inputFiles()) == 1
    # an attempt that fails before its commit is not seen
    with monkeypatch.context() as broken:
        broken.setattr(batches, "_files", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.write_clean(clean_frame(spark, first), base, "b1")
    assert rows(jobs.read_clean(spark, base), "tweet_id") == [(2,), (4,), (9,)]
    # nothing is left of a batch whose second write is empty
    assert jobs.write_clean(clean_frame(spark, []), base, "b1") == {"n_rows": 0, "n_spam": 0}
    assert rows(jobs.read_clean(spark, base), "tweet_id") == [(9,)] and jobs.read_clean(spark, base, spam=True).isEmpty()
    jobs.write_clean(clean_frame(spark, []), base, "b2")
    assert jobs.read_clean(spark, base).isEmpty() and "ticker" in jobs.read_clean(spark, base).columns
    jobs.write_clean(clean_frame(spark, first), base, "b2")
    assert batches.vacuum(spark, base) == [] and len(batches.vacuum(spark, base, older_than_hours=-1)) >= 4
    assert rows(jobs.read_clean(spark, base), "tweet_id") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="name"):
        jobs.write_clean(clean_frame(spark, first), base, "a/b")


def test_posts_that_a_day_no_longer_holds_are_served_no_more(spark, tmp_path):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    day = dt.date(2022, 11, 30)
    jobs.write_clean(clean_frame(spark, [mention(1, "A", "01"), mention(2, "A", "02"), mention(5, "B", "01", "29")]), clean, "b1")
    jobs.write_clean(clean_frame(spark, [mention(3, "A", "03")]), clean, "b2")
    assert jobs.aggregate(spark, clean, base, "r1", day) and not jobs.aggregate(spark, clean, base, "r1b", day)
    # the merged batch is cleaned again: one post is gone, one has moved; its days are rebuilt by themselves
    jobs.write_clean(clean_frame(spark, [mention(1, "A", "01", text="other"), mention(5, "B", "04", "29")]), clean, "b1")
    assert jobs.stale_days(spark, clean, base) == ["2022-10-28", "2022-10-29"]
    assert jobs.aggregate(spark, clean, base, "r2", day)
    now = jobs.read_clean(spark, clean)
    assert rows(jobs.read_rollup(spark, base)) == rows(rollup.ticker_rollup(now, "r2.rebuild"))
    recent = jobs.read_recent(spark, base)
    assert rows(recent) == rows(serve.recent_table(now, 5, "r2.rebuild").select(*recent.columns))
    assert rows(jobs.read_metrics(spark, base), "DetailLevel", "NUM_MENTIONS") == rows(rollup.level_metrics(now), "DetailLevel", "NUM_MENTIONS")
    assert jobs.stale_days(spark, clean, base) == [] and not jobs.aggregate(spark, clean, base, "r3", day)
    # late posts of a rebuilt day, then the whole batch taken away
    jobs.write_clean(clean_frame(spark, [mention(7, "A", "05")]), clean, "b3")
    assert jobs.aggregate(spark, clean, base, "r4", day)
    jobs.write_clean(clean_frame(spark, []), clean, "b1")
    assert jobs.aggregate(spark, clean, base, "r5", day)
    now = jobs.read_clean(spark, clean)
    assert rows(jobs.read_recent(spark, base), "ID") == [("3",), ("7",)] == rows(now.select(F.col("tweet_id").cast("string")))
    assert rows(jobs.read_rollup(spark, base).drop("RUN_ID")) == rows(rollup.ticker_rollup(now))


def written_bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_a_run_writes_what_its_day_adds(spark, tmp_path):
    base, clean = tmp_path / "serving", str(tmp_path / "clean")
    grown = []
    for i in range(4):
        rows_ = [mention(100 * i + k, "ABC"[k % 3], f"{k % 24:02d}", f"{i + 21:02d}") for k in range(60)]
        jobs.write_clean(clean_frame(spark, rows_), clean, f"b{i}")
        before = written_bytes(base)
        assert jobs.aggregate(spark, clean, str(base), f"r{i}", dt.date(2022, 11, 30))
        grown.append(written_bytes(base) - before)
    assert max(grown) < 1.1 * min(grown)
    whole = rows(rollup.ticker_rollup(jobs.read_clean(spark, clean)))
    assert rows(jobs.read_rollup(spark, str(base)).drop("RUN_ID")) == whole == rows(jobs.read_index(spark, str(base)))
    metrics = jobs.read_metrics(spark, str(base)).drop("RUN_ID")
    recent = rows(jobs.read_recent(spark, str(base)).drop("RUN_ID"))
    assert not jobs.compact(spark, str(base), "c1", longest=4) and jobs.compact(spark, str(base), "c1", longest=3)
    assert tables.current_chain(spark, jobs.Serving(str(base)).manifest) == ["c1"]
    assert rows(jobs.read_rollup(spark, str(base)).drop("RUN_ID")) == whole == rows(jobs.read_index(spark, str(base)))
    assert rows(jobs.read_metrics(spark, str(base)).drop("RUN_ID")) == rows(metrics)
    assert rows(jobs.read_recent(spark, str(base)).drop("RUN_ID")) == recent
    # the newest posts come from the newest runs, whatever their number
    asked = []
    live = jobs._live_recent

    def watched(*args, **kwargs):
        asked.append(args[2] if len(args) > 2 else None)
        return live(*args, **kwargs)

    jobs._live_recent = watched
    try:
        for n, kwargs in ((1, {}), (70, {}), (5, {"ticker": "b"}), (10, {"start": "2022-10-22 00:00:00", "end": "2022-10-23 12:00:00"}), (1000, {})):
            asked.clear()
            got = jobs.read_newest(spark, str(base), n, **kwargs)
            want = serve.recent_posts(jobs.read_recent(spark, str(base)), n, **kwargs)
            assert rows(got.select(*want.columns)) == rows(want), n
            if n == 1:
                assert [a for a in asked if a] == [["r3"], ["r3"]]
    finally:
        jobs._live_recent = live
    assert jobs.read_newest(spark, str(base), 5, ticker="none").isEmpty()


def test_a_repeated_run_leaves_nothing_of_its_first_try(spark, tmp_path, monkeypatch):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    day = dt.date(2022, 11, 30)
    jobs.write_clean(clean_frame(spark, [mention(1, "A", "01"), mention(2, "A", "02")]), clean, "b1")
    jobs.aggregate(spark, clean, base, "r1", day)
    jobs.write_clean(clean_frame(spark, [mention(1, "A", "01", text="again"), mention(3, "B", "01")]), clean, "b2")
    with monkeypatch.context() as broken:
        broken.setattr(tables, "commit_run", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.aggregate(spark, clean, base, "r2", day)
    assert rows(jobs.read_recent(spark, base), "ID", "TEXT") == [("1", "some text 1"), ("2", "some text 2")]
    jobs.write_clean(clean_frame(spark, [mention(3, "B", "01")]), clean, "b2")  # the post is not delivered again after all
    assert jobs.aggregate(spark, clean, base, "r2", day)
    assert rows(jobs.read_recent(spark, base), "ID", "TEXT") == [("1", "some text 1"), ("2", "some text 2"), ("3", "some text 3")]


def test_look_ups_list_only_files_that_may_hold_the_answer(spark, tmp_path):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    tickers_ = [f"T{n:02}" for n in range(40)]
    rows_ = [mention(100 * n + h, t, f"{h:02}") for n, t in enumerate(tickers_) for h in range(0, 24, 3)]
    jobs.write_clean(clean_frame(spark, rows_), clean, "one")
    assert jobs.aggregate(spark, clean, base, "run1", dt.date(2030, 1, 1))
    # small tables make one file: lay the index out as a large one
    out = jobs.Serving(base)
    kept = tables.read_snapshot(spark, out.rollup, "run1", TICKER_ROLLUP_KEPT).drop("RUN_ID")
    tables.write_index(kept, out.index("run1"), 32)
    tables.write_bounds(spark, out.index("run1"), f"{out.bounds}/RUN_ID=run1", jobs.INDEX_KEYS, TICKER_ROLLUP_KEPT)
    whole = jobs.read_index(spark, base)
    n_files = len(whole.inputFiles())
    assert n_files >= 24
    start, end = "2022-10-28 05:00:00", "2022-10-28 13:00:00"

    def same():
        for ticker in ("T17", "T99"):
            for span in ((None, None), (start, end)):
                assert rows(jobs.read_trend(spark, base, ticker, "hourly", *span)) == rows(
                    serve.trend(jobs.read_index(spark, base), ticker, "hourly", *span)
                )
        assert rows(jobs.read_comparison(spark, base, "T03", "T30", "daily")) == rows(
            serve.compare(jobs.read_index(spark, base), "T03", "T30", "daily")
        )

    same()
    assert jobs.read_trend(spark, base, "T17", "hourly", start, end).count() == 3
    assert 1 <= len(jobs.read_index(spark, base, ["T17_HOURLY"]).inputFiles()) <= 3
    assert len(jobs.read_index(spark, base, ["T03_DAILY", "T30_DAILY"]).inputFiles()) <= 4
    # late posts of the same hours in a second run: times of rows are the earliest of both
    late = [mention(n, "T17", f"{h:02}") for n, h in enumerate((4, 6, 12))]
    jobs.write_clean(clean_frame(spark, late), clean, "two")
    assert jobs.aggregate(spark, clean, base, "run2", dt.date(2030, 1, 1))
    same()
    # a run whose bounds were never written is read whole
    tables.write_index(kept, out.index("run3"))
    tables.commit_run(spark, out.manifest, "run3")
    assert jobs.read_trend(spark, base, "T17", "hourly").count() == 8


def test_posts_delivered_twice_in_a_run_are_found_by_their_keys(spark, tmp_path):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    day = dt.date(2022, 11, 30)
    once = [mention(i, "AB"[i % 2], "01") for i in range(6)]
    again = [(*once[0][:4], "other", *once[0][5:]), once[1], once[1], (None, *once[2][1:]), (None, *once[2][1:])]
    jobs.write_clean(clean_frame(spark, once + again), clean, "b1")
    assert jobs.aggregate(spark, clean, base, "r1", day)
    served = jobs.read_recent(spark, base)
    assert rows(served, "ID") == sorted([(str(i),) for i in range(6)] + [(None,)], key=repr)
    both = serve.recent_table(jobs.read_clean(spark, clean), 5).filter("ID = '0'")
    first = both.orderBy(F.xxhash64(*both.columns)).first()["TEXT"]
    assert rows(served.filter("ID = '0'"), "TEXT") == [(first,)]
    # without such posts no row is sorted or shuffled before its layout
    out = jobs.Serving(base)
    single = serve.recent_table(jobs.read_clean(spark, clean).filter("tweet_id > 1"), 5)
    assert jobs._delivered_once(single, out, "r2") is single
    chosen = jobs._delivered_once(serve.recent_table(jobs.read_clean(spark, clean), 5), out, "r2")
    assert rows(chosen, "ID") == rows(served, "ID")
