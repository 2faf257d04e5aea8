"""Texts that are kept apart from the rows that show them."""

import datetime as dt
import hashlib
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from mention_pulse.operators import serve
from mention_pulse.plans import jobs
from mention_pulse.sources import batches, tables

DAY = dt.date(2022, 11, 30)
DAY0 = 1666915200.0  # 2022-10-28
SIZE = 4000  # of a text that no compression shortens by more than half


def noise(i):
    return "".join(hashlib.sha256(f"{i} {k}".encode()).hexdigest() for k in range(SIZE // 64 + 1))[:SIZE]


def mentions(spark, ids, day="28", text=noise):
    """Two mentions a post, of its two tickers."""
    data = [
        (i, t, "POSITIVE", DAY0 + 86400 * (int(day) - 28) + 60 * i, text(i), text(i)[:100], False, "2022", "10", day, f"{i // 60:02d}")
        for i in ids
        for t in "AB"
    ]
    names = "tweet_id long, ticker string, tweet_text_sentiment string, tweet_meta_created_at double, tweet_text_text string, tweet_text_clean string"
    return spark.createDataFrame(data, names + ", possible_spam boolean, year string, month string, day string, hour string").coalesce(2)


def held(folder, pattern):
    return {f.name: f.stat().st_size for f in Path(folder).rglob(pattern)}


def test_a_layout_moves_no_text_and_keeps_each_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "fresh_folder", lambda _, name: str(tmp_path / name))
    recent = serve.recent_table(mentions(spark, range(100)))
    laid = tables.recency_layout(recent, 4)
    assert rows(laid) == rows(recent)
    # once per post, though it has two mentions and ranges are sampled from the rows before they are dealt
    assert SIZE * 100 * 0.5 < sum(held(tmp_path, "*.texts").values()) < SIZE * 100 * 0.7
    between = plan(laid).split("MapInArrow unpack")[1].split("MapInArrow pack(")[0].split("\n", 1)[1]
    assert "rangepartitioning(PARTITION" in between and "TEXT#" not in between


def test_without_a_shared_folder_rows_move_whole(spark, monkeypatch):
    def none(*_):
        raise ValueError("no folder")

    monkeypatch.setattr(tables, "fresh_folder", none)
    recent = serve.recent_table(mentions(spark, range(5)))
    laid = tables.recency_layout(recent, 2)
    assert rows(laid) == rows(recent) and "MapInArrow" not in plan(laid)


@pytest.fixture
def late(spark, tmp_path):
    """A batch merged, and a late one of the same day and the next, not merged yet."""
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    jobs.write_clean(mentions(spark, range(60)), clean, "b1")
    assert jobs.aggregate(spark, clean, base, "r1", DAY)
    jobs.write_clean(mentions(spark, range(60, 90)).unionByName(mentions(spark, range(90, 120), "29")), clean, "b2")
    return base, clean


def served_as(spark, clean, run, base):
    whole = serve.recent_table(jobs.read_clean(spark, clean), 5, run)
    recent = jobs.read_recent(spark, base)
    assert rows(recent) == rows(whole.select(*recent.columns))


def test_merged_batches_keep_each_text_once_a_side(spark, late):
    base, clean = late
    assert jobs.aggregate(spark, clean, base, "r2", DAY)
    served_as(spark, clean, "r2", base)
    texts = held(clean, "*.texts")
    assert held(base, "*.texts") == texts and sum(texts.values()) < SIZE * 120 * 0.7
    assert sum(held(clean, "*.parquet").values()) + sum(held(base + "/recent_posts", "*.parquet").values()) < SIZE * 120 * 0.5
    # a roll-up reads no text, a reader who asks for none opens none
    assert "ArrowEvalPython" in plan(jobs.read_clean(spark, clean))
    assert "ArrowEvalPython" not in plan(jobs.read_clean(spark, clean).groupBy("day").count())


def test_rebuilt_days_take_no_text_again(spark, late):
    base, clean = late
    jobs.rebuild_days(spark, clean, base, "r2", ["2022-10-28", "2022-10-29"])
    served_as(spark, clean, "r2", base)
    before = held(base, "*.texts")
    assert before == held(clean, "*.texts")
    jobs.rebuild_days(spark, clean, base, "r3", ["2022-10-28"])
    assert held(base, "*.texts") == before
    served_as(spark, clean, "r3", base)


def test_the_serving_side_outlives_the_batches_it_was_made_from(spark, late):
    base, clean = late
    want = rows(jobs.read_recent(spark, base))
    jobs.write_clean(mentions(spark, range(3)), clean, "b1")
    assert batches.vacuum(spark, clean, older_than_hours=-1)
    assert rows(jobs.read_recent(spark, base)) == want


def test_newest_posts_come_with_their_texts_from_few_entries(spark, late):
    base, clean = late
    assert jobs.aggregate(spark, clean, base, "r2", DAY)
    newest = jobs.read_newest(spark, base, 7)
    assert rows(newest) == rows(serve.recent_posts(jobs.read_recent(spark, base), 7))
    assert [r["TEXT"] for r in newest.collect()] == [noise(i) for i in (119, 119, 118, 118, 117, 117, 116)]
    # rows are chosen by their keys: texts are opened above the choice
    text = plan(newest)
    assert 0 <= text.find("MapInArrow unpack") < text.find("LeftSemi")


def test_batches_written_with_their_texts_inside_are_read_along(spark, tmp_path):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    odd = {0: None, 1: "", 2: "ü\U0001f600"}

    def text(i):
        return noise(i) if i not in odd else odd[i] or ""

    first = mentions(spark, range(10), text=text)
    first = first.withColumn("tweet_text_text", F.when(F.col("tweet_id") != 0, F.col("tweet_text_text")))
    batches.write_batch(first, clean, "old", jobs.CLEAN_KEYS)
    served = []
    for run, batch in (("r1", None), ("r2", first.withColumn("tweet_id", F.col("tweet_id") + 10))):
        if batch is not None:
            jobs.write_clean(batch, clean, "new")
            served = rows(jobs.read_recent(spark, base).drop("RUN_ID"))
        assert jobs.aggregate(spark, clean, base, run, DAY)
        served_as(spark, clean, run, base)
    assert set(served) < set(rows(jobs.read_recent(spark, base).drop("RUN_ID")))
    # once no batch has its texts inside, runs refer to them; earlier runs stay as they are
    jobs.write_clean(first, clean, "old")
    assert jobs.aggregate(spark, clean, base, "r3", DAY)
    served_as(spark, clean, "r3.rebuild", base)


def test_posts_delivered_twice_are_told_apart_by_their_texts(spark, tmp_path):
    base, clean = str(tmp_path / "serving"), str(tmp_path / "clean")
    twice = mentions(spark, range(4)).unionByName(mentions(spark, range(2), text=lambda i: f"other {i}"))
    jobs.write_clean(twice, clean, "b1")
    assert jobs.aggregate(spark, clean, base, "r1", DAY)
    whole = serve.recent_table(jobs.read_clean(spark, clean), 5)
    want = whole.groupBy("ID", "TICKER").agg(F.min_by("TEXT", F.xxhash64(*whole.columns)))
    assert rows(jobs.read_recent(spark, base), "ID", "TICKER", "TEXT") == rows(want)


def test_a_compacted_chain_leaves_texts_alone(spark, late):
    base, clean = late
    assert jobs.aggregate(spark, clean, base, "r2", DAY)
    before = held(base, "*.texts")
    assert before == held(clean, "*.texts") and jobs.compact(spark, base, "c1", longest=1)
    assert held(base, "*.texts") == before
    served_as(spark, clean, "c1", base)
