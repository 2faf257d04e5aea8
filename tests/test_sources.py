import base64
import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from mention_pulse.operators.sentiment import Lexicon
from mention_pulse.plans import jobs
from mention_pulse.schemas import LEVEL_METRICS, POSTS_SCORED, RECORDS, TICKER_ROLLUP
from mention_pulse.sources import files, records, tables

META = {"created_at": 1666915198.0, "tweet_type": "original", "sensitive": False, "hashcashtags": ["Q", "наука"]}
POSTS = [
    {"tweet_id": 1, "author_id": 808, "text": "very good", "tweet_meta": META},
    {"tweet_id": 2, "author_id": 808, "text": "very good", "tweet_meta": {**META, "sensitive": True}},
    {"tweet_id": 3, "author_id": 2**40, "text": "very bad", "tweet_meta": {**META, "tweet_type": "replied_to", "sensitive": None},
     "reference_tweets": {"tweet_id": "x", "tweet_type": "original", "text": "ref good", "hashcashtags": ["TSLA"]}},
    {"tweet_id": 4, "author_id": 5, "text": "no tags", "tweet_meta": {**META, "hashcashtags": []}},
]
LEXICON = Lexicon({2.0: ["good"], -2.0: ["bad"]})


@pytest.fixture
def posts_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = [json.dumps(p) for p in POSTS] + ["{not json"]
    (folder / "a.json").write_text("\n".join(lines))
    return str(folder)


def test_read_posts_and_corrupt_lines(spark, posts_dir):
    df = files.read_posts(spark, posts_dir)
    assert rows(df.filter("tweet_id IS NOT NULL"), "tweet_id", "author_id", "reference_tweets.tweet_id") == [
        (1, 808, None), (2, 808, None), (3, 2**40, "x"), (4, 5, None),
    ]
    kept = files.read_posts(spark, posts_dir, keep_corrupt=True).filter("_corrupt_record IS NOT NULL")
    assert rows(kept, "tweet_id", "_corrupt_record") == [(None, "{not json")]


def test_ticker_csv_with_mark_and_quoted_commas(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿#,Symbol,Company,Weight\n1,AAPL,"Apple, Inc.",7.5\n2,BRK.B,Berkshire,1\n'.encode())
    assert rows(files.read_tickers(spark, str(path))) == [(1, "AAPL", "Apple, Inc.", 7.5), (2, "BRK.B", "Berkshire", 1.0)]
    jobs.land_tickers(spark, str(path), str(tmp_path / "dim"))
    assert files.read_table(spark, str(tmp_path / "dim")).count() == 2


def envelopes(spark):
    coded = [base64.b64encode(json.dumps(p).encode()).decode() for p in POSTS]
    data = [(f"r{i}", 1495072949453, d) for i, d in enumerate([*coded, "%%%"], 1)]
    return spark.createDataFrame(data, RECORDS)


def test_transform_records(spark):
    out = records.transform_records(envelopes(spark), LEXICON)
    assert rows(out, "recordId", "result") == [
        ("r1", "Ok"), ("r2", "Dropped"), ("r3", "Ok"), ("r4", "Dropped"), ("r5", "ProcessingFailed"),
    ]
    data = {r["recordId"]: r["data"] for r in out.collect()}
    line = base64.b64decode(data["r3"]).decode()
    assert line.endswith("\n") and line.count("\n") == 1
    post = json.loads(line)
    assert "text" not in post
    assert post["tweet_text"]["sentiment"] == "NEGATIVE"
    assert post["reference_tweets"]["tweet_text"] == {"text": "ref good", "sentiment": "POSITIVE",
        "total": 2 / 19**0.5, "positive": 0.5, "negative": 0.0}
    assert json.loads(base64.b64decode(data["r2"]))["tweet_text"] == {"text": "very good"}
    assert data["r5"] == "%%%"


def test_records_round_trip_through_files(spark, tmp_path):
    posts = records.decode_records(envelopes(spark)).filter("post IS NOT NULL").select("recordId", "post.*")
    tables.write_records(posts, str(tmp_path / "out"))
    again = records.decode_records(spark.read.schema(RECORDS).json(str(tmp_path / "out")))
    assert rows(again.select("recordId", "post.*")) == rows(posts)


# ---- tables --------------------------------------------------------------------------------
@pytest.fixture
def parted(spark, tmp_path):
    data = [(i, f"20{21 + i % 3}", f"{1 + i % 12:02d}", f"{1 + i % 28:02d}", f"{i % 24:02d}", i % 2 == 0) for i in range(200)]
    df = spark.createDataFrame(data, "id int, year string, month string, day string, hour string, possible_spam boolean")
    path = str(tmp_path / "t")
    tables.write_partitioned(df.repartition(8), path)
    return df, path


def test_partition_values_stay_text_and_prune(spark, parted):
    df, path = parted
    back = files.read_table(spark, path)
    assert dict(back.dtypes)["hour"] == "string"
    assert rows(back.select(*df.columns).filter("hour = '05'")) == rows(df.filter("hour = '05'"))
    closed = files.closed_days(back, dt.date(2022, 3, 5))
    text = plan(closed)
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    assert "cast(" not in text.split("PartitionFilters")[1].split("]")[0]


def test_rebalance_leaves_one_file_per_small_partition(spark, parted):
    import pathlib

    _, path = parted
    folders = [p.parent for p in pathlib.Path(path).rglob("*.parquet")]
    assert len(folders) == len(set(folders))


def test_closed_days_keeps_late_months_of_earlier_years(spark, parted):
    df, _ = parted
    run = dt.date(2022, 3, 5)
    want = [r for r in df.collect() if f"{r['year']}-{r['month']}-{r['day']}" < "2022-03-05"]
    assert files.closed_days(df, run).count() == len(want)
    assert any(r["year"] == "2021" and r["month"] > "03" for r in want)


def test_split_write_is_whole(spark, parted, tmp_path):
    df, _ = parted
    clean, junk = tables.split_write(df, str(tmp_path / "s"))
    a, b = files.read_table(spark, clean), files.read_table(spark, junk)
    assert rows(a, "id") == rows(df.filter("NOT possible_spam"), "id")
    assert rows(a.unionByName(b), "id") == rows(df, "id")


def test_file_count(spark, parted, tmp_path):
    df, _ = parted
    tables.write_table(df.repartition(6), str(tmp_path / "one"), files=1)
    assert len(spark.read.parquet(str(tmp_path / "one")).inputFiles()) == 1


def test_stage_keeps_rows_and_prunes_later_reads(spark, parted):
    df, _ = parted
    staged = tables.stage(df, "parted")
    assert rows(staged) == rows(df)
    assert "ReadSchema: struct<id:int>" in plan(staged.select("id"))
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in file for file in staged.inputFiles())


def test_snapshots_and_pointer(spark, tmp_path):
    base, manifest = str(tmp_path / "m"), str(tmp_path / "runs")
    assert tables.current_run(spark, manifest) is None
    assert files.is_empty(tables.read_snapshot(spark, base, None, LEVEL_METRICS))

    def metrics(n):
        return spark.createDataFrame([("2022", "YEARLY", n, 0, 0, 0, "")], LEVEL_METRICS)

    tables.write_snapshot(metrics(1), base, "r1")
    tables.write_snapshot(metrics(2), base, "r2")
    tables.write_snapshot(metrics(3), base, "r1", files=1)
    tables.commit_run(spark, manifest, "r1", ["2022-01-01"])
    got = tables.read_snapshot(spark, base, tables.current_run(spark, manifest), LEVEL_METRICS)
    assert rows(got, "NUM_MENTIONS", "RUN_ID") == [(3, "r1")]
    assert "RUN_ID" in plan(got).split("PartitionFilters")[1].split("]")[0]
    tables.commit_run(spark, manifest, "r2")
    assert tables.current_run(spark, manifest) == "r2"
    both = tables.read_runs(spark, base, manifest, LEVEL_METRICS, ["DetailLevel", "NUM_MENTIONS"])
    assert rows(both, "NUM_MENTIONS", "RUN_ID") == [(2, "r2"), (3, "r2")]
    last = tables.read_runs(spark, base, manifest, LEVEL_METRICS, ["DetailLevel"])
    assert rows(last, "NUM_MENTIONS", "RUN_ID") == [(2, "r2")]


def test_upsert_is_last_write_wins_and_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    delta = spark.createDataFrame([("b", 2), ("c", 2), ("c", 3)], "k string, v int")
    once = tables.upsert(target, delta, ["k"], F.col("v"))
    assert rows(once) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(tables.upsert(once, delta, ["k"], F.col("v"))) == rows(once)


def test_index_is_ordered_by_ticker_and_time(spark, tmp_path):
    data = [("d", f"T{i % 7}", f"T{i % 7}_DAILY", f"2022-{i:04d}", i, 0, 0, 0, "r") for i in range(100)]
    tables.write_index(spark.createDataFrame(data, TICKER_ROLLUP), str(tmp_path / "ix"), 3)
    back = spark.read.parquet(str(tmp_path / "ix")).withColumn("f", F.input_file_name())
    assert len(back.columns) == 10 and back.count() == 100
    spans = back.groupBy("f").agg(F.min(F.struct("TickerDetail", "TIMESTAMP")), F.max(F.struct("TickerDetail", "TIMESTAMP")))
    ordered = sorted((tuple(lo), tuple(hi)) for _, lo, hi in spans.collect())
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_recency_layout_has_no_global_sort(spark):
    df = spark.createDataFrame([(str(i % 5), f"{i:03d}") for i in range(50)], "PARTITION string, TIMESTAMP string")
    out = tables.recency_layout(df, 4)
    assert "rangepartitioning(PARTITION" in plan(out) and "false, 0" in plan(out)
    assert rows(out) == rows(df)


def test_refresh_finds_new_partitions(spark, parted, tmp_path):
    df, path = parted
    spark.sql(f"CREATE TABLE parted_t (id INT, possible_spam BOOLEAN, year STRING, month STRING, day STRING, hour STRING) "
              f"USING parquet PARTITIONED BY (year, month, day, hour) LOCATION '{path}'")  # fmt: skip
    try:
        tables.refresh(spark, "parted_t")
        assert files.read_table(spark, "parted_t", F.col("year") == "2022").count() == df.filter("year = '2022'").count()
        tables.refresh(spark, path)
    finally:
        spark.sql("DROP TABLE parted_t")


def test_scored_schema_is_what_packing_makes(spark, posts_dir):
    from mention_pulse.streaming.ingest import score_posts

    scored = score_posts(files.read_posts(spark, posts_dir), LEXICON)
    assert scored.drop("result").to(POSTS_SCORED).count() == 2


def test_layouts_let_look_ups_skip_files(spark, tmp_path):
    """Few files of the index and of a snapshot hold the key that is looked up."""
    import pyarrow.parquet as pq
    from conftest import plan

    from mention_pulse.operators import serve
    from mention_pulse.schemas import TICKER_ROLLUP

    keys = [(f"2024-01-{d:02}", f"T{t}", f"T{t}_DAILY", f"2024-01-{d:02} 00:00:00.{t}") for d in range(1, 29) for t in range(40)]
    table = spark.createDataFrame([(*k, 1, 1, 0, 0, "r1") for k in keys], TICKER_ROLLUP).repartition(4)

    def holding(folder, column, value):
        found = 0
        for file in folder.rglob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index(column)
            groups = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            found += sum(g.min <= value <= g.max for g in groups)
        return found

    tables.write_index(table.drop(tables.RUN), str(tmp_path / "index"), 8)
    assert len(list((tmp_path / "index").glob("*.parquet"))) == 8
    assert holding(tmp_path / "index", "TickerDetail", "T3_DAILY") <= 2
    index = tables.read_index(spark, str(tmp_path / "index"), table.drop(tables.RUN).schema)
    found = serve.trend(index, "T3", "daily")
    assert "EqualTo(TickerDetail,T3_DAILY)" in plan(found)
    assert found.count() == 28
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_snapshot(table.drop(tables.RUN), str(tmp_path / "snapshot"), "r1", order=["DetailLevel", "TICKER"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "snapshot").rglob("*.parquet"))) == 4
    assert holding(tmp_path / "snapshot", "DetailLevel", "2024-01-03") <= 2
    found = serve.at_level(tables.read_snapshot(spark, str(tmp_path / "snapshot"), "r1", TICKER_ROLLUP), "2024-01-03")
    assert "EqualTo(DetailLevel,2024-01-03)" in plan(found)
    assert found.count() == 40


RECENT = "PARTITION string, TIMESTAMP string, ID string, TICKER string, TEXT string, CLEANTEXT string"


def recent_rows(spark):
    data = [(str(i % 5), f"{i // 2:03d}", str(i), f"T{i % 3}", f"text {i} " + "w x. \u00fc\U0001f600 " * (i % 7), "" if i % 4 else None) for i in range(60)]
    odd = F.when(F.col("ID") == "7", F.expr("cast(X'41FF42' AS string)")).when(F.col("ID") != "8", F.col("TEXT"))
    return spark.createDataFrame(data, RECENT).withColumn("TEXT", odd)


def test_texts_travel_packed_and_come_back_as_they_were(spark, tmp_path, monkeypatch):
    df = recent_rows(spark)
    shown = [*df.columns[:4], F.expr("hex(cast(TEXT AS binary)) AS bytes"), "CLEANTEXT"]
    for size in (tables.UNPACKED_BYTES, 1):
        monkeypatch.setattr(tables, "UNPACKED_BYTES", size)
        out = tables.recency_layout(df, 3)
        assert out.schema == df.schema and rows(out.select(*shown)) == rows(df.select(*shown))
        # the order of the layout holds within every partition
        placed = out.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), "PARTITION", "TIMESTAMP").collect()
        parts = [[(r["PARTITION"], r["TIMESTAMP"]) for r in sorted(placed, key=lambda r: r["i"]) if r["p"] == p] for p in range(3)]
        for part in parts:
            newest_last = sorted(part, key=lambda r: r[1], reverse=True)
            assert part == sorted(newest_last, key=lambda r: r[0])
    text = plan(tables.recency_layout(df, 3))
    # the shuffle lies between packing and unpacking
    assert text.index("MapInArrow unpack") < text.index("rangepartitioning(PARTITION") < text.index("MapInArrow pack(")
    path = str(tmp_path / "parted")
    tables.write_partitioned(df, path, ["TICKER"], texts=["TEXT", "CLEANTEXT", "none"])
    assert rows(files.read_table(spark, path).select(*shown)) == rows(df.select(*shown))


@pytest.fixture
def no_broadcast(spark):
    """Joins as of tables that are too large to be broadcast unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_appending_leaves_the_posts_that_stand_in_place(spark, monkeypatch, no_broadcast):
    df = recent_rows(spark)
    old, new = df.filter("ID < '4'"), df.filter("ID >= '3'").withColumn("CLEANTEXT", F.lit("new"))
    keys = ["PARTITION", "TIMESTAMP", "TICKER"]
    for batch in (new, df.filter("ID >= '4'"), new.withColumn("TICKER", F.lit(None).cast("string"))):
        want = rows(tables.upsert(old, batch, keys).drop("TEXT"))
        out = tables.append_recent(old, batch)
        assert rows(out.drop("TEXT")) == want
        # the older posts are not shuffled, with their texts, to be told from those written again
        assert all("BroadcastHashJoin" in line for line in plan(out).splitlines() if "LeftAnti" in line)
        with monkeypatch.context() as many:
            many.setattr(tables, "AGAIN_ROWS", 1)
            assert rows(tables.append_recent(old, batch).drop("TEXT")) == want
