"""Threads whose posts land bit by bit, against a walk over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from mention_pulse.operators import thread_index, threads
from test_operators import brute_roots

SCHEMA = "tweet_id bigint, parent_id bigint, text string"


def frame(spark, parents):
    return spark.createDataFrame([(i, p, f"t{i}") for i, p in parents.items()], SCHEMA)


def found(spark, base):
    got = thread_index.read_roots(spark, base).collect()
    assert len({r["tweet_id"] for r in got}) == len(got)
    return {r["tweet_id"]: (r["root_id"], r["hops"]) for r in got}


def forest(seed, n=300):
    rng = random.Random(seed)
    parents = {0: None, 1: None}
    for i in range(2, n):
        parents[i] = rng.choice([None, 0, 0, i - 1, i - 1, i - 1, rng.randrange(i), 10_000 + i])
    parents |= {n: n + 2, n + 1: n, n + 2: n + 1, n + 3: n + 3, n + 4: n}  # circles
    return parents


@pytest.mark.parametrize(("max_rows", "hot_rows", "hops"), [(50_000, 500_000, 5), (0, 3, 5), (20, 500_000, 8), (50_000, 2, 1)])
def test_landings_in_any_order_equal_a_walk(spark, tmp_path, max_rows, hot_rows, hops):
    parents = forest(hops)
    rng = random.Random(3)
    part = {i: rng.randrange(3) for i in parents}
    base, so_far = str(tmp_path), {}
    for n in range(3):
        new = {i: p for i, p in parents.items() if part[i] == n}
        thread_index.land_threads(spark, frame(spark, new), base, f"run{n}", hops, max_rows=max_rows, hot_rows=hot_rows)
        so_far |= new
        assert found(spark, base) == brute_roots(so_far, hops)
    by_run = [thread_index.read_roots(spark, base, f"run{n}").count() for n in range(3)]
    assert sum(by_run) == len(brute_roots(parents, hops)) and all(by_run)
    waiting = {r["missing_id"] for r in thread_index.read_waiting(spark, base).collect()}
    assert waiting and not waiting & set(parents)
    thread_index.compact_threads(spark, base, "whole")
    assert found(spark, base) == brute_roots(parents, hops)


def test_roots_of_landings_equal_those_of_one_frame(spark, tmp_path):
    parents = forest(11)
    posts = frame(spark, parents)
    for n in range(2):
        thread_index.land_threads(spark, posts.filter(F.col("tweet_id") % 2 == 1 - n), str(tmp_path), f"run{n}")
    got = threads.with_root_text(thread_index.read_roots(spark, str(tmp_path)), posts)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, threads.resolve_root(posts).collect()))


def test_posts_that_land_again_and_repeated_runs_change_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    thread_index.land_threads(spark, frame(spark, {2: 1, 3: 2}), base, "a")
    assert found(spark, base) == {}
    whole = frame(spark, {1: None, 2: None, 4: 3})
    with monkeypatch.context() as patched:
        patched.setattr(thread_index.tables, "commit_run", lambda *_, **__: None)  # fails before the commit
        thread_index.land_threads(spark, whole, base, "b")
    assert found(spark, base) == {}
    thread_index.land_threads(spark, whole, base, "b")
    wanted = {2: (1, 1), 3: (1, 2), 4: (1, 3)}  # 2 is no root: it landed before
    assert found(spark, base) == wanted
    with pytest.raises(ValueError, match="committed"):
        thread_index.land_threads(spark, whole, base, "b")
    thread_index.land_threads(spark, whole, base, "c")
    assert found(spark, base) == wanted
    assert thread_index.read_roots(spark, base, "c").isEmpty()
    thread_index.compact_threads(spark, base, "d")
    assert found(spark, base) == wanted


def test_nulls_repeats_and_empty_landings(spark, tmp_path):
    base = str(tmp_path)
    rows_ = [(None, 1, "x"), (None, None, "y"), (5, 7, "a"), (5, 6, "b"), (6, None, "c"), (6, None, "c")]
    thread_index.land_threads(spark, spark.createDataFrame([], SCHEMA), base, "none")
    thread_index.land_threads(spark, spark.createDataFrame(rows_, SCHEMA), base, "some")
    assert found(spark, base) == {5: (6, 1)}


def test_a_landing_writes_its_own_threads_only(spark, tmp_path):
    base = str(tmp_path)
    thread_index.land_threads(spark, frame(spark, {i: i - 1 if i % 4 else None for i in range(2000)}), base, "old")
    thread_index.land_threads(spark, frame(spark, {5000: 1998, 5001: None}), base, "new")
    links = spark.read.parquet(f"{base}/links").filter("RUN_ID = 'new'")
    assert sorted(r["ID"] for r in links.collect()) == [5000, 5001]
    assert found(spark, base)[5000] == (1996, 3)
