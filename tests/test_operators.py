import random
from collections import Counter, defaultdict

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mention_pulse.operators import capture, rollup, sentiment, serve, skew, spam, tags, threads
from mention_pulse.schemas import COUNTERS, POSTS_RAW

relaxed = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- tags ----------------------------------------------------------------------------------
@pytest.fixture
def tagged(spark):
    return spark.createDataFrame(
        [(1, ["A", "B"], ["C"]), (2, ["A"], None), (3, None, ["Z"]), (4, None, None), (5, ["C", "A"], ["A"])],
        "tweet_id bigint, tweet_meta_hashcashtags array<string>, reference_tweets_hashcashtags array<string>",
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "ticker string, ticker_name string")


def test_mentions_by_set_and_by_join_agree(tagged, dim, monkeypatch):
    columns = ["tweet_id", "ticker", "ticker_name", "ticker_ls", "ticker_sz"]
    by_set = tags.tag_mentions(tagged, dim)
    monkeypatch.setattr(tags, "small_values", lambda *_: None)
    by_join = tags.tag_mentions(tagged, dim)
    assert rows(by_set, *columns) == rows(by_join, *columns)
    assert rows(by_set, "tweet_id", "ticker", "ticker_sz") == [
        (1, "A", 3), (1, "B", 3), (1, "C", 3), (2, "A", 1), (5, "A", 2), (5, "C", 2),
    ]


def test_ticker_lists_of_shared_ids_and_repeated_tickers(spark, monkeypatch):
    posts = spark.createDataFrame(
        [(1, "x", ["A"], None), (1, "y", ["B", "C"], ["A"]), (1, "y", ["B", "C"], ["A"]), (None, "z", ["C"], None), (2, "n", None, None)],
        "tweet_id int, text string, tweet_meta_hashcashtags array<string>, reference_tweets_hashcashtags array<string>",
    )
    twice = spark.createDataFrame([("A", "a"), ("A", "aa"), ("B", "b"), ("C", "c")], "ticker string, ticker_name string")
    columns = ["tweet_id", "text", "ticker", "ticker_name", "ticker_ls", "ticker_sz"]
    by_set = rows(tags.tag_mentions(posts, twice), *columns)
    monkeypatch.setattr(tags, "small_values", lambda *_: None)
    assert rows(tags.tag_mentions(posts, twice), *columns) == by_set
    assert sorted((t, n) for _, t, _, _, _, n in by_set) == [("x", 1)] * 2 + [("y", 3)] * 8 + [("z", 1)]


def test_large_dimension_joins_in_slices(spark, tagged, dim):
    exploded = tags.explode_tags(tagged)
    small = tags.match_tickers(exploded, dim)
    large = tags.match_tickers(exploded, dim, max_rows=1, hot_rows=2)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    text = plan(large)
    assert "_slice" in text and "_copy" in text


def test_mentions_need_no_shuffle(tagged, dim):
    text = plan(tags.tag_mentions(tagged, dim))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_large_dimension_is_not_broadcast(spark, dim):
    assert skew.small_values(dim, "ticker", 2) is None
    assert not skew.is_small(dim, 2)
    assert skew.is_small(dim, 3)


def test_attach_posts_drops_untagged(tagged, dim):
    matched = tags.match_tickers(tags.explode_tags(tagged), dim)
    assert {r[0] for r in rows(tags.attach_posts(matched, tagged), "tweet_id")} == {1, 2, 5}


def test_top_tickers(spark):
    df = spark.createDataFrame([(3, "C", "c"), (1, "A", "a"), (2, "B", "b")], "sno int, ticker string, ticker_name string")
    assert [tuple(r) for r in tags.top_tickers(df, 2).collect()] == [("A", "a"), ("B", "b")]


# ---- spam ----------------------------------------------------------------------------------
def flagged(spark, texts, **options):
    df = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(texts)], "tweet_id bigint, tweet_text_text string, n int")
    mentions = spam.with_clean_text(df).withColumn("ticker", F.explode(F.sequence(F.lit(1), "n")))
    return spam.flag_spam(mentions, **options)


def test_two_tickers_flag_a_post_by_mentions_not_by_posts(spark):
    texts = [("unique words", 2), ("other words", 1)]
    assert rows(flagged(spark, texts), "tweet_id", "possible_spam") == [(0, True), (0, True), (1, False)]
    by_post = flagged(spark, texts, count_unit="post")
    assert not any(r["possible_spam"] for r in by_post.collect())


def test_null_text_is_no_spam_and_tag_only_texts_are_copies(spark):
    texts = [(None, 1), (None, 1), ("#a $b", 1), ("@c", 1)]
    assert rows(flagged(spark, texts), "tweet_id", "possible_spam") == [(0, False), (1, False), (2, True), (3, True)]


@pytest.mark.parametrize("count_unit", ["mention", "post"])
def test_hot_keys_are_sliced_without_changing_flags(spark, count_unit):
    rng = random.Random(3)
    texts = [("the very same text", 1)] * 300
    texts += [(rng.choice(["dup one", "dup two", None, f"text {i}"]), rng.choice([1, 2])) for i in range(300)]
    plain = flagged(spark, texts, count_unit=count_unit)
    sliced = flagged(spark, texts, count_unit=count_unit, hot_rows=20)
    assert rows(plain, "tweet_id", "ticker", "possible_spam") == rows(sliced, "tweet_id", "ticker", "possible_spam")
    assert plain.columns == sliced.columns
    seen = Counter()
    for text, n in texts:
        seen[text] += n if count_unit == "mention" else 1
    wanted = sorted(
        (i, text is not None and seen[text] > 1) for i, (text, n) in enumerate(texts) for _ in range(n)
    )
    assert sorted((r["tweet_id"], r["possible_spam"]) for r in sliced.collect()) == wanted


def test_slices_split_a_hot_key_and_nulls(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 600, "hot").when(F.col("id") < 900, "cold").alias("k"))
    hot = skew.hot_keys(df.groupBy("k").agg(F.count("k").alias("n")), "k", "n", 400)
    sliced = skew.slice_rows(df, "k", "id", hot)
    sizes = {(r["k"], r["_slice"]): r["n"] for r in sliced.groupBy("k", "_slice").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 1000
    assert len([key for key in sizes if key[0] == "hot"]) == 2
    assert max(n for (k, _), n in sizes.items() if k == "hot") < 400
    assert [key for key in sizes if key[0] == "cold"] == [("cold", 0)]
    assert len([key for key in sizes if key[0] is None]) > 90


def test_texts_are_cleaned_once_per_branch(spark):
    text = plan(flagged(spark, [("a b", 1)]))
    assert "isnotnull(lower(substring" not in text


def test_spam_profile(spark):
    texts = [("same", 1), ("same", 1), ("lone", 1)]
    assert rows(spam.spam_profile(flagged(spark, texts))) == [(False, 1), (True, 2)]


# ---- roll-ups ------------------------------------------------------------------------------
CELLS = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.sampled_from(["POSITIVE", "NEGATIVE", "NEUTRAL", None]),
    st.integers(0, 40 * 24 * 3600),
    st.integers(0, 50),
)


def mentions(spark, cells):
    from mention_pulse.functions.columns import with_date_parts

    data = [(i, t, s, 1_672_000_000.0 + sec) for t, s, sec, i in cells]
    df = spark.createDataFrame(data, "tweet_id bigint, ticker string, tweet_text_sentiment string, tweet_meta_created_at double")
    return with_date_parts(df, "tweet_meta_created_at")


@relaxed
@given(st.lists(CELLS, min_size=1, max_size=60), st.integers(0, 60))
def test_merging_any_split_gives_the_whole(spark, cells, cut):
    whole = mentions(spark, cells)
    left, right = mentions(spark, cells[:cut]), mentions(spark, cells[cut:])
    merged = rollup.merge_rollup(rollup.ticker_rollup(right), rollup.ticker_rollup(left, "r1"), "r2")
    assert rows(merged) == rows(rollup.ticker_rollup(whole, "r2"))
    merged = rollup.merge_metrics(rollup.level_metrics(right), rollup.level_metrics(left, "r1"), "r2")
    assert rows(merged) == rows(rollup.level_metrics(whole, "r2"))


@relaxed
@given(st.lists(CELLS, min_size=1, max_size=60))
def test_levels_add_up_and_agree_with_single_level(spark, cells):
    df = mentions(spark, cells)
    rolled = rollup.ticker_rollup(df)
    sums = defaultdict(Counter)
    for r in rolled.collect():
        for c in COUNTERS:
            sums[r["TickerDetail"].rsplit("_", 1)[1]][c] += r[c]
        assert r["NUM_POSITIVE"] + r["NUM_NEGATIVE"] + r["NUM_NEUTRAL"] <= r["NUM_MENTIONS"]
    assert len({tuple(sorted(s.items())) for s in sums.values()}) == 1
    assert sums["YEARLY"]["NUM_MENTIONS"] == len(cells)
    daily = rolled.filter(F.col("TickerDetail").endswith("_DAILY"))
    assert rows(daily) == rows(rollup.rollup_at(df, ["year", "month", "day"], "daily"))
    by_ticker = rollup.metrics_of_rollup(rolled)
    assert rows(by_ticker) == rows(rollup.level_metrics(df))
    assert rows(rollup.metrics_from_hours(rollup.hour_partials(df))) == rows(by_ticker)


def test_first_time_key_is_the_least_text(spark):
    cells = [("A", None, 5, 10), ("A", None, 5, 9), ("A", None, 4, 77), ("A", None, 4, 8)]
    year = rollup.ticker_rollup(mentions(spark, cells)).filter("TickerDetail = 'A_YEARLY'").first()
    assert year["TIMESTAMP"].endswith("44.77")
    assert (year["NUM_MENTIONS"], year["NUM_NEUTRAL"]) == (4, 0)


def test_rollup_aggregates_by_hash(spark):
    df = mentions(spark, [("A", None, 5, 10)])
    assert "SortAggregate" not in plan(rollup.ticker_rollup(df))
    assert "HashAggregate" in plan(rollup.ticker_rollup(df))


def test_first_period_changes_by_its_whole_count(spark):
    df = mentions(spark, [("A", "POSITIVE", 0, 1), ("A", None, 3 * 86400, 2), ("B", None, 3 * 86400, 3)])
    daily = rollup.with_previous(rollup.level_metrics(df)).filter("LEVEL = 'DAILY'").orderBy("DetailLevel")
    first, second = daily.collect()
    assert (first["D_NUM_MENTIONS"], first["D_NUM_POSITIVE"]) == (0, 0)
    # the previous period is the previous present one, three days before
    assert (second["NUM_MENTIONS"], second["D_NUM_MENTIONS"], second["D_NUM_POSITIVE"]) == (2, 1, 1)
    change = rollup.period_change(rollup.with_previous(rollup.level_metrics(df)), second["DetailLevel"]).first()
    assert (change["CHANGE_NUM_MENTIONS"], change["CHANGE_NUM_POSITIVE"]) == (1, -1)


def test_union_all_wants_a_list(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(rollup.union_all([df, df.select("b", "a")], "r")) == [(1, 2, "r")] * 2
    with pytest.raises(ValueError):
        rollup.union_all(df, "r")


# ---- serving -------------------------------------------------------------------------------
@pytest.fixture
def recent(spark):
    data = [(str(i % 5), f"2022-11-0{1 + i % 9} 00:00:0{i % 7}.{i}", str(i), "AB"[i % 3 == 0], "POSITIVE", "t", "c d") for i in range(40)]
    return spark.createDataFrame(data, "PARTITION string, TIMESTAMP string, ID string, TICKER string, SENTIMENT string, TEXT string, CLEANTEXT string")


def test_limit_then_filter_differs_from_filter_then_limit(recent):
    newest = sorted(recent.collect(), key=lambda r: (r["TIMESTAMP"], r["TICKER"]), reverse=True)
    then = serve.recent_then_ticker(recent, 10, "B").collect()
    assert [r["ID"] for r in then] == [r["ID"] for r in newest[:10] if r["TICKER"] == "B"]
    only = serve.recent_for_ticker(recent, 10, "b").collect()
    assert [r["ID"] for r in only] == [r["ID"] for r in newest if r["TICKER"] == "B"][:10]


def test_recent_reads_all_spread_keys(recent):
    assert {r["PARTITION"] for r in serve.recent_posts(recent, 40).collect()} == set("01234")


def test_range_end_is_text(recent):
    got = serve.recent_posts(recent, 100, "2022-11-02 00:00:00", "2022-11-03 24:00:00").collect()
    assert {r["TIMESTAMP"][:10] for r in got} == {"2022-11-02", "2022-11-03"}


def test_top_k_plans(recent):
    assert "TakeOrderedAndProject" in plan(serve.recent_posts(recent, 5))
    text = plan(serve.recent_per_ticker(recent, 3))
    assert text.count("WindowGroupLimit") == 2


def test_leaderboard_ranks_by_share_with_ticker_as_tie_break(spark):
    data = [("d", t, f"{t}_DAILY", "x", m, p, 0, 0) for t, m, p in [("A", 10, 5), ("B", 2, 1), ("C", 100, 1)]]
    df = spark.createDataFrame(data, "DetailLevel string, TICKER string, TickerDetail string, TIMESTAMP string, NUM_MENTIONS bigint, NUM_POSITIVE bigint, NUM_NEGATIVE bigint, NUM_NEUTRAL bigint")
    assert [r["TICKER"] for r in serve.leaderboard(df, "d", "NUM_POSITIVE", 2).collect()] == ["B", "A"]
    assert [r["TICKER"] for r in serve.leaderboard(df, "d", n=1).collect()] == ["C"]
    with pytest.raises(ValueError):
        serve.leaderboard(df, "d", "TICKER")


def test_result_set_counts(recent):
    assert tuple(serve.class_totals(recent).first()) == (40, 0, 40)
    assert rows(serve.term_counts(recent)) == [("c", 40), ("d", 40)]
    assert serve.sample_rows(recent, 4).count() == 4
    assert [tuple(r) for r in serve.value_counts(recent, "TICKER", 1).collect()] == [("A", 26)]


# ---- sentiment -----------------------------------------------------------------------------
TEXTS = [(1, "Good good, bad!"), (2, "nothing here"), (3, None), (4, ""), (5, "BAD Großes Bad é")]
LEX = [("good", 2.0), ("bad", -3.0)]


def test_scores_by_set_and_by_join_agree(spark):
    df = spark.createDataFrame(TEXTS, "tweet_id bigint, text string")
    lex = spark.createDataFrame(LEX, "token string, valence double")
    by_set = sentiment.score_sentiment(df, "text", lex, "s")
    by_join = sentiment.score_by_join(df, "text", lex, "tweet_id")
    fields = [F.col(f"s.{f}").alias(f) for f in sentiment.SCORE_FIELDS]
    assert rows(by_set, "tweet_id", *fields) == rows(by_join)
    by_slices = sentiment.score_by_join(df, "text", lex, "tweet_id", max_rows=1, hot_rows=1)
    assert rows(by_slices) == rows(by_join)
    got = {r["tweet_id"]: r for r in by_join.collect()}
    assert (got[1]["sentiment"], got[1]["positive"], got[1]["negative"]) == ("POSITIVE", 2 / 3, 1 / 3)
    assert got[1]["total"] == pytest.approx(1 / 16**0.5)
    assert (got[2]["sentiment"], got[4]["sentiment"], got[5]["sentiment"]) == ("NEUTRAL", "NEUTRAL", "NEGATIVE")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    posts=st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([None, "", "good bad good", "été мир", "bad", "x y"])), max_size=8),
    lex=st.lists(st.tuples(st.sampled_from(["good", "bad", "été", "мир", None]), st.sampled_from([2.0, -3.0, 0.5, 0.0, None])), max_size=6),
)
def test_both_ways_score_shared_ids_nulls_and_repeated_tokens_alike(spark, posts, lex):
    df = spark.createDataFrame(posts, "tweet_id int, text string")
    words = spark.createDataFrame(lex, "token string, valence double")
    fields = [F.col(f"s.{f}").alias(f) for f in sentiment.SCORE_FIELDS]
    by_set = sentiment.score_sentiment(df, "text", words, "s").select("tweet_id", *fields)
    by_join = sentiment.score_by_join(df, "text", words, "tweet_id")
    near = [F.round(f, 12).alias(f) if f != "sentiment" else f for f in sentiment.SCORE_FIELDS]
    assert rows(by_join, "tweet_id", *near) == rows(by_set, "tweet_id", *near)


def test_lexicon_of_many_valences_and_scripts(spark):
    many = {(-1) ** i * (i + 1) / 100: [f"word{chr(97 + i % 26)}{'abcdefghij'[i // 26 % 10]}{'abcdefghijklmnopqrst'[i // 260]}"] for i in range(5000)}
    df = spark.createDataFrame([("wordaaa wordbaa",), ("Été",), ("мир",)], "text string")
    got = sentiment.score_sentiment(df, "text", sentiment.Lexicon(many | {9.0: ["été"], -9.0: ["мир"]}), "s").collect()
    assert [r["s"]["sentiment"] for r in got] == ["NEGATIVE", "POSITIVE", "NEGATIVE"]
    assert got[0]["s"]["positive"] == got[0]["s"]["negative"] == 0.5


def test_null_text_has_no_scores(spark):
    df = spark.createDataFrame(TEXTS, "tweet_id bigint, text string").filter("tweet_id = 3")
    got = sentiment.score_sentiment(df, "text", sentiment.Lexicon({2.0: ["good"]}), "s").first()["s"]
    assert tuple(got) == (None, None, None, None, None)


def test_lexicon_above_the_bound_is_refused(spark):
    lex = spark.createDataFrame(LEX, "token string, valence double")
    with pytest.raises(ValueError):
        sentiment.Lexicon.of(lex, 1)


def test_own_scorer_fails_record_by_record(spark):
    def score(text):
        if "bad" in text.lower():
            raise ValueError(text)
        return "POSITIVE", 0.5, 0.5, 0.0

    df = spark.createDataFrame(TEXTS[:2], "tweet_id bigint, text string")
    got = sentiment.score_with(df, "text", score, "s").select("tweet_id", "s.text", "s.sentiment", "s.total")
    assert rows(got) == [(1, "Good good, bad!", None, None), (2, "nothing here", "POSITIVE", 0.5)]


# ---- capture -------------------------------------------------------------------------------
def test_capture_rule(spark, dim, monkeypatch):
    posts = spark.createDataFrame(
        [(1, "go $a", "en", "original"), (2, "go #B x", "en", "quoted"), (3, "$A", "en", "retweeted"),
         (4, "$A", "fr", "original"), (5, "$A Algo", "en", "original"), (6, "A", "en", "original"), (7, "#AB", "en", "original")],
        "tweet_id bigint, text string, lang string, tweet_type string",
    )
    assert rows(capture.capture_filter(posts, dim), "tweet_id") == [(1,), (2,)]
    shared = posts.withColumn("tweet_id", F.when(F.col("tweet_id") < 7, 1))
    judged = rows(capture.capture_filter(shared, dim), "tweet_id", "text")
    assert judged == [(1, "go #B x"), (1, "go $a")]
    monkeypatch.setattr(capture, "small_values", lambda *_: None)
    assert rows(capture.capture_filter(posts, dim), "tweet_id") == [(1,), (2,)]
    assert rows(capture.capture_filter(shared, dim), "tweet_id", "text") == judged


def test_status(spark):
    def post(i, sensitive, tags_, parent=None, text="good"):
        return (i, 1, text, (0.0, "original", sensitive, tags_), parent)

    parent = ("x", "original", "bad", ["T"])
    posts = spark.createDataFrame(
        [post(1, False, ["A"]), post(2, True, ["A"]), post(3, None, ["A"]), post(4, False, []),
         post(5, False, [], parent), post(6, False, ["A"], None, None), post(7, False, ["A"], ("x", "original", None, []))],
        POSTS_RAW,
    )
    packed = sentiment.pack_scores(posts, sentiment.Lexicon({1.0: ["good"], -1.0: ["bad"]}))
    got = {r["tweet_id"]: r for r in capture.with_status(packed).collect()}
    assert [got[i]["result"] for i in range(1, 8)] == [
        "Ok", "Dropped", "Ok", "Dropped", "Ok", "ProcessingFailed", "ProcessingFailed",
    ]
    assert got[5]["reference_tweets"]["tweet_text"]["sentiment"] == "NEGATIVE"
    assert got[1]["reference_tweets"] is None
    # a parent that cannot be scored leaves the post's own text alone
    assert got[7]["tweet_text"]["text"] == "good"


# ---- threads -------------------------------------------------------------------------------
def brute_roots(parents, hops=5):
    out = {}
    for node, parent in parents.items():
        at, n = parent, 1
        while parent is not None and n <= hops and at in parents:
            if parents[at] is None:
                out[node] = (at, n)
                break
            at, n = parents[at], n + 1
    return out


@pytest.mark.parametrize("hot_rows", [2_000_000, 3])
def test_roots_equal_a_walk(spark, hot_rows):
    rng = random.Random(7)
    parents = {0: None, 1: None}
    for i in range(2, 400):
        parents[i] = rng.choice([None, 0, 0, 0, i - 1, i - 1, rng.randrange(i), 10_000 + i])
    df = spark.createDataFrame([(i, p, f"t{i}") for i, p in parents.items()], "tweet_id bigint, parent_id bigint, text string")
    got = threads.resolve_root(df, hot_rows=hot_rows).collect()
    assert {r["tweet_id"]: (r["root_id"], r["hops"]) for r in got} == brute_roots(parents)
    assert all(r["root_text"] == f"t{r['root_id']}" for r in got)
    assert max(r["hops"] for r in got) == 5


def test_every_hop_is_one_join(spark):
    df = spark.createDataFrame([(i, i // 2 or None, "t") for i in range(50)], "tweet_id bigint, parent_id bigint, text string")
    out = threads.resolve_root(df)
    assert out.collect()
    # levels are written once: what is left is the join of the texts and its two hot-key marks
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("HashJoin") + final.count("MergeJoin") <= 3


def test_with_parent(spark):
    df = spark.createDataFrame([(1, None, "about #x"), (2, 1, "re"), (3, 9, "lost")], "tweet_id bigint, parent_id bigint, text string")
    got = {r["tweet_id"]: r["reference_tweets"] for r in threads.with_parent(df).collect()}
    assert got[1] is None and got[3] is None
    assert tuple(got[2]) == ("1", "original", "about #x", ["X"])
