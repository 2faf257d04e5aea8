import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mention_pulse.functions import columns, keys, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("x")).first()["x"]


def test_tags_of_any_script_upper_distinct(spark):
    got = one(spark, "#blue_sky $Q rises #наука with |data #Q done#", text.extract_tags("c"))
    assert got == ["BLUE_SKY", "Q", "НАУКА", "DATA"]


def test_dotted_ticker_needs_the_option(spark):
    assert one(spark, "$BRK.B up. $T.", text.extract_tags("c")) == ["BRK", "T"]
    assert one(spark, "$BRK.B up. $T.", text.extract_tags("c", dotted=True)) == ["BRK.B", "T"]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("see http://x and more words here", "see here"),
        ("trailing http://t.co/abc", "trailing http t co abc"),
        ("@me #tag $T1 |x hello,  wörld -ok", "hello w rld -ok"),
        ("#only $tags", ""),
        ("a http://1 b\nc http://2 d e", "a b c e"),
        ("  two  lead", "two lead"),
        (None, None),
    ],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, text.clean_text("c")) == clean


def test_clean_text_by_url_token(spark):
    assert one(spark, "a http://x/y b https://z", text.clean_text("c", "token")) == "a b"
    with pytest.raises(ValueError):
        text.clean_text("c", "other")


def test_prefix_key(spark):
    assert one(spark, "A" * 30, text.prefix_key("c")) == "a" * 25


def test_tag_lists_survive_nulls(spark):
    df = spark.createDataFrame(
        [(["A", "B"], ["B"]), (None, ["C"]), (None, None)], "a array<string>, b array<string>"
    )
    got = df.select(text.all_tags("a", "b"), text.union_tags("a", "b")).collect()
    assert [tuple(r) for r in got] == [(["A", "B", "B"], ["A", "B"]), (["C"], ["C"]), ([], [])]


def test_label(spark):
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.0,), (None,)], "c double")
    got = [r[0] for r in df.select(text.label("c")).collect()]
    assert got == ["POSITIVE", "NEGATIVE", "NEUTRAL", None]


def test_has_word_is_whole_and_caseless(spark):
    words = ["algo", "alerts"]
    for value, hit in [("Algo!", True), ("algorithm", False), ("my_algo", False), ("x ALERTS", True)]:
        assert one(spark, value, text.has_word("c", words)) is hit


def test_keys(spark):
    df = spark.createDataFrame([(1666915198.0, 1585841080431321090, 7)], "at double, id bigint, s bigint")
    got = df.select(
        keys.time_key("at", "id"),
        keys.time_key("at", "s"),
        keys.spread_key("id", 5),
        keys.ticker_detail(F.lit("AAPL"), "hourly"),
        keys.key_ts(keys.time_key("at", "id")),
        keys.level_key("Daily", columns.to_ts("at")),
    ).first()
    assert got[:4] == (
        "2022-10-27 23:59:58.0431321090", "2022-10-27 23:59:58.7", "0", "AAPL_HOURLY",
    )
    assert got[4] == dt.datetime(2022, 10, 27, 23, 59, 58)
    assert got[5] == "2022-10-27"


def test_level_key_of_a_choice():
    day = dt.date(2022, 11, 3)
    got = [keys.level_key(level, day, 5) for level in ("Yearly", "Monthly", "Daily", "Hourly")]
    assert got == ["2022", "2022-11", "2022-11-03", "2022-11-03-05"]


def test_level_arguments_are_checked():
    with pytest.raises(KeyError):
        keys.check_parts(["year", "week"])
    with pytest.raises(KeyError):
        keys.check_level("weekly")


def test_detail_level_skips_absent_parts(spark):
    df = spark.createDataFrame([("2022", "11", None, None)], "year string, month string, day string, hour string")
    assert df.select(keys.detail_level(keys.PARTS)).first()[0] == "2022-11"


MOMENTS = st.sampled_from([0, 1, 999_999, 1_000_000, 1_100_000, 1_170_000, 1_179_575, 1_500_000, 61_000_000])
IDS = st.one_of(st.integers(0, 130), st.integers(0, 2**62), st.sampled_from([10**9, 10**10, 10**10 + 5]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(MOMENTS, IDS), min_size=30, max_size=80))
def test_packed_time_key_orders_and_reads_like_the_text(spark, pairs):
    data = [((1_700_000_000_000_000 + micros) / 1e6, ident) for micros, ident in pairs]
    df = spark.createDataFrame(data, "at double, id bigint")
    packed = keys.packed_time_key("at", "id")
    got = df.select(keys.time_key("at", "id"), packed, keys.unpack_time_key(packed)).collect()
    assert all(plain == unpacked for plain, _, unpacked in got)
    by_text = [plain for plain, _, _ in sorted(got, key=lambda r: r[0])]
    by_number = [plain for plain, _, _ in sorted(got, key=lambda r: r[1])]
    assert by_text == by_number


def test_epoch_round_trip_keeps_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-01-01 00:00:07.179575' AS ts")
    at = columns.to_epoch("ts")
    assert df.select(columns.to_ts(at).cast("string")).first()[0] == "2024-01-01 00:00:07.179575"


def test_flatten_keeps_arrays_and_null_structs(spark):
    kind = "id int, s struct<x:int,deep:struct<y:array<string>>>"
    df = spark.createDataFrame([(1, (2, (["a"],))), (3, None)], kind)
    flat = columns.flatten(df)
    assert flat.columns == ["id", "s_x", "s_deep_y"]
    assert rows(flat) == [(1, 2, ["a"]), (3, None, None)]


def test_resolve_long(spark):
    struct = spark.createDataFrame([((1, None),), ((None, 2**40),)], "a struct<int:int,long:bigint>")
    assert rows(struct.select(columns.resolve_long(struct, "a"))) == [(1,), (2**40,)]
    loose = spark.createDataFrame([("12",), ("x",)], "a string")
    assert rows(loose.select(columns.resolve_long(loose, "a"))) == [(12,), (None,)]


def test_apply_mapping(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    out = columns.apply_mapping(df, [("a", "int", "A", "string"), ("b", "string", "B", "bigint")])
    assert out.dtypes == [("A", "string"), ("B", "bigint")]


def test_post_type(spark):
    kind = "array<struct<type:string,id:bigint>>"
    for value, want in [(None, "original"), ([], "original"), ([None], "original"),
                        ([("quoted", 1), ("replied_to", 2)], "quoted")]:
        assert one(spark, value, columns.post_type("c"), kind) == want


def test_date_parts_are_padded_and_passed_through(spark):
    df = spark.createDataFrame([(1666915198.0, "x")], "at double, hour string")
    got = columns.with_date_parts(df, "at").select("year", "month", "day", "hour").first()
    assert tuple(got) == ("2022", "10", "27", "x")


def test_original_flag(spark):
    df = spark.createDataFrame([(None,), ("original",)], "reference_tweets_tweet_type string")
    assert [r[0] for r in columns.with_original_flag(df).select("is_original").collect()] == [True, False]
