"""P*, F*, E2, E5, E8-E11, C6, C7 on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from scorebook.functions.columns import (ball_facts, blank_to_null, cast_timestamps_to_date, declared_flag,
                                         drop_prefixed, first_map_entry, first_of, innings_key, last_of,
                                         match_type_fix, nested_json_value, opponent, parse_date,
                                         rename_columns, replace_values)


def test_ball_facts(spark):
    df = spark.createDataFrame([(0.1, 4, ""), (12.6, 6, "bowled"), (3.0, 5, None)], "delivery double, batter_runs long, wicket_type string")
    r = ball_facts(df).collect()
    assert [(x.over, x.ball, x.wickets, x.six, x.four) for x in r] == [(1, 1, 0, 0, 1), (13, 6, 1, 1, 0), (4, 0, 0, 0, 1)]


def test_whole_value_replace_and_blanks(spark):
    df = spark.createDataFrame([("Royal Challengers Bengaluru", "Royal Challengers Bengaluru Women", ""), ("x", None, "y")],
                               "a string, b string, c string")
    out = blank_to_null(replace_values(df, {"Royal Challengers Bengaluru": "Royal Challengers Bangalore"})).collect()
    assert tuple(out[0]) == ("Royal Challengers Bangalore", "Royal Challengers Bengaluru Women", None)
    assert tuple(out[1]) == ("x", None, "y")


def test_rename_drop_cast(spark):
    df = spark.createDataFrame([(1, True, dt.datetime(2020, 1, 2, 3, 4))], "`Batting Style` int, missing_x boolean, ts timestamp")
    out = cast_timestamps_to_date(drop_prefixed(rename_columns(df), "missing_"))
    assert out.columns == ["batting_style", "ts"] and dict(out.dtypes)["ts"] == "date"


def test_document_helpers(spark):
    df = spark.createDataFrame([(["a", "b", "c"], "2020-07-01", {"wickets": 7.0}, '{"info": {"event": {"name": "X"}}}'),
                                ([], "2020-13-45", None, '{"info": {"event": "flat"}}'),
                                (["solo"], "2021-01-05T10:00:00", {}, '{bad')],
                               "arr array<string>, d string, m map<string,double>, j string")
    out = df.select(first_of("arr").alias("f"), last_of("arr").alias("l"), parse_date("d").alias("d"),
                    first_map_entry("m")["key"].alias("k"), nested_json_value("j", ["info", "event", "name"], "none").alias("e")).collect()
    assert tuple(out[0]) == ("a", "c", dt.date(2020, 7, 1), "wickets", "X")
    assert tuple(out[1]) == (None, None, None, None, "none")
    assert tuple(out[2]) == ("solo", "solo", dt.date(2021, 1, 5), None, "none")


def test_opponent_declared_innings_key(spark):
    df = spark.createDataFrame([(["A", "B"], "A", "Yes", "m", "1st"), (["A"], "A", "true", "m", None),
                                (None, None, "no", None, "2nd"), ([None, "B"], None, None, "m", "2nd")],
                               "teams array<string>, team string, dec string, mid string, inn string")
    out = df.select(opponent("teams", "team").alias("o"), declared_flag("dec").alias("d"),
                    innings_key("mid", "inn").alias("k")).collect()
    assert [tuple(r) for r in out] == [("B", 1, "m_1"), ("Unknown", 1, None), ("Unknown", 0, None), ("B", 0, "m_2")]


def test_match_type_fix(spark):
    df = spark.createDataFrame([("ODM", "Men International"), ("ODM", None), ("ODM", "Club"), ("T20", "intl INTERNATIONAL")],
                               "match_type string, league string")
    assert [r.m for r in df.select(match_type_fix().alias("m")).collect()] == ["ODI", "ODM", "ODM", "T20"]
