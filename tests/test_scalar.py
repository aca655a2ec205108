import datetime as dt

import pytest
from pyspark.sql import functions as F

from cdcflow.functions import text, times, types
from cdcflow.operators.records import column_specs, message_map, project, to_message_records


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, millis",
    [("2020-03-18 10:56:00", 1584500160000), ("20200318105600", 1584500160000), ("2020-03-18 10:56:00.123", 1584500160000)],
)
def test_time_text_is_read_in_gmt8(spark, value, millis):
    assert one(spark, value, lambda c: types.wall_millis(times.parse_time(c))) == millis


def test_custom_format_and_bad_text(spark):
    fmt = "yyyy/MM/dd HH:mm:ss"
    assert one(spark, "2020/03/18 13:26:00", lambda c: types.wall_millis(times.parse_time(c, fmt))) == 1584509160000
    assert one(spark, "", lambda c: times.parse_time(c)) is None
    assert one(spark, "xxxx", lambda c: times.time_error(c, times.parse_time(c))) is True
    assert one(spark, "  ", lambda c: times.time_error(c, times.parse_time(c))) is False
    assert one(spark, "2020-03-18 junk", lambda c: times.parse_time(c, prefixes=True)) == dt.datetime(2020, 3, 18)


def test_results_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert one(spark, "2020-03-18 10:56:00", lambda c: types.wall_millis(times.parse_time(c))) == 1584500160000
            assert one(spark, 1584500160000, lambda c: times.format_time(times.millis_to_wall(c)), "long") == "2020-03-18 10:56:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "value, millis",
    [("1584500160", 1584500160000), ("1584500160000", 1584500160000), ("1584500160000000", 1584500160000),
     ("1584500160000000000", 1584500160000), ("1", 57600000)],
)
def test_epoch_text(spark, value, millis):
    assert one(spark, value, times.epoch_millis) == millis


def test_epoch_number_to_time(spark):
    want = dt.datetime(2020, 3, 18, 10, 56)
    assert one(spark, 1584500160, lambda c: times.to_timestamp_any(c, "int"), "int") == want
    assert one(spark, 1584500160000, lambda c: times.to_timestamp_any(c, "bigint"), "long") == want


@pytest.mark.parametrize(
    "value, kind, want",
    [("123", "TINYINT", 123), ("1", "SMALLINT", 1), ("1", "INT", 1), ("1", "MEDIUMINT", 1), (" 1 ", "BIGINT", 1),
     ("1.1", "DOUBLE", 1.1), ("true", "BOOLEAN", True), ("yes", "BOOLEAN", False), ("x", "unknown", "x"), ("7", "INTEGER", "7"),
     ("300", "TINYINT", None), ("1.5", "INT", None), ("", "INT", None), (None, "INT", None)],
)
def test_text_to_typed(spark, value, kind, want):
    assert one(spark, value, lambda c: types.text_to(c, kind)) == want


def test_text_with_time_format_is_rendered_again(spark):
    got = one(spark, "20200312-174412", lambda c: types.text_to(c, "STRING", "yyyyMMdd-HHmmss"))
    assert got == "2020-03-12 17:44:12"


@pytest.mark.parametrize(
    "kind, want",
    [("LONG", "1584510286187"), ("STRING", "2020-03-18 13:44:46"), ("DATE", "2020-03-18"), ("DATETIME", "2020-03-18 13:44:46")],
)
def test_timestamp_to_text(spark, kind, want):
    ts = dt.datetime(2020, 3, 18, 13, 44, 46, 187000)
    assert one(spark, ts, lambda c: types.value_to_text(c, kind, "timestamp_ntz"), "timestamp_ntz") == want


def test_null_to_text_is_empty(spark):
    assert one(spark, None, lambda c: types.value_to_text(c, "INT", "int"), "int") == ""


@pytest.mark.parametrize("value, want", [("decimal(10,2)", (10, 2)), ("decimal", (38, 18)), ("int", None), ("Decimal( 5 , 1 )", (5, 1))])
def test_decimal_info(spark, value, want):
    got = one(spark, value, types.decimal_info)
    assert (None if got is None else tuple(got)) == want


@pytest.mark.parametrize(
    "value, lenient, strict",
    [("int unsigned", "INT", "INT"), ("varchar(20)", "VARCHAR", "VARCHAR"), ("timestamp(6) with time zone", "TIMESTAMP", "TIMESTAMP"),
     ("my_timestamp_type", "TIMESTAMP", None), ("blob", "STRING", None), (None, None, None)],
)
def test_type_names(spark, value, lenient, strict):
    assert one(spark, value, types.normalize_type) == lenient
    assert one(spark, value, lambda c: types.normalize_type(c, strict=True)) == strict


def test_small_text_functions(spark):
    assert one(spark, "123456", text.md5_key) == "e10adc3949ba59abbe56e057f20f883e"
    assert one(spark, r"a\tb\r\n\101", text.unescape) == "a\tb\r\nA"
    assert one(spark, None, text.unescape) == ""
    assert bytes(one(spark, "6162", text.hex_bytes)) == b"ab"
    assert one(spark, "'dbo_test'.[t.x].plain.\"a.b\"", text.split_quoted) == ["dbo_test", "t.x", "plain", "a.b"]
    assert one(spark, "['dbo_test'].[table]", text.dotted_name) == "dbo_test.table"
    assert one(spark, '"a""b"', text.unquote) == 'a"b'
    assert one(spark, '"', text.unquote) == '"'


def test_long_quoted_name_does_not_overflow(spark):
    long = "'" + "a\\'" * 50_000 + "'.b"
    assert len(one(spark, long, text.split_quoted)) == 2


def test_row_json_and_message_forms(spark):
    df = spark.createDataFrame([(1, "val", None)], "col1 int, col2 string, col3 string")
    assert df.select(text.row_json(["col1", "col2", "col3"]).alias("j")).first().j == '{"col1":1,"col2":"val"}'
    named = to_message_records(df, "t-%{a}", ["a", "b", "c"]).first()
    assert (named.topic, named.key, named.value) == ("t-1", "{a=1, b=val, c=null}", '{"a":"1","b":"val","c":"null"}')
    whole = df.select(message_map(df).alias("m")).first().m
    assert whole == {"message": "1,val,null"}
    lone = spark.createDataFrame([('{"x":null,"y":{"z":1}}',)], "v string")
    got = to_message_records(lone, "%{y}/%{nope}").first()
    assert got.topic == '{"z":1}/%{nope}'
    assert '"x":null' in got.value


def test_json_decode(spark):
    assert one(spark, "oops", text.decode_json) == {"message": "oops"}
    assert one(spark, '{"message":"m","n":[1]}', text.decode_json) == {"message": "m", "n": "[1]"}
    assert one(spark, None, text.decode_json) is None


@pytest.mark.parametrize("value, want", [("1", "int"), ("3000000000", "long"), ("1.0", "double"), ("[1]", "array"), ('{"a":1}', "object"), ('"s"', "string"), ("true", "boolean"), ("null", "null"), ("{", None)])
def test_json_value_types(spark, value, want):
    assert one(spark, value, text.json_value_type) == want


def test_column_specs(spark):
    df = spark.createDataFrame([(1, "a", "2020-01-02")], "x int, y string, z string")
    assert project(df, ["*"]).columns == ["x", "y", "z"]
    assert project(df, ["z", "x"]).first() == ("2020-01-02", 1)
    row = project(df, [{"index": 1}, {"value": "k"}, {"name": "z", "type": "date"}]).first().asDict()
    assert row == {"1": "a", "val_k": "k", "z": dt.date(2020, 1, 2)}
    with pytest.raises(ValueError):
        project(df, ["x"], restore_column="y")
    with pytest.raises(ValueError):
        column_specs([])
