from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parsing
from tidemark.functions.event_time import access_log_time, behavior_time, keep, rowtime
from tidemark.schemas import ACCESS_LOG, BEHAVIOR


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def ms(*fields):
    return int(datetime(*fields, tzinfo=UTC).timestamp() * 1000)


def test_behavior_line(spark):
    rows = parsing.parse_behavior(lines(spark, "1,42,7,pv,1704067200"))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in BEHAVIOR
    ]
    assert rows.collect() == [(1, 42, 7, "pv", 1704067200)]


@pytest.mark.parametrize(
    "line,want",
    [
        ("1,2,3,pv,100,x", (1, 2, 3, "pv", 100)),
        ("+1,-2,3,,100,,,", (1, -2, 3, "", 100)),
        ("9223372036854775807,-9223372036854775808,2147483647,pv,0007",
         (2**63 - 1, -(2**63), 2**31 - 1, "pv", 7)),
    ],
)
def test_behavior_accepts(spark, line, want):
    assert parsing.parse_behavior(lines(spark, line)).collect() == [want]


BAD_BEHAVIOR = [
    "x,2,3,pv,100",
    "1,2,3",
    " 1,2,3,pv,100",
    "",
    "1,2,3,pv,",
    "1,2,2147483648,pv,100",
    "9223372036854775808,2,3,pv,100",
    "1,2,3,pv,100 ",
]


@pytest.mark.parametrize("line", BAD_BEHAVIOR)
def test_behavior_failfast(spark, line):
    with pytest.raises(Exception, match="malformed behavior line"):
        parsing.parse_behavior(lines(spark, "1,2,3,pv,100", line)).collect()


def test_failfast_also_when_no_field_is_read(spark):
    with pytest.raises(Exception, match="malformed behavior line"):
        parsing.parse_behavior(lines(spark, "1,2,3,pv,100", "x,2,3,pv,1")).count()
    with pytest.raises(Exception, match="malformed access-log line"):
        rows = parsing.parse_access_log(lines(spark, "10.0.0.8 - - nonsense"))
        rows.where("method = 'GET'").count()


def test_behavior_quarantine(spark):
    good, bad = parsing.split_behavior(lines(spark, "1,2,3,pv,100", *BAD_BEHAVIOR))
    assert good.collect() == [(1, 2, 3, "pv", 100)]
    assert sorted(r.value for r in bad.collect()) == sorted(BAD_BEHAVIOR)


def test_access_log_line(spark):
    rows = parsing.parse_access_log(
        lines(spark, "10.0.0.8 - - 01/01/2024:00:00:07 +0000 GET /p/69")
    )
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in ACCESS_LOG
    ]
    assert rows.collect() == [("10.0.0.8", "-", ms(2024, 1, 1, 0, 0, 7), "GET", "/p/69")]


@pytest.mark.parametrize(
    "time,want",
    [
        ("17/05/2015:10:05:03", ms(2015, 5, 17, 10, 5, 3)),
        ("01/01/2024:00:00:07]", ms(2024, 1, 1, 0, 0, 7)),
        ("01/01/2024:00:00:07/x:y", ms(2024, 1, 1, 0, 0, 7)),
        ("1/1/2024:0:0:7", ms(2024, 1, 1, 0, 0, 7)),
        ("32/01/2024:00:00:00", ms(2024, 2, 1)),
        ("30/02/2024:00:00:00", ms(2024, 3, 1)),
        ("01/13/2023:24:60:61", ms(2024, 1, 2, 1, 1, 1)),
        ("00/03/2024:00:00:00", ms(2024, 2, 29)),
        ("01/01/1969:00:00:00", ms(1969, 1, 1)),
    ],
)
def test_log_times(spark, time, want):
    rows = parsing.parse_access_log(lines(spark, f"ip u - {time} +0000 GET /p"))
    assert rows.first().event_time == want


BAD_LOG = [
    "ip u - 01-01-2024:00:00:00 +0000 GET /p",
    "ip u - 01/01/2024 +0000 GET /p",
    "ip u - 01/01/2024:00:00:00 +0000 GET",
    "ip u - 01/01/2024:00:00:00 +0000 GET   ",
    "",
]


def test_access_log_quarantine(spark):
    good, bad = parsing.split_access_log(
        lines(spark, "ip u - 01/01/2024:00:00:00 +0000 GET  x", *BAD_LOG)
    )
    assert good.collect() == [("ip", "u", ms(2024, 1, 1), "GET", "")]
    assert sorted(r.value for r in bad.collect()) == sorted(BAD_LOG)


def test_filter_is_exact(spark):
    kinds = ["pv", "PV", "buy", "", None, "pv "]
    df = spark.createDataFrame([(k, 1) for k in kinds], "behavior string, timestamp long")
    assert keep(behavior_time(df), "behavior", "pv").count() == 1


def test_row_times(spark):
    behavior = spark.createDataFrame([("pv", 7)], "behavior string, timestamp long")
    log = spark.createDataFrame([("GET", "/p", 7001)], "method string, url string, event_time long")
    got = rowtime(behavior_time(behavior), "behavior")
    assert got.columns == ["behavior", "rt"]
    assert got.select(F.unix_millis("rt")).first()[0] == 7000
    got = rowtime(access_log_time(log), "method", "url")
    assert got.columns == ["method", "url", "rt"]
    assert got.select(F.unix_millis("rt")).first()[0] == 7001


@pytest.mark.parametrize(
    "time, want",
    [
        ("01/01/2024:00:00:86400", "2024-01-02 00:00:00"),
        ("01/01/2024:00:00:123456789", "2027-11-29 21:33:09"),
        ("00000000001/1/2024:0:0:90", "2024-01-01 00:01:30"),
        ("1/12345/2000:0:0:0", "3028-09-01 00:00:00"),
        ("0/3/2024:25:61:0", "2024-03-01 02:01:00"),
    ],
)
def test_long_time_parts_carry_over(spark, time, want):
    line = f"ip u - {time} +0000 GET /a"
    row = parsing.parse_access_log(spark.createDataFrame([(line,)], "value string")).select(
        F.date_format(F.timestamp_millis("event_time"), "yyyy-MM-dd HH:mm:ss").alias("t")
    ).first()
    assert row.t == want
