"""Column operators on hand-written rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import DateTimeException
from pyspark.sql import functions as F

from reelhouse.functions import columns as C
from reelhouse.functions.times import ntz, wall_clock, whole_hours, whole_minutes


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    ("email", "masked"),
    [
        ("ann@x.org", "a*****@x.org"),
        ("@x.org", "@*****@x.org"),
        ("a@b@c", "a*****@b@c"),
        ("abc", "a*****"),
        ("", "*****"),
        (None, None),
    ],
)
def test_mask_email(spark, email, masked):
    assert values(spark, C.mask_email("e"), [(email,)], "e string") == [masked]


def test_mask_email_honours_its_argument(spark):
    df = spark.createDataFrame([("ann@x.org", "bob@y.org")], "email string, other string")
    assert df.select(C.mask_email("other")).first()[0] == "b*****@y.org"


def test_mask_never_shows_the_local_part(spark):
    names = st.text("abcdefgh.", min_size=2, max_size=12)
    emails = st.lists(st.tuples(names, names), min_size=1, max_size=20)

    @settings(max_examples=5, deadline=None)
    @given(emails)
    def check(pairs):
        rows = [(local, f"{local}@{domain}") for local, domain in pairs]
        df = spark.createDataFrame(rows, "local string, email string")
        masked = df.select("local", "email", C.mask_email("email").alias("m")).collect()
        for row in masked:
            assert row.m == row.email[0] + "*****" + row.email[len(row.local) :]

    check()


def test_mask_ssn(spark):
    rows = [("123-45-6789",), ("123",), (None,)]
    assert values(spark, C.mask_ssn("s"), rows, "s string") == ["xxx-xx-6789", "xxx-xx-", None]


def test_full_name_is_null_when_a_part_is(spark):
    rows = [("A", "B"), ("A", None), (None, "B"), ("", "B")]
    names = values(spark, C.full_name("f", "l"), rows, "f string, l string")
    assert names == ["A B", None, None, " B"]


def test_surrogate_key(spark):
    rows = [(None, "b"), ("a-b", "c"), ("a", "b-c"), ("é", "")]
    keys = values(spark, C.surrogate_key("x", "y"), rows, "x string, y string")
    assert keys[0] == "1f9a533592f721c4b0ed13af5b7a19b8"
    assert keys[1] == keys[2] == hashlib.md5(b"a-b-c").hexdigest()
    assert keys[3] == hashlib.md5("é-".encode()).hexdigest()


def test_surrogate_key_of_other_types(spark):
    row = spark.sql("select 7 as i, true as b, cast(null as int) as n")
    text = "7-true-_dbt_utils_surrogate_key_null_"
    key = row.select(C.surrogate_key("i", "b", "n")).first()[0]
    assert key == hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("a"), F.lit("z").alias("b"))
    key = C.surrogate_key("a", "b").alias("k")
    spread = {tuple(r) for r in df.repartition(7).select("a", key).collect()}
    assert spread == {tuple(r) for r in df.coalesce(1).select("a", key).collect()}


def test_surrogate_key_needs_parts():
    with pytest.raises(ValueError):
        C.surrogate_key()


def test_gen_id_is_a_uniform_integer_from_1_to_10000(spark):
    ids = spark.range(200_000).select(C.gen_id(3).alias("i"))
    assert ids.dtypes == [("i", "int")]
    low, high, mean = ids.agg(F.min("i"), F.max("i"), F.avg("i")).first()
    assert low == 1 and high == 10_000 and abs(mean - 5000.5) < 50


def test_load_stamp(spark):
    df = spark.range(3)
    assert df.select(C.load_stamp()).distinct().count() == 1
    assert df.select(C.load_stamp("2024-02-23 00:00:00").alias("t")).dtypes == [("t", "timestamp")]


def test_first_where_and_first_element(spark):
    rows = [(["end", None, "A", "B"],), (["end"],), ([],), (None,)]
    first = C.first_where("a", lambda x: x != "end")
    assert values(spark, first, rows, "a array<string>") == ["A", None, None, None]
    assert values(spark, C.first_element("a"), rows, "a array<string>") == ["end", "end", None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_ignores_offset_fraction_and_session_zone(spark, conf, zone):
    conf(session__timeZone=zone)
    rows = [("2021-12-25T07:00:00.000-06:00",), ("2024-03-10T02:30:00.999Z",), (None,)]
    texts = values(spark, wall_clock("t").cast("string"), rows, "t string")
    assert texts == ["2021-12-25 07:00:00", "2024-03-10 02:30:00", None]


def test_malformed_time_fails_or_gives_null(spark):
    rows = [("not a time at all",)]
    with pytest.raises(DateTimeException):
        values(spark, wall_clock("t"), rows, "t string")
    assert values(spark, wall_clock("t", on_error="null"), rows, "t string") == [None]
    with pytest.raises(ValueError):
        wall_clock("t", on_error="skip")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    ("start", "end", "hours", "minutes"),
    [
        ("2024-01-01 10:59:00", "2024-01-01 11:01:00", 0, 2),
        ("2024-01-01 11:01:00", "2024-01-01 10:00:30", -1, -60),
        ("2024-01-01 10:59:30", "2024-01-01 11:01:29", 0, 1),
        ("2024-01-01 00:00:00", "2025-04-25 18:59:59", 11538, 692339),
        ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 2, 120),
        ("2024-03-10 01:30:00", "2024-03-10 02:30:00", 1, 60),
    ],
)
def test_whole_units(spark, conf, zone, start, end, hours, minutes):
    conf(session__timeZone=zone)
    row = spark.range(1).select(
        whole_hours(ntz(start), ntz(end)), whole_minutes(ntz(start), ntz(end))
    )
    assert tuple(row.first()) == (hours, minutes)
