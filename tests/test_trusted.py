"""The six questions: hand-written rows, and documented answers on the test tables."""

import random
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelhouse.plans import trusted as T
from reelhouse.plans.stage import STAGE_MODELS
from reelhouse.session import comes_from_input
from reelhouse.workload import queries, views

STREAM = "movie_title string, user_email string, size_mb double, start_at string, end_at string"
REVIEW = "movie_title string, book_title string"
BOOK = "name string, author string"
AUTHOR = "name string, nationality_slug string"


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def session(title, email, start, end, size=1.0, day="2021-12-25"):
    return (title, email, size, f"{day}T{start}.000-06:00", f"{day}T{end}.000-06:00")


def streams_of(spark, titles):
    return frame(spark, STREAM, [session(t, "u", "01:00:00", "02:00:00") for t in titles])


def test_adaptation_share(spark):
    streams = streams_of(spark, ["Heat", "HEAT", "Dune", None, None, "Emma"])
    reviews = frame(spark, REVIEW, [("dune", "b"), ("DUNE", "c"), (None, "d"), ("Solo", "e")])
    assert tuple(T.adaptation_share(streams, reviews).first()) == (4, 1, 0.25)


def test_adaptation_share_of_nothing_is_null(spark):
    empty = frame(spark, STREAM, [])
    assert tuple(T.adaptation_share(empty, frame(spark, REVIEW, [])).first()) == (0, 0, None)


WINDOW = ("2021-12-25 07:00:00", "2021-12-25 12:00:00")


@pytest.mark.parametrize(
    ("start", "end", "endpoint", "overlap"),
    [
        ("07:00:00", "13:00:00", 1, 1),
        ("12:00:00", "13:00:00", 1, 1),
        ("06:00:00", "07:00:00", 1, 1),
        ("06:00:00", "12:00:00", 1, 1),
        ("06:00:00", "13:00:00", 0, 1),
        ("06:00:00", "06:59:59", 0, 0),
        ("12:00:01", "13:00:00", 0, 0),
    ],
)
def test_window_bounds(spark, start, end, endpoint, overlap):
    streams = frame(spark, STREAM, [session("Heat", "u", start, end)])
    assert T.users_in_window(streams, "Heat", *WINDOW).first()[0] == endpoint
    assert T.users_in_window(streams, "Heat", *WINDOW, mode="overlap").first()[0] == overlap


def test_window_counts_distinct_users_of_the_exact_title(spark):
    inside = ("08:00:00", "09:00:00")
    rows = [
        session("Heat", "a", *inside),
        session("Heat", "a", *inside),
        session("Heat", None, *inside),
        session("heat", "b", *inside),
        session(None, "c", *inside),
        session("Heat", "d", *inside, day="2021-12-24"),
    ]
    streams = frame(spark, STREAM, rows)
    assert T.users_in_window(streams, "Heat", *WINDOW).first()[0] == 1
    assert T.users_in_window(streams, None, *WINDOW).first()[0] == 3
    with pytest.raises(ValueError):
        T.users_in_window(streams, None, *WINDOW, mode="other")


def test_window_over_several_days(spark):
    long = ("m", "u", 1.0, "2021-12-20T00:00:00Z", "2021-12-30T00:00:00Z")
    late = ("m", "v", 1.0, "2021-12-26T23:59:59Z", "2021-12-30T00:00:00Z")
    streams = frame(spark, STREAM, [long, late])
    days = ("2021-12-24 10:00:00", "2021-12-26 23:59:59")
    assert T.users_in_window(streams, "m", *days).first()[0] == 1
    assert T.users_in_window(streams, "m", *days, mode="overlap").first()[0] == 2


def origin_by_hand(titles, reviews, books, authors, slug):
    def low(text):
        return None if text is None else text.lower()

    streamed = {low(t) for t in titles} - {None}
    pairs = {(low(m), low(b)) for m, b in reviews}
    return sum(
        1
        for movie, (m, b), (name, by), (author, origin) in product(
            streamed, pairs, books, authors
        )
        if movie == m
        and None not in (b, name, by, author)
        and b == low(name)
        and low(by) == low(author)
        and (slug is None or origin == slug)
    )


def test_adaptations_by_author_origin_counts_join_rows(spark):
    titles = ["Dune", "dune", "Emma", None]
    reviews = [("DUNE", "dune"), ("Dune", "DUNE"), ("Dune", "Emma"), ("Solo", "Dune"), (None, "x")]
    books = [("Dune", "Ann"), ("dune", "ANN"), ("Emma", "Bob"), ("Dune", None), (None, "Ann")]
    authors = [("ann", "sg"), ("Ann", "sg"), ("Bob", "uk"), (None, "sg")]
    args = (
        streams_of(spark, titles),
        frame(spark, REVIEW, reviews),
        frame(spark, BOOK, books),
        frame(spark, AUTHOR, authors),
    )
    assert T.adaptations_by_author_origin(*args, "sg").first()[0] == 4
    assert T.adaptations_by_author_origin(*args, None).first()[0] == 5
    assert T.adaptations_by_author_origin(*args, "none").first()[0] == 0


def test_adaptations_by_author_origin_equals_brute_force(spark):
    text = st.sampled_from(["a", "A", "b", "B", "c", None])
    slug = st.sampled_from(["x", "y", None])

    @settings(max_examples=6, deadline=None)
    @given(
        st.lists(text, max_size=5),
        st.lists(st.tuples(text, text), max_size=8),
        st.lists(st.tuples(text, text), max_size=8),
        st.lists(st.tuples(text, slug), max_size=6),
        slug,
    )
    def check(titles, reviews, books, authors, wanted):
        ours = T.adaptations_by_author_origin(
            streams_of(spark, titles),
            frame(spark, REVIEW, reviews),
            frame(spark, BOOK, books),
            frame(spark, AUTHOR, authors),
            wanted,
        ).first()[0]
        assert ours == origin_by_hand(titles, reviews, books, authors, wanted)

    check()


def test_mean_session_hours_truncates_each_session(spark):
    rows = [
        session("m", "u", "10:59:00", "11:01:00"),
        session("m", "u", "10:00:00", "12:59:59"),
        session("m", "u", "11:01:00", "10:00:30"),
        ("m", "u", 1.0, None, "2021-12-25T10:00:00Z"),
    ]
    assert T.mean_session_hours(frame(spark, STREAM, rows)).first()[0] == pytest.approx(1 / 3)
    assert T.mean_session_hours(frame(spark, STREAM, [])).first()[0] is None


def test_median_size_gb(spark):
    rows = [session("m", "u", "01:00:00", "02:00:00", size) for size in (100.0, 936.0, 944.9, 2e6)]
    streams = frame(spark, STREAM, rows)
    assert T.median_size_gb(streams).first()[0] == 0.94
    assert T.median_size_gb(frame(spark, STREAM, [])).first()[0] is None


def test_users_past_half(spark):
    movies = frame(
        spark,
        "title string, duration_mins int",
        [("Heat", 113), ("Emma", 60), ("Emma", 400), ("Nil", None), (None, 2)],
    )
    rows = [
        session("Heat", "a", "01:00:00", "01:56:00"),
        session("Heat", "b", "01:00:00", "01:55:59"),
        session("heat", "c", "01:00:00", "09:00:00"),
        session("Emma", "d", "01:00:00", "01:30:00"),
        session("Emma", "d", "02:00:00", "02:30:00"),
        session("Emma", None, "02:00:00", "02:30:00"),
        session("Nil", "e", "01:00:00", "09:00:00"),
        session(None, "f", "01:00:00", "09:00:00"),
        session("Heat", "g", "23:59:58", "23:59:59", day="2021-12-24"),
        ("Heat", "h", 1.0, "2021-12-24T23:59:59Z", "2021-12-25T02:00:00Z"),
        ("Heat", "i", 1.0, "2021-12-24T23:59:58Z", "2021-12-25T02:00:00Z"),
    ]
    streams = frame(spark, STREAM, rows)
    since = "2021-12-24 23:59:59"
    assert T.users_past_half(streams, movies, since).first()[0] == 3
    assert tuple(T.users_past_half(streams, movies, since, with_sessions=True).first()) == (3, 5)


@pytest.mark.parametrize(
    "bad",
    [
        ("m", "x", 1.0, "15/01/2024 08:00", "2021-12-25T09:00:00Z"),
        ("m", "x", 1.0, "2021-12-25T08:00:00Z", "later"),
        ("m", "x", 1.0, "2020-01-01Tnoon", "2020-01-01T13:00:00Z"),
    ],
)
@pytest.mark.parametrize("stored", [False, True])
def test_a_malformed_time_fails_every_question_about_times(spark, tmp_path, bad, stored):
    rows = [session("m", "u", "08:00:00", "09:00:00"), ("m", "v", 1.0, None, None)]
    movies = frame(spark, "title string, duration_mins int", [("m", 60)])

    def questions(streams):
        yield T.users_in_window(streams, None, *WINDOW)
        yield T.users_in_window(streams, "m", *WINDOW, mode="overlap")
        yield T.mean_session_hours(streams)
        yield T.users_past_half(streams, movies, "2021-12-24 00:00:00")

    def streams_of_rows(rows, name):
        streams = frame(spark, STREAM, rows)
        if stored:
            STAGE_MODELS["streams"].build(streams).write.parquet(str(tmp_path / name))
            streams = spark.read.parquet(str(tmp_path / name))
        return streams

    assert [q.first()[0] for q in questions(streams_of_rows(rows, "good"))] == [1, 1, 1.0, 1]
    for question in questions(streams_of_rows([*rows, bad], "bad")):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            question.collect()


def test_median_of_one_value_on_most_rows_and_of_odd_sizes(spark):
    def median(sizes):
        rows = [session("m", "u", "01:00:00", "02:00:00", size) for size in sizes]
        return T.median_size_gb(frame(spark, STREAM, rows)).first()[0]

    assert median([5000.0] * 400 + [1.0, 9000.0, None]) == 5.0
    assert median([-2000.0, -1000.0, 0.0, 1000.0, None]) == -1.0
    assert median([1000.0 + i / 1000 for i in range(1001)]) == round((1000.0 + 0.5) / 1000, 2)


@pytest.mark.parametrize("values", [1, 5, 1 << 20])
def test_median_of_crowded_sizes(spark, monkeypatch, values):
    """Cut into slices again and again, down to neighbouring values and to one value."""
    monkeypatch.setattr(T, "VALUES", values)
    monkeypatch.setattr(T, "FINE", 4)
    rnd = random.Random(values)
    for sizes in (
        [1e6 + rnd.randrange(50) * 2e-10 for _ in range(301)],
        [1e6] * 200 + [1e6 + i for i in range(150)],
        [-(2.0**-i) for i in range(40)] + [2.0**i for i in range(41)],
    ):
        streams = spark.createDataFrame([(x,) for x in sizes], "size_mb double")
        want = sorted(sizes)[(len(sizes) + 1) // 2 - 1]
        assert T.median_size_gb(streams).first()[0] == round(want / 1000, 2)


def test_times_that_cannot_be_read_fail_where_they_are_not_stored(spark):
    good, bad = session("m", "u", "01:00:00", "02:00:00"), ("m", "u", 1.0, "2021-12-25T01:00:00Z", "soon")
    movies = frame(spark, "title string, duration_mins int", [("m", 10)])
    for rows, fails in (([good], False), ([good, bad], True), ([good, (*bad[:4], None)], False)):
        raw = frame(spark, STREAM, rows)
        staged = STAGE_MODELS["streams"].build(raw)
        for streams in (raw, staged):
            for question in (
                T.users_in_window(streams, None, "2020-01-01 00:00:00", "2020-01-02 00:00:00"),
                T.users_in_window(streams, "m", "2020-01-01 00:00:00", "2020-01-02 00:00:00", mode="overlap"),
                T.users_past_half(streams, movies, "2022-01-01 00:00:00"),
            ):
                if fails:
                    with pytest.raises(PySparkException):
                        question.collect()
                else:
                    assert question.first()[0] == 0


def test_what_comes_from_the_input(spark, tmp_path):
    spark.range(3).selectExpr("id", "id + 1 AS next").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert comes_from_input(df, "id", "next") and comes_from_input(df.filter("id > 1").select("next", "id"), "next")
    assert not comes_from_input(df.withColumn("next", F.col("id") + 1), "id", "next")
    assert not comes_from_input(df, "id", "other")


# Answers of FIXTURES.md: Q1, any-title window, origin, mean, median, past half twice.
DOCUMENTED = {
    "sf0.001": ("nation_19", (151, 129, 0.8543046357615894), 2, 17, 0.426, 0.36, (11, 19), (15, 109)),
    "sf0.01": ("nation_20", (1501, 643, 0.4283810792804797), 60, 9, 0.4236, 0.35, (97, 151), (150, 1124)),
}


@pytest.mark.parametrize("sf", DOCUMENTED)
def test_documented_answers(spark, sf):
    slug, share, window, origin, mean, median, late, early = DOCUMENTED[sf]
    stage = {
        name: queries._staged(name, landing)
        for name, landing in views.landing_views(spark, f"/root/testdata/{sf}").items()
    }
    streams, movies, reviews = stage["streams"], stage["movies"], stage["reviews"]
    assert tuple(T.adaptation_share(streams, reviews).first()) == share
    assert T.users_in_window(streams, None, *queries.OUTAGE).first()[0] == window
    by_origin = T.adaptations_by_author_origin(
        streams, reviews, stage["books"], stage["authors"], slug
    )
    assert by_origin.first()[0] == origin
    assert T.mean_session_hours(streams).first()[0] == mean
    assert T.median_size_gb(streams).first()[0] == median
    for since, answer in (("2024-01-30 00:00:00", late), ("2024-01-23 23:59:59", early)):
        assert tuple(T.users_past_half(streams, movies, since, True).first()) == answer
