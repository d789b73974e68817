"""The analytic questions over stage tables. Each returns one row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.times import (
    moment_from,
    moment_of,
    moment_until,
    parsed_moment,
    second_from,
    second_until,
    stored_moment,
    whole_units,
)
from reelhouse.operators.joins import join_dimension
from reelhouse.session import comes_from_input
from reelhouse.sources.snapshots import Facts

#: Slices that a crowded bucket is cut into, and rows whose values are counted one by one.
FINE = 4_096
VALUES = 1 << 20


def _lower(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.lower(source).alias(name) for name, source in columns.items()])


def adaptation_share(streams: DataFrame, reviews: DataFrame) -> DataFrame:
    """How many streamed titles have a review that ties them to a book.

    Titles are compared without case. A NULL title counts as one streamed title and never
    matches. The share is a fraction from 0 to 1, NULL when nothing was streamed.
    """
    # One aggregate over both sides: a single shuffle of titles that are already distinct
    # within each task, and no join.
    titles = _titles(streams, streamed=1, reviewed=0).unionAll(
        _titles(reviews, streamed=0, reviewed=1)
    )
    flags = titles.groupBy("title").agg(
        F.max("streamed").alias("streamed"), F.max("reviewed").alias("reviewed")
    )
    total = F.count(F.lit(1))
    adapted = F.count_if((F.col("reviewed") == 1) & F.col("title").isNotNull())
    return flags.filter("streamed = 1").agg(
        total.alias("total_titles"),
        adapted.alias("adapted_titles"),
        F.try_divide(adapted.cast("double"), total).alias("adapted_share"),
    )


def _begun() -> Column:
    return moment_of("start_ts", "start_at")


def _ended() -> Column:
    return moment_of("end_ts", "end_at")


def _with_moments(streams: DataFrame) -> DataFrame:
    """Sessions with stored moments, also where they come from rows without them."""
    missing = {
        stored: stored_moment(text)
        for stored, text in (("start_ts", "start_at"), ("end_ts", "end_at"))
        if stored not in streams.columns
    }
    return streams.withColumns(missing)


def _about(streams: DataFrame, near: Column, inside: Callable[[Column, Column], Column]) -> DataFrame:
    """Sessions whose moments are `inside`. One whose time cannot be read fails the query.

    Where moments are stored, the first condition uses them only, so files and row groups are
    skipped by it; `near` must let pass what is inside. Rows without a moment pass it too, and
    their text is parsed in the second. Where moments would be calculated here, each text is parsed
    once instead: a filter on calculated columns would calculate them anew for each comparison.
    """
    if not comes_from_input(streams, "start_ts", "end_ts"):
        times = F.array(F.struct(parsed_moment("start_at").alias("begun"), parsed_moment("end_at").alias("ended")))
        return streams.filter(F.exists(times, lambda t: inside(t["begun"], t["ended"])))
    unread = F.col("start_ts").isNull() | F.col("end_ts").isNull()
    parsed = F.coalesce(F.greatest(_begun(), _ended()) > F.lit(-(2**62)), F.lit(True))
    return streams.filter(near | unread).filter(parsed).filter(inside(_begun(), _ended()))


def near_window(
    start: str | datetime, end: str | datetime, mode: str = "endpoint"
) -> Callable[[Facts], bool]:
    """Whether a part of stored sessions, by its bounds, can hold one that a window is about, or one
    whose time cannot be read. A part may hold sessions that start before the window."""
    first, last = second_from(start), second_until(end)

    def near(part: Facts) -> bool:
        if mode == "overlap":
            inside = _meets(part, "start", None, last) and _meets(part, "end", first, None)
        else:
            inside = _meets(part, "start", first, last) or _meets(part, "end", first, last)
        return bool(part["unread"]) or inside

    return near


def near_start(since: str | datetime) -> Callable[[Facts], bool]:
    """As `near_window`, for sessions that start at a moment or later."""
    first = second_from(since)
    return lambda part: bool(part["unread"]) or _meets(part, "start", first, None)


def _meets(part: Facts, end: str, first: int | None, last: int | None) -> bool:
    low, high = part[f"{end}_low"], part[f"{end}_high"]
    return low is not None and (last is None or low <= last) and (first is None or high >= first)


def _titles(df: DataFrame, streamed: int, reviewed: int) -> DataFrame:
    return df.select(
        F.lower("movie_title").alias("title"),
        F.lit(streamed).alias("streamed"),
        F.lit(reviewed).alias("reviewed"),
    )


def users_in_window(
    streams: DataFrame,
    title: str | None,
    start: str | datetime,
    end: str | datetime,
    mode: str = "endpoint",
) -> DataFrame:
    """Distinct users with a session of `title` (exact case; None: any) in a time window.

    `mode="endpoint"` counts sessions that start or end within the window, bounds
    included; one that spans the whole window is not counted. `mode="overlap"` counts
    every session that was in progress at some point of the window.
    """
    first, last = moment_from(start), moment_until(end)
    start_ts, end_ts = F.col("start_ts"), F.col("end_ts")
    if mode == "endpoint":
        near = start_ts.between(first, last) | end_ts.between(first, last)

        def inside(begun: Column, ended: Column) -> Column:
            return begun.between(first, last) | ended.between(first, last)
    elif mode == "overlap":
        near = (start_ts <= last) & (end_ts >= first)

        def inside(begun: Column, ended: Column) -> Column:
            return (begun <= last) & (ended >= first)
    else:
        raise ValueError(f"mode must be 'endpoint' or 'overlap', not {mode!r}")
    sessions = streams if title is None else streams.filter(F.col("movie_title") == title)
    return _about(sessions, near, inside).agg(F.count_distinct("user_email").alias("users_affected"))


def adaptations_by_author_origin(
    streams: DataFrame,
    reviews: DataFrame,
    books: DataFrame,
    authors: DataFrame,
    slug: str | None,
) -> DataFrame:
    """Streamed adaptations of books whose author has a nationality (None: any author).

    Counts the rows of streamed title x (movie, book) pair x book x author, so books and
    authors listed twice count twice. Every step is counted per key before it is joined:
    the joins meet each key once on the right, and no pair is ever emitted.
    """
    if slug is not None:
        authors = authors.filter(F.col("nationality_slug") == slug)
    author_rows = (
        _lower(authors, author="name")
        .filter(F.col("author").isNotNull())
        .groupBy("author")
        .agg(F.count(F.lit(1)).alias("author_rows"))
    )
    book_rows = (
        _lower(books, book="name", author="author")
        .filter(F.col("book").isNotNull() & F.col("author").isNotNull())
        .groupBy("book", "author")
        .agg(F.count(F.lit(1)).alias("book_rows"))
    )
    by_book = (
        join_dimension(book_rows, author_rows, "author")
        .groupBy("book")
        .agg(F.sum(F.col("book_rows") * F.col("author_rows")).alias("written"))
    )
    # Only pairs whose book counts, and of the streamed titles only those in such pairs, go on.
    pairs = _lower(reviews, movie="movie_title", book="book_title").filter(
        F.col("movie").isNotNull() & F.col("book").isNotNull()
    )
    per_movie = (
        join_dimension(pairs, by_book, "book")
        .distinct()
        .groupBy("movie")
        .agg(F.sum("written").alias("written"))
    )
    titles = _lower(streams, movie="movie_title").filter(F.col("movie").isNotNull())
    streamed = (
        join_dimension(titles, per_movie, "movie")
        .groupBy("movie")
        .agg(F.max("written").alias("written"))
    )
    return streamed.agg(
        F.coalesce(F.sum("written"), F.lit(0)).cast("bigint").alias("adaptations")
    )


def session_hours(streams: DataFrame) -> DataFrame:
    """Sessions with their complete hours, NULL without both times."""
    return _with_moments(streams).withColumn("hours", whole_units(_begun(), _ended(), 3600))


def mean_session_hours(streams: DataFrame) -> DataFrame:
    """Mean of the sessions' complete hours; each session is truncated before averaging."""
    return session_hours(streams).agg(F.avg(F.col("hours").cast("double")).alias("mean_hours"))


def mean_of_title_days(title_days: DataFrame) -> DataFrame:
    """As `mean_session_hours`, from the sums that are kept for titles and days."""
    mean = F.try_divide(F.sum("hours").cast("double"), F.sum("timed"))
    return title_days.agg(mean.alias("mean_hours"))


def _bucket(size: Column) -> Column:
    """A bucket that rises with the size: about one in a hundred wide, on either side of zero."""
    step = F.floor(F.log2(F.abs(size)) * 64) + 1_000_000
    return F.when(size > 0, step).when(size < 0, -step).otherwise(F.lit(0)).cast("bigint")


def _holding(counts: DataFrame, by: str, rank: Column) -> DataFrame:
    """Of counted values in order, the one that holds a rank (from 1), and the rank inside it."""
    upto = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = counts.withColumn("__upto", F.sum("n").over(upto)).withColumn(
        "__total", F.sum("n").over(everything)
    )
    return counted.withColumn("rank", rank - F.col("__upto") + F.col("n")).filter(
        (F.col("rank") >= 1) & (F.col("rank") <= F.col("n"))
    )


def median_size_gb(streams: DataFrame) -> DataFrame:
    """Median stream size in decimal gigabytes, rounded to two places; the lower of two middles.

    Exact, and counted instead of sorted: rows per bucket of sizes, and then rows per value in the
    bucket that holds the middle. A bucket of more than `VALUES` rows is cut into `FINE` slices
    before, and the slice that holds the middle again, until few rows or a single value are left.
    Every count is combined in the tasks, so one value on most rows is no burden. What is put in
    order are the buckets (a few hundred thousand at most for all sizes there are), the slices,
    and the last `VALUES` values. Each step is one job, of which the driver gets one row.
    """
    sizes = streams.select(F.col("size_mb").cast("double").alias("size")).filter("size IS NOT NULL")
    rows, low, high = F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high")
    buckets = sizes.groupBy(_bucket(F.col("size")).alias("bucket")).agg(rows, low, high)
    held = _holding(buckets, "bucket", F.floor((F.col("__total") + 1) / 2)).first()
    while held is not None and held["n"] > VALUES and held["low"] < held["high"]:
        share = (F.col("size") - held["low"]) / (held["high"] - held["low"])
        slice_ = F.least(F.floor(share * FINE), F.lit(FINE - 1)).alias("slice")
        slices = sizes.filter(F.col("size").between(held["low"], held["high"])).groupBy(slice_).agg(rows, low, high)
        held = _holding(slices, "slice", F.lit(held["rank"])).first()
    if held is None:
        values = sizes.groupBy("size").agg(rows).withColumn("rank", F.lit(1))
    else:
        inside = sizes.filter(F.col("size").between(held["low"], held["high"]))
        values = _holding(inside.groupBy("size").agg(rows), "size", F.lit(held["rank"]))
    return values.agg(F.round(F.max("size") / 1000, 2).alias("median_size_gb"))


def median_of_sketches(size_sketches: DataFrame) -> DataFrame:
    """About the median of `median_size_gb`, and the rows it is of, from one sketch a part.

    A value of some row, whose rank is off by the sketches' error. No session is read.
    """
    merged = size_sketches.agg(F.kll_merge_agg_double("sizes").alias("sizes"))
    rows = F.kll_sketch_get_n_double("sizes")
    middle = F.when(rows > 0, F.kll_sketch_get_quantile_double("sizes", F.lit(0.5)))
    return merged.select(F.round(middle / 1000, 2).alias("median_size_gb"), F.coalesce(rows, F.lit(0)).alias("sized_rows"))


def sessions_past_half(
    streams: DataFrame, movies: DataFrame, since: str | datetime
) -> DataFrame:
    """Sessions from `since` on that lasted at least half of their movie (exact title).

    Complete minutes are compared with the halved duration without its fraction. When a
    title is listed several times, its shortest duration decides.
    """
    halves = (
        movies.filter(F.col("title").isNotNull())
        .groupBy(F.col("title").alias("movie_title"))
        .agg(F.min(F.expr("duration_mins div 2")).alias("half_minutes"))
    )
    first = moment_from(since)
    named = streams.filter(F.col("movie_title").isNotNull())
    recent = _with_moments(_about(named, F.col("start_ts") >= first, lambda begun, _: begun >= first)).select(
        "movie_title", "user_email", whole_units(_begun(), _ended(), 60).alias("minutes")
    )
    # Coalesced, so that no separate null test parses the times a second time.
    long_enough = F.coalesce(F.col("minutes") >= F.col("half_minutes"), F.lit(False))
    return join_dimension(recent, halves, "movie_title").filter(long_enough)


def users_past_half(
    streams: DataFrame, movies: DataFrame, since: str | datetime, with_sessions: bool = False
) -> DataFrame:
    """Distinct users who watched at least half of any movie since a moment."""
    users = F.count_distinct("user_email").alias("users_past_half")
    sessions: list[Column] = [F.count(F.lit(1)).alias("sessions")] if with_sessions else []
    return sessions_past_half(streams, movies, since).agg(users, *sessions)
