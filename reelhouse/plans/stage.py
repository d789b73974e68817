"""Stage models: landing rows to flat, keyed rows.

Each takes the load time to stamp and the names of landing columns to carry along.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import (
    first_element,
    first_where,
    full_name,
    load_stamp,
    mask_email,
    surrogate_key,
)
from reelhouse.functions.times import stored_moment, wall_clock

RunTime = str | Column | None

# Fixed value: the title of the placeholder that ends a review's movie list.
MOVIE_LIST_END = "end"


def stage_movies(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    return landing.select(
        surrogate_key("title", "original_language").alias("movie_id"),
        "title",
        "duration_mins",
        "original_language",
        "size_mb",
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def stage_streams(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Sessions with their raw times and, where those can be read, the moments they stand for."""
    return landing.select(
        surrogate_key("movie_title", "user_email", "start_at", "end_at").alias("stream_id"),
        "movie_title",
        "user_email",
        "size_mb",
        "start_at",
        "end_at",
        stored_moment("start_at").alias("start_ts"),
        stored_moment("end_at").alias("end_ts"),
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def stage_users(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Names and masked e-mail. The masked value joins to nothing."""
    return landing.select(
        surrogate_key("first_name", "last_name").alias("user_id"),
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        mask_email("email").alias("email"),
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def stage_authors(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per author with the first nationality that has a slug."""
    flat = landing.select(
        F.col("metadata.name").alias("name"),
        F.col("metadata.birth_date").alias("birth_date"),
        F.col("metadata.died_at").alias("died_at"),
        first_where("nationalities", lambda n: n["slug"].isNotNull()).alias("nationality"),
        *carry,
    )
    return flat.select(
        surrogate_key("name", "birth_date").alias("author_id"),
        "name",
        "birth_date",
        "died_at",
        F.col("nationality.id").alias("nationality_id"),
        F.col("nationality.label").alias("nationality_label"),
        F.col("nationality.slug").alias("nationality_slug"),
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def stage_books(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    return landing.select(
        surrogate_key("name", "author").alias("book_id"),
        "name",
        "pages",
        "author",
        "publisher",
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def stage_reviews(
    landing: DataFrame, run_ts: RunTime = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per review with its first book and its first real movie."""
    flat = landing.select(
        F.col("content.text").alias("text"),
        F.col("rating.rate").alias("rate"),
        F.col("rating.label").alias("label"),
        first_element("books").alias("book"),
        first_where("movies", lambda m: m["title"] != MOVIE_LIST_END).alias("movie"),
        *carry,
    )
    return flat.select(
        surrogate_key("book.metadata.title", "movie.title", "text").alias("review_id"),
        "text",
        "rate",
        "label",
        F.col("book.id").alias("book_id"),
        F.col("book.metadata.title").alias("book_title"),
        F.col("book.metadata.pages").alias("book_pages"),
        F.col("movie.id").alias("movie_id"),
        F.col("movie.title").alias("movie_title"),
        load_stamp(run_ts).alias("reference_date"),
        *carry,
    )


def start_day() -> Column:
    """The day a session starts on, as text. The key of a session contains its start."""
    day = wall_clock("start_at", on_error="null").cast("date").cast("string")
    return F.coalesce(day, F.lit("unknown"))


def session_bounds() -> dict[str, Column]:
    """What a part of sessions is known by: the bounds of its moments, and how many rows have a
    time that cannot be read, which a question about times must find."""
    unread = [F.col(ts).isNull() & F.col(text).isNotNull() for ts, text in _MOMENTS]
    return {
        "start_low": F.min("start_ts"),
        "start_high": F.max("start_ts"),
        "end_low": F.min("end_ts"),
        "end_high": F.max("end_ts"),
        "unread": F.count_if(unread[0] | unread[1]),
    }


_MOMENTS = (("start_ts", "start_at"), ("end_ts", "end_at"))


@dataclass(frozen=True)
class StageModel:
    """How an entity is staged: projection, merge key, origin tag, file order, the part of the
    stored table that a row belongs to (by default a hash of the key), and what is kept of each
    part. Rows with one key must belong to one part."""

    name: str
    build: Callable[..., DataFrame]
    key: str
    tag: str
    sort_by: tuple[str, ...] = ()
    part: Callable[[], Column] | None = None
    facts: Callable[[], dict[str, Column]] = dict


STAGE_MODELS = {
    model.name: model
    for model in (
        StageModel("movies", stage_movies, "title", "internal"),
        StageModel(
            "streams", stage_streams, "stream_id", "internal", ("start_ts",), start_day, session_bounds
        ),
        StageModel("users", stage_users, "user_id", "internal"),
        StageModel("authors", stage_authors, "author_id", "vendor"),
        StageModel("books", stage_books, "book_id", "vendor"),
        StageModel("reviews", stage_reviews, "review_id", "vendor"),
    )
}
