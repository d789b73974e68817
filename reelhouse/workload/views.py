"""The six landing views, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.schemas import ENTITIES
from reelhouse.sources.files import conform

#: One session in `HOT_SHARE` is of this title, the others are spread over all.
HOT_PART, HOT_SHARE = 7, 4

Tables = Callable[[str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Reader of the driver's tables that opens each one once."""
    return lru_cache(None)(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _title() -> Column:
    return F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))


def _count_of(t: Tables, table: str, key: str) -> Column:
    """How many numbers a table's keys take up, from 0 on."""
    return t(table).agg(F.max(key) + 1).scalar()


def _with_part(df: DataFrame, number: Column, t: Tables) -> DataFrame:
    """Join rows to the part that a number refers to."""
    parts = t("part").select("p_partkey", "p_name", "p_size")
    return df.withColumn("p_partkey", number).join(parts, "p_partkey")


def _iso(ts: Column) -> Column:
    text = ts.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit(".000Z"))


def movies(t: Tables) -> DataFrame:
    return t("part").select(
        _title().alias("title"),
        (F.col("p_size") + 45).alias("duration_mins"),
        F.col("p_type").alias("original_language"),
        F.floor("p_retailprice").alias("size_mb"),
    )


def streams(t: Tables) -> DataFrame:
    def unless_multiple_of(n: int, value: Column) -> Column:
        return F.when(F.col("event_id") % n != 0, value)

    end = F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts"))
    spread = F.col("event_id") % _count_of(t, "part", "p_partkey")
    number = F.when(F.col("event_id") % HOT_SHARE == 0, F.lit(HOT_PART)).otherwise(spread)
    events = _with_part(t("events"), number, t)
    return events.select(
        unless_multiple_of(101, _title()).alias("movie_title"),
        unless_multiple_of(
            97, F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        ).alias("user_email"),
        (F.col("value") * 10).alias("size_mb"),
        _iso(F.col("ts")).alias("start_at"),
        _iso(end).alias("end_at"),
    )


def users(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    name = F.split("c_name", "#")
    return t("customer").select(
        F.get(name, F.lit(0)).alias("first_name"),
        F.get(name, F.lit(1)).alias("last_name"),
        F.when(key % 50 == 0, F.concat(F.lit("nomail"), key.cast("string")))
        .when(
            key % 49 != 0,
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com")),
        )
        .alias("email"),
    )


def authors(t: Tables) -> DataFrame:
    key, none = F.col("s_suppkey"), F.lit(None).cast("string")

    def nationality(id_: Column, label: Column, slug: Column) -> Column:
        return F.struct(id_.alias("id"), label.alias("label"), slug.alias("slug"))

    real = nationality(F.col("n_nationkey"), F.col("n_name"), F.lower("n_name"))
    unknown = nationality(F.lit(-1), F.lit("unknown"), none)
    suppliers = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return suppliers.select(
        F.struct(
            F.col("s_name").alias("name"), none.alias("birth_date"), none.alias("died_at")
        ).alias("metadata"),
        F.when(key % 7 == 0, F.filter(F.array(real), lambda _: F.lit(False)))
        .when(key % 3 == 0, F.array(unknown, real))
        .otherwise(F.array(real))
        .alias("nationalities"),
    )


def books(t: Tables) -> DataFrame:
    author = F.col("p_partkey") % _count_of(t, "supplier", "s_suppkey")
    number = F.lpad(author.cast("string"), 9, "0")
    return t("part").select(
        F.concat(F.lit("Book of "), _title()).alias("name"),
        F.col("p_size").alias("pages"),
        F.concat(F.lit("SUPPLIER#"), number).alias("author"),
        F.col("p_brand").alias("publisher"),
    )


def reviews(t: Tables) -> DataFrame:
    key, none = F.col("doc_id"), F.lit(None).cast("string")

    def movie(id_: Column, title: Column) -> Column:
        return F.struct(id_.cast("int").alias("id"), title.alias("title"))

    real = movie(
        F.col("p_partkey"),
        F.concat(F.upper("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")),
    )
    def book(number: Column, title: Column) -> Column:
        pages = F.col("p_size").cast("string")
        metadata = F.struct(title.alias("title"), pages.alias("pages"))
        return F.struct(number.alias("id"), metadata.alias("metadata"))

    named = book(F.col("p_partkey"), F.concat(F.lit("BOOK OF "), _title()))
    second = book(F.col("p_partkey") + 1, F.lit("a second book"))
    documents = _with_part(t("documents"), key % _count_of(t, "part", "p_partkey"), t)
    return documents.select(
        F.struct("text").alias("content"),
        F.struct((key % 5).alias("rate"), F.col("lang").alias("label")).alias("rating"),
        F.when(key % 5 == 0, F.filter(F.array(named), lambda _: F.lit(False)))
        .when(key % 4 == 0, F.array(named, second))
        .otherwise(F.array(named))
        .alias("books"),
        F.when(key % 7 == 0, F.filter(F.array(real), lambda _: F.lit(False)))
        .when(key % 3 == 0, F.array(movie(F.lit(0), F.lit("end")), real))
        .otherwise(F.array(real))
        .alias("movies"),
        none.alias("updated"),
        none.alias("created"),
    )


_BUILDERS = {
    "movies": movies,
    "streams": streams,
    "users": users,
    "authors": authors,
    "books": books,
    "reviews": reviews,
}


def landing_view(name: str, t: Tables) -> DataFrame:
    return conform(_BUILDERS[name](t), ENTITIES[name].schema)


def landing_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = tables(spark, sf_dir)
    return {name: landing_view(name, t) for name in _BUILDERS}
