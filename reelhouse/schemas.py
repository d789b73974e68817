"""Declared schemas of the six landing entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TEXT, _INT, _DOUBLE = StringType(), IntegerType(), DoubleType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


MOVIES = _struct(title=_TEXT, duration_mins=_INT, original_language=_TEXT, size_mb=_INT)
STREAMS = _struct(
    movie_title=_TEXT, user_email=_TEXT, size_mb=_DOUBLE, start_at=_TEXT, end_at=_TEXT
)
USERS = _struct(first_name=_TEXT, last_name=_TEXT, email=_TEXT)
AUTHORS = _struct(
    metadata=_struct(name=_TEXT, birth_date=_TEXT, died_at=_TEXT),
    nationalities=ArrayType(_struct(id=_INT, label=_TEXT, slug=_TEXT)),
)
BOOKS = _struct(name=_TEXT, pages=_INT, author=_TEXT, publisher=_TEXT)
REVIEWS = _struct(
    content=_struct(text=_TEXT),
    rating=_struct(rate=_INT, label=_TEXT),
    books=ArrayType(_struct(id=_INT, metadata=_struct(title=_TEXT, pages=_TEXT))),
    movies=ArrayType(_struct(id=_INT, title=_TEXT)),
    updated=_TEXT,
    created=_TEXT,
)


@dataclass(frozen=True)
class Entity:
    """A landing entity: where it comes from, its file type and its schema."""

    name: str
    origin: str
    source_format: str
    schema: StructType


ENTITIES = {
    entity.name: entity
    for entity in (
        Entity("movies", "internal", "csv", MOVIES),
        Entity("streams", "internal", "csv", STREAMS),
        Entity("users", "internal", "csv", USERS),
        Entity("authors", "vendor", "json", AUTHORS),
        Entity("books", "vendor", "json", BOOKS),
        Entity("reviews", "vendor", "json", REVIEWS),
    )
}

GROUPS = ("internal", "vendor", "all")


def entities_in(group: str) -> list[Entity]:
    if group not in GROUPS:
        raise ValueError(f"unknown source group {group!r}, expected one of {GROUPS}")
    return [e for e in ENTITIES.values() if group in ("all", e.origin)]
