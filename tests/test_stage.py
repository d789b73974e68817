"""Stage models on hand-written landing rows."""

import hashlib

from reelhouse import schemas
from reelhouse.plans.stage import STAGE_MODELS

RUN = "2024-02-23 00:00:00"
NULL = "_dbt_utils_surrogate_key_null_"


def stage(spark, name, rows):
    landing = spark.createDataFrame(rows, schemas.ENTITIES[name].schema)
    return [r.asDict() for r in STAGE_MODELS[name].build(landing, RUN).collect()]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_movies(spark):
    (row,) = stage(spark, "movies", [("Heat", 170, "English", 900)])
    assert row["movie_id"] == md5("Heat-English")
    assert list(row) == [
        "movie_id", "title", "duration_mins", "original_language", "size_mb", "reference_date",
    ]
    assert str(row["reference_date"]) == RUN


def test_streams_keep_the_raw_email(spark):
    (row,) = stage(spark, "streams", [("Heat", "a@b.c", 1.5, "s", "e")])
    assert row["stream_id"] == md5("Heat-a@b.c-s-e") and row["user_email"] == "a@b.c"


def test_users(spark):
    first, second = stage(spark, "users", [("A", "B", "ann@x.org"), ("A", None, None)])
    assert first["user_id"] == md5("A-B") and second["user_id"] == md5(f"A-{NULL}")
    assert (first["full_name"], first["email"]) == ("A B", "a*****@x.org")
    assert (second["full_name"], second["email"]) == (None, None)


def test_authors_take_the_first_nationality_with_a_slug(spark):
    rows = [
        (("Ann", "1900", None), [(1, "x", None), (2, "y", "why"), (3, "z", "zed")]),
        (("Bob", None, "1999"), []),
        (("Cyd", "1901", None), None),
        (None, [(4, "w", "dub")]),
    ]
    ann, bob, cyd, nobody = stage(spark, "authors", rows)
    assert ann["author_id"] == md5("Ann-1900") and bob["author_id"] == md5(f"Bob-{NULL}")
    assert [ann[f"nationality_{c}"] for c in ("id", "label", "slug")] == [2, "y", "why"]
    assert bob["nationality_slug"] is None and bob["died_at"] == "1999"
    assert cyd["nationality_id"] is None
    assert nobody["name"] is None and nobody["author_id"] == md5(f"{NULL}-{NULL}")


def test_books(spark):
    (row,) = stage(spark, "books", [("Dune", 412, "Frank", "Chilton")])
    assert row["book_id"] == md5("Dune-Frank") and row["pages"] == 412


def test_reviews_take_the_first_book_and_the_first_real_movie(spark):
    books = [(9, ("Dune", "412")), (8, ("Emma", "300"))]
    rows = [
        (("good",), (5, "top"), books, [(0, "end"), (1, None), (2, "Dune")], "u", "c"),
        (("bad",), (1, "low"), [], [(0, "end")], None, None),
        (("none",), None, None, None, None, None),
    ]
    good, bad, none = stage(spark, "reviews", rows)
    assert good["review_id"] == md5("Dune-Dune-good")
    assert (good["book_id"], good["book_title"], good["book_pages"]) == (9, "Dune", "412")
    assert (good["movie_id"], good["movie_title"], good["rate"]) == (2, "Dune", 5)
    assert bad["review_id"] == md5(f"{NULL}-{NULL}-bad")
    assert bad["book_id"] is None and bad["movie_title"] is None
    assert none["text"] == "none" and none["label"] is None
    assert "updated" not in good and "created" not in good
