"""The registered queries as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from reelhouse.workload.queries import HALF_SINCE, OUTAGE, SLUG, TITLE

KEY_NULL = "_dbt_utils_surrogate_key_null_"


def _key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(
        f"coalesce(CAST({p} AS VARCHAR), '{KEY_NULL}')" for p in parts
    ) + ")"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.000Z')"


def _wall_clock(column: str) -> str:
    return (
        f"CAST(substring({column}, 1, 10) || ' ' || substring({column}, 12, 8) AS TIMESTAMP)"
    )


def _seconds(column: str) -> str:
    text = f"substring({column}, 1, 10) || ' ' || substring({column}, 12, 8)"
    return f"CAST(floor(epoch(TRY_CAST({text} AS TIMESTAMP))) AS BIGINT)"


def _mask(email: str) -> str:
    return (
        f"CASE WHEN {email} IS NULL THEN NULL ELSE substring({email}, 1, 1) || '*****' || "
        f"CASE WHEN instr({email}, '@') = 0 THEN '' "
        f"ELSE substring({email}, instr({email}, '@')) END END"
    )


TITLE_OF = "p_name || ' #' || p_partkey"


def landing(name: str, where: str = "TRUE") -> str:
    """The landing view; `where` limits the table that it takes its rows from."""
    book, second = (
        f"{{'id': CAST({number} AS INTEGER), "
        f"'metadata': {{'title': {title}, 'pages': CAST(p_size AS VARCHAR)}}}}"
        for number, title in (
            ("p_partkey", f"'BOOK OF ' || {TITLE_OF}"),
            ("p_partkey + 1", "'a second book'"),
        )
    )
    return {
        "movies": f"""
SELECT {TITLE_OF} AS title, CAST(p_size + 45 AS INTEGER) AS duration_mins,
       p_type AS original_language, CAST(floor(p_retailprice) AS INTEGER) AS size_mb
FROM part WHERE {where}""",
        "streams": f"""
SELECT CASE WHEN event_id % 101 <> 0 THEN {TITLE_OF} END AS movie_title,
       CASE WHEN event_id % 97 <> 0 THEN 'user' || user_id || '@example.com' END AS user_email,
       value * 10 AS size_mb, {_iso("ts")} AS start_at,
       {_iso("ts + to_seconds(CAST(floor(value * 60) AS BIGINT))")} AS end_at
FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN 7
                     ELSE event_id % (SELECT max(p_partkey) + 1 FROM part) END AS part_no
      FROM events WHERE {where}) JOIN part ON p_partkey = part_no""",
        "users": f"""
SELECT split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       CASE WHEN c_custkey % 50 = 0 THEN 'nomail' || c_custkey
            WHEN c_custkey % 49 = 0 THEN NULL
            ELSE lower(c_mktsegment) || c_custkey || '@example.com' END AS email
FROM customer WHERE {where}""",
        "authors": f"""
SELECT {{'name': s_name, 'birth_date': CAST(NULL AS VARCHAR),
         'died_at': CAST(NULL AS VARCHAR)}} AS metadata,
       CASE WHEN s_suppkey % 7 = 0 THEN []
            WHEN s_suppkey % 3 = 0 THEN
                 [{{'id': -1, 'label': 'unknown', 'slug': CAST(NULL AS VARCHAR)}},
                  {{'id': n_nationkey, 'label': n_name, 'slug': lower(n_name)}}]
            ELSE [{{'id': n_nationkey, 'label': n_name, 'slug': lower(n_name)}}]
       END AS nationalities
FROM (SELECT * FROM supplier WHERE {where}) JOIN nation ON s_nationkey = n_nationkey""",
        "books": f"""
SELECT 'Book of ' || {TITLE_OF} AS name, p_size AS pages,
       'SUPPLIER#' || lpad(CAST(p_partkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS VARCHAR),
                           9, '0') AS author,
       p_brand AS publisher
FROM part WHERE {where}""",
        "reviews": f"""
SELECT {{'text': text}} AS content,
       {{'rate': CAST(doc_id % 5 AS INTEGER), 'label': lang}} AS rating,
       CASE WHEN doc_id % 5 = 0 THEN []
            WHEN doc_id % 4 = 0 THEN [{book}, {second}] ELSE [{book}] END AS books,
       CASE WHEN doc_id % 7 = 0 THEN []
            WHEN doc_id % 3 = 0 THEN
                 [{{'id': 0, 'title': 'end'}},
                  {{'id': CAST(p_partkey AS INTEGER),
                    'title': upper(p_name) || ' #' || p_partkey}}]
            ELSE [{{'id': CAST(p_partkey AS INTEGER),
                    'title': upper(p_name) || ' #' || p_partkey}}]
       END AS movies,
       CAST(NULL AS VARCHAR) AS updated, CAST(NULL AS VARCHAR) AS created
FROM (SELECT *, doc_id % (SELECT max(p_partkey) + 1 FROM part) AS part_no
      FROM documents WHERE {where}) JOIN part ON p_partkey = part_no""",
    }[name]


def stage(name: str, where: str = "TRUE") -> str:
    """The stage model without its load time."""
    source = f"({landing(name, where)})"
    return {
        "movies": f"""
SELECT {_key("title", "original_language")} AS movie_id, title, duration_mins,
       original_language, size_mb FROM {source}""",
        "streams": f"""
SELECT {_key("movie_title", "user_email", "start_at", "end_at")} AS stream_id, movie_title,
       user_email, size_mb, start_at, end_at, {_seconds("start_at")} AS start_ts,
       {_seconds("end_at")} AS end_ts FROM {source}""",
        "users": f"""
SELECT {_key("first_name", "last_name")} AS user_id, first_name, last_name,
       first_name || ' ' || last_name AS full_name, {_mask("email")} AS email FROM {source}""",
        "authors": f"""
SELECT {_key("name", "birth_date")} AS author_id, name, birth_date, died_at,
       nationality.id AS nationality_id, nationality.label AS nationality_label,
       nationality.slug AS nationality_slug
FROM (SELECT metadata.name AS name, metadata.birth_date AS birth_date,
             metadata.died_at AS died_at,
             list_extract(list_filter(nationalities, lambda n: n.slug IS NOT NULL), 1)
                 AS nationality
      FROM {source})""",
        "books": f"""
SELECT {_key("name", "author")} AS book_id, name, pages, author, publisher FROM {source}""",
        "reviews": f"""
SELECT {_key("book.metadata.title", "movie.title", "text")} AS review_id, text, rate, label,
       book.id AS book_id, book.metadata.title AS book_title, book.metadata.pages AS book_pages,
       movie.id AS movie_id, movie.title AS movie_title
FROM (SELECT content.text AS text, rating.rate AS rate, rating.label AS label,
             list_extract(books, 1) AS book,
             list_extract(list_filter(movies, lambda m: m.title <> 'end'), 1) AS movie
      FROM {source})""",
    }[name]


COLUMNS = {
    "movies": "movie_id title duration_mins original_language size_mb",
    "streams": "stream_id movie_title user_email size_mb start_at end_at start_ts end_ts",
    "users": "user_id first_name last_name full_name email",
    "authors": "author_id name birth_date died_at nationality_id nationality_label "
    "nationality_slug",
    "books": "book_id name pages author publisher",
    "reviews": "review_id text rate label book_id book_title book_pages movie_id movie_title",
}
KEYS = {
    "movies": "title",
    "streams": "stream_id",
    "users": "user_id",
    "authors": "author_id",
    "books": "book_id",
    "reviews": "review_id",
}


def last(name: str, source: str) -> str:
    """Of the stage rows with one key, the greatest by its columns in order."""
    order = ", ".join(f"{column} DESC NULLS LAST" for column in COLUMNS[name].split())
    return (
        f"SELECT * FROM ({source}) "
        f"QUALIFY row_number() OVER (PARTITION BY {KEYS[name]} ORDER BY {order}) = 1"
    )


def _with(*names: str, reloaded: bool = False) -> str:
    rows = {name: _upsert(name, unique=True) if reloaded else stage(name) for name in names}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in rows.items()) + "\n"


FLAT = {
    "authors": """
SELECT metadata.name AS name, metadata.birth_date AS birth_date, metadata.died_at AS died_at,
       array_to_string(list_transform(nationalities,
           lambda n: concat_ws('|', CAST(n.id AS VARCHAR), n.label, n.slug)), ';')
           AS nationalities
FROM ({source})""",
    "reviews": """
SELECT content.text AS text, rating.rate AS rate, rating.label AS label,
       array_to_string(list_transform(books, lambda b: concat_ws('|',
           CAST(b.id AS VARCHAR), b.metadata.title, b.metadata.pages)), ';') AS books,
       array_to_string(list_transform(movies, lambda m: concat_ws('|',
           CAST(m.id AS VARCHAR), m.title)), ';') AS movies,
       updated, created
FROM ({source})""",
}


def _scan(name: str) -> str:
    return FLAT.get(name, "SELECT * FROM ({source})").format(source=landing(name))


HALVES = {
    "movies": ("p_size < 35", "p_size >= 25", "size_mb", "size_mb + 1"),
    "streams": (
        "ts < TIMESTAMP '2024-01-20 00:00:00'",
        "ts >= TIMESTAMP '2024-01-10 00:00:00'",
        "size_mb",
        "size_mb + 1",
    ),
    "users": ("c_acctbal < 6000", "c_acctbal >= 1000", "email", "upper(email)"),
    "authors": (
        "s_acctbal < 6000",
        "s_acctbal >= 1000",
        "nationality_label",
        "lower(nationality_label)",
    ),
    "books": ("p_size < 35", "p_size >= 25", "pages", "pages + 1"),
    "reviews": ("n_chars < 4000", "n_chars >= 1000", "rate", "rate + 1"),
}


def _upsert(name: str, unique: bool = False) -> str:
    """Both halves merged; with `unique`, the first one is reduced to one row per key as well."""
    earlier, later, column, change = HALVES[name]
    key = KEYS[name]
    changed = f"SELECT * REPLACE ({change} AS {column}) FROM ({stage(name, later)})"
    before = stage(name, earlier)
    return f"""
WITH target AS ({last(name, before) if unique else before}),
source AS ({last(name, changed)})
SELECT * FROM target
WHERE NOT EXISTS (SELECT 1 FROM source WHERE source.{key} = target.{key})
UNION ALL SELECT source.* FROM target JOIN source ON source.{key} = target.{key}
UNION ALL SELECT * FROM source
WHERE NOT EXISTS (SELECT 1 FROM target WHERE source.{key} = target.{key})"""


def _whole(unit: str) -> str:
    return f"date_sub('{unit}', {_wall_clock('start_at')}, {_wall_clock('end_at')})"


def _in_window(mode: str, title: str | None = None) -> str:
    first, last = (f"TIMESTAMP '{moment}'" for moment in OUTAGE)
    start, end = _wall_clock("start_at"), _wall_clock("end_at")
    inside = {
        "endpoint": f"({start} BETWEEN {first} AND {last} OR {end} BETWEEN {first} AND {last})",
        "overlap": f"({start} <= {last} AND {end} >= {first})",
    }[mode]
    named = "" if title is None else f" AND movie_title = '{title}'"
    return (
        "SELECT count(DISTINCT user_email) AS users_affected FROM streams "
        f"WHERE {inside}{named}"
    )


ADAPTATION_SHARE = """
SELECT count(*) AS total_titles, count(r.title) AS adapted_titles,
       CAST(count(r.title) AS DOUBLE) / count(*) AS adapted_share
FROM (SELECT DISTINCT lower(movie_title) AS title FROM streams) s
LEFT JOIN (SELECT DISTINCT lower(movie_title) AS title FROM reviews) r ON s.title = r.title"""

MEAN_HOURS = f"SELECT avg(CAST({_whole('hour')} AS DOUBLE)) AS mean_hours FROM streams"

MEDIAN_GB = "SELECT round(quantile_disc(size_mb, 0.5) / 1000, 2) AS median_size_gb FROM streams"

PAST_HALF = f"""
SELECT count(DISTINCT user_email) AS users_past_half, count(*) AS sessions
FROM streams JOIN movies ON movie_title = title
WHERE {_wall_clock("start_at")} >= TIMESTAMP '{HALF_SINCE}'
  AND {_whole("minute")} >= duration_mins // 2"""


def _origin(slug: str | None) -> str:
    wanted = "" if slug is None else f" AND nationality_slug = '{slug}'"
    return f"""
SELECT count(1) AS adaptations
FROM (SELECT DISTINCT lower(movie_title) AS movie FROM streams) s
JOIN (SELECT DISTINCT lower(movie_title) AS movie, lower(book_title) AS book FROM reviews) r
  ON s.movie = r.movie
JOIN books ON r.book = lower(books.name)
JOIN authors ON lower(books.author) = lower(authors.name){wanted}"""


def _answer(metric: str, column: str, sql: str) -> str:
    return f"SELECT '{metric}' AS metric, CAST({column} AS DOUBLE) AS answer FROM ({sql})"


ANSWERS = "\nUNION ALL ".join(
    (
        _answer("adaptation_share", "adapted_share", ADAPTATION_SHARE),
        _answer("users_in_window", "users_affected", _in_window("endpoint")),
        _answer("adaptations_by_author_origin", "adaptations", _origin(SLUG)),
        _answer("mean_session_hours", "mean_hours", MEAN_HOURS),
        _answer("median_size_gb", "median_size_gb", MEDIAN_GB),
        _answer("users_past_half", "users_past_half", PAST_HALF),
    )
)

SUMMARIZED = ("streams", "movies", "reviews", "books", "authors")

GATE = f"""
WITH movies AS ({stage("movies")}),
last AS (SELECT max(ts) AS stamp FROM events),
none AS (SELECT max(ts) AS stamp FROM events WHERE ts < TIMESTAMP '1970-01-01 00:00:00')
SELECT 'later' AS gate, count(*) AS passed FROM movies
WHERE coalesce(TIMESTAMP '2030-01-01 00:00:00' > (SELECT stamp FROM last), TRUE)
UNION ALL SELECT 'earlier', count(*) FROM movies
WHERE coalesce(TIMESTAMP '2024-01-05 00:00:00' > (SELECT stamp FROM last), TRUE)
UNION ALL SELECT 'empty', count(*) FROM movies
WHERE coalesce(TIMESTAMP '2030-01-01 00:00:00' > (SELECT stamp FROM none), TRUE)
UNION ALL SELECT 'strict', count(*) FROM movies
WHERE TIMESTAMP '2030-01-01 00:00:00' > (SELECT stamp FROM none)"""

MASK_SSN = """
SELECT c_custkey, 'xxx-xx-' || substring(number, 8, 4) AS masked
FROM (SELECT c_custkey, substring(digits, 1, 3) || '-' || substring(digits, 4, 2) || '-'
                        || substring(digits, 6, 4) AS number
      FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS digits FROM customer))"""

CSV_REJECTS = f"""
WITH rows AS (SELECT *, CAST(regexp_extract(title, '#([0-9]+)$', 1) AS INTEGER) % 10 AS bad FROM ({landing("movies")})),
told AS (
  SELECT CASE bad WHEN 0 THEN title || ',long,' || original_language || ',' || size_mb
                  WHEN 1 THEN title || ',' || duration_mins ELSE title END AS record,
         CASE bad WHEN 0 THEN 'duration_mins is no int' WHEN 1 THEN 'number of fields'
                  ELSE 'landed' END AS reason
  FROM rows)
SELECT * FROM told
UNION ALL SELECT 'landed', CAST(count(*) FILTER (reason = 'landed') AS VARCHAR) FROM told
UNION ALL SELECT 'rejected', CAST(count(*) FILTER (reason <> 'landed') AS VARCHAR) FROM told"""

JSON_REJECTS = f"""
WITH rows AS (SELECT *, CAST(regexp_extract(name, '#([0-9]+)$', 1) AS INTEGER) % 10 AS bad FROM ({landing("books")})),
told AS (
  SELECT CASE bad WHEN 0 THEN '{{"name":"' || name || '","pages":"many"}}' WHEN 1 THEN '{{' || name ELSE name END AS record,
         CASE WHEN bad < 2 THEN 'no record of the declared schema' ELSE 'landed' END AS reason
  FROM rows)
SELECT * FROM told
UNION ALL SELECT 'landed', CAST(count(*) FILTER (reason = 'landed') AS VARCHAR) FROM told
UNION ALL SELECT 'rejected', CAST(count(*) FILTER (reason <> 'landed') AS VARCHAR) FROM told"""

ENTITIES = ("movies", "streams", "users", "authors", "books", "reviews")

EVENT_ORDER = f"""
WITH arrived AS (
  SELECT *, '2024-01-01' AS updated FROM ({stage("reviews", HALVES["reviews"][0])})
  UNION ALL SELECT * REPLACE (rate + 1 AS rate), '2024-01-02'
  FROM ({stage("reviews", HALVES["reviews"][1])}))
SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY updated DESC,
  {", ".join(f"{column} DESC NULLS LAST" for column in COLUMNS["reviews"].split())}) = 1"""

ORACLES: dict[str, str] = {
    "users_past_half": _with("streams", "movies") + PAST_HALF,
    "adaptation_share": _with("streams", "reviews") + ADAPTATION_SHARE,
    "users_in_window": _with("streams") + _in_window("endpoint"),
    "users_in_window_title": _with("streams") + _in_window("endpoint", TITLE),
    "users_in_window_overlap": _with("streams") + _in_window("overlap"),
    "adaptations_by_origin": _with("streams", "reviews", "books", "authors") + _origin(SLUG),
    "adaptations_any_origin": _with("streams", "reviews", "books", "authors") + _origin(None),
    "mean_session_hours": _with("streams") + MEAN_HOURS,
    "median_size_gb": _with("streams") + MEDIAN_GB,
    "surrogate_key": (
        f"SELECT start_at, {_key('movie_title', 'user_email')} AS session_key "
        f"FROM ({landing('streams')})"
    ),
    "mask_email": f"SELECT last_name, {_mask('email')} AS masked FROM ({landing('users')})",
    "mask_ssn": MASK_SSN,
    "full_name": (
        "SELECT last_name, first_name || ' ' || email AS full_name "
        f"FROM ({landing('users')})"
    ),
    "session_times": (
        f"SELECT {_wall_clock('start_at')} AS started, {_wall_clock('end_at')} AS ended, "
        f"{_whole('hour')} AS hours, {_whole('minute')} AS minutes FROM ({landing('streams')})"
    ),
    "first_nationality": (
        "SELECT name, first.id AS id, first.label AS label, first.slug AS slug FROM ("
        "SELECT metadata.name AS name, list_extract(list_filter(nationalities, "
        f"lambda n: n.slug IS NOT NULL), 1) AS first FROM ({landing('authors')}))"
    ),
    "first_movie": (
        "SELECT text, first.id AS id, first.title AS title FROM ("
        "SELECT content.text AS text, list_extract(list_filter(movies, "
        f"lambda m: m.title <> 'end'), 1) AS first FROM ({landing('reviews')}))"
    ),
    "first_book": (
        "SELECT text, first.id AS id, first.metadata.title AS title FROM ("
        "SELECT content.text AS text, list_extract(books, 1) AS first "
        f"FROM ({landing('reviews')}))"
    ),
    **{f"stage_{name}": stage(name) for name in ENTITIES},
    **{f"upsert_{name}": _upsert(name) for name in ENTITIES},
    **{f"scan_{name}": _scan(name) for name in ENTITIES},
    "land_append_rows": (
        f"SELECT * FROM ({landing('users')}) UNION ALL SELECT * FROM ({landing('users')})"
    ),
    "land_json_records": _scan("reviews"),
    "land_once": (
        f"SELECT * FROM ({landing('users')}) UNION ALL SELECT * FROM ({landing('users')})"
    ),
    "csv_rejects": CSV_REJECTS,
    "json_rejects": JSON_REJECTS,
    "table_refresh": f"SELECT * REPLACE (pages + 1 AS pages) FROM ({stage('books', 'p_size >= 25')})",
    "incremental_gate": GATE,
    "pipeline_summary": _with(*SUMMARIZED) + ANSWERS,
    "pipeline_reload": _with(*SUMMARIZED, reloaded=True) + ANSWERS,
    "pipeline_increment": (
        _with(*SUMMARIZED, reloaded=True) + ANSWERS
        + "".join(f"\nUNION ALL SELECT 'version of {name}', 2.0::DOUBLE" for name in ENTITIES)
    ),
    "stream_upserts": _upsert("books", unique=True),
    "stream_event_order": EVENT_ORDER,
    "merge_by_parts": _upsert("movies"),
    "users_in_window_by_parts": _with("streams") + _in_window("endpoint"),
    "users_past_half_by_parts": _with("streams", "movies") + PAST_HALF,
    "mean_hours_by_measure": f"WITH streams AS ({_upsert('streams')}) {MEAN_HOURS}",
    "adaptation_share_by_measure": (
        f"WITH streams AS ({_upsert('streams')}), reviews AS ({stage('reviews')}) {ADAPTATION_SHARE}"
    ),
    "median_by_sketches": (
        f"SELECT count(size_mb) AS sized_rows, TRUE AS in_the_middle FROM ({_upsert('streams')})"
    ),
    **{f"csv_{name}": _scan(name) for name in ("movies", "streams", "users")},
    **{f"json_{name}": _scan(name) for name in ("authors", "books", "reviews")},
    "ingest_internal": f"""
SELECT 'movies' AS entity, title AS value FROM ({landing("movies")})
UNION ALL SELECT 'streams', start_at FROM ({landing("streams")})
UNION ALL SELECT 'users', last_name FROM ({landing("users")})""",
    "external_table": landing("users"),
    "stage_refresh": f"SELECT * REPLACE (pages + 1 AS pages) FROM ({stage('books', 'p_size >= 25')})",
    "load_stamp": (
        "SELECT title, TIMESTAMP '2024-02-23 00:00:00' AS loaded_at "
        f"FROM ({landing('movies')})"
    ),
    "ambiguous_keys": f"""
WITH target AS ({stage("books", "p_size < 35")}),
source AS (SELECT book_id FROM ({stage("books", "p_size >= 25")})
           UNION ALL SELECT book_id FROM ({stage("books", "p_size >= 30")}))
SELECT book_id, CAST(s.n AS BIGINT) AS source_rows, CAST(t.n AS BIGINT) AS target_rows
FROM (SELECT book_id, count(*) AS n FROM source GROUP BY book_id) s
JOIN (SELECT book_id, count(*) AS n FROM target GROUP BY book_id) t USING (book_id)
WHERE s.n > 1""",
    "gen_id": "SELECT c_custkey, TRUE AS in_range FROM customer",
}
