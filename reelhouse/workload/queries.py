"""One registered query per operator, over the views of `workload.views`."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions import columns as C
from reelhouse.functions.times import ntz, wall_clock, whole_hours, whole_minutes
from reelhouse.operators.load import ambiguous_keys, by_repeats, incremental_gate, latest_per_key, upsert
from reelhouse.plans import trusted as T
from reelhouse.plans.lineage import run_in_order
from reelhouse.plans.measures import MEASURES, SKETCH, measure_table, refresh
from reelhouse.plans.pipeline import (
    FILE_COLUMNS,
    Questions,
    load_stage,
    merge_rows,
    run_pipeline,
    snapshot_of,
    stage_table,
    summary,
)
from reelhouse.plans.stage import STAGE_MODELS
from reelhouse.schemas import ENTITIES
from reelhouse.session import scratch_dir
from reelhouse.sources.catalog import create_landing_table, create_namespace
from reelhouse.sources.files import conform
from reelhouse.sources.landing import ingest, land, read_source, register_sources, scan
from reelhouse.sources.rejects import ingest_checked, read_rejects
from reelhouse.sources.snapshots import SnapshotTable, State
from reelhouse.streaming.incremental import stream_stage
from reelhouse.workload import views

Query = Callable[[SparkSession, str], DataFrame]

OUTAGE = ("2024-01-15 07:00:00", "2024-01-15 12:00:00")
TITLE = "red bolt #7"
HALF_SINCE = "2024-01-23 23:59:59"
SLUG = "nation_20"
RUN_TS = "2024-02-23 00:00:00"


def _view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.landing_view(name, views.tables(spark, sf_dir))


def _staged(name: str, landing: DataFrame) -> DataFrame:
    return STAGE_MODELS[name].build(landing, RUN_TS)


def _stage(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(name, _view(name, spark, sf_dir))


def _stages(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    t = views.tables(spark, sf_dir)
    return [_staged(name, views.landing_view(name, t)) for name in names]


def flat(name: str, landing: DataFrame) -> DataFrame:
    """Landing rows without nesting, so that two engines print them alike."""
    if name == "authors":
        nationality = F.transform(
            "nationalities",
            lambda n: F.concat_ws("|", n["id"].cast("string"), n["label"], n["slug"]),
        )
        return landing.select("metadata.*", F.array_join(nationality, ";").alias("nationalities"))
    if name == "reviews":
        book = F.transform(
            "books",
            lambda b: F.concat_ws(
                "|", b["id"].cast("string"), b["metadata"]["title"], b["metadata"]["pages"]
            ),
        )
        movie = F.transform(
            "movies", lambda m: F.concat_ws("|", m["id"].cast("string"), m["title"])
        )
        return landing.select(
            "content.text",
            "rating.rate",
            "rating.label",
            F.array_join(book, ";").alias("books"),
            F.array_join(movie, ";").alias("movies"),
            "updated",
            "created",
        )
    return landing


def _scan(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark)
        land(_view(name, spark, sf_dir), root, name)
        return flat(name, scan(spark, root, name))

    return query


def _land_append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark)
    for _ in range(2):
        land(_view("users", spark, sf_dir), root, "users")
    return scan(spark, root, "users")


def _land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark)
    land(_view("reviews", spark, sf_dir), root, "reviews", "json")
    return flat("reviews", scan(spark, root, "reviews", "json"))


def _surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view("streams", spark, sf_dir).select(
        "start_at", C.surrogate_key("movie_title", "user_email").alias("session_key")
    )


def _mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view("users", spark, sf_dir).select(
        "last_name", C.mask_email("email").alias("masked")
    )


def _mask_ssn(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    number = F.concat_ws(
        "-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4)
    )
    customers = views.tables(spark, sf_dir)("customer")
    return customers.select("c_custkey", C.mask_ssn(number).alias("masked"))


def _gen_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That the random id of every customer is in its range."""
    customers = views.tables(spark, sf_dir)("customer")
    drawn = customers.select("c_custkey", C.gen_id().alias("random_id"))
    return drawn.select("c_custkey", F.col("random_id").between(1, 10_000).alias("in_range"))


def _full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view("users", spark, sf_dir).select(
        "last_name", C.full_name("first_name", "email").alias("full_name")
    )


def _session_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = wall_clock("start_at"), wall_clock("end_at")
    return _view("streams", spark, sf_dir).select(
        start.alias("started"),
        end.alias("ended"),
        whole_hours(start, end).alias("hours"),
        whole_minutes(start, end).alias("minutes"),
    )


def _first_nationality(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = C.first_where("nationalities", lambda n: n["slug"].isNotNull())
    return (
        _view("authors", spark, sf_dir)
        .select("metadata.name", first.alias("first"))
        .select("name", "first.id", "first.label", "first.slug")
    )


def _first_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = C.first_where("movies", lambda m: m["title"] != "end")
    return (
        _view("reviews", spark, sf_dir)
        .select("content.text", first.alias("first"))
        .select("text", "first.id", "first.title")
    )


def _first_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _view("reviews", spark, sf_dir)
        .select("content.text", C.first_element("books").alias("first"))
        .select("text", "first.id", "first.metadata.title")
    )


def _stage_query(name: str) -> Query:
    return lambda spark, sf_dir: _stage(name, spark, sf_dir).drop("reference_date")


# Upserts: the table holds earlier rows, the load brings later ones with a changed value,
# and the two overlap. Each entry gives the split by the driver's table, and the change.
_HALVES = {
    "movies": ("part", "p_size < 35", "p_size >= 25", ("size_mb", "size_mb + 1")),
    "streams": (
        "events",
        "ts < timestamp_ntz'2024-01-20 00:00:00'",
        "ts >= timestamp_ntz'2024-01-10 00:00:00'",
        ("size_mb", "size_mb + 1"),
    ),
    "users": ("customer", "c_acctbal < 6000", "c_acctbal >= 1000", ("email", "upper(email)")),
    "authors": (
        "supplier",
        "s_acctbal < 6000",
        "s_acctbal >= 1000",
        ("nationality_label", "lower(nationality_label)"),
    ),
    "books": ("part", "p_size < 35", "p_size >= 25", ("pages", "pages + 1")),
    "reviews": ("documents", "n_chars < 4000", "n_chars >= 1000", ("rate", "rate + 1")),
}


def _limited(t: views.Tables, base: str, condition: str) -> views.Tables:
    """The tables, with one of them limited by a condition."""
    return lambda table: t(table).filter(condition) if table == base else t(table)


def halves(name: str, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base, earlier, later, (column, change) = _HALVES[name]
    t = views.tables(spark, sf_dir)

    def part(condition: str) -> DataFrame:
        return _staged(name, views.landing_view(name, _limited(t, base, condition)))

    return part(earlier), part(later).withColumn(column, F.expr(change))


def _upsert(name: str) -> Query:
    """Merge into a stored table; of several arrivals with one key, the greatest row wins."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, root = STAGE_MODELS[name].key, scratch_dir(spark)
        earlier, later = halves(name, spark, sf_dir)
        table, arrived = SnapshotTable(spark, f"{root}/table"), SnapshotTable(spark, f"{root}/new")
        table.write(earlier)
        arrived.write(latest_per_key(later, key, []))
        return upsert(table.read(), arrived.read(), key, stored=True).drop("reference_date")

    return query


def _incremental_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _stage("movies", spark, sf_dir)
    events = views.tables(spark, sf_dir)("events").select(F.col("ts").alias("reference_date"))
    nothing = events.filter(F.col("reference_date") < ntz("1970-01-01 00:00:00"))
    cases = [
        ("later", incremental_gate(source, events, ntz("2030-01-01 00:00:00"))),
        ("earlier", incremental_gate(source, events, ntz("2024-01-05 00:00:00"))),
        ("empty", incremental_gate(source, nothing, ntz("2030-01-01 00:00:00"))),
        ("strict", incremental_gate(source, nothing, ntz("2030-01-01 00:00:00"), strict=True)),
    ]
    result = None
    for case, passed in cases:
        row = passed.agg(F.count(F.lit(1)).alias("passed")).select(
            F.lit(case).alias("gate"), "passed"
        )
        result = row if result is None else result.unionByName(row)
    return result


def _table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = SnapshotTable(spark, f"{scratch_dir(spark)}/books")
    earlier, later = halves("books", spark, sf_dir)
    table.write(earlier)
    table.write(later)
    return table.read().drop("reference_date")


def _adaptation_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.adaptation_share(*_stages(spark, sf_dir, "streams", "reviews"))


def _window(title: str | None, mode: str) -> Query:
    return lambda spark, sf_dir: T.users_in_window(
        _stage("streams", spark, sf_dir), title, *OUTAGE, mode=mode
    )


def _origin(slug: str | None) -> Query:
    return lambda spark, sf_dir: T.adaptations_by_author_origin(
        *_stages(spark, sf_dir, "streams", "reviews", "books", "authors"), slug
    )


def _mean_session_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.mean_session_hours(_stage("streams", spark, sf_dir))


def _median_size_gb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.median_size_gb(_stage("streams", spark, sf_dir))


def users_past_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams, movies = _stages(spark, sf_dir, "streams", "movies")
    return T.users_past_half(streams, movies, HALF_SINCE, with_sessions=True)


def _pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = Questions(None, *OUTAGE, SLUG, HALF_SINCE)
    written = run_pipeline(
        views.landing_views(spark, sf_dir), scratch_dir(spark), questions=questions, run_ts=RUN_TS
    )
    return summary(written)


def _arrivals(name: str, t: views.Tables) -> tuple[DataFrame, DataFrame]:
    """Landing rows of the two halves; the second has the changed value of `_HALVES`."""
    base, earlier, later, (column, change) = _HALVES[name]
    first, second = (views.landing_view(name, _limited(t, base, c)) for c in (earlier, later))
    if name == "reviews":
        second = second.withColumn("rating", F.col("rating").withField("rate", F.expr("rating.rate + 1")))
    elif name == "authors":
        lowered = F.transform("nationalities", lambda n: n.withField("label", F.lower(n["label"])))
        second = second.withColumn("nationalities", lowered)
    else:
        second = second.withColumn(column, F.expr(change))
    return first, conform(second, ENTITIES[name].schema)


def _pipeline_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, incremental run replaces changed rows and adds new ones before it answers."""
    questions = Questions(None, *OUTAGE, SLUG, HALF_SINCE)
    warehouse, t = scratch_dir(spark), views.tables(spark, sf_dir)
    # All rows of a run count as landed together, so that their own values decide which is last.
    together = {column: F.lit("together") for column in FILE_COLUMNS}
    runs = zip(*(_arrivals(name, t) for name in ENTITIES), strict=True)
    first, second = (
        {name: df.withColumns(together) for name, df in zip(ENTITIES, run, strict=True)} for run in runs
    )
    run_pipeline(first, warehouse, select="stage", run_ts=RUN_TS, dedupe="latest")
    written = run_pipeline(
        second,
        warehouse,
        full_refresh=False,
        questions=questions,
        run_ts="2024-02-23 00:30:00",
        dedupe="latest",
    )
    return summary(written)


def _pipeline_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers after two increments over the landing zone, and the version of each stage table:
    the first run opens all files, the second those that came since, the third finds none."""
    questions, root = Questions(None, *OUTAGE, SLUG, HALF_SINCE), scratch_dir(spark)
    landing, warehouse, t = f"{root}/landing", f"{root}/warehouse", views.tables(spark, sf_dir)
    # One row a key in each arrival; of several files' rows the path would decide.
    runs = zip(*(_arrivals(name, t) for name in ENTITIES), strict=True)
    for hour, arrivals in enumerate(runs):
        landed = {
            name: partial(_land_last, name, df, landing)
            for name, df in zip(ENTITIES, arrivals, strict=True)
        }
        run_in_order(spark, landed, {})
        run_pipeline(landing, warehouse, hour == 0, select="stage", run_ts=f"2024-02-23 0{hour}:00:00")
    written = run_pipeline(landing, warehouse, False, questions=questions, run_ts="2024-02-23 09:00:00")
    versions = [
        (f"version of {name}", float(stage_table(spark, warehouse, name).version())) for name in STAGE_MODELS
    ]
    return summary(written).unionByName(spark.createDataFrame(versions, "metric string, answer double"))


def _land_last(name: str, df: DataFrame, landing: str) -> str:
    return land(_last_of_each(name, df), landing, name)


def _last_of_each(name: str, landing: DataFrame) -> DataFrame:
    """Landing rows whose staged row is the greatest of its key."""
    model, landed = STAGE_MODELS[name], F.struct(*landing.columns).alias("landed")
    staged = model.build(landing.select("*", landed), RUN_TS, carry=("landed",)).drop("reference_date")
    values = F.struct(*(c for c in staged.columns if c != "landed"))
    once, rest = by_repeats(staged, model.key)
    last = rest.groupBy(model.key).agg(F.max_by("landed", values).alias("landed")).select("landed.*")
    return last if once is None else once.select("landed.*").unionByName(last)


def _stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of book files, each merged by a streaming run that then stops. The second one
    replaces rows of the first and brings new ones."""
    root = scratch_dir(spark)
    table = snapshot_of(spark, f"{root}/warehouse/books", "books")
    for arrival in _arrivals("books", views.tables(spark, sf_dir)):
        land(arrival, root, "books")
        stream_stage(
            spark, root, "books", table, f"{root}/checkpoint", dedupe="latest"
        ).awaitTermination()
    return table.read().drop("reference_date")


def _stream_event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of reviews, the later one first. The row that was updated last stays."""
    root = scratch_dir(spark)
    table = snapshot_of(spark, f"{root}/warehouse/reviews", "reviews")
    earlier, later = _arrivals("reviews", views.tables(spark, sf_dir))
    for arrival, updated in ((later, "2024-01-02"), (earlier, "2024-01-01")):
        land(arrival.withColumn("updated", F.lit(updated)), root, "reviews")
        stream_stage(
            spark, root, "reviews", table, f"{root}/checkpoint", newest=("updated",)
        ).awaitTermination()
    return table.read().drop("reference_date")


def _merge_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a stored table that reads and writes only the parts of the new rows' keys."""
    table, model = snapshot_of(spark, f"{scratch_dir(spark)}/movies", "movies"), STAGE_MODELS["movies"]
    earlier, later = halves("movies", spark, sf_dir)
    table.write(earlier)
    merge_rows(table, model, latest_per_key(later, model.key, []))
    return table.read().drop("reference_date")


def _stored_sessions(spark: SparkSession, sf_dir: str) -> tuple[SnapshotTable, State]:
    table, model = snapshot_of(spark, f"{scratch_dir(spark)}/streams", "streams"), STAGE_MODELS["streams"]
    table.write(_stage("streams", spark, sf_dir), model.sort_by)
    return table, table.state()


def _window_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outage question over a stored table, of which only the parts near the window are opened."""
    table, state = _stored_sessions(spark, sf_dir)
    near = table.read(state, state.parts_where(T.near_window(*OUTAGE)))
    return T.users_in_window(near, None, *OUTAGE)


def _measured(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure of the sessions, made from one half of the days and then from what has changed."""
    root, model = scratch_dir(spark), STAGE_MODELS["streams"]
    table, kept = stage_table(spark, root, "streams"), measure_table(spark, root, name)
    earlier, later = halves("streams", spark, sf_dir)
    table.write(earlier, model.sort_by)
    refresh(MEASURES[name], kept, table, table.state())
    merge_rows(table, model, latest_per_key(later, model.key, []))
    refresh(MEASURES[name], kept, table, table.state())
    return kept.read()


def _mean_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.mean_of_title_days(_measured("title_days", spark, sf_dir))


def _share_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.adaptation_share(_measured("title_days", spark, sf_dir), _stage("reviews", spark, sf_dir))


def _median_by_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that merged sketches stand for, and whether their median has about the middle rank."""
    answer = T.median_of_sketches(_measured("size_sketches", spark, sf_dir)).first()
    earlier, later = halves("streams", spark, sf_dir)
    sizes = upsert(earlier, latest_per_key(later, "stream_id", []), "stream_id")
    below = F.count_if(F.col("size_mb") / 1000 < answer["median_size_gb"] - 0.005)
    upto = F.count_if(F.col("size_mb") / 1000 <= answer["median_size_gb"] + 0.005)
    n = F.count("size_mb")
    error = 2 * 2.296 / SKETCH**0.9723
    return sizes.agg(
        F.lit(answer["sized_rows"]).alias("sized_rows"),
        ((below <= n * (0.5 + error)) & (upto >= n * (0.5 - error))).alias("in_the_middle"),
    )


def _past_half_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies watched to the half, from the parts since a moment."""
    table, state = _stored_sessions(spark, sf_dir)
    near = table.read(state, state.parts_where(T.near_start(HALF_SINCE)))
    return T.users_past_half(near, _stage("movies", spark, sf_dir), HALF_SINCE, with_sessions=True)


def _source_files(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> dict[str, str]:
    """Landing views written as files of the kind that their entity arrives in."""
    root, files = scratch_dir(spark), {}
    for name in names:
        files[name] = f"{root}/{name}"
        writer = _view(name, spark, sf_dir).write
        if ENTITIES[name].source_format == "csv":
            writer.option("header", True).option("escape", '"').csv(files[name])
        else:
            writer.option("ignoreNullFields", False).json(files[name])
    return files


def _read_source(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = _source_files(spark, sf_dir, (name,))
        return flat(name, read_source(spark, files[name], name))

    return query


def _planted(name: str, spark: SparkSession, sf_dir: str) -> str:
    """A source file of an entity in which rows of every tenth number do not fit, in two ways."""
    t, path = views.tables(spark, sf_dir), f"{scratch_dir(spark)}/{name}"
    number = F.regexp_extract("title" if name == "movies" else "name", "#([0-9]+)$", 1).cast("int")
    rows = views.landing_view(name, t).withColumn("bad", number % 10)
    if name == "movies":
        good = F.to_csv(F.struct(*ENTITIES[name].schema.names))
        wrong = F.concat_ws(",", "title", F.lit("long"), "original_language", "size_mb")
        short = F.concat_ws(",", "title", "duration_mins")
    else:
        good = F.to_json(F.struct(*ENTITIES[name].schema.names), {"ignoreNullFields": "false"})
        wrong = F.to_json(F.struct("name", F.lit("many").alias("pages")))
        short = F.concat(F.lit("{"), "name")
    line = F.when(F.col("bad") == 0, wrong).when(F.col("bad") == 1, short).otherwise(good)
    if name == "movies":  # the first row of a partition brings the header of its file
        header = F.lit(",".join(ENTITIES[name].schema.names) + "\n")
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        line = F.concat(F.when(first, header).otherwise(""), line)
    rows.select(line.alias("line")).write.text(path)
    return path


def _rejects(name: str) -> Query:
    """What was landed of a file with rows that do not fit, and what was rejected, and why."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, title = scratch_dir(spark), "title" if name == "movies" else "name"
        counts = ingest_checked(spark, {name: _planted(name, spark, sf_dir)}, root)
        landed = scan(spark, root, name).select(F.col(title).alias("record"), F.lit("landed").alias("reason"))
        rejected = read_rejects(spark, root, name).select("record", "reason")
        totals = [("landed", str(counts[name][0])), ("rejected", str(counts[name][1]))]
        return landed.unionByName(rejected).unionByName(spark.createDataFrame(totals, "record string, reason string"))

    return query


def _land_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load that is repeated and another one: two copies, not three."""
    root = scratch_dir(spark)
    for load_id in ("2024-02-23", "2024-02-24", "2024-02-23"):
        land(_view("users", spark, sf_dir), root, "users", load_id=load_id)
    return scan(spark, root, "users")


def _ingest_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of each entity of a group that was ingested from its source files."""
    shown = {"movies": "title", "streams": "start_at", "users": "last_name"}
    root = scratch_dir(spark)
    ingest(spark, _source_files(spark, sf_dir, tuple(shown)), root, "internal")
    tables = register_sources(spark, root, "internal")
    return reduce(
        DataFrame.unionByName,
        (
            tables[name].select(F.lit(name).alias("entity"), F.col(column).alias("value"))
            for name, column in shown.items()
        ),
    )


def _external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed users, read through the catalog by name."""
    root = scratch_dir(spark)
    land(_view("users", spark, sf_dir), root, "users")
    namespace = f"landing_{uuid.uuid4().hex}"
    create_namespace(spark, namespace, f"{root}/namespace")
    return spark.table(create_landing_table(spark, namespace, root, "users"))


def _stage_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh over a table that holds other rows."""
    table, model = snapshot_of(spark, f"{scratch_dir(spark)}/books", "books"), STAGE_MODELS["books"]
    earlier, later = halves("books", spark, sf_dir)
    load_stage(table, model, earlier, run_ts=RUN_TS)
    load_stage(table, model, later, full_refresh=True, run_ts=RUN_TS)
    return table.read().drop("reference_date")


def _load_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("reference_date").cast("timestamp_ntz").alias("loaded_at")
    return _stage("movies", spark, sf_dir).select("title", stamp)


def _ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books that arrive twice and are in the table already."""
    earlier, later = halves("books", spark, sf_dir)
    t = _limited(views.tables(spark, sf_dir), "part", "p_size >= 30")
    again = _staged("books", views.landing_view("books", t))
    return ambiguous_keys(earlier, later.unionByName(again), "book_id")


QUERIES: dict[str, Query] = {
    "users_past_half": users_past_half,
    "adaptation_share": _adaptation_share,
    "users_in_window": _window(None, "endpoint"),
    "users_in_window_title": _window(TITLE, "endpoint"),
    "users_in_window_overlap": _window(None, "overlap"),
    "adaptations_by_origin": _origin(SLUG),
    "adaptations_any_origin": _origin(None),
    "mean_session_hours": _mean_session_hours,
    "median_size_gb": _median_size_gb,
    "surrogate_key": _surrogate_key,
    "mask_email": _mask_email,
    "mask_ssn": _mask_ssn,
    "gen_id": _gen_id,
    "full_name": _full_name,
    "session_times": _session_times,
    "first_nationality": _first_nationality,
    "first_movie": _first_movie,
    "first_book": _first_book,
    **{f"stage_{name}": _stage_query(name) for name in STAGE_MODELS},
    **{f"upsert_{name}": _upsert(name) for name in STAGE_MODELS},
    **{f"scan_{name}": _scan(name) for name in ENTITIES},
    "land_append_rows": _land_append_rows,
    "land_json_records": _land_json,
    "land_once": _land_once,
    "csv_rejects": _rejects("movies"),
    "json_rejects": _rejects("books"),
    "table_refresh": _table_refresh,
    "incremental_gate": _incremental_gate,
    "pipeline_summary": _pipeline_summary,
    "pipeline_reload": _pipeline_reload,
    "pipeline_increment": _pipeline_increment,
    "stream_upserts": _stream_upserts,
    "stream_event_order": _stream_event_order,
    "merge_by_parts": _merge_by_parts,
    "users_in_window_by_parts": _window_by_parts,
    "users_past_half_by_parts": _past_half_by_parts,
    "mean_hours_by_measure": _mean_by_measure,
    "adaptation_share_by_measure": _share_by_measure,
    "median_by_sketches": _median_by_sketches,
    **{f"csv_{name}": _read_source(name) for name in ("movies", "streams", "users")},
    **{f"json_{name}": _read_source(name) for name in ("authors", "books", "reviews")},
    "ingest_internal": _ingest_internal,
    "external_table": _external_table,
    "stage_refresh": _stage_refresh,
    "load_stamp": _load_stamp,
    "ambiguous_keys": _ambiguous_keys,
}
