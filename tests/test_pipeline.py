"""The pipeline end to end, in batches and as a stream."""

import itertools
import threading
import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators.load import AmbiguousUpsert, upsert_newest
from reelhouse.plans import measures, trusted
from reelhouse.plans.lineage import run_in_order
from reelhouse.plans.measures import MEASURES, measure_table, refresh
from reelhouse.plans.pipeline import (
    STAGE_MODELS,
    TRUSTED_MODELS,
    Questions,
    StoredTable,
    edges,
    expire_warehouse,
    merge_rows,
    run_pipeline,
    stage_table,
    summary,
    trusted_table,
)
from reelhouse.schemas import ENTITIES
from reelhouse.sources.landing import land, scan
from reelhouse.sources import snapshots
from reelhouse.sources.snapshots import SnapshotTable
from reelhouse.streaming import incremental
from reelhouse.streaming.incremental import stream_stage
from reelhouse.workload import queries, views

ASKED = Questions(
    "Heat", "2021-12-25 07:00:00", "2021-12-25 12:00:00", "sg", "2021-12-24 23:59:59"
)
FIRST, SECOND = "2024-02-23 00:00:00", "2024-02-23 00:30:00"


def landing(spark, **rows):
    """Small landing tables; a keyword replaces the rows of one entity."""
    tables = {
        "movies": [("Heat", 60, "English", 900), ("Dune", 100, "English", 1500)],
        "streams": [
            ("Heat", "a", 100.0, "2021-12-25T08:00:00Z", "2021-12-25T09:00:00Z"),
            ("Dune", "b", 200.0, "2021-12-25T08:00:00Z", "2021-12-25T08:10:00Z"),
            ("Dune", "c", 300.0, "2021-12-26T08:00:00Z", "2021-12-26T10:00:00Z"),
        ],
        "users": [("A", "B", "ann@x.org")],
        "authors": [(("Frank", "1920", None), [(1, "S", None), (2, "S", "sg")])],
        "books": [("dune", 412, "FRANK", "p")],
        "reviews": [
            (("t",), (5, "top"), [(1, ("Dune", "412"))], [(0, "end"), (1, "DUNE")], None, None)
        ],
    }
    tables.update(rows)
    return {n: spark.createDataFrame(r, ENTITIES[n].schema) for n, r in tables.items()}


def answers(written):
    return {r.metric: r.answer for r in summary(written).collect()}


EXPECTED = {
    "adaptation_share": 0.5,
    "users_in_window": 1.0,
    "adaptations_by_author_origin": 1.0,
    "mean_session_hours": 1.0,
    "median_size_gb": 0.2,
    "users_past_half": 2.0,
}


def test_full_run(spark, tmp_path):
    written = run_pipeline(landing(spark), str(tmp_path), questions=ASKED, run_ts=FIRST)
    assert set(written) == {f"stage.{n}" for n in STAGE_MODELS} | {
        f"trusted.{n}" for n in TRUSTED_MODELS
    }
    assert answers(written) == EXPECTED
    assert all(written[f"trusted.{n}"].count() == 1 for n in TRUSTED_MODELS)
    stamps = written["stage.users"].select(F.col("reference_date").cast("string"))
    assert [r[0] for r in stamps.collect()] == [FIRST]


def test_full_refresh_replaces(spark, tmp_path):
    run_pipeline(landing(spark), str(tmp_path), select="internal")
    written = run_pipeline(
        landing(spark, movies=[("Solo", 1, "x", 2)]), str(tmp_path), select="internal"
    )
    assert [r.title for r in written["stage.movies"].collect()] == ["Solo"]
    assert stage_table(spark, str(tmp_path), "movies").read(1).count() == 2


def test_incremental_run_merges(spark, tmp_path):
    run_pipeline(landing(spark), str(tmp_path), select="stage", run_ts=FIRST)
    changed = [("Dune", 100, "French", 7), ("Solo", 1, "x", 2)]
    written = run_pipeline(
        landing(spark, movies=changed), str(tmp_path), False, questions=ASKED, run_ts=SECOND
    )
    movies = {r.title: r for r in written["stage.movies"].collect()}
    assert set(movies) == {"Heat", "Dune", "Solo"}
    assert movies["Dune"].size_mb == 7 and str(movies["Dune"].reference_date) == SECOND
    assert str(movies["Heat"].reference_date) == FIRST
    key = STAGE_MODELS["movies"].build(landing(spark, movies=changed)["movies"])
    assert movies["Dune"].movie_id == key.filter("title = 'Dune'").first().movie_id
    assert answers(written) == EXPECTED


def test_a_closed_gate_writes_nothing(spark, tmp_path):
    run_pipeline(landing(spark), str(tmp_path), select="stage", run_ts=SECOND)
    run_pipeline(landing(spark), str(tmp_path), False, select="stage", run_ts=FIRST)
    assert stage_table(spark, str(tmp_path), "movies").version() == 1


@pytest.mark.parametrize(("strict", "rows"), [(False, 2), (True, 0)])
def test_incremental_run_into_an_empty_table(spark, tmp_path, strict, rows):
    run_pipeline(landing(spark, movies=[]), str(tmp_path), select="internal", run_ts=FIRST)
    written = run_pipeline(
        landing(spark), str(tmp_path), False, select="internal", run_ts=SECOND, strict=strict
    )
    assert written["stage.movies"].count() == rows


def test_selections(spark, tmp_path):
    tables = landing(spark)
    internal = run_pipeline(tables, str(tmp_path), select="internal")
    assert set(internal) == {"stage.movies", "stage.streams", "stage.users"}
    vendor = run_pipeline(tables, str(tmp_path), select="vendor")
    assert set(vendor) == {"stage.authors", "stage.books", "stage.reviews"}
    assert answers(run_pipeline({}, str(tmp_path), select="trusted", questions=ASKED)) == EXPECTED
    other = replace(
        ASKED, outage_title="Dune", outage_start="2021-12-26 00:00:00",
        outage_end="2021-12-27 00:00:00",
    )
    again = run_pipeline({}, str(tmp_path), select="trusted", questions=other)
    assert answers(again)["users_in_window"] == 1.0
    assert trusted_table(spark, str(tmp_path), "users_in_window").version() == 2
    with pytest.raises(ValueError):
        run_pipeline(tables, str(tmp_path), select="other")
    with pytest.raises(ValueError):
        run_pipeline(tables, str(tmp_path))


def test_landing_twice_duplicates_unless_the_latest_row_is_asked_for(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    for _ in range(2):
        for name, df in landing(spark).items():
            land(df, root, name)
    twice = {name: scan(spark, root, name, file_times=True) for name in ENTITIES}
    raw = run_pipeline(twice, warehouse, questions=ASKED, run_ts=FIRST)
    assert raw["stage.books"].count() == 2 and raw["stage.books"].columns[-1] == "reference_date"
    assert answers(raw)["adaptations_by_author_origin"] == 4.0
    with pytest.raises(AmbiguousUpsert):
        run_pipeline(twice, warehouse, False, questions=ASKED, run_ts=SECOND)
    once = run_pipeline(twice, warehouse, questions=ASKED, run_ts=FIRST, dedupe="latest")
    assert once["stage.books"].count() == 1 and answers(once) == EXPECTED
    merged = run_pipeline(
        twice, warehouse, False, questions=ASKED, run_ts=SECOND, dedupe="latest"
    )
    assert merged["stage.streams"].count() == 3 and answers(merged) == EXPECTED
    with pytest.raises(ValueError):
        run_pipeline(twice, warehouse, questions=ASKED, dedupe="first")


def test_shuffles_are_sized_for_the_input(spark, tmp_path, conf, monkeypatch):
    conf(
        shuffle__partitions="8",
        adaptive__coalescePartitions__initialPartitionNum="8",
        adaptive__advisoryPartitionSizeInBytes="64MB",
    )
    initial, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    write = SnapshotTable.write

    def spy(*args, **options):
        seen.append(spark.conf.get(initial))
        return write(*args, **options)

    monkeypatch.setattr(SnapshotTable, "write", spy)
    run_pipeline(landing(spark), str(tmp_path), select="vendor")
    assert set(seen) == {"8"}
    seen.clear()
    run_pipeline(landing(spark), str(tmp_path), select="vendor", input_bytes=2**31)
    assert set(seen) == {"16"} and spark.conf.get(initial) == "8"


def land_all(spark, root, **rows):
    for name, df in landing(spark, **rows).items():
        land(df, root, name)


def part_loads(spark, warehouse):
    return {name: stage_table(spark, warehouse, name).state().loads for name in STAGE_MODELS}


def test_a_run_takes_each_landing_file_once(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_all(spark, root)
    first = run_pipeline(root, warehouse, questions=ASKED, run_ts=FIRST)
    assert answers(first) == EXPECTED
    loads = part_loads(spark, warehouse)
    again = run_pipeline(root, warehouse, False, questions=ASKED, run_ts=SECOND)
    assert answers(again) == EXPECTED and part_loads(spark, warehouse) == loads
    assert all(stage_table(spark, warehouse, n).version() == 1 for n in STAGE_MODELS)
    # what was taken is gone, and one day has a new session and a changed one
    for old in (tmp_path / "landing").rglob("*.parquet"):
        old.unlink()
    changed = [
        ("Heat", "a", 900.0, "2021-12-25T08:00:00Z", "2021-12-25T09:00:00Z"),
        ("Heat", "d", 100.0, "2021-12-25T08:00:00Z", "2021-12-25T08:40:00Z"),
    ]
    land(landing(spark, streams=changed)["streams"], root, "streams")
    merged = run_pipeline(root, warehouse, False, questions=ASKED, run_ts=SECOND)
    sizes = {(r.user_email, r.size_mb) for r in merged["stage.streams"].collect()}
    assert sizes == {("a", 900.0), ("b", 200.0), ("c", 300.0), ("d", 100.0)}
    assert answers(merged)["users_past_half"] == 3.0
    after = part_loads(spark, warehouse)
    moved = {(name, part) for name in loads for part in after[name] if after[name][part] != loads[name].get(part)}
    assert moved == {("streams", "2021-12-25")}
    ledger = stage_table(spark, warehouse, "streams")
    assert ledger.ledger(ledger.state()).count() > 1


def test_a_full_refresh_takes_all_files_again(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_all(spark, root)
    run_pipeline(root, warehouse, select="stage")
    land(landing(spark)["users"], root, "users")
    written = run_pipeline(root, warehouse, select="stage")
    assert written["stage.users"].count() == 2
    table = stage_table(spark, warehouse, "users")
    files = list((tmp_path / "landing/internal/users").rglob("*.parquet"))
    assert table.ledger(table.state()).count() == len(files)
    assert run_pipeline(root, warehouse, False, select="stage")["stage.users"].count() == 2
    assert table.version() == 2
    # merges of other rows leave the account of the files alone
    merge_rows(table, STAGE_MODELS["users"], STAGE_MODELS["users"].build(users(spark, ("X", "Y", None))))
    assert table.version() == 3 and table.ledger(table.state()).count() == len(files)


def test_a_failed_run_leaves_its_files_for_the_next(spark, tmp_path, monkeypatch):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_all(spark, root)
    run_pipeline(root, warehouse, select="stage", run_ts=FIRST)
    land(landing(spark, users=[("C", "D", "cyd@x.org")])["users"], root, "users")
    with monkeypatch.context() as broken:
        broken.setattr(SnapshotTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_pipeline(root, warehouse, False, select="stage", run_ts=SECOND)
    written = run_pipeline(root, warehouse, False, select="stage", run_ts=SECOND)
    assert {r.full_name for r in written["stage.users"].collect()} == {"A B", "C D"}


def test_files_that_were_landed_twice_in_one_increment(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_all(spark, root)
    run_pipeline(root, warehouse, select="stage", run_ts=FIRST)
    for email in ("bob@x.org", "cyd@x.org"):
        land(landing(spark, users=[("A", "B", email)])["users"], root, "users")
        time.sleep(0.05)
    with pytest.raises(AmbiguousUpsert):
        run_pipeline(root, warehouse, False, select="stage", run_ts=SECOND)
    written = run_pipeline(root, warehouse, False, select="stage", run_ts=SECOND, dedupe="latest")
    assert [r.email for r in written["stage.users"].collect()] == ["c*****@x.org"]


# reading by time


def sessions(spark, *times):
    rows = [(t, f"u{i}", 1.0, a, b) for i, (t, a, b) in enumerate(times)]
    return STAGE_MODELS["streams"].build(spark.createDataFrame(rows, schemas.STREAMS))


TIMES = (
    ("Heat", "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z"),
    ("Heat", "2024-01-02T23:00:00Z", "2024-01-03T08:30:00Z"),
    ("Heat", "2024-01-03T09:00:00Z", "2024-01-03T10:00:00Z"),
    ("Heat", "2024-01-04T10:00:00Z", "2024-01-04T11:00:00Z"),
    ("Heat", "2024-01-05T10:00:00Z", None),
)
WINDOW = ("2024-01-03 08:00:00", "2024-01-03 12:00:00")


def ask(table, near, question):
    state = table.state()
    parts = state.parts_where(near)
    return parts, question(table.read(state, parts)).first()[0]


def test_questions_about_times_open_only_the_parts_they_need(spark, tmp_path):
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    table.write(sessions(spark, *TIMES), model.sort_by)
    for folder in list((tmp_path / "stage/streams/data").glob("*/__part=2024-01-0[145]")):
        folder.rename(tmp_path / folder.name)
    parts, users = ask(table, trusted.near_window(*WINDOW), lambda s: trusted.users_in_window(s, "Heat", *WINDOW))
    # the session that starts the day before ends inside
    assert parts == ["2024-01-02", "2024-01-03"] and users == 2
    night = ("2024-01-03 00:00:00", "2024-01-03 01:00:00")
    assert ask(table, trusted.near_window(*night), lambda s: trusted.users_in_window(s, None, *night)) == ([], 0)
    parts, users = ask(
        table,
        trusted.near_window(*night, mode="overlap"),
        lambda s: trusted.users_in_window(s, None, *night, mode="overlap"),
    )
    assert parts == ["2024-01-02"] and users == 1


def test_a_time_that_cannot_be_read_is_still_found(spark, tmp_path):
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    table.write(sessions(spark, *TIMES, ("Heat", "2024-01-04T10:00:00Z", "soon")), model.sort_by)
    state = table.state()
    assert state.parts_where(trusted.near_window(*WINDOW)) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    with pytest.raises(PySparkException):
        ask(table, trusted.near_window(*WINDOW), lambda s: trusted.users_in_window(s, "Heat", *WINDOW))


def test_past_half_opens_the_parts_since_its_moment(spark, tmp_path):
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    table.write(sessions(spark, *TIMES), model.sort_by)
    since = "2024-01-03 09:00:00"
    movies = spark.createDataFrame([("Heat", 60)], "title string, duration_mins int")
    parts, users = ask(table, trusted.near_start(since), lambda s: trusted.users_past_half(s, movies, since))
    assert parts == ["2024-01-03", "2024-01-04", "2024-01-05"] and users == 2
    assert ask(table, trusted.near_start("2025-01-01 00:00:00"), lambda s: s.selectExpr("count(*)")) == ([], 0)


def test_the_pipeline_opens_only_the_parts_it_needs(spark, tmp_path):
    run_pipeline(landing(spark), str(tmp_path), select="stage")
    streams, movies = (stage_table(spark, str(tmp_path), n) for n in ("streams", "movies"))
    opened = []

    class Spy(SnapshotTable):
        def read(self, version=None, parts=None, with_loads=False):
            opened.append(parts)
            return super().read(version, parts, with_loads)

    def stage(name):
        table = {"streams": streams, "movies": movies}[name]
        return StoredTable(Spy(spark, table.path, table.part, table.key), table.state())

    asked = replace(ASKED, half_since="2021-12-26 00:00:00")
    for name, parts in (("users_in_window", ["2021-12-25"]), ("users_past_half", ["2021-12-26"])):
        assert TRUSTED_MODELS[name].run(stage, asked).first()[0] == 1
        assert opened[0] == parts
        opened.clear()


# measures


def sessions_of(measure, table, source):
    refresh(measure, table, source, source.state())
    return table.read()


def test_a_measure_reads_only_parts_that_have_changed(spark, tmp_path):
    source, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    days = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03"), ("a", "2024-01-03"), ("A", "2024-01-03")]
    source.write(streams(spark, *days), model.sort_by)
    measure, table = MEASURES["title_days"], measure_table(spark, str(tmp_path), "title_days")
    rows = sessions_of(measure, table, source).collect()
    assert sorted((r.part, r.movie_title, r.sessions, r.hours) for r in rows) == sorted(
        (day, title, 1, 1) for title, day in days
    )
    before = table.state()
    assert refresh(measure, table, source, source.state()) == before.version
    merge_rows(source, model, streams(spark, ("d", "2024-01-02")))
    for folder in (tmp_path / "stage/streams/data").glob("*/__part=2024-01-0[13]"):
        folder.rename(tmp_path / folder.name)
    rows = sessions_of(measure, table, source).collect()
    assert {(r.part, r.movie_title) for r in rows} == {(day, title) for title, day in days} | {("2024-01-02", "d")}
    after = table.state()
    assert [p for p in after.loads if after.loads[p] != before.loads[p]] == ["2024-01-02"]
    # a refresh of the source that has fewer days
    source.write(streams(spark, ("z", "2024-01-05")), model.sort_by)
    assert [(r.part, r.movie_title) for r in sessions_of(measure, table, source).collect()] == [("2024-01-05", "z")]


def test_a_measure_of_nothing(spark, tmp_path):
    source = stage_table(spark, str(tmp_path), "streams")
    source.write(streams(spark))
    for name in MEASURES:
        assert sessions_of(MEASURES[name], measure_table(spark, str(tmp_path), name), source).count() == 0
    sketches = measure_table(spark, str(tmp_path), "size_sketches").read()
    assert tuple(trusted.median_of_sketches(sketches).first()) == (None, 0)
    titles = measure_table(spark, str(tmp_path), "title_days").read()
    assert trusted.mean_of_title_days(titles).first()[0] is None


def test_answers_from_measures_are_those_from_the_sessions(spark, tmp_path):
    views_of = views.landing_views(spark, "/root/testdata/sf0.001")
    staged = {n: STAGE_MODELS[n].build(views_of[n]) for n in ("streams", "reviews", "books", "authors")}
    source = stage_table(spark, str(tmp_path), "streams")
    source.write(staged["streams"], ("start_ts",))
    days = sessions_of(MEASURES["title_days"], measure_table(spark, str(tmp_path), "title_days"), source)
    sessions = source.read()
    assert trusted.mean_of_title_days(days).first() == trusted.mean_session_hours(sessions).first()
    share = [trusted.adaptation_share(s, staged["reviews"]).first() for s in (days, sessions)]
    assert share[0] == share[1]
    rest = [staged[n] for n in ("reviews", "books", "authors")]
    assert len({trusted.adaptations_by_author_origin(s, *rest, None).first() for s in (days, sessions)}) == 1


def test_a_time_that_cannot_be_read_fails_the_measure(spark, tmp_path):
    source = stage_table(spark, str(tmp_path), "streams")
    source.write(sessions(spark, *TIMES, ("Heat", "2024-01-04T10:00:00Z", "soon")))
    with pytest.raises(PySparkException):
        refresh(MEASURES["title_days"], measure_table(spark, str(tmp_path), "title_days"), source, source.state())


def test_the_median_of_sketches_is_near(spark, tmp_path, monkeypatch):
    """Merged from many parts; the rank is within the stated error."""
    monkeypatch.setattr(measures, "SKETCH", 256)
    sizes = [(i * 7919) % 20_011 / 3 for i in range(20_000)]
    rows = [("t", "u", s, f"2024-01-{i % 28 + 1:02}T10:00:00Z", f"2024-01-{i % 28 + 1:02}T11:00:00Z") for i, s in enumerate(sizes)]
    rows += [("t", "u", None, "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z")]
    source = stage_table(spark, str(tmp_path), "streams")
    source.write(STAGE_MODELS["streams"].build(spark.createDataFrame(rows, schemas.STREAMS)))
    sketches = sessions_of(MEASURES["size_sketches"], measure_table(spark, str(tmp_path), "size_sketches"), source)
    assert sketches.count() == 28
    for folder in (tmp_path / "stage/streams/data").glob("*"):
        folder.rename(tmp_path / folder.name)
    median, n = trusted.median_of_sketches(sketches).first()
    rank = sum(s <= median * 1000 for s in sizes) / len(sizes)
    assert n == len(sizes) and abs(rank - 0.5) < 2.296 / 256**0.9723


def test_an_answer_is_kept_until_what_it_reads_has_changed(spark, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land_all(spark, root)

    def run(questions=ASKED):
        written = run_pipeline(root, warehouse, False, questions=questions, run_ts=SECOND)
        return answers(written), {n: trusted_table(spark, warehouse, n).version() for n in TRUSTED_MODELS}

    run_pipeline(root, warehouse, questions=ASKED, run_ts=FIRST)
    assert run() == (EXPECTED, dict.fromkeys(TRUSTED_MODELS, 1))
    # a user changes none, a movie only the question that reads movies
    land(landing(spark, users=[("C", "D", None)])["users"], root, "users")
    land(landing(spark, movies=[("Solo", 1, "x", 2)])["movies"], root, "movies")
    assert run() == (EXPECTED, dict.fromkeys(TRUSTED_MODELS, 1) | {"users_past_half": 2})
    later = replace(ASKED, half_since="2030-01-01 00:00:00")
    found, versions = run(later)
    assert found["users_past_half"] == 0 and versions["users_past_half"] == 3
    session = [("Heat", "z", 1.0, "2021-12-25T08:00:00Z", "2021-12-25T08:10:00Z")]
    land(landing(spark, streams=session)["streams"], root, "streams")
    found, versions = run(later)
    assert found["users_in_window"] == 2 and versions == {
        "adaptation_share": 2, "users_in_window": 2, "adaptations_by_author_origin": 2,
        "mean_session_hours": 2, "median_size_gb": 2, "users_past_half": 4,
    }


def test_a_warehouse_keeps_its_last_versions(spark, tmp_path):
    for run_ts in (FIRST, SECOND):
        written = run_pipeline(landing(spark), str(tmp_path), questions=ASKED, run_ts=run_ts)
    gone = expire_warehouse(spark, str(tmp_path), 1)
    assert gone["stage.movies"] == 1 and gone["measure.title_days"] == 1 and gone["measure.size_sketches"] == 0
    assert answers(written) == EXPECTED
    assert set(expire_warehouse(spark, str(tmp_path), 1).values()) == {0}


# lineage


def test_edges_are_those_of_the_models():
    needs = edges()
    assert set(needs) == {f"stage.{n}" for n in STAGE_MODELS} | {f"trusted.{n}" for n in TRUSTED_MODELS} | {
        "measure.title_days", "measure.size_sketches"
    }
    assert needs["measure.title_days"] == {"stage.streams"}
    assert needs["trusted.adaptation_share"] == {"measure.title_days", "stage.reviews"}
    assert needs["trusted.users_past_half"] == {"stage.streams", "stage.movies"}
    assert not any(needs[f"stage.{n}"] for n in STAGE_MODELS)


def test_a_model_that_fails_stops_only_what_needs_it(spark, tmp_path):
    tables = landing(spark)
    tables["reviews"] = tables["reviews"].withColumn("updated", F.raise_error("lost")).withColumn(
        "content", F.struct(F.raise_error("lost").cast("string").alias("text"))
    )
    with pytest.raises(PySparkException) as caught:
        run_pipeline(tables, str(tmp_path), questions=ASKED)
    notes = " ".join(caught.value.__notes__)
    assert "in stage.reviews" in notes
    assert "trusted.adaptation_share" in notes and "trusted.adaptations_by_author_origin" in notes
    for name in TRUSTED_MODELS:
        stopped = name in ("adaptation_share", "adaptations_by_author_origin")
        assert (trusted_table(spark, str(tmp_path), name).version() is None) == stopped
    assert stage_table(spark, str(tmp_path), "authors").read().count() == 1


def test_models_run_in_order_and_side_by_side(spark):
    done, together = [], threading.Barrier(2)

    def model(name, wait=False):
        def run():
            if wait:
                together.wait(30)
            assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == name
            done.append(name)
            return name.upper()

        return run

    models = {"c": model("c"), "a": model("a", True), "b": model("b", True), "d": model("d")}
    made = run_in_order(spark, models, {"c": {"a", "b"}, "d": {"c", "elsewhere"}})
    assert made == {n: n.upper() for n in models} and list(made) == list(models)
    assert set(done[:2]) == {"a", "b"} and done[2:] == ["c", "d"]
    assert run_in_order(spark, {}, {}) == {}


# merges


def streams(spark, *rows):
    sessions = [(t, "u", 1.0, f"{start}T10:00:00Z", f"{start}T11:00:00Z") for t, start in rows]
    return STAGE_MODELS["streams"].build(spark.createDataFrame(sessions, schemas.STREAMS))


def test_a_merge_touches_only_its_days(spark, tmp_path):
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    first = streams(spark, ("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03"), ("d", "bad"))
    merge_rows(table, model, first)
    before = table.state().loads
    days = {"2024-01-01", "2024-01-02", "2024-01-03", "unknown"}
    assert set(before) == days
    changed = streams(spark, ("b", "2024-01-02"), ("e", "2024-01-02")).withColumn("size_mb", F.lit(9.0))
    assert table.parts_in(changed) == ["2024-01-02"]
    merge_rows(table, model, changed)
    after = table.state().loads
    for day in days:
        assert (after[day] == before[day]) == (day != "2024-01-02")
    assert table.read(parts=["2024-01-02"]).inputFiles() != []
    assert all("2024-01-02" in f for f in table.read(parts=["2024-01-02"]).inputFiles())
    rows = {r.movie_title: r.size_mb for r in table.read().collect()}
    assert rows == {"a": 1.0, "b": 9.0, "c": 1.0, "d": 1.0, "e": 9.0}
    assert {r.movie_title for r in table.read(1).collect()} == {"a", "b", "c", "d"}
    assert table.read().columns == first.columns


def test_a_merge_of_an_untouched_day_that_cannot_be_read(spark, tmp_path):
    """The files of other days are gone, and the merge does not notice."""
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    merge_rows(table, model, streams(spark, ("a", "2024-01-01"), ("b", "2024-01-02")))
    folder = next((tmp_path / "stage/streams/data").glob("*/__part=2024-01-01"))
    folder.rename(tmp_path / "elsewhere")
    merge_rows(table, model, streams(spark, ("b", "2024-01-02"), ("c", "2024-01-02")))
    assert sorted(r.movie_title for r in table.read(parts=["2024-01-02"]).collect()) == ["b", "c"]


@pytest.mark.parametrize("name", ["movies", "users"])
def test_a_merge_reads_only_the_parts_of_its_keys(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(snapshots, "PART_BYTES", 20_000)
    table, model = stage_table(spark, str(tmp_path), name), STAGE_MODELS[name]

    def staged(low, high, value):
        title = F.concat(F.lit("t"), F.col("id").cast("string"))
        made = {
            "movies": [title.alias("title"), F.lit(value).alias("duration_mins"), F.lit("x").alias("original_language"), F.lit(1).alias("size_mb")],
            "users": [title.alias("first_name"), F.lit("n").alias("last_name"), F.lit(f"{value}@x").alias("email")],
        }[name]
        return model.build(spark.range(low, high).select(*made), FIRST)

    staged(0, 4000, 1).write.parquet(str(tmp_path / "rows"))
    table.write(spark.read.parquet(str(tmp_path / "rows")))
    before = table.state()
    assert before.buckets > 3
    change = staged(17, 18, 2)
    (part,) = table.parts_in(change, before)
    folders = {p: tmp_path / f"stage/{name}/data/__load={at}/__part={p}" for p, at in before.loads.items()}
    for p, folder in folders.items():
        if p != part:
            folder.rename(tmp_path / f"away-{p}")
    merge_rows(table, model, change)
    after = table.state()
    assert [p for p in after.loads if after.loads[p] != before.loads[p]] == [part]
    for p, folder in folders.items():
        if p != part:
            (tmp_path / f"away-{p}").rename(folder)
    assert table.read().count() == 4000 == sum(f["rows"] for f in after.facts.values())
    assert table.read().columns == table.read(1).columns
    assert table.read().exceptAll(table.read(1)).count() == 1


def test_parts_by_key_are_cut_when_they_have_grown(spark, tmp_path, monkeypatch):
    table, model = stage_table(spark, str(tmp_path), "users"), STAGE_MODELS["users"]

    def staged(low, high):
        rows = spark.range(low, high).selectExpr("concat('f', id) AS first_name", "'n' AS last_name", "'a@b' AS email")
        return model.build(rows, FIRST)

    merge_rows(table, model, staged(0, 3000))
    assert table.state().buckets == 1
    monkeypatch.setattr(snapshots, "PART_BYTES", 20_000)
    assert table.crowded(table.state())
    merge_rows(table, model, staged(2999, 3001))
    state = table.state()
    assert state.buckets > 2 and not table.crowded(state)
    assert table.read().count() == 3001 == table.read().select("user_id").distinct().count()
    merge_rows(table, model, staged(3001, 3002))
    assert len(set(table.state().loads.values())) == 2


def test_a_full_refresh_forgets_old_days(spark, tmp_path):
    table, model = stage_table(spark, str(tmp_path), "streams"), STAGE_MODELS["streams"]
    table.write(streams(spark, ("a", "2024-01-01"), ("b", "2024-01-02")), model.sort_by)
    table.write(streams(spark, ("c", "2024-01-02")), model.sort_by)
    assert [r.movie_title for r in table.read().collect()] == ["c"]
    table.write(streams(spark), model.sort_by)
    assert table.read().count() == 0 and table.read(1).count() == 2


def users(spark, *rows):
    return spark.createDataFrame(rows, schemas.USERS)


@pytest.fixture
def stream(spark, tmp_path):
    root = str(tmp_path / "landing")
    table = SnapshotTable(spark, str(tmp_path / "users"))

    def run(*rows, checkpoint="checkpoint", dedupe=None):
        if rows:
            land(users(spark, *rows), root, "users")
        stream_stage(
            spark, root, "users", table, str(tmp_path / checkpoint), dedupe=dedupe
        ).awaitTermination()
        return Counter((r.full_name, r.email) for r in table.read().collect())

    run.table, run.root = table, root
    return run


def test_stream_merges_each_arrival_once(spark, stream):
    first = stream(("A", "B", "ann@x.org"), ("C", "D", "cyd@x.org"))
    assert first == Counter([("A B", "a*****@x.org"), ("C D", "c*****@x.org")])
    second = stream(("A", "B", "zed@y.org"), ("E", "F", None))
    assert second == Counter(
        [("A B", "z*****@y.org"), ("C D", "c*****@x.org"), ("E F", None)]
    )
    assert stream() == second and stream.table.version() == 2


def test_a_repeated_micro_batch_changes_nothing(spark, stream, tmp_path):
    """The commit of batch 1 is lost, as when the driver dies right after the table's write."""
    stream(("A", "B", "ann@x.org"))
    state = stream(("A", "C", "bob@x.org"))
    lost = tmp_path / "checkpoint" / "commits"
    (lost / "1").rename(tmp_path / "commit-1")
    (lost / ".1.crc").rename(tmp_path / "commit-1.crc")
    assert stream() == state
    assert stream.table.version() == 2
    assert stream(("E", "F", None))[("E F", None)] == 1


def test_a_new_stream_starts_with_all_files(spark, stream):
    state = stream(("A", "B", "ann@x.org"))
    assert stream(checkpoint="other") == state
    assert stream.table.version() == 2


def test_stream_rejects_a_key_that_comes_twice(spark, stream):
    stream(("A", "B", "ann@x.org"))
    with pytest.raises(StreamingQueryException, match="AmbiguousUpsert"):
        stream(("A", "B", "bob@x.org"), ("A", "B", "cyd@x.org"))
    assert stream.table.version() == 1


def test_the_newest_row_of_a_key_stays_in_any_order_of_arrival(spark, tmp_path):
    """Over several runs, with ties and rows without a time."""
    def review(text, rate, updated):
        return ((text,), (rate, "l"), [], [], updated, None)

    arrivals = [
        [review("a", 1, "2024-01-01"), review("b", 1, "2024-01-05"), review("c", 1, None)],
        [review("a", 2, "2024-01-03"), review("b", 2, "2024-01-02"), review("d", 2, "2024-01-01")],
        [review("a", 3, "2024-01-02"), review("d", 5, "2024-01-01"), review("d", 4, "2024-01-01"), review("c", 3, "2023-01-01")],
    ]
    found = set()
    for order in itertools.permutations(range(3)):
        at = tmp_path / "".join(map(str, order))
        table = stage_table(spark, str(at), "reviews")
        for i in order:
            land(spark.createDataFrame(arrivals[i], schemas.REVIEWS), str(at / "landing"), "reviews")
            stream_stage(
                spark, str(at / "landing"), "reviews", table, str(at / "checkpoint"), run_ts=FIRST, newest=("updated",)
            ).awaitTermination()
        found.add(tuple(sorted((r.text, r.rate, r.updated) for r in table.read().collect())))
    assert found == {(("a", 2, "2024-01-03"), ("b", 1, "2024-01-05"), ("c", 3, "2023-01-01"), ("d", 5, "2024-01-01"))}


def test_a_stream_by_newest_compares_rows_once(spark, tmp_path, monkeypatch):
    """The table compares them with its own rows; the stream does not do so before."""
    def again(*_):
        raise AssertionError("compared before the merge")

    monkeypatch.setattr(incremental, "latest_per_key", again)
    table = stage_table(spark, str(tmp_path), "reviews")
    for rates in ((1, 3, 2), (5, 4)):
        rows = [(("a",), (rate, "l"), [], [], f"2024-01-0{rate}", None) for rate in rates]
        land(spark.createDataFrame(rows, schemas.REVIEWS), f"{tmp_path}/landing", "reviews")
        stream_stage(
            spark, f"{tmp_path}/landing", "reviews", table, f"{tmp_path}/checkpoint", newest=("updated",)
        ).awaitTermination()
        assert [r.rate for r in table.read().collect()] == [max(rates)]


def test_an_old_file_that_arrives_late_does_not_undo_a_newer_one(spark, tmp_path, stream):
    land(users(spark, ("A", "B", "old@x.org")), stream.root, "users")
    late = next((tmp_path / "landing/internal/users/parquet").glob("*.parquet"))
    late.rename(tmp_path / late.name)
    time.sleep(0.05)
    land(users(spark, ("A", "B", "new@x.org")), stream.root, "users")

    def run():
        stream_stage(
            spark, stream.root, "users", stream.table, str(tmp_path / "checkpoint"), newest=("landed_at", "landed_in")
        ).awaitTermination()
        return [r.email for r in stream.table.read().collect()]

    assert run() == ["n*****@x.org"]
    (tmp_path / late.name).rename(late)  # which keeps its time
    assert run() == ["n*****@x.org"] and stream.table.version() == 2


@pytest.mark.parametrize("bound", [-1, 10**6])
def test_both_ways_of_a_newest_upsert_agree(spark, bound):
    ddl = "k string, at int, v int"
    target = spark.createDataFrame([("a", 1, 1), ("b", 5, 1), (None, 1, 1), ("c", None, 1), ("z", 1, 1)], ddl)
    source = spark.createDataFrame([("a", 2, 2), ("b", 4, 2), (None, 2, 2), ("c", 1, 2), ("n", 1, 2), ("n", 0, 3)], ddl)
    got = upsert_newest(target, source, "k", ["at"], broadcast_bytes=bound)
    want = [("a", 2, 2), ("b", 5, 1), (None, 1, 1), (None, 2, 2), ("c", 1, 2), ("z", 1, 1), ("n", 1, 2)]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_arrivals_with_a_key_of_their_own_are_landed_as_they_are(spark):
    book = ("dune", 412, "frank", "p")
    rows = [book, (*book[:3], "q"), ("emma", 9, "jane", None), ("emma", 8, "jane", "z"), ("ada", 1, "v", "p")]
    df = spark.createDataFrame(rows, schemas.BOOKS)
    last = queries._last_of_each("books", df)
    assert sorted(map(tuple, last.collect())) == [rows[4], rows[1], rows[2]]
    alone = queries._last_of_each("books", df.filter("name = 'ada'"))
    assert "BroadcastHashJoin" in alone._jdf.queryExecution().executedPlan().toString()


def test_stream_into_a_table_by_name_needs_merge_support(spark, tmp_path):
    root = str(tmp_path / "landing")
    land(users(spark, ("A", "B", "ann@x.org")), root, "users")
    STAGE_MODELS["users"].build(users(spark)).write.saveAsTable("named_users")
    try:
        query = stream_stage(spark, root, "users", "named_users", str(tmp_path / "checkpoint"))
        with pytest.raises(StreamingQueryException, match="MERGE INTO"):
            query.awaitTermination()
    finally:
        spark.sql("DROP TABLE named_users")


def test_stream_can_take_the_latest_row(spark, stream):
    stream(("A", "B", "ann@x.org"))
    for email in ("bob@x.org", "cyd@x.org"):
        land(users(spark, ("A", "B", email)), stream.root, "users")
        time.sleep(0.05)
    state = stream(dedupe="latest")
    assert state == Counter([("A B", "c*****@x.org")])
    with pytest.raises(ValueError):
        stream(dedupe="first")
