"""The whole pipeline as one Spark application: landing, stage, trusted."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators.joins import settled
from reelhouse.operators.load import incremental_gate, latest_of_repeated, latest_per_key, upsert, upsert_newest
from reelhouse.plans import trusted
from reelhouse.plans.lineage import run_in_order
from reelhouse.plans.measures import MEASURES, Measure, measure_table, refresh
from reelhouse.plans.stage import STAGE_MODELS, RunTime, StageModel
from reelhouse.session import estimated_bytes, sized_shuffles
from reelhouse.sources.landing import landing_files, scan
from reelhouse.sources.snapshots import Facts, SnapshotTable, State

FILE_COLUMNS = ("landed_at", "landed_in")
SELECTIONS = ("internal", "vendor", "stage", "trusted")


@dataclass(frozen=True)
class Questions:
    """Parameters of the trusted models; without a title or slug, all are counted."""

    outage_title: str | None
    outage_start: str
    outage_end: str
    author_slug: str | None
    half_since: str


@dataclass(frozen=True)
class TrustedModel:
    """A question and the stage tables and measures it reads, in argument order.

    `near` tells from the facts of a part of the sessions whether the question needs it.
    """

    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    answer: str
    options: Callable[[Questions], tuple] = field(default=lambda q: ())
    near: Callable[[Questions], Callable[[Facts], bool]] | None = None

    def made_of(self, stage: Callable[[str], StoredTable], questions: Questions) -> dict[str, str]:
        """What the answer depends on: the tables' contents and the options."""
        contents = {name: stage(name).state.contents for name in self.reads}
        return contents | {"options": repr(self.options(questions))}

    def run(self, stage: Callable[[str], StoredTable], questions: Questions) -> DataFrame:
        tables = []
        for name in self.reads:
            stored = stage(name)
            parts = None
            if name == "streams" and self.near is not None:
                parts = stored.state.parts_where(self.near(questions))
            tables.append(stored.table.read(stored.state, parts))
        return self.build(*tables, *self.options(questions))


@dataclass(frozen=True)
class StoredTable:
    """A table in one of its versions."""

    table: SnapshotTable
    state: State

    def read(self) -> DataFrame:
        return self.table.read(self.state)


TRUSTED_MODELS = {
    model.name: model
    for model in (
        TrustedModel(
            "adaptation_share", ("title_days", "reviews"), trusted.adaptation_share, "adapted_share"
        ),
        TrustedModel(
            "users_in_window",
            ("streams",),
            trusted.users_in_window,
            "users_affected",
            lambda q: (q.outage_title, q.outage_start, q.outage_end),
            lambda q: trusted.near_window(q.outage_start, q.outage_end),
        ),
        TrustedModel(
            "adaptations_by_author_origin",
            ("title_days", "reviews", "books", "authors"),
            trusted.adaptations_by_author_origin,
            "adaptations",
            lambda q: (q.author_slug,),
        ),
        TrustedModel("mean_session_hours", ("title_days",), trusted.mean_of_title_days, "mean_hours"),
        TrustedModel("median_size_gb", ("streams",), trusted.median_size_gb, "median_size_gb"),
        TrustedModel(
            "users_past_half",
            ("streams", "movies"),
            trusted.users_past_half,
            "users_past_half",
            lambda q: (q.half_since,),
            lambda q: trusted.near_start(q.half_since),
        ),
    )
}


def snapshot_of(spark: SparkSession, path: str, name: str) -> SnapshotTable:
    """The stored table of a stage model: in parts of its own, or by its key."""
    model = STAGE_MODELS[name]
    if model.part is None:
        return SnapshotTable(spark, path, key=model.key, facts=model.facts())
    return SnapshotTable(spark, path, model.part(), facts=model.facts())


def stage_table(spark: SparkSession, warehouse: str, name: str) -> SnapshotTable:
    return snapshot_of(spark, f"{warehouse.rstrip('/')}/stage/{name}", name)


def trusted_table(spark: SparkSession, warehouse: str, name: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{warehouse.rstrip('/')}/trusted/{name}")


def staged_rows(
    model: StageModel, landing: DataFrame, run_ts: RunTime = None, dedupe: str | None = None
) -> DataFrame:
    """The model's projection, optionally with only the last landed row of each key.

    `dedupe="latest"` needs the file columns that `scan(..., file_times=True)` adds.
    """
    if dedupe is None:
        return model.build(landing, run_ts)
    if dedupe != "latest":
        raise ValueError(f"dedupe must be None or 'latest', not {dedupe!r}")
    staged = model.build(landing, run_ts, carry=FILE_COLUMNS)
    return latest_of_repeated(staged, model.key, FILE_COLUMNS).drop(*FILE_COLUMNS)


def _gate_shut(table: SnapshotTable, state: State, run_ts: RunTime, strict: bool) -> bool:
    # The gate compares no source row, so one row stands for all of them.
    one_row = table.spark.range(1)
    return incremental_gate(one_row, table.read(state), run_ts, strict=strict).isEmpty()


def load_stage(
    table: SnapshotTable,
    model: StageModel,
    staged: DataFrame,
    full_refresh: bool = False,
    run_ts: RunTime = None,
    strict: bool = False,
) -> int:
    """Bring a stage table up to date and return its version.

    Without a table, or on a full refresh, the staged rows become the table as they are,
    duplicates included. Otherwise, if the incremental gate is open, they are merged by key.
    """
    state = table.state()
    if state is None or full_refresh:
        return table.write(staged, model.sort_by, state=state)
    if _gate_shut(table, state, run_ts, strict):
        return state.version
    return merge_rows(table, model, staged, state=state)


def load_arrivals(
    table: SnapshotTable,
    model: StageModel,
    root: str,
    full_refresh: bool = False,
    run_ts: RunTime = None,
    strict: bool = False,
    dedupe: str | None = None,
) -> int:
    """Bring a stage table up to date with the landing files below `root`; returns its version.

    The table's commit lists the files that it has taken. Without a table, or on a full refresh,
    all files make the table. Otherwise, if the gate is open, only files that no commit lists are
    opened and merged; if there are none, nothing is written. Files that arrive during the run are
    the next run's. The driver gets the names of the files to read, as Spark's own scan does.
    """
    spark, state = table.spark, table.state()
    whole = state is None or full_refresh
    if not whole and _gate_shut(table, state, run_ts, strict):
        return state.version
    files = landing_files(spark, root, model.name)
    seen = None if whole else table.ledger(state)
    if seen is not None:
        files = files.join(seen, ["landed_in", "landed_at"], "left_anti")
    files = settled(files)
    names = [row["landed_in"] for row in files.select("landed_in").collect()]
    if not names and not whole:
        return state.version
    rows = scan(spark, root, model.name, file_times=True, files=names)
    staged = staged_rows(model, rows, run_ts, dedupe)
    if whole:
        return table.write(staged, model.sort_by, state=state, taken=table.take(files))
    return merge_rows(table, model, staged, state=state, taken=table.take(files, state))


def merge_rows(
    table: SnapshotTable,
    model: StageModel,
    staged: DataFrame,
    stream: str | None = None,
    batch: int | None = None,
    state: State | None = None,
    taken: tuple[str, ...] | None = None,
    newest: tuple[str, ...] = (),
) -> int:
    """Merge staged rows into the table, or start it with them; returns the new version.

    Of a table in parts, only the parts that the staged rows belong to are read and written; a
    table whose parts by key have grown too large is written anew, in more of them. With `newest`,
    columns of both, a key keeps the row that comes last by them, whichever was there first.
    The landing files that the table has taken stay as they are unless `taken` names others; a
    stream has its own account of its files, so a table is kept either by streams or by runs.
    """
    state = state or table.state()
    if state is None:
        if newest:
            staged = latest_per_key(staged, model.key, newest)
        return table.write(staged, model.sort_by, stream, batch, taken=taken or ())
    if taken is None:
        taken = state.taken
    staged = settled(staged)
    parts = None
    if table.in_parts and not table.crowded(state):
        parts = table.parts_in(staged, state)
    target = table.read(state, parts)
    if newest:
        merged = upsert_newest(target, staged, model.key, newest)
    else:
        merged = upsert(target, staged, model.key, stored=True)
    return table.write(merged, model.sort_by, stream, batch, state, parts, taken)


def edges() -> dict[str, set[str]]:
    """What each model needs, from what the models themselves read."""
    stage = {f"stage.{name}": set() for name in STAGE_MODELS}
    measures = {f"measure.{m.name}": {f"stage.{m.of}"} for m in MEASURES.values()}
    return stage | measures | {
        f"trusted.{m.name}": {_node(name) for name in m.reads} for m in TRUSTED_MODELS.values()
    }


def _node(name: str) -> str:
    return f"measure.{name}" if name in MEASURES else f"stage.{name}"


def run_pipeline(
    landing: Mapping[str, DataFrame] | str,
    warehouse: str,
    full_refresh: bool = True,
    select: str | None = None,
    questions: Questions | None = None,
    run_ts: RunTime = None,
    dedupe: str | None = None,
    strict: bool = False,
    input_bytes: int | None = None,
) -> dict[str, DataFrame]:
    """Run stage models and trusted models and return the tables written.

    `landing` is the landing zone's root, or a DataFrame for each entity. From a root, a run with
    `full_refresh=False` opens only the files that have landed since (`load_arrivals`); DataFrames
    are merged whole.

    An answer is calculated again only if a table that it reads has other contents, or its options
    have changed. Questions about titles and hours read one grouped pass over the sessions, which is kept for
    each part of them and made again only for parts that have changed (`plans.measures`).

    A model starts as soon as those that it reads are done (`lineage.run_in_order`). Shuffles are
    sized for `input_bytes`, by default the size of the landing files.

    `select` limits the run: an origin tag ("internal", "vendor") or a layer ("stage",
    "trusted"). Trusted models read the stage tables as stored, never the landing rows,
    and answer `questions`.
    """
    if select is not None and select not in SELECTIONS:
        raise ValueError(f"unknown selection {select!r}, expected one of {SELECTIONS}")
    if select in (None, "trusted") and questions is None:
        raise ValueError("trusted models need their questions")
    spark = SparkSession.active()
    staged = [m for m in STAGE_MODELS.values() if select in (None, "stage", m.tag)]
    if input_bytes is None:
        frames = (scan(spark, landing, m.name) for m in staged) if isinstance(landing, str) else landing.values()
        input_bytes = sum(estimated_bytes(df) for df in frames)
    done: dict[str, StoredTable] = {}

    def stored(name: str, table: SnapshotTable, version: int | None = None) -> StoredTable:
        done[name] = StoredTable(table, table.state(version))
        return done[name]

    def found(name: str) -> StoredTable:
        return done.get(_node(name)) or stored(_node(name), stage_table(spark, warehouse, name))

    def measure(asked: Measure) -> StoredTable:
        table, source = measure_table(spark, warehouse, asked.name), found(asked.of)
        version = refresh(asked, table, source.table, source.state)
        return stored(f"measure.{asked.name}", table, version)

    def load(model: StageModel) -> StoredTable:
        table = stage_table(spark, warehouse, model.name)
        if isinstance(landing, str):
            version = load_arrivals(table, model, landing, full_refresh, run_ts, strict, dedupe)
        else:
            rows = staged_rows(model, landing[model.name], run_ts, dedupe)
            version = load_stage(table, model, rows, full_refresh, run_ts, strict)
        return stored(f"stage.{model.name}", table, version)

    def answer(model: TrustedModel) -> StoredTable:
        table = trusted_table(spark, warehouse, model.name)
        state, made_of = table.state(), model.made_of(found, questions)
        if state is None or state.made_of != made_of:
            version = table.write(model.run(found, questions), state=state, made_of=made_of)
            return stored(f"trusted.{model.name}", table, version)
        return stored(f"trusted.{model.name}", table, state.version)

    models = {f"stage.{m.name}": partial(load, m) for m in staged}
    if select in (None, "trusted"):
        read = {name for model in TRUSTED_MODELS.values() for name in model.reads}
        models |= {f"measure.{m.name}": partial(measure, m) for m in MEASURES.values() if m.name in read}
        models |= {f"trusted.{m.name}": partial(answer, m) for m in TRUSTED_MODELS.values()}
    with sized_shuffles(spark, input_bytes):
        written = run_in_order(spark, models, edges())
    return {name: made.read() for name, made in written.items() if not name.startswith("measure.")}


def expire_warehouse(spark: SparkSession, warehouse: str, keep: int) -> dict[str, int]:
    """Delete the loads that none of the last `keep` versions of any table uses; how many of each."""
    tables = {f"stage.{name}": stage_table(spark, warehouse, name) for name in STAGE_MODELS}
    tables |= {f"measure.{name}": measure_table(spark, warehouse, name) for name in MEASURES}
    tables |= {f"trusted.{name}": trusted_table(spark, warehouse, name) for name in TRUSTED_MODELS}
    return {name: table.expire(keep) for name, table in tables.items()}


def summary(written: Mapping[str, DataFrame]) -> DataFrame:
    """One row per trusted model: its name and its answer as a double."""
    rows = [
        written[f"trusted.{model.name}"].select(
            F.lit(model.name).alias("metric"), F.col(model.answer).cast("double").alias("answer")
        )
        for model in TRUSTED_MODELS.values()
    ]
    return reduce(DataFrame.unionByName, rows)
