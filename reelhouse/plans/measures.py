"""Small tables kept beside the sessions, part by part, from which several questions are answered.

A measure is what one grouped pass over a part of the sessions leaves. It is kept in the same parts
as the sessions, and each part of it knows the load that it was made from, so only parts that a
merge has changed are read again. Questions then read the measure instead of the sessions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.plans.trusted import session_hours
from reelhouse.sources.snapshots import LOAD, PART, SnapshotTable, State

#: Size of a sketch. The rank of its answers is wrong by at most 2.296 / SKETCH ** 0.9723 of the
#: rows (0.14 %) with 99 % confidence; it takes some 50 KB for each part.
SKETCH = 2048


def title_days(sessions: DataFrame) -> DataFrame:
    """Per part and title: its sessions, those with both times, and their complete hours.

    Answers how many titles were streamed, which ones, and for how long on average.
    """
    return session_hours(sessions).groupBy(PART, LOAD, "movie_title").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count("hours").alias("timed"),
        F.coalesce(F.sum("hours"), F.lit(0)).alias("hours"),
    )


def size_sketches(sessions: DataFrame) -> DataFrame:
    """Per part: a quantile sketch of the sizes. Sketches of parts merge into one of all rows."""
    sizes = sessions.select(PART, LOAD, F.col("size_mb").cast("double").alias("size"))
    return sizes.groupBy(PART, LOAD).agg(F.kll_sketch_agg_double("size", F.lit(SKETCH)).alias("sizes"))


@dataclass(frozen=True)
class Measure:
    """A table made from the parts of another one."""

    name: str
    of: str
    build: Callable[[DataFrame], DataFrame]


MEASURES = {
    m.name: m for m in (Measure("title_days", "streams", title_days), Measure("size_sketches", "streams", size_sketches))
}


def measure_table(spark: SparkSession, warehouse: str, name: str) -> SnapshotTable:
    path = f"{warehouse.rstrip('/')}/measures/{name}"
    return SnapshotTable(spark, path, F.col("part"), facts={"of_load": F.max("of_load")})


def refresh(measure: Measure, table: SnapshotTable, source: SnapshotTable, state: State) -> int:
    """Bring a measure in line with a version of its source; returns the measure's version.

    Reads the source's parts that have another load than the measure's, and no others. If there
    are none, and none has gone, nothing is written.
    """
    ours = table.state()
    known = {} if ours is None else {p: f["of_load"] for p, f in ours.facts.items()}
    changed = [p for p, load in state.loads.items() if known.get(p) != load]
    gone = [p for p in known if p not in state.loads]
    if ours is not None and not changed and not gone:
        return ours.version
    made = measure.build(source.read(state, changed, with_loads=True))
    made = made.withColumnsRenamed({PART: "part", LOAD: "of_load"})
    return table.write(made, state=ours, parts=None if ours is None else [*changed, *gone])
