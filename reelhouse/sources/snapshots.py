"""Tables kept as Parquet loads with one commit file per version, whole or in parts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.session import CODEC, estimated_bytes
from reelhouse.sources import store

#: Names of the columns that hold a row's part and load.
PART, LOAD = "__part", "__load"
_WHOLE = ""
#: Parts by key are cut so that one holds about as much, and at most so many.
PART_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 1 << 17
#: Lists of taken files that are kept apart before they are written as one.
LEDGER_LISTS = 16

Facts = dict[str, float | int | str | None]


class ConcurrentWrite(RuntimeError):
    """Another writer committed a version in between."""


@dataclass(frozen=True)
class State:
    """What one version consists of: the load that holds each part (one without a name, if the
    table is not kept in parts), what is known of each part, the number of buckets that keys are
    dealt to, the last micro-batch of each stream, the lists of the landing files taken, and what
    the rows were calculated from."""

    version: int
    columns: str
    loads: dict[str, str]
    facts: dict[str, Facts] = field(default_factory=dict)
    buckets: int = 1
    batches: dict[str, int] = field(default_factory=dict)
    taken: tuple[str, ...] = ()
    made_of: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))

    @property
    def contents(self) -> str:
        """A digest of the loads, which no other contents of any table have."""
        return hashlib.md5(json.dumps(sorted(self.loads.items())).encode()).hexdigest()

    def parts_where(self, wanted: Callable[[Facts], bool]) -> list[str]:
        """The parts whose facts do not rule out what is wanted; one without facts is wanted."""
        return sorted(p for p in self.loads if p not in self.facts or wanted(self.facts[p]))


class SnapshotTable:
    """A table whose every write makes a new version.

    Data goes into a folder of its own for each load, and a version counts once its commit file is
    there. Readers never see a failed or running write, and a job may read the version it replaces.
    A version is committed once only: of two writers that replace the same one, however they
    overlap, one fails (`store.publish`). A commit file names all parts, so one small file tells a
    table's state.

    A table can be kept in parts, by `part`, an expression over the rows that gives a plain name (a
    date, say), or by `key`: a hash of the key gives the part, and the number of parts follows the
    table's size. A write can then replace some parts and leave the others, which are neither read
    nor written. `facts` are aggregates that are kept for every part with the commit, so that a
    reader can tell which parts it needs. Old loads stay until `expire` is called.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        part: Column | None = None,
        key: str | None = None,
        facts: Mapping[str, Column] | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.part = part
        self.key = key
        self.facts = dict(facts or {})

    @property
    def in_parts(self) -> bool:
        return self.part is not None or self.key is not None

    def state(self, version: int | None = None) -> State | None:
        """The current state, or that of an older version; None before the first commit."""
        if version is None:
            versions = self._versions()
            if not versions:
                return None
            version = versions[-1]
        told = json.loads(store.read_text(self.spark, self._commit_path(version)))
        return State(**told | {"taken": tuple(told["taken"])})

    def version(self) -> int | None:
        """The current version, or None before the first commit."""
        return max(self._versions(), default=None)

    def last_batch(self, stream: str) -> int | None:
        """The last micro-batch of a stream that reached the table."""
        state = self.state()
        return None if state is None else state.batches.get(stream)

    def read(
        self,
        version: int | State | None = None,
        parts: Iterable[str] | None = None,
        with_loads: bool = False,
    ) -> DataFrame:
        """A version's rows; with `parts`, only those parts are opened.

        `with_loads` adds the part and the load of each row, of a table in parts.
        """
        state = version if isinstance(version, State) else self.state(version)
        if state is None:
            raise ValueError(f"no committed version in {self.path}")
        schema = state.schema
        if not self.in_parts:
            return self.spark.read.schema(schema).parquet(self._folder(state.loads[_WHOLE]))
        if with_loads:
            schema = T.StructType([*schema, *(T.StructField(c, T.StringType()) for c in (PART, LOAD))])
        wanted = state.loads if parts is None else set(parts)
        folders = [f"{self._folder(at)}/{PART}={p}" for p, at in state.loads.items() if p in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*schema.names)

    def parts_in(self, df: DataFrame, state: State | None = None) -> list[str]:
        """The names of the parts that rows belong to."""
        part = self._part(state.buckets if state else 1)
        return sorted(r[0] for r in df.select(part.alias(PART)).distinct().collect())

    def crowded(self, state: State) -> bool:
        """Whether parts by key hold more than twice what they should."""
        return self.key is not None and _held(state) > 2 * PART_BYTES * state.buckets

    def write(
        self,
        df: DataFrame,
        sort_by: tuple[str, ...] = (),
        stream: str | None = None,
        batch: int | None = None,
        state: State | None = None,
        parts: Iterable[str] | None = None,
        taken: Iterable[str] = (),
        made_of: Mapping[str, str] | None = None,
    ) -> int:
        """Write `df` as the next version and commit it.

        `sort_by` orders rows inside each task's files, without a shuffle, so that row-group
        statistics on those columns become selective. A streaming writer also records its stream
        and micro-batch, a batch writer the lists of the landing files it has `taken`. `state` is
        the state that the rows were made from, if it is known; with `parts`, only these parts are
        replaced, by rows of no other. `made_of` names what the rows were calculated from.
        """
        state = state or self.state()
        version = 1 if state is None else state.version + 1
        load = f"{version:06d}-{uuid.uuid4().hex[:8]}"
        buckets = state.buckets if state else 1
        if parts is None and self.key is not None:
            buckets = buckets_for(max(estimated_bytes(df), _held(state) if state else 0))
        facts = self._write_load(df, load, sort_by, buckets)
        gone = set(state.loads if parts is None else parts) if state else set()
        loads = {p: at for p, at in state.loads.items() if p not in gone} if state else {}
        known = {p: f for p, f in state.facts.items() if p not in gone} if state else {}
        batches = dict(state.batches) if state else {}
        if stream is not None:
            batches[stream] = batch
        self._commit(
            State(
                version,
                df.schema.json(),
                loads | dict.fromkeys(facts, load),
                known | {p: f for p, f in facts.items() if f},
                buckets,
                batches,
                tuple(taken),
                dict(made_of or {}),
            )
        )
        return version

    def _write_load(self, df: DataFrame, load: str, sort_by: tuple[str, ...], buckets: int) -> dict[str, Facts]:
        """The parts written, and what is known of them."""
        folder = self._folder(load)
        if not self.in_parts:
            (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(folder, compression=CODEC)
            return {_WHOLE: {}}
        rows = df.withColumn(PART, self._part(buckets))
        if self.part is not None or buckets > 1:
            # adaptive execution cuts large parts into several tasks and joins small ones
            rows = rows.hint("rebalance", PART)
        rows.sortWithinPartitions(PART, *sort_by).write.partitionBy(PART).parquet(folder, compression=CODEC)
        schema = T.StructType([*df.schema, T.StructField(PART, T.StringType())])
        asked = {"rows": F.count(F.lit(1)), **self.facts}
        told = (
            self.spark.read.schema(schema)
            .parquet(folder)
            .groupBy(PART)
            .agg(*(c.alias(name) for name, c in asked.items()))
            .collect()
        )
        found = {r[PART]: {name: r[name] for name in asked} for r in told}
        if self.key is not None:
            size, total = store.total_bytes(self.spark, folder), sum(f["rows"] for f in found.values())
            for f in found.values():
                f["bytes"] = size * f["rows"] // total
        return found

    def ledger(self, state: State) -> DataFrame | None:
        """(landed_in, landed_at) of the landing files that a version has taken; None if none."""
        if not state.taken:
            return None
        return self.spark.read.parquet(*(self._list(name) for name in state.taken))

    def take(self, files: DataFrame, state: State | None = None) -> tuple[str, ...]:
        """List landing files as taken, beside those of `state`; the names of the lists, which count
        once a write commits them."""
        name, before = uuid.uuid4().hex, state.taken if state else ()
        if len(before) >= LEDGER_LISTS:
            files, before = files.unionByName(self.ledger(state)), ()
        files.write.parquet(self._list(name))
        return (*before, name)

    def _commit(self, state: State) -> None:
        if not store.publish(self.spark, self._commit_path(state.version), json.dumps(asdict(state))):
            raise ConcurrentWrite(f"version {state.version} of {self.path} is already committed")

    def expire(self, keep: int) -> int:
        """Delete what none of the last `keep` versions uses; returns the number of loads deleted.

        Loads that may belong to a running write are left alone.
        """
        versions = self._versions()
        kept = [self.state(v) for v in versions[-keep:]]
        if not kept:
            return 0
        used = {load for s in kept for load in s.loads.values()}
        lists = {name for s in kept for name in s.taken}
        first_running = f"{versions[-1] + 1:06d}"
        loads = (name.removeprefix(f"{LOAD}=") for name in store.names(self.spark, f"{self.path}/data"))
        gone = [load for load in loads if load not in used and load < first_running]
        for load in gone:
            store.delete(self.spark, self._folder(load))
        old = {name for v in versions[:-keep] for name in self.state(v).taken} - lists
        for name in old:
            store.delete(self.spark, self._list(name))
        for version in versions[:-keep]:
            store.delete(self.spark, self._commit_path(version))
        return len(gone)

    def _part(self, buckets: int) -> Column:
        if self.part is not None:
            return self.part
        return F.lpad(F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("string"), 6, "0")

    def _versions(self) -> list[int]:
        found = store.names(self.spark, f"{self.path}/commits")
        return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0].isdigit()]

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def _folder(self, load: str) -> str:
        return f"{self.path}/data/{LOAD}={load}"

    def _list(self, name: str) -> str:
        return f"{self.path}/ledger/{name}"


def _held(state: State) -> int:
    return sum(f.get("bytes", 0) for f in state.facts.values())


def buckets_for(size: int) -> int:
    """The least power of two that leaves a bucket at most `PART_BYTES`."""
    buckets = 1
    while buckets < MOST_BUCKETS and size > buckets * PART_BYTES:
        buckets *= 2
    return buckets
