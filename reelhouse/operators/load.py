"""Incremental loading: gate, ambiguity guard, keyed upsert, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import load_stamp
from reelhouse.operators.joins import broadcast_bound, join_unique, row_bytes, settled

COPIES_PER_PIECE = 10_000


class AmbiguousUpsert(ValueError):
    """Several source rows match one target row."""


def incremental_gate(
    source: DataFrame,
    target: DataFrame,
    run_ts: str | Column | None = None,
    stamp: str = "reference_date",
    strict: bool = False,
) -> DataFrame:
    """Pass the whole source when the run is later than the target's last load.

    All or nothing: no source column is compared. An empty target passes everything;
    with `strict` it passes nothing, as `run > NULL` does in SQL.
    """
    now = run_ts if isinstance(run_ts, Column) else load_stamp(run_ts)
    later = now > target.agg(F.max(stamp)).scalar()
    return source.filter(later if strict else F.coalesce(later, F.lit(True)))


def _with_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def _source_keys(source: DataFrame, key: str) -> DataFrame:
    """The source's keys, each once, with its number of source rows."""
    return _with_key(source, key).groupBy(key).agg(F.count(F.lit(1)).alias("__source_rows"))


def matched_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys found on both sides, with the number of source rows and of target rows.

    One shuffle of both key columns, counted before it; no join.
    """
    in_source = _with_key(source, key).select(key, F.lit(1).alias("s"), F.lit(0).alias("t"))
    in_target = _with_key(target, key).select(key, F.lit(0).alias("s"), F.lit(1).alias("t"))
    return (
        in_source.unionAll(in_target)
        .groupBy(key)
        .agg(F.sum("s").alias("__source_rows"), F.sum("t").alias("__target_rows"))
        .filter("__source_rows > 0 AND __target_rows > 0")
    )


def ambiguous_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The keys of target rows that several source rows match, and how many of either."""
    return (
        matched_keys(target, source, key)
        .filter("__source_rows > 1")
        .withColumnsRenamed({"__source_rows": "source_rows", "__target_rows": "target_rows"})
    )


def _matched_small(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """As `matched_keys`, without a shuffle of the target."""
    return (
        target.select(key)
        .join(F.broadcast(keys), key)
        .groupBy(key)
        .agg(F.max("__source_rows").alias("__source_rows"), F.count(F.lit(1)).alias("__target_rows"))
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    stored: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The target after merging `source` into it on `key`.

    Matched target rows take every column from the source, other source rows are added,
    other target rows stay. NULL keys never match. Several source rows for one target row
    raise `AmbiguousUpsert`. A target that holds a key n times gets n copies of its source
    row. The checks read the key columns only; they run when this is called.

    The source is written to the shared folder first, unless it is `stored` already, so that it
    is computed once. If its distinct keys take at most `broadcast_bytes` (by default the
    session's threshold for broadcasts) they are broadcast, and the target is not shuffled.
    """
    source = source.select(target.columns)
    source = source if stored else settled(source)
    keys = _source_keys(source, key)
    size = keys.agg(F.sum(row_bytes(keys))).first()[0] or 0
    bound = broadcast_bound(target) if broadcast_bytes is None else broadcast_bytes
    small = size <= bound
    matches = _matched_small(target, keys, key) if small else matched_keys(target, source, key)
    most = matches.agg(F.max("__source_rows"), F.max("__target_rows")).first()
    if (most[0] or 0) > 1:
        example = matches.filter("__source_rows > 1").first()
        raise AmbiguousUpsert(f"{example['__source_rows']} source rows for {key} = {example[key]!r}")
    keyed, keyless = _with_key(target, key), target.filter(F.col(key).isNull())
    if small:
        kept = keyed.join(F.broadcast(keys.select(key)), key, "left_anti")
    else:
        kept = join_unique(keyed, keys.select(key), key, "left_anti")
    merged = kept.unionByName(keyless).unionByName(source)
    if (most[1] or 0) > 1:
        repeated = matches.filter("__target_rows > 1").select(
            key, (F.col("__target_rows") - 1).alias("__extra")
        )
        merged = merged.unionByName(_copies(join_unique(source, repeated, key), key, "__extra"))
    return merged.select(target.columns)


def _copies(df: DataFrame, key: str, times: str) -> DataFrame:
    """Each row `times` times. A large number is cut into pieces for several tasks."""
    last = F.expr(f"({times} - 1) div {COPIES_PER_PIECE}")
    pieces = df.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(
        F.lit(COPIES_PER_PIECE), F.col(times) - F.col("__piece") * COPIES_PER_PIECE
    )
    return (
        pieces.withColumn("__size", size.cast("int"))
        .repartition(key, "__piece")
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__size"))))
        .drop(times, "__piece", "__size", "__copy")
    )


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that sorts last by `order_by`; rows without a key all stay.

    An aggregate instead of a window: copies of a hot key collapse before the shuffle. Rows are
    sorted by key before and after it, since whole rows cannot be kept in a hash aggregate; where
    keys are unique the sort before the shuffle collapses nothing. Remaining ties are broken by
    the row's own values, so the result is deterministic.
    """
    rank = F.struct(*order_by, *[c for c in df.columns if c not in order_by])
    latest = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(rank).alias("__row"))
        .select(*[F.col("__row")[c].alias(c) for c in df.columns])
    )
    return latest.unionByName(df.filter(F.col(key).isNull()))


def by_repeats(df: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame]:
    """The rows whose key no other row has, and the rest, rows without a key included.

    Only keys are shuffled to tell them apart, and `df` is computed twice. If the keys that repeat
    are too many to be broadcast, all rows are the rest.
    """
    again = settled(_source_keys(df, key).filter("__source_rows > 1").select(key))
    size = again.agg(F.sum(row_bytes(again))).first()[0] or 0
    if size > broadcast_bound(df):
        return None, df
    once = _with_key(df, key).join(F.broadcast(again), key, "left_anti")
    met = _with_key(df, key).join(F.broadcast(again), key, "left_semi")
    rest = met.select(df.columns).unionByName(df.filter(F.col(key).isNull()))
    return once.select(df.columns), rest


def latest_of_repeated(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """As `latest_per_key`, where rows whose key comes once pass by without a sort or a shuffle.

    The keys are counted when this is called.
    """
    once, rest = by_repeats(df, key)
    latest = latest_per_key(rest, key, order_by)
    return latest if once is None else once.unionByName(latest)


def upsert_newest(
    target: DataFrame,
    source: DataFrame,
    key: str,
    newest: Sequence[str],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The target after merging a stored `source` into it, where the last row of a key by the
    columns `newest` stays, whether it was in the target or comes with the source.

    Rows that tie are told apart by their values, so any order of several merges gives the same
    table. A key is kept once; rows without a key all stay. Only target rows whose key the source
    has are compared; the others pass by without a shuffle if the source's keys are few.
    """
    source = source.select(target.columns)
    keys = _source_keys(source, key).select(key)
    size = keys.agg(F.sum(row_bytes(keys))).first()[0] or 0
    bound = broadcast_bound(target) if broadcast_bytes is None else broadcast_bytes
    keyed, keyless = _with_key(target, key), target.filter(F.col(key).isNull())
    if size <= bound:
        kept, met = (keyed.join(F.broadcast(keys), key, how) for how in ("left_anti", "left_semi"))
    else:
        kept, met = (join_unique(keyed, keys, key, how) for how in ("left_anti", "left_semi"))
    last = latest_per_key(met.unionByName(source), key, newest)
    return kept.unionByName(keyless).unionByName(last).select(target.columns)


def merge_into_table(
    source: DataFrame, table: str, key: str, newest: Sequence[str] = ()
) -> None:
    """Upsert into a catalog table whose format supports row-level changes.

    The table format rewrites only the files it must, which suits large targets with
    small changes. Plain Parquet tables do not support it. With `newest`, a matched row changes
    only if the source's comes after it by these columns.
    """
    later = None
    if newest:
        theirs, ours = (F.struct(*(F.col(f"{side}.{c}") for c in newest)) for side in ("source", table))
        later = theirs > ours
    (
        source.alias("source")
        .mergeInto(table, F.col(f"{table}.{key}") == F.col(f"source.{key}"))
        .whenMatched(later)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
