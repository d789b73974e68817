"""Joins against a side that holds each key once, safe for hot keys on the other side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reelhouse.session import CODEC, scratch_dir

ROW_OVERHEAD_BYTES = 64
_HASH = "__key_hash"


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to a large grouped or distinct side on `key`.

    Spark broadcasts the right side when its size is below the session's threshold, at
    planning or at run time. Otherwise both sides are shuffled and adaptive execution
    splits hot partitions of the left side. It only does so when a shuffle lies directly
    below the join's sort on both sides. A grouped side would reuse the shuffle below its
    aggregate; joining on a hash of the key as well gives it a (small) shuffle of its own.
    """
    hashed = F.xxhash64(F.col(key))
    joined = left.withColumn(_HASH, hashed).join(
        right.withColumn(_HASH, hashed), [key, _HASH], how
    )
    return joined.drop(_HASH)


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder once, so that they are not computed again."""
    folder = scratch_dir(df.sparkSession)
    df.write.parquet(folder, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def join_dimension(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to a grouped side that is usually small.

    The right side is settled, so it is computed once and Spark knows its size when it plans:
    below the session's threshold for broadcasts the left side is not shuffled at all, and
    beyond it both are, with hot partitions of the left side split.
    """
    return left.join(settled(right), key, how)


def broadcast_bound(df: DataFrame) -> int:
    """The session's threshold for broadcasts, in bytes; -1 if there are to be none."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    for unit, factor in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if text.endswith(unit):
            return int(text.removesuffix(unit)) * factor
    return int(text)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, StringType)
        else F.lit(8)
        for f in df.schema
    ]
    return sum(sizes, F.lit(ROW_OVERHEAD_BYTES)).cast("bigint")
