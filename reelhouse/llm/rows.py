"""Small helpers that the operators share: typed batches, column choice, plain words."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelhouse.session import estimated_bytes

#: A word: a run of characters that are not ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Lower-casing of A-Z alone.
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chosen(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns under the operator's own names; others never clash."""
    return df.select(*(df[f"`{source}`"].alias(name) for name, source in columns.items()))


def release() -> None:
    """Give freed memory back to the system, so that a worker between tasks holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def over_batches(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Map Arrow batches: `make()` runs once per task and returns a function that takes the
    batch's columns and returns the columns of `schema`."""
    struct = T.StructType.fromDDL(schema)

    def run(batches):
        target = to_arrow_schema(struct)
        fn = make()
        for batch in batches:
            made = fn(*batch.columns)
            del batch
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type)
                    for c, f in zip(made, target, strict=True)
                ],
                schema=target,
            )
            del made
        del fn
        release()

    return df.mapInArrow(run, struct)


def bucket_count(df: DataFrame, each: int = 1 << 25) -> int:
    """How many buckets leave about `each` bytes of the files that `df` reads in one, so that a
    bucket fits in a task's memory whatever the input; at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-estimated_bytes(df) // each))


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column; null gives no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))
