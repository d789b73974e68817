"""Session settings and the scratch folder of a run."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024
#: How Parquet files of the landing zone and of tables are compressed: texts take about two thirds of
#: what Spark's default leaves.
CODEC = "zstd"
#: What the planner gives for inputs whose size it does not know.
UNKNOWN_SIZE = 2**63 - 1
#: Beyond this, the bookkeeping of a shuffle costs more than larger partitions do.
MAX_PARTITIONS = 1_000_000


def local_session(
    cores: int | str = "*", app: str = "reelhouse", options: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    parallelism = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parallelism))
    )
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def estimated_bytes(df: DataFrame) -> int:
    """The size of what a DataFrame reads, as Spark's planner knows it: of files, their length.

    Inputs of unknown size count as nothing.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_SIZE)


def comes_from_input(df: DataFrame, *columns: str) -> bool:
    """Whether columns are read as they are, and not calculated by the query."""
    if not set(columns) <= set(df.columns):
        return False
    plan = df.select(*columns)._jdf.queryExecution().analyzed()
    leaves, asked = plan.collectLeaves(), plan.output()
    read = [leaves.apply(i).outputSet() for i in range(leaves.size())]
    return all(any(r.contains(asked.apply(i)) for r in read) for i in range(asked.size()))


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """How many partitions leave at most `TARGET_SHUFFLE_BYTES` of the input in each; the session's
    own number is the least."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_PARTITIONS, max(least, -(-input_bytes // TARGET_SHUFFLE_BYTES)))


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Start shuffles with enough partitions for `input_bytes`; the session's settings come back
    at the end.

    Adaptive execution merges partitions that turn out small, but it never adds any:
    with the default of 200, a 100 TB shuffle would make 500 GB partitions.
    """
    partitions = shuffle_partitions(spark, input_bytes)
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TARGET_SHUFFLE_BYTES,
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield partitions
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_root(spark: SparkSession) -> str | None:
    """The folder below the shared `spark.checkpoint.dir` that holds all scratch folders of this
    application; None if no such folder is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared and f"{shared.rstrip('/')}/reelhouse-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the application's scratch root.

    Only a local master may fall back to the machine's temporary folder; such a folder is removed
    when the program ends. On a cluster folders stay, because results are read from them lazily,
    until `clear_scratch` is called or the root is deleted.
    """
    root = scratch_root(spark)
    if root:
        return f"{root}/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="reelhouse-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/run"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all scratch folders of this application, once its results have been stored elsewhere;
    whether there were any. DataFrames that still read from them fail afterwards."""
    root = scratch_root(spark)
    if not root:
        return False
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
