"""The landing zone: append-only datasets by origin, entity and format."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.schemas import ENTITIES, Entity, entities_in
from reelhouse.sources.files import conform, read_csv, read_json_records, write_records


def landing_path(root: str, entity: Entity, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{entity.origin}/{entity.name}/{fmt}"


def land(
    df: DataFrame, root: str, name: str, fmt: str = "parquet", load_id: str | None = None
) -> str:
    """Append rows to a landing dataset and return its path.

    Nothing is replaced: landing the same rows twice stores them twice. A `load_id` (letters,
    digits, `-` and `_`) names the load instead: it gets a folder of its own in the dataset, and
    landing it again, as a repeated task does, replaces that load and no other.
    """
    entity = ENTITIES[name]
    path = landing_path(root, entity, fmt)
    rows = conform(df, entity.schema)
    if load_id is None:
        write_records(rows, path, fmt)
    elif re.fullmatch(r"[\w-]+", load_id, re.ASCII):
        write_records(rows, f"{path}/load-{load_id}", fmt, mode="overwrite")
    else:
        raise ValueError(f"a load id has letters, digits, - and _ only, not {load_id!r}")
    return path


def read_source(spark: SparkSession, path: str, name: str, multiline: bool = False) -> DataFrame:
    """A source file of an entity, by the file type the entity arrives in."""
    entity = ENTITIES[name]
    read = read_csv if entity.source_format == "csv" else read_json_records
    return read(spark, path, entity.schema, multiline)


def ingest(
    spark: SparkSession,
    files: Mapping[str, str],
    root: str,
    group: str = "all",
    fmt: str = "parquet",
    multiline: bool = False,
    load_id: str | None = None,
) -> dict[str, str]:
    """Land the source files of a group; returns the landing path per entity."""
    return {
        entity.name: land(
            read_source(spark, files[entity.name], entity.name, multiline), root, entity.name, fmt, load_id
        )
        for entity in entities_in(group)
    }


def landing_files(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """(landed_in, landed_at): the files of a landing dataset and their times, none of them
    opened. Files without a byte are not listed."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing_path(root, ENTITIES[name], fmt))
    return listing.select(
        F.col("path").alias("landed_in"), F.col("modificationTime").alias("landed_at")
    )


def scan(
    spark: SparkSession,
    root: str,
    name: str,
    fmt: str = "parquet",
    file_times: bool = False,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """A landing dataset with its declared schema, addressed by entity name.

    `file_times` adds `landed_at` and `landed_in`, the time and path of each row's file. With
    `files`, only these of the dataset's files are read.
    """
    entity = ENTITIES[name]
    where = [landing_path(root, entity, fmt)] if files is None else list(files)
    if not where:
        df = spark.createDataFrame([], entity.schema)
        return df.withColumns({"landed_at": F.lit(None).cast("timestamp"), "landed_in": F.lit("")}) if file_times else df
    reader = spark.read.schema(entity.schema).option("recursiveFileLookup", True)
    df = reader.format(fmt).load(where)
    if file_times:
        df = df.select(
            "*", "_metadata.file_modification_time", "_metadata.file_path"
        ).withColumnsRenamed(
            {"file_modification_time": "landed_at", "file_path": "landed_in"}
        )
    return df


def register_sources(spark: SparkSession, root: str, group: str = "all") -> dict[str, DataFrame]:
    """Scan a group's datasets and expose each as a temporary view `<origin>_<entity>`."""
    tables = {}
    for entity in entities_in(group):
        tables[entity.name] = scan(spark, root, entity.name)
        tables[entity.name].createOrReplaceTempView(f"{entity.origin}_{entity.name}")
    return tables
