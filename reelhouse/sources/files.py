"""Reading source files and writing records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelhouse.session import CODEC

# Texts that stand for a missing value in the source files.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header line, cast to the declared schema.

    Header names and the number of fields must fit the schema, and values must fit their
    type, else the query fails. `multiline` allows line breaks inside quotes, at the price
    of one task per file.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema])
    raw = (
        spark.read.schema(texts)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return raw.select(
        *[
            F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def read_json_records(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False
) -> DataFrame:
    """JSON records: one per line, or arrays of records that fill one line each.

    Anything else fails the query. `multiline` reads files that hold one array spread over
    many lines; such a file cannot be split, so it is one task's work.
    """
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .json(path)
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of `schema`, in its order and types.

    Written files must carry exactly the declared types: a 64-bit file column cannot be
    read back as a 32-bit one.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_records(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Write rows as Parquet or as JSON records, one per line."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown format {fmt!r}, expected 'parquet' or 'json'")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    else:
        writer = writer.option("compression", CODEC)
    writer.save(path)
