"""Reading source files without losing rows that do not fit: they go to a reject table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelhouse.schemas import ENTITIES
from reelhouse.session import scratch_dir
from reelhouse.sources.files import NULL_TOKENS
from reelhouse.sources.landing import land

_TEXT, _FILE, _REASON, _FITS = "__text", "__file", "__reason", "__fits"
REJECTS = "source_file string, record string, reason string"


def _checked_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> DataFrame:
    """CSV rows with all their values as declared or, if one does not fit, with the reason.

    A header that does not fit is not a matter of rows and fails the query.
    """
    texts = StructType([*(StructField(f.name, StringType()) for f in schema), StructField(_TEXT, StringType())])
    raw = (
        spark.read.schema(texts)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _TEXT)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias(_FILE))
    )
    values, reasons = [], [F.when(F.col(_TEXT).isNotNull(), "number of fields")]
    for f in schema:
        given = F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name))
        value = given.try_cast(f.dataType)
        values.append(value.alias(f.name))
        reasons.append(F.when(given.isNotNull() & value.isNull(), f"{f.name} is no {f.dataType.simpleString()}"))
    record = F.coalesce(_TEXT, F.to_csv(F.struct(*schema.names)))
    return raw.select(*values, *_told(record, F.coalesce(*reasons)))


def _checked_json(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> DataFrame:
    """JSON records as declared, or the text of what is none."""
    raw = (
        spark.read.schema(StructType([*schema, StructField(_TEXT, StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _TEXT)
        .option("multiLine", multiline)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias(_FILE))
    )
    reason = F.when(F.col(_TEXT).isNotNull(), "no record of the declared schema")
    return raw.select(*schema.names, *_told(F.col(_TEXT), reason))


def _told(record: Column, reason: Column) -> list[Column]:
    return [
        F.col(_FILE),
        F.when(reason.isNotNull(), record).alias(_TEXT),
        reason.alias(_REASON),
        reason.isNull().alias(_FITS),
    ]


class Checked:
    """The rows of a source file in two: those that fit and those that do not.

    The file is parsed once, when this is made, into the shared folder; both sides, and their
    counts, are read from there, so every record is on exactly one of them.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, multiline: bool = False):
        entity = ENTITIES[name]
        read = _checked_csv if entity.source_format == "csv" else _checked_json
        parsed = read(spark, path, entity.schema, multiline)
        folder = scratch_dir(spark)
        parsed.write.partitionBy(_FITS).parquet(folder)
        stored = spark.read.schema(StructType([*parsed.schema])).parquet(folder)
        self.rows = stored.filter(F.col(_FITS)).select(*entity.schema.names)
        self.rejects = stored.filter(~F.col(_FITS)).select(
            F.col(_FILE).alias("source_file"), F.col(_TEXT).alias("record"), F.col(_REASON).alias("reason")
        )
        self._stored = stored

    def counts(self) -> tuple[int, int]:
        """How many records fit, and how many do not."""
        told = self._stored.agg(F.count_if(F.col(_FITS)), F.count_if(~F.col(_FITS))).first()
        return told[0], told[1]


def rejects_path(root: str, name: str) -> str:
    entity = ENTITIES[name]
    return f"{root.rstrip('/')}/rejects/{entity.origin}/{entity.name}"


def ingest_checked(
    spark: SparkSession,
    files: dict[str, str],
    root: str,
    multiline: bool = False,
    load_id: str | None = None,
) -> dict[str, tuple[int, int]]:
    """Land what fits of each source file, and append the rest to the entity's reject table below
    the landing root; returns for each entity how many records were landed and rejected.

    `ingest` remains the default way: there one record that does not fit stops the whole load.
    """
    done = {}
    for name, path in files.items():
        checked = Checked(spark, path, name, multiline)
        land(checked.rows, root, name, load_id=load_id)
        at = rejects_path(root, name)
        if load_id is None:
            checked.rejects.write.mode("append").parquet(at)
        else:
            checked.rejects.write.mode("overwrite").parquet(f"{at}/load-{load_id}")
        done[name] = checked.counts()
    return done


def read_rejects(spark: SparkSession, root: str, *entities: str) -> DataFrame:
    """(entity, source_file, record, reason) of what was rejected."""
    reader = spark.read.schema(REJECTS).option("recursiveFileLookup", True)
    tables = [
        reader.parquet(rejects_path(root, name)).select(F.lit(name).alias("entity"), "*") for name in entities
    ]
    return reduce(DataFrame.unionByName, tables)
