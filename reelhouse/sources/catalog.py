"""Namespaces and external tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelhouse.schemas import ENTITIES, entities_in
from reelhouse.sources.landing import landing_path


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quote(name)} LOCATION {_text(location)}")


def create_landing_table(spark: SparkSession, namespace: str, root: str, name: str) -> str:
    """(Re)define the external table of an entity; dropping it keeps the files."""
    entity = ENTITIES[name]
    table = f"{_quote(namespace)}.{_quote(f'{entity.origin}_{entity.name}_parquet')}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({entity.schema.toDDL()}) USING PARQUET "
        f"OPTIONS ('recursiveFileLookup' 'true') LOCATION {_text(landing_path(root, entity))}"
    )
    return table


def create_landing_tables(
    spark: SparkSession, namespace: str, root: str, group: str = "all"
) -> list[str]:
    return [create_landing_table(spark, namespace, root, e.name) for e in entities_in(group)]


def list_catalogs(spark: SparkSession) -> list[str]:
    return [c.name for c in spark.catalog.listCatalogs()]


def list_namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)
