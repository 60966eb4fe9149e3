"""Catalog-table access: a layer is a (catalog, schema) namespace.

``Layer("main", "silver").read("booking")`` is ``spark.table`` on the
qualified name; ``ensure_table`` creates an external Parquet table from a
``StructType`` contract when it does not exist yet.  Spark has no primary
key enforcement, so ``check_primary_key`` verifies uniqueness with one
aggregate job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakepipe.operators.quality import duplicate_keys


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Layer:
    schema: str
    catalog: str | None = None

    def qualified(self, table: str) -> str:
        parts = ([self.catalog] if self.catalog else []) + [self.schema, table]
        return ".".join(quote(p) for p in parts)

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(self.qualified(table).replace("`", ""))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self.qualified(table))

    def use(self, spark: SparkSession) -> None:
        """Make this layer the session's current namespace."""
        if self.catalog:
            spark.catalog.setCurrentCatalog(self.catalog)
        spark.catalog.setCurrentDatabase(self.schema)

    def publish(self, spark: SparkSession, table: str, path: str) -> None:
        publish_view(spark, self, table, path)

    def ensure_schema(self, spark: SparkSession) -> None:
        ns = (quote(self.catalog) + "." if self.catalog else "") + quote(self.schema)
        if not spark.catalog.databaseExists(ns.replace("`", "")):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ns}")

    def ensure_table(
        self,
        spark: SparkSession,
        table: str,
        schema: T.StructType,
        location: str | None = None,
        partition_cols: Sequence[str] | None = None,
    ) -> bool:
        """Create the table if missing; returns True when it was created."""
        if self.exists(spark, table):
            return False
        self.ensure_schema(spark)
        cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        ddl = f"CREATE TABLE IF NOT EXISTS {self.qualified(table)} ({cols}) USING parquet"
        if partition_cols:
            ddl += " PARTITIONED BY (" + ", ".join(quote(c) for c in partition_cols) + ")"
        if location:
            ddl += f" LOCATION '{location}'"
        spark.sql(ddl)
        return True


def publish_view(spark: SparkSession, layer: "Layer", table: str, path: str, fmt: str = "parquet") -> None:
    """Point the catalog name ``layer.table`` at the data under ``path``.

    The name is a view over the path, replaced in one catalog operation:
    SQL readers switch from the previous snapshot to the new one at once,
    never seeing a table that is still being written."""
    layer.ensure_schema(spark)
    literal = path.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {layer.qualified(table)} AS SELECT * FROM {fmt}.`{literal}`")


def check_primary_key(df: DataFrame, *keys: str) -> DataFrame:
    """Keys violating uniqueness (empty frame when the key holds); NULL
    keys count as violations too."""
    nulls = df.filter(" OR ".join(f"{quote(k)} IS NULL" for k in keys)).select(*keys).limit(1)
    return duplicate_keys(df, *keys).select(*keys).unionByName(nulls)
