"""Where each layer lives: one root, one naming scheme for all layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class LakeLayout:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, table: str) -> str:
        return self._p("bronze", table)

    def silver(self, entity: str) -> str:
        return self._p("silver", entity)

    def gold(self, name: str) -> str:
        return self._p("gold", name)

    def checkpoint(self, layer: str, name: str) -> str:
        return self._p("_checkpoints", layer, name)

    def schema_dir(self, table: str) -> str:
        return self._p("_schemas", table)

    def watermarks(self) -> str:
        return self._p("_meta", "watermarks")


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for any Hadoop-supported URI (file, hdfs, s3a, abfss ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
