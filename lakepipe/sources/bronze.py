"""Bronze readers: batch and streaming, with a recorded schema.

A file stream needs its schema before it starts.  The schema is inferred
from the files present (merging all schema versions) and stored as JSON
beside the stream.  Each run widens it by the columns that appeared since the
last one (a column never disappears or changes to an unrelated type);
``evolve=False`` keeps the recorded columns.  Only footers of files newer than
the last run are read, one for each job that wrote some."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakepipe.sources.layout import hadoop_fs
from lakepipe.sources.schemas import widen_schema

SCHEMA_FILE = "schema.json"
SEEN_FILE = "seen.json"  # modification time of the newest file the schema covers


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether any Parquet file lies under ``path`` (an ingest that found no
    rows leaves none).  Stops at the first one."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


# Part files of one write job share the job's id, and with it their schema.
_PART_FILE = re.compile(r"^part-\d+-([0-9a-f-]{36})")


def list_parquet(spark: SparkSession, path: str, since: int = 0) -> list[tuple[str, int]]:
    """(file, modification time in ms) of the Parquet files under ``path`` changed at or after ``since``."""
    fs, p = hadoop_fs(spark, path)
    out = []
    if not fs.exists(p):
        return out
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")) and f.getModificationTime() >= since:
            out.append((f.getPath().toString(), f.getModificationTime()))
    return sorted(out)


def by_write_job(files: list[str]) -> dict[str, list[str]]:
    """Files of one schema together: those one job wrote into any folder; a file of another name is by itself."""
    out: dict[str, list[str]] = {}
    for f in files:
        m = _PART_FILE.match(f.rsplit("/", 1)[-1])
        out.setdefault(m[1] if m else f, []).append(f)
    return out


def file_schema(spark: SparkSession, file: str) -> T.StructType:
    """The schema in one file's footer."""
    return spark.read.option("recursiveFileLookup", "true").parquet(file).schema


def tracked_schema(spark: SparkSession, path: str, schema_path: str, evolve: bool = False) -> T.StructType:
    file, seen_file = f"{schema_path.rstrip('/')}/{SCHEMA_FILE}", f"{schema_path.rstrip('/')}/{SEEN_FILE}"
    saved = _read_text(spark, file)
    if saved is not None and not evolve:
        return T.StructType.fromJson(json.loads(saved))
    seen = json.loads(_read_text(spark, seen_file) or "0") if saved is not None else 0
    files = list_parquet(spark, path, seen)
    if saved is None:
        schema = read_bronze(spark, path).schema
    else:
        schema = T.StructType.fromJson(json.loads(saved))
        # Files as old as the newest one seen are looked at again: more may have come in that instant.
        for group in by_write_job([f for f, _ in files]).values():
            schema = widen_schema(schema, file_schema(spark, group[0]))
    _write_text(spark, file, schema.json())
    _write_text(spark, seen_file, json.dumps(max([t for _, t in files], default=seen)))
    return schema


def read_bronze_stream(
    spark: SparkSession,
    path: str,
    schema_path: str,
    evolve: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded frame over the bronze parquet files of one table."""
    schema = tracked_schema(spark, path, schema_path, evolve)
    reader = spark.readStream.schema(schema).option("mergeSchema", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)
