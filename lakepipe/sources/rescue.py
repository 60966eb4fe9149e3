"""Rescued data: rows of files whose columns do not fit the tracked schema.

Each file is read with its own schema.  A column whose type differs is cast;
a value that does not cast, and every column the tracked schema lacks, is kept
as JSON text in ``_rescued_data`` beside the row.  Nothing is dropped and no
file stops the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakepipe.functions.numeric import std_cast
from lakepipe.sources.bronze import by_write_job, file_schema

RESCUED = "_rescued_data"
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def fit_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` and ``_rescued_data`` (NULL where all values fit)."""
    own = {f.name: f.dataType for f in df.schema.fields}
    columns, misfits = [], []
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name not in own:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if own[field.name] == field.dataType:
            columns.append(c.alias(field.name))
            continue
        castable = _plain(own[field.name]) and _plain(field.dataType)
        value = std_cast(c, field.dataType.simpleString()) if castable else F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
        misfits.append(F.when(c.isNotNull() & value.isNull(), c).alias(field.name))
    names = {f.name for f in schema.fields}
    misfits += [F.col(f"`{name}`") for name in own if name not in names]
    if not misfits:
        return df.select(*columns, F.lit(None).cast("string").alias(RESCUED))
    text = F.to_json(F.struct(*misfits))  # leaves out NULLs
    return df.select(*columns, F.when(text != "{}", text).alias(RESCUED))


def read_rescued(spark: SparkSession, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """All rows of the files in the columns of ``schema`` and ``_rescued_data``.

    One footer is read for each job that wrote some of the files, one scan
    made for each distinct schema.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for same in by_write_job(list(files)).values():
        own = file_schema(spark, same[0])
        groups.setdefault(own.json(), (own, []))[1].extend(same)
    if not groups:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())]))
    scans = [fit_to(spark.read.schema(own).option("recursiveFileLookup", "true").parquet(*paths), schema) for own, paths in groups.values()]
    return reduce(DataFrame.unionByName, scans)


def run_rescuing_stream(
    spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, handle: Callable[[DataFrame, int], None], available_now: bool = True, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """Give ``handle`` the rows of each micro-batch of new files under ``path``.

    The stream is one of file names (contents are not read by it), so files of
    any schema may come; a micro-batch's names reach the driver, as in any file
    stream.
    """
    reader = spark.readStream.format("binaryFile").schema(_BINARY_FILE).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def on_batch(names: DataFrame, n: int) -> None:
        handle(read_rescued(spark, [r["path"] for r in names.collect()], schema), n)

    writer = reader.load(path).select("path").writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
