"""JDBC sources and sink (Spark's built-in JDBC data source).

Nothing here opens a connection by itself; Spark does when a query runs.
Reads can be split over ``numPartitions`` ranges of a numeric/date column so
a large table is fetched by many executors instead of one."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcOptions:
    host: str
    port: int | str
    database: str
    user: str
    password: str = field(repr=False, default="")
    driver: str = "org.postgresql.Driver"
    subprotocol: str = "postgresql"
    # Connection settings of the source database.
    sslmode: str = "require"
    connect_timeout_s: int = 60
    socket_timeout_s: int = 600
    tcp_keepalive: bool = True
    rewrite_batched_inserts: bool = True
    fetchsize: int = 10_000
    batchsize: int = 10_000

    @property
    def url(self) -> str:
        params = (
            f"sslmode={self.sslmode}&connectTimeout={self.connect_timeout_s}"
            f"&socketTimeout={self.socket_timeout_s}&tcpKeepAlive={str(self.tcp_keepalive).lower()}"
            f"&reWriteBatchedInserts={str(self.rewrite_batched_inserts).lower()}"
        )
        return f"jdbc:{self.subprotocol}://{self.host}:{self.port}/{self.database}?{params}"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetchsize),
            "batchsize": str(self.batchsize),
        }


@dataclass(frozen=True)
class JdbcPartitioning:
    """Range split of a read: ``numPartitions`` strides over
    ``[lower, upper]`` of ``column`` (rows outside still land in the end
    partitions, so nothing is lost)."""

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def quote_ident(name: str) -> str:
    """Quoted identifier: the source uses mixed-case table/column names."""
    return '"' + name.replace('"', '""') + '"'


def read_jdbc_full(
    spark: SparkSession,
    opts: JdbcOptions,
    table: str,
    partitioning: JdbcPartitioning | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").options(**opts.options()).option("dbtable", quote_ident(table))
    if partitioning:
        reader = reader.options(
            partitionColumn=quote_ident(partitioning.column),
            lowerBound=str(partitioning.lower),
            upperBound=str(partitioning.upper),
            numPartitions=str(partitioning.num_partitions),
        )
    return reader.load()


def sql_literal(v) -> str:
    """A value as a SQL literal (timestamps, dates, numbers, text)."""
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def bounds_query(table: str, column: str, where: str | None = None) -> str:
    cond = f" where {where}" if where else ""
    return f"(select min({quote_ident(column)}) lo, max({quote_ident(column)}) hi from {quote_ident(table)}{cond}) b"


def partitioning_for(
    spark: SparkSession,
    opts: JdbcOptions,
    table: str,
    column: str,
    num_partitions: int,
    where: str | None = None,
) -> JdbcPartitioning | None:
    """Bounds from one ``min/max`` query (a one-row result), over the rows
    ``where`` selects -- for an incremental read, the new rows only, so
    they are spread over all partitions instead of landing in the last."""
    q = bounds_query(table, column, where)
    row = spark.read.format("jdbc").options(**opts.options()).option("dbtable", q).load().first()
    if row is None or row["lo"] is None:
        return None
    return JdbcPartitioning(column, row["lo"], row["hi"], num_partitions)


def write_jdbc(df: DataFrame, opts: JdbcOptions, table: str, mode: str = "append") -> None:
    """Append (or other ``mode``) rows into a database table; errors raise."""
    df.write.format("jdbc").options(**opts.options()).option("dbtable", quote_ident(table)).mode(mode).save()
