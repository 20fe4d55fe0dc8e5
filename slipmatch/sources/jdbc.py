"""JDBC scans of the two source databases, read in parallel ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from slipmatch.schemas import ACCOUNTING, SALES

# Driver classes of the two source databases.
SQL_SERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
ORACLE_DRIVER = "oracle.jdbc.OracleDriver"


@dataclass(frozen=True)
class JdbcSplit:
    """A numeric, date or timestamp column whose range is read by several tasks."""

    column: str
    lower: str | int
    upper: str | int
    parts: int


def sql_server(host: str, port: int, database: str, user: str, password: str) -> dict:
    url = f"jdbc:sqlserver://{host}:{port};databaseName={database}"
    return {"url": url, "driver": SQL_SERVER_DRIVER, "user": user, "password": password}


def oracle(host: str, port: int, service: str, user: str, password: str) -> dict:
    url = f"jdbc:oracle:thin:@//{host}:{port}/{service}"
    return {"url": url, "driver": ORACLE_DRIVER, "user": user, "password": password}


def scan_options(connection: dict, table: str, split: JdbcSplit | None, fetch_rows: int = 10_000) -> dict:
    """Reader options: names of the declared columns keep their declared types."""
    layout = {**ACCOUNTING, **SALES}.get(table)
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_rows)}
    if layout is not None:
        options["customSchema"] = layout
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return options


def read_table(spark: SparkSession, connection: dict, table: str, split: JdbcSplit | None = None) -> DataFrame:
    """Filters and column choices made later reach the database; rows stay in Spark tasks."""
    return spark.read.format("jdbc").options(**scan_options(connection, table, split)).load()
