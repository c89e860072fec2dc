"""Batch writers."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import fixed_values as fv

# Connections one JDBC write opens at a time, whatever the cluster's size.
JDBC_CONNECTIONS = 16
JDBC_BATCH_ROWS = 10_000

BATCH_ID = "batch_id"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def append_table(
    df: DataFrame,
    table: str,
    partition_by: str | None = None,
    rebalance: bool = False,
    path: str | None = None,
) -> None:
    """Append to a Parquet catalog table, creating it on first use.

    `rebalance` shuffles by the partition column first, so that each partition
    gets few, evenly sized files: adaptive execution splits a partition that
    holds most rows over several tasks and joins small ones. `path` makes the
    table external.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header and fixed date formats; quotes are doubled, so that texts
    with quotes and line breaks read back whole."""
    df.write.mode("overwrite").options(
        header=True,
        escape='"',
        dateFormat=fv.CSV_DATE,
        timestampFormat=fv.CSV_TIMESTAMP,
    ).csv(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str,
    properties: dict[str, str],
    connections: int = JDBC_CONNECTIONS,
) -> None:
    """Write to a database table over `connections` connections.

    The rows are dealt out to them by a shuffle: without one, the writer would draw the
    scan and all steps before it together into as many tasks.
    """
    options = {"numPartitions": str(connections), "batchsize": str(JDBC_BATCH_ROWS), **properties}
    df.repartition(connections).write.jdbc(url=url, table=table, mode=mode, properties=options)


def read_jdbc_batch(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], batch_id: int
) -> DataFrame:
    """The rows of one batch in a database table; the filter runs in the database."""
    return spark.read.jdbc(url=url, table=table, properties=properties).where(
        F.col(BATCH_ID) == batch_id
    )


def append_once(
    batch: DataFrame,
    batch_id: int,
    written: Callable[[int], DataFrame] | None,
    append: Callable[[DataFrame], None],
) -> None:
    """Append a micro-batch that may be a retry of one already written in part.

    Rows carry their batch number. `written` returns the target's rows of a batch,
    or is None for a target that does not exist yet; only rows missing there are
    appended, counting copies.
    """
    rows = batch.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
    if written is not None:
        present = written(batch_id).select(*rows.columns)
        if not present.isEmpty():
            rows = rows.exceptAll(present)
    append(rows)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Publish the `value` column; every replica must confirm. Needs the Kafka connector."""
    df.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    ).save()
