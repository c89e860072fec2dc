"""Batch readers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tramline.sources import records


def read_json(
    spark: SparkSession, path, schema: StructType | None = None, multiline: bool = False
) -> DataFrame:
    """JSON lines; a malformed line gives NULL fields. `multiline` reads one value per file."""
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", multiline)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(
    spark: SparkSession, path, schema: StructType | None = None
) -> DataFrame:
    """Parquet files, by the given schema or the files' own."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_csv(
    spark: SparkSession,
    path,
    schema: StructType | None = None,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header, UTF-8. Without a schema, types are inferred by an extra pass.

    `multiline` accepts texts that span lines; large files are still read by many tasks.
    """
    if multiline:
        return records.read_multiline_csv(spark, path, schema, sep)
    reader = spark.read.options(
        header=True, sep=sep, encoding="UTF-8", escape='"'
    )
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_table(spark: SparkSession, table: str, where: str | None = None) -> DataFrame:
    """A catalog table; `where` on the partition column prunes partitions."""
    rows = spark.table(table)
    return rows.where(where) if where else rows


def table_schema(spark: SparkSession, table: str) -> StructType:
    return spark.table(table).schema
