"""Streaming readers.

`limits` are the file source's rate options, such as `maxFilesPerTrigger` or
`maxBytesPerTrigger`: they bound a micro-batch when a large backlog waits.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",", **limits) -> DataFrame:
    """CSV files with a header; a cell of the wrong type is NULL."""
    return spark.readStream.schema(schema).options(header=True, sep=sep, **limits).csv(path)


def stream_text(spark: SparkSession, path: str, **limits) -> DataFrame:
    """Lines of text files, in the column `value`."""
    return spark.readStream.options(**limits).text(path)


def stream_json(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False, **limits
) -> DataFrame:
    """JSON lines. `multiline` reads one value per file and loses any after the first."""
    options = {"mode": "PERMISSIVE", "multiLine": multiline, **limits}
    return spark.readStream.schema(schema).options(**options).json(path)


def stream_parquet(spark: SparkSession, path: str, schema: StructType, **limits) -> DataFrame:
    return spark.readStream.schema(schema).options(**limits).parquet(path)


def stream_table(spark: SparkSession, table: str, **limits) -> DataFrame:
    """New files of a catalog table."""
    return spark.readStream.options(**limits).table(table)


def kafka_options(servers: str, topic: str, **limits) -> dict:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **limits}


def stream_kafka(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    """Records of a topic in the Kafka envelope. Needs the Kafka connector;
    `maxOffsetsPerTrigger` and `minPartitions` pass through."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **limits)).load()
