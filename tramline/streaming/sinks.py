"""Streaming writers. Each starts the query and returns it; the caller awaits it.

`trigger` holds the arguments of `DataStreamWriter.trigger`; none means batches
follow each other as data arrives.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str = "append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def stream_files(
    df: DataFrame,
    fmt: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Append to files of a format; each row is written exactly once. One query per path."""
    return _writer(df, checkpoint, trigger).format(fmt).options(**options).start(path)


def stream_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: str | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet catalog table, created on first use; exactly once.

    A table filled this way should have no other writer: readers trust the
    query's log of committed files.
    """
    writer = _writer(df, checkpoint, trigger).format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def foreach_batch(
    df: DataFrame,
    function: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call `function(batch, batch_id)` per micro-batch; a batch may come again after a failure."""
    return _writer(df, checkpoint, trigger, mode).foreachBatch(function).start()
