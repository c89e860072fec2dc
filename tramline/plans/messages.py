"""Disruption messages: Kafka -> landing files -> flat table -> database or CSV."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tramline import schemas, sinks, sources
from tramline.operators import messages
from tramline.sinks.commits import VERSION, CommitLog
from tramline.streaming import sinks as stream_sinks
from tramline.streaming import sources as stream_sources


def land_messages(
    envelope: DataFrame, landing: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the message text of each Kafka record as JSON lines."""
    return stream_sinks.stream_files(
        messages.decode_kafka(envelope), "json", landing, checkpoint, trigger
    )


def load_messages(
    spark: SparkSession,
    landing: str,
    table: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    infer: bool = False,
    multiline: bool = False,
    path: str | None = None,
    commits: str | None = None,
    **limits,
) -> StreamingQuery:
    """Flatten landed messages into a table partitioned by year.

    With the fixed payload schema this is one stateless projection into an
    exactly-once sink. `infer` also takes further fields from each micro-batch's own
    payloads, at the price of one more pass; rows and their types are the same. Its
    appends to a catalog table may come twice after a failure; with `commits`, a folder
    for a commit log, they go there instead, exactly once (read by `committed_messages`).
    """
    landed = stream_sources.stream_json(spark, landing, schemas.LANDED, multiline, **limits)
    if not infer:
        flat = messages.flatten(messages.parse_payload(landed))
        return stream_sinks.stream_table(flat, table, checkpoint, trigger, "year", path)

    log = CommitLog(spark, commits, "year") if commits else None

    def append(batch: DataFrame, batch_id: int) -> None:
        if log and log.committed(batch_id) or batch.isEmpty():
            return
        schema = messages.with_payload_types(messages.infer_payload_schema(batch))
        flat = messages.flatten(messages.parse_payload(batch, schema))
        if log:
            log.append(flat.hint("rebalance", "year"), batch_id)
            return
        sinks.append_table(flat, table, "year", rebalance=True, path=path)

    return stream_sinks.foreach_batch(landed, append, checkpoint, trigger)


def committed_messages(spark: SparkSession, commits: str) -> DataFrame:
    """The messages that `load_messages` has committed to a folder."""
    return CommitLog(spark, commits, "year").read(schemas.MESSAGES).drop(VERSION)


def load_messages_batch(
    spark: SparkSession,
    landing: str,
    table: str | None = None,
    infer: bool = False,
    parse_update: bool = True,
    rebalance: bool = False,
    path: str | None = None,
) -> DataFrame:
    """The batch twin of `load_messages`; with `table`, also appends the rows to it.

    `rebalance` pays for landing files that mix many years: one shuffle instead of a
    small file per task and year.
    """
    landed = sources.read_json(spark, landing, schemas.LANDED)
    schema = schemas.PAYLOAD
    if infer:
        schema = messages.with_payload_types(messages.infer_payload_schema(landed))
    flat = messages.flatten(messages.parse_payload(landed, schema), parse_update)
    if table:
        by_year = "year" if parse_update else None
        sinks.append_table(flat, table, by_year, rebalance, path)
    return flat


def publish_messages(
    rows: DataFrame,
    append: Callable[[DataFrame], None],
    checkpoint: str,
    trigger: dict | None = None,
    written: Callable[[int], DataFrame] | None = None,
    tag_batches: bool = False,
) -> StreamingQuery:
    """Append each micro-batch of new messages to a database.

    Plain appends may repeat rows when a batch is retried. `tag_batches` adds the
    batch number to every row and, with `written`, appends only what is missing.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        if tag_batches:
            sinks.append_once(batch, batch_id, written, append)
        else:
            append(batch)

    return stream_sinks.foreach_batch(rows, publish, checkpoint, trigger)


def publish_messages_jdbc(
    spark: SparkSession,
    source_table: str,
    url: str,
    target: str,
    properties: dict[str, str],
    checkpoint: str,
    trigger: dict | None = None,
    tag_batches: bool = False,
    connections: int = sinks.JDBC_CONNECTIONS,
    **limits,
) -> StreamingQuery:
    """`publish_messages` from a catalog table to a database table over JDBC.

    With `tag_batches` the target must exist and have a `batch_id` column.
    """
    return publish_messages(
        stream_sources.stream_table(spark, source_table, **limits),
        lambda rows: sinks.write_jdbc(rows, url, target, "append", properties, connections),
        checkpoint,
        trigger,
        lambda batch_id: sinks.read_jdbc_batch(spark, url, target, properties, batch_id),
        tag_batches,
    )


def export_messages(spark: SparkSession, table: str, path: str) -> None:
    """The messages table as CSV, in parts."""
    sinks.export_csv(sources.read_table(spark, table), path)
