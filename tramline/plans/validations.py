"""Ticket validations: drop folder -> staging -> table -> weekday KPIs."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline import schemas, sinks
from tramline.operators import kpis
from tramline.sinks.commits import CommitLog
from tramline.streaming import sinks as stream_sinks
from tramline.streaming import sources as stream_sources

RAW_SEP = ";"

TOTAL_KEYS = ["kpi", "label", "day_number"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

WriteKpi = Callable[[DataFrame, str], None]


def ingest_validations(
    spark: SparkSession,
    drop: str,
    staging: str,
    checkpoint: str,
    trigger: dict | None = None,
    **limits,
) -> list[StreamingQuery]:
    """Stage dropped `*.csv` files as comma-separated CSV and `*.txt` files as text.

    Two queries run side by side, each with its own folder and checkpoint.
    """
    csv = stream_sources.stream_csv(spark, f"{drop}/*.csv", schemas.VALIDATIONS, RAW_SEP, **limits)
    txt = stream_sources.stream_text(spark, f"{drop}/*.txt", **limits)
    return [
        stream_sinks.stream_files(
            csv, "csv", f"{staging}/csv", f"{checkpoint}/csv", trigger, header=True
        ),
        stream_sinks.stream_files(txt, "text", f"{staging}/txt", f"{checkpoint}/txt", trigger),
    ]


def parse_lines(lines: DataFrame, sep: str = RAW_SEP) -> DataFrame:
    """Validations from text lines; header lines are left out."""
    header = schemas.VALIDATIONS.fieldNames()[0]
    body = lines.filter(~F.startswith("value", F.lit(f"{header}{sep}")))
    row = F.from_csv("value", schemas.ddl(schemas.VALIDATIONS), {"sep": sep})
    return body.select(row.alias("row")).select("row.*")


def load_validations(
    spark: SparkSession,
    csv_path: str,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    txt_path: str | None = None,
    path: str | None = None,
    **limits,
) -> StreamingQuery:
    """Append staged CSV, and optionally staged text, to a catalog table."""
    rows = stream_sources.stream_csv(spark, csv_path, schemas.VALIDATIONS, **limits)
    if txt_path:
        rows = rows.unionByName(parse_lines(stream_sources.stream_text(spark, txt_path, **limits)))
    return stream_sinks.stream_table(rows, table, checkpoint, trigger, path=path)


def jdbc_kpi_writer(
    url: str, properties: dict[str, str], connections: int = sinks.JDBC_CONNECTIONS
) -> WriteKpi:
    """Overwrites a database table with a KPI."""

    def write(kpi: DataFrame, table: str) -> None:
        sinks.write_jdbc(kpi, url, table, "overwrite", properties, connections)

    return write


def _publish(grain: DataFrame, write: WriteKpi) -> None:
    # The grain is small and feeds both tables. Should an executor take its blocks
    # along, Spark recomputes them.
    grain = grain.persist()
    try:
        for table, key in kpis.KPI_TABLES.items():
            write(kpis.from_grain(grain, key), table)
    finally:
        grain.unpersist()


def refresh_kpis(validations: DataFrame, write: WriteKpi) -> None:
    """Recompute both KPI tables from all validations in one scan."""
    _publish(kpis.daily_grain(validations), write)


def stream_kpis(
    spark: SparkSession,
    table: str,
    write: WriteKpi,
    checkpoint: str,
    trigger: dict | None = None,
    incremental: bool = True,
    **limits,
) -> StreamingQuery:
    """Keep both KPI tables up to date with a growing validations table.

    Incremental: a streaming aggregation keeps one state row per category, stop
    and weekday, so a batch costs as much as its new rows. The session's shuffle
    partitions at the first start fix the number of state stores; for this small
    state a few do. Otherwise each batch only signals new data and the whole table
    is aggregated again.
    """
    rows = stream_sources.stream_table(spark, table, **limits)
    if incremental:
        return stream_sinks.foreach_batch(
            kpis.daily_grain(rows),
            lambda grain, _: _publish(grain, write),
            checkpoint,
            trigger,
            mode="complete",
        )

    def recompute(_: DataFrame, __: int) -> None:
        spark.catalog.refreshTable(table)
        refresh_kpis(spark.table(table), write)

    return stream_sinks.foreach_batch(rows, recompute, checkpoint, trigger)


def stream_kpi_changes(
    spark: SparkSession,
    table: str,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    compact_after: int = 50,
    **limits,
) -> StreamingQuery:
    """Keep KPIs in a folder behind a commit log, writing only the keys a batch changes.

    The totals of each key are state in RocksDB, on disk. A batch emits the keys it
    changed with their new totals, which are committed as a version of those keys; a batch
    that comes again adds nothing. After `compact_after` batches only the newest
    version of each key stays. Readers use `changed_kpi`.
    """
    log = CommitLog(spark, target)
    schema = totals_schema(spark)

    def merge(changed: DataFrame, batch_id: int) -> None:
        if log.committed(batch_id):
            changed.write.format("noop").mode("overwrite").save()  # the state moves on all the same
            return
        # A batch holds at most one row for a key; few files do for what changed.
        log.append(changed.hint("rebalance"), batch_id)
        if len(log.snapshot().folders) > compact_after:
            log.compact(schema, TOTAL_KEYS)

    totals = kpis.keyed_totals(stream_sources.stream_table(spark, table, **limits))
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # a query takes its settings when it starts
    try:
        return stream_sinks.foreach_batch(totals, merge, checkpoint, trigger, mode="update")
    finally:
        spark.conf.set(_PROVIDER, before)


def totals_schema(spark: SparkSession):
    """The schema of `kpis.keyed_totals` rows."""
    return kpis.keyed_totals(spark.createDataFrame([], schemas.VALIDATIONS)).schema


def changed_kpi(spark: SparkSession, target: str, kpi: str) -> DataFrame:
    """A KPI table from the folder that `stream_kpi_changes` keeps."""
    newest = CommitLog(spark, target).latest(totals_schema(spark), TOTAL_KEYS)
    return kpis.from_totals(newest, kpi)
