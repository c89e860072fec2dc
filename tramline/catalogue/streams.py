"""Streaming jobs, run over all files that are there and read back."""

from pyspark.sql import functions as F

from tramline import schemas, sinks, sources
from tramline.catalogue import files, json_messages, kpi, views
from tramline.operators import kpis, messages
from tramline.plans import messages as message_plans
from tramline.plans import validations as validation_plans
from tramline.session import work_folder
from tramline.sinks.commits import VERSION, CommitLog
from tramline.streaming import sinks as stream_sinks
from tramline.streaming import sources as stream_sources

NOW = stream_sinks.AVAILABLE_NOW


def _halves(spark, sf, table):
    """A rate limit that takes the files written from a table in about two batches."""
    cores = spark.sparkContext.defaultParallelism
    files = max(cores, views.table(spark, sf, table).rdd.getNumPartitions())
    return {"maxFilesPerTrigger": (files + 1) // 2}


def _drop_csv(spark, sf, path, sep=validation_plans.RAW_SEP):
    views.validations(spark, sf).write.csv(path, header=True, sep=sep)


def _staged(spark, sf):
    """Validations dropped as CSV and as text, staged by the ingest job."""
    root = work_folder(spark, "ingest")
    _drop_csv(spark, sf, f"{root}/drop/csv")
    fields = schemas.VALIDATIONS.fieldNames()
    line = F.array_join(F.array(*[F.col(c).cast("string") for c in fields]), ";", "")
    lines = views.validations(spark, sf).select(line.alias("value"))
    lines.write.text(f"{root}/drop/txt")
    limits = _halves(spark, sf, "events")
    queries = validation_plans.ingest_validations(
        spark, f"{root}/drop/*", f"{root}/staging", f"{root}/checkpoints", NOW, **limits
    )
    for query in queries:
        query.awaitTermination()
    return root


def stream_csv_roundtrip(spark, sf):
    root = _staged(spark, sf)
    return files.printable(sources.read_csv(spark, f"{root}/staging/csv", schemas.VALIDATIONS))


def stream_text_roundtrip(spark, sf):
    root = _staged(spark, sf)
    return files.printable(validation_plans.parse_lines(spark.read.text(f"{root}/staging/txt")))


def stream_csv_to_table(spark, sf):
    root = work_folder(spark, "load")
    _drop_csv(spark, sf, f"{root}/staging", ",")
    name, path = files.new_table(spark, "validations")
    limits = _halves(spark, sf, "events")
    validation_plans.load_validations(
        spark, f"{root}/staging", name, f"{root}/checkpoint", NOW, path=path, **limits
    ).awaitTermination()
    return files.printable(sources.read_table(spark, name))


def _kpi_stream(incremental, kpi_table):
    def run(spark, sf):
        root = work_folder(spark, "kpi")
        name, path = files.new_table(spark, "validations")
        sinks.append_table(views.validations(spark, sf), name, path=path)
        limits = _halves(spark, sf, "events")

        def write(rows, table):
            sinks.write_parquet(rows, f"{root}/{table}")

        validation_plans.stream_kpis(
            spark, name, write, f"{root}/checkpoint", NOW, incremental, **limits
        ).awaitTermination()
        return sources.read_parquet(spark, f"{root}/{kpi_table}")

    return run


def _landed(spark, sf, root):
    """Kafka records fed from files, landed by the landing job."""
    json_messages.envelope(spark, sf).write.parquet(f"{root}/records")
    limits = _halves(spark, sf, "documents")
    records = stream_sources.stream_parquet(
        spark, f"{root}/records", schemas.KAFKA_ENVELOPE, **limits
    )
    message_plans.land_messages(
        records, f"{root}/landing", f"{root}/landing-checkpoint", NOW
    ).awaitTermination()
    return f"{root}/landing"


def _flatten_stream(infer):
    def run(spark, sf):
        root = work_folder(spark, "messages")
        landing = _landed(spark, sf, root)
        name, path = files.new_table(spark, "messages")
        limits = _halves(spark, sf, "documents")
        message_plans.load_messages(
            spark, landing, name, f"{root}/checkpoint", NOW, infer=infer, path=path, **limits
        ).awaitTermination()
        return json_messages.printable(sources.read_table(spark, name))

    return run


def forget_last_batch(spark, checkpoint):
    """Takes the newest batch's commit out of a checkpoint, as if its query had died before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().isdigit()]
    files.delete(max(done, key=lambda p: int(p.getName())), False)


def stream_messages_replay(spark, sf):
    """Messages with inferred fields, the last batch run twice: every message once."""
    root = work_folder(spark, "replay")
    landing, limits = _landed(spark, sf, root), _halves(spark, sf, "documents")
    for again in (False, True):
        if again:
            forget_last_batch(spark, f"{root}/checkpoint")
        message_plans.load_messages(
            spark, landing, None, f"{root}/checkpoint", NOW, infer=True, commits=f"{root}/messages", **limits
        ).awaitTermination()
    return json_messages.printable(message_plans.committed_messages(spark, f"{root}/messages"))


def messages_compaction(spark, sf):
    """Twenty small appends by year, compacted, with a batch after the compaction."""
    log = CommitLog(spark, work_folder(spark, "compaction"), "year")
    rows = messages.flatten(messages.parse_payload(json_messages.landed(spark, sf)))
    lot = F.pmod(F.xxhash64("id"), F.lit(21))
    for number in range(21):
        log.append(rows.filter(lot == number), number)
        if number == 19:
            log.compact(schemas.MESSAGES)
            log.vacuum()
    return json_messages.printable(log.read(schemas.MESSAGES).drop(VERSION))


def _kpi_changes(kpi_table):
    """Three lots of validations, each a batch; the second batch comes twice."""

    def run(spark, sf):
        root = work_folder(spark, "kpi-changes")
        name, path = files.new_table(spark, "validations")
        rows = views.validations(spark, sf)
        lots = [F.col("CODE_STIF_ARRET") < 50, F.col("CODE_STIF_ARRET").between(50, 89), F.col("CODE_STIF_ARRET") > 89]
        for number, lot in enumerate(lots):
            sinks.append_table(rows.filter(lot), name, path=path)
            for again in (False, number == 1):
                if again:
                    forget_last_batch(spark, f"{root}/checkpoint")
                validation_plans.stream_kpi_changes(
                    spark, name, f"{root}/totals", f"{root}/checkpoint", NOW, compact_after=2
                ).awaitTermination()
        return validation_plans.changed_kpi(spark, f"{root}/totals", kpi_table)

    return run


def stream_publish_messages(spark, sf):
    """Published batch by batch to a folder, each row tagged with its batch."""
    root = work_folder(spark, "publish")
    name, path = files.new_table(spark, "messages")
    flat = messages.flatten(messages.parse_payload(json_messages.landed(spark, sf)))
    sinks.append_table(flat, name, path=path)
    target = f"{root}/target"
    message_plans.publish_messages(
        stream_sources.stream_table(spark, name, **_halves(spark, sf, "documents")),
        lambda rows: rows.write.mode("append").parquet(target),
        f"{root}/checkpoint",
        NOW,
        tag_batches=True,
    ).awaitTermination()
    return json_messages.printable(sources.read_parquet(spark, target).drop(sinks.BATCH_ID))


def stream_csv_and_text_to_table(spark, sf):
    """Staged CSV and staged text in one table: every validation twice."""
    root = _staged(spark, sf)
    name, path = files.new_table(spark, "validations")
    validation_plans.load_validations(
        spark, f"{root}/staging/csv", name, f"{root}/load", NOW, f"{root}/staging/txt", path
    ).awaitTermination()
    return files.printable(sources.read_table(spark, name))


def stream_restart(spark, sf):
    """Two lots of files, two runs, one checkpoint: the second run reads only the new lot."""
    root = work_folder(spark, "restart")
    name, path = files.new_table(spark, "validations")
    rows = views.validations(spark, sf)
    first = F.col("CODE_STIF_ARRET") < 50
    for lot in (rows.filter(first), rows.filter(~first)):
        lot.write.mode("append").csv(f"{root}/staging", header=True)
        validation_plans.load_validations(spark, f"{root}/staging", name, f"{root}/load", NOW, path=path).awaitTermination()
    spark.catalog.refreshTable(name)
    return files.printable(sources.read_table(spark, name))


QUERIES = {
    "stream_csv_roundtrip": stream_csv_roundtrip,
    "stream_text_roundtrip": stream_text_roundtrip,
    "stream_csv_to_table": stream_csv_to_table,
    "stream_csv_and_text_to_table": stream_csv_and_text_to_table,
    "stream_restart": stream_restart,
    "stream_kpi_ticket_weekday": _kpi_stream(True, "titre_transport"),
    "stream_kpi_stop_weekday": _kpi_stream(True, "arret"),
    "stream_kpi_full_refresh": _kpi_stream(False, "titre_transport"),
    "stream_messages_flatten": _flatten_stream(False),
    "stream_messages_infer": _flatten_stream(True),
    "stream_publish_messages": stream_publish_messages,
    "stream_messages_replay": stream_messages_replay,
    "messages_compaction": messages_compaction,
    "stream_kpi_ticket_changes": _kpi_changes("titre_transport"),
    "stream_kpi_stop_changes": _kpi_changes("arret"),
}


def oracles():
    ticket = f"WITH {views.VALIDATIONS_SQL} {kpi.kpi_sql(kpis.TICKET_KEY)}"
    return {
        "stream_csv_roundtrip": files.VALIDATION_ROWS_SQL,
        "stream_text_roundtrip": files.VALIDATION_ROWS_SQL,
        "stream_csv_to_table": files.VALIDATION_ROWS_SQL,
        "stream_csv_and_text_to_table": f"SELECT a.* FROM ({files.VALIDATION_ROWS_SQL}) AS a, range(2)",
        "stream_restart": files.VALIDATION_ROWS_SQL,
        "stream_kpi_ticket_weekday": ticket,
        "stream_kpi_stop_weekday": f"WITH {views.VALIDATIONS_SQL} {kpi.kpi_sql(kpis.STOP_KEY)}",
        "stream_kpi_full_refresh": ticket,
        "stream_messages_flatten": json_messages.FLAT_SQL,
        "stream_messages_infer": json_messages.FLAT_SQL,
        "stream_publish_messages": json_messages.FLAT_SQL,
        "stream_messages_replay": json_messages.FLAT_SQL,
        "messages_compaction": json_messages.FLAT_SQL,
        "stream_kpi_ticket_changes": ticket,
        "stream_kpi_stop_changes": f"WITH {views.VALIDATIONS_SQL} {kpi.kpi_sql(kpis.STOP_KEY)}",
    }
