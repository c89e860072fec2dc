from pathlib import Path

import pytest
import samples
from pyspark.sql import functions as F

from tramline import schemas, sinks
from tramline.operators import kpis
from tramline.plans import messages as message_plans
from tramline.plans import validations as plans
from tramline.streaming import sinks as stream_sinks
from tramline.streaming import sources as stream_sources

NOW = stream_sinks.AVAILABLE_NOW
FIRST = [("2024-01-22", "NATION", "Navigo", 10), ("2024-01-23", "ÉTOILE", "Imagine R", 4)]
SECOND = [("2024-01-22", "NATION", "Navigo", 5)]


def ingest(spark, folder):
    queries = plans.ingest_validations(
        spark, f"{folder}/drop", f"{folder}/staging", f"{folder}/checkpoints", NOW
    )
    assert len(queries) == 2
    for query in queries:
        query.awaitTermination()


def drop(folder, name, rows, header=True):
    lines = ([samples.CSV_HEADER] if header else []) + samples.csv_lines(rows)
    samples.write_lines(Path(folder) / "drop" / name, lines)


def test_ingest_stages_both_formats_and_only_new_files(spark, folder):
    drop(folder, "a.csv", FIRST)
    drop(folder, "a.txt", SECOND)
    ingest(spark, folder)

    def staged():
        csv = spark.read.schema(schemas.VALIDATIONS).csv(f"{folder}/staging/csv", header=True)
        return csv.count(), spark.read.text(f"{folder}/staging/txt").count()

    assert staged() == (2, 2)
    ingest(spark, folder)
    assert staged() == (2, 2)
    drop(folder, "b.csv", SECOND)
    ingest(spark, folder)
    assert staged() == (3, 2)
    staged_text = "".join(p.read_text() for p in Path(folder, "staging/csv").glob("*.csv"))
    assert "2024-01-22,100,110,1,NATION,7,Navigo,10" in staged_text


def test_an_empty_file_adds_nothing(spark, folder):
    Path(folder, "drop").mkdir()
    Path(folder, "drop/empty.csv").write_text("")
    drop(folder, "a.csv", FIRST)
    drop(folder, "a.txt", [])
    ingest(spark, folder)
    assert spark.read.csv(f"{folder}/staging/csv", header=True).count() == 2


@pytest.mark.parametrize("with_text", [False, True])
def test_load_reads_staged_csv_and_text(spark, folder, with_text):
    drop(folder, "a.csv", FIRST)
    drop(folder, "a.txt", SECOND)
    ingest(spark, folder)
    table = f"validations_{with_text}"
    plans.load_validations(
        spark,
        f"{folder}/staging/csv",
        table,
        f"{folder}/load",
        NOW,
        f"{folder}/staging/txt" if with_text else None,
        path=f"{folder}/table",
    ).awaitTermination()
    rows = {(str(r["JOUR"]), r["LIBELLE_ARRET"], r["CATEGORIE_TITRE"], r["NB_VALD"]) for r in spark.table(table).collect()}
    assert rows == set(FIRST + SECOND if with_text else FIRST)
    assert spark.table(table).schema == schemas.VALIDATIONS


def kpi_run(spark, folder, table, incremental):
    out = f"{folder}/{'incremental' if incremental else 'full'}"

    def write(kpi, name):
        sinks.write_parquet(kpi, f"{out}/{name}")

    plans.stream_kpis(spark, table, write, f"{out}/checkpoint", NOW, incremental, maxFilesPerTrigger=1).awaitTermination()
    return {name: sorted(spark.read.parquet(f"{out}/{name}").collect(), key=str) for name in kpis.KPI_TABLES}


def test_kpis_follow_the_table_in_both_modes(spark, folder):
    table = "kpi_source"
    for step in range(3):
        more = samples.validations(spark).withColumn("NB_VALD", F.col("NB_VALD") + step)
        sinks.append_table(more.repartition(2), table, path=f"{folder}/table")
        spark.catalog.refreshTable(table)
        expected = {
            name: sorted(kpis.by_weekday(spark.table(table), key).collect(), key=str)
            for name, key in kpis.KPI_TABLES.items()
        }
        assert kpi_run(spark, folder, table, incremental=True) == expected
        assert kpi_run(spark, folder, table, incremental=False) == expected


def test_batch_refresh_writes_both_tables(spark):
    written = {}
    plans.refresh_kpis(samples.validations(spark), lambda kpi, name: written.update({name: kpi.count()}))
    assert written == {"titre_transport": 5, "arret": 5}


def envelope(spark, folder, texts):
    rows = [(None, bytearray(t.encode()), "t", 0, i, None, 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, schemas.KAFKA_ENVELOPE).write.mode("append").parquet(f"{folder}/records")
    return stream_sources.stream_parquet(spark, f"{folder}/records", schemas.KAFKA_ENVELOPE)


@pytest.mark.parametrize("infer", [False, True])
def test_messages_from_records_to_table_and_out(spark, folder, infer):
    table = f"stream_messages_{infer}"
    total = 0
    for copies in (2, 3):
        payloads = samples.payloads(samples.messages(spark, copies))
        texts = [r["value"] for r in payloads.collect()] + ["{bad"]
        total += len(texts)
        records = envelope(spark, folder, texts)
        message_plans.land_messages(records, f"{folder}/landing", f"{folder}/land", NOW).awaitTermination()
        message_plans.load_messages(
            spark, f"{folder}/landing", table, f"{folder}/load", NOW, infer=infer, path=f"{folder}/table"
        ).awaitTermination()
        spark.catalog.refreshTable(table)
        assert spark.read.table(table).count() == total
    loaded = spark.table(table).filter("id IS NOT NULL").dropDuplicates()
    wanted = samples.messages(spark, 3).withColumn("year", F.year("begin"))
    assert loaded.select(*wanted.columns).exceptAll(wanted).isEmpty()
    assert wanted.exceptAll(loaded.select(*wanted.columns)).isEmpty()
    assert [p.name for p in Path(folder, "table").glob("year=2024")] == ["year=2024"]

    target = f"{folder}/published"
    message_plans.publish_messages(
        stream_sources.stream_table(spark, table),
        lambda rows: rows.write.mode("append").parquet(target),
        f"{folder}/publish",
        NOW,
    ).awaitTermination()
    assert spark.read.parquet(target).count() == total


@pytest.mark.parametrize("infer", [False, True])
def test_batches_of_malformed_messages_stay(spark, folder, infer):
    table = f"malformed_{infer}"
    for lot in (['{"id":"a"}', "{bad"], ["{bad1", "{bad2"]):
        spark.createDataFrame([(t,) for t in lot], schemas.LANDED).coalesce(1).write.mode("append").json(f"{folder}/landing")
        message_plans.load_messages(
            spark, f"{folder}/landing", table, f"{folder}/load", NOW, infer=infer, path=f"{folder}/table"
        ).awaitTermination()
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 4


def test_publishing_a_retried_batch_repeats_nothing(spark, folder):
    sinks.append_table(samples.messages(spark, 5).repartition(3), "to_publish", path=f"{folder}/table")
    target, failures = f"{folder}/target", []

    def append(rows):
        if not failures:
            failures.append(1)
            rows.limit(7).write.mode("append").parquet(target)
            raise RuntimeError("lost after a part was written")
        rows.write.mode("append").parquet(target)

    def written(batch_id):
        return spark.read.parquet(target).filter(F.col(sinks.BATCH_ID) == batch_id)

    def publish(read_back):
        message_plans.publish_messages(
            stream_sources.stream_table(spark, "to_publish"),
            append,
            f"{folder}/checkpoint",
            NOW,
            read_back,
            tag_batches=True,
        ).awaitTermination()

    with pytest.raises(Exception, match="lost after"):
        publish(None)
    publish(written)
    out = spark.read.parquet(target)
    assert out.count() == 20 and out.select("id").distinct().count() == 20
