"""Commit log, replays, compaction and KPIs by changed keys."""

import threading
from pathlib import Path

import samples
from pyspark.sql import functions as F

from tramline import schemas, sinks
from tramline.catalogue.streams import forget_last_batch
from tramline.operators import kpis
from tramline.plans import messages as message_plans
from tramline.plans import validations as plans
from tramline.sinks.commits import VERSION, CommitLog
from tramline.streaming.sinks import AVAILABLE_NOW as NOW


def rows_of(spark, *values):
    return spark.createDataFrame([(v, v % 3) for v in values], "v long, y int").coalesce(1)


def held(log, spark):
    return sorted(r.v for r in log.read(rows_of(spark, 1).schema).collect())


def test_a_batch_is_added_once(spark, folder):
    log = CommitLog(spark, folder, "y")
    assert held(log, spark) == [] and log.snapshot().last == -1
    assert log.append(rows_of(spark, 1, 2), 0) and not log.append(rows_of(spark, 1, 2), 0)
    assert log.append(rows_of(spark, 3), 1)
    assert held(log, spark) == [1, 2, 3]
    later = log.read(rows_of(spark, 1).schema, after=0)
    assert [(r.v, r.y, r[VERSION]) for r in later.collect()] == [(3, 0, 1)]


def test_only_one_of_two_writers_commits(spark, folder):
    logs = [CommitLog(spark, folder) for _ in range(4)]
    done = []
    for log in logs:  # all have staged before one publishes
        log.staged = log._stage(rows_of(spark, 7))
    def publish(log):
        done.append(log._publish(f"_log/{log._manifest(5)}", {"folder": log.staged}))

    threads = [threading.Thread(target=publish, args=(log,)) for log in logs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == [False, False, False, True] and held(logs[0], spark) == [7]


def test_staged_rows_are_not_read(spark, folder):
    log = CommitLog(spark, folder)
    log.append(rows_of(spark, 1), 0)
    log._stage(rows_of(spark, 9))  # its writer died
    assert held(log, spark) == [1]
    assert log.vacuum() == 1 and held(log, spark) == [1]


def files_in(folder):
    return list(Path(folder, "data").rglob("*.parquet"))


def test_compaction_under_a_reader(spark, folder):
    log, schema = CommitLog(spark, folder, "y"), rows_of(spark, 1).schema
    for k in range(20):
        log.append(rows_of(spark, 3 * k, 3 * k + 1, 3 * k + 2).repartition(3), k)
    reader = log.read(schema)
    assert len(files_in(folder)) >= 40
    assert log.compact(schema) and not log.compact(schema)
    assert log.append(rows_of(spark, 100), 20) and not log.append(rows_of(spark, 5), 7)
    wanted = list(range(60))
    assert sorted(r.v for r in reader.collect()) == wanted and held(log, spark) == [*wanted, 100]
    assert log.snapshot().last == 20
    log.vacuum()
    assert held(log, spark) == [*wanted, 100] and len(files_in(folder)) <= 4
    assert not log.append(rows_of(spark, 5), 7)  # compacted batches stay known


def test_latest_row_of_each_key(spark, folder):
    log = CommitLog(spark, folder)
    for k in range(4):
        log.append(spark.createDataFrame([("a", k, None), (None, 10 * k, "x"), (f"k{k}", 1, "z")], "key string, n long, t string"), k)
    schema = log.spark.createDataFrame([], "key string, n long, t string").schema
    wanted = {("a", 3, None), (None, 30, "x"), *((f"k{k}", 1, "z") for k in range(4))}
    assert {tuple(r) for r in log.latest(schema, ["key"]).collect()} == wanted
    assert log.compact(schema, ["key"])
    assert {tuple(r) for r in log.read(schema).drop(VERSION).collect()} == wanted


def test_replayed_batch_gives_no_row_twice(spark, folder):
    samples.payloads(samples.messages(spark, 3)).repartition(2).write.json(f"{folder}/landing")

    def load():
        message_plans.load_messages(
            spark, f"{folder}/landing", None, f"{folder}/checkpoint", NOW, infer=True,
            commits=f"{folder}/out", maxFilesPerTrigger=1,
        ).awaitTermination()

    load()
    forget_last_batch(spark, f"{folder}/checkpoint")
    load()
    found = message_plans.committed_messages(spark, f"{folder}/out")
    assert found.schema == schemas.MESSAGES
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in samples.messages(spark, 3).collect())


def test_kpis_write_changed_keys_only(spark, folder):
    table, log = f"validations_{abs(hash(folder))}", CommitLog(spark, f"{folder}/totals")
    first = spark.range(4000).selectExpr(
        "DATE'2024-01-22' + CAST(id % 7 AS INT) AS JOUR", "1 AS CODE_STIF_TRNS", "1 AS CODE_STIF_RES",
        "1 AS CODE_STIF_ARRET", "concat('S', id % 500) AS LIBELLE_ARRET", "1 AS ID_ZDC",
        "IF(id % 90 = 0, NULL, concat('T', id % 9)) AS CATEGORIE_TITRE", "CAST(id % 11 AS INT) AS NB_VALD",
    )
    lots = [first, first.limit(3), first.filter("NB_VALD = 5").limit(2)]
    seen = None
    for number, lot in enumerate(lots):
        lot = lot.coalesce(2)
        sinks.append_table(lot, table, path=f"{folder}/table")
        seen = lot if seen is None else seen.unionByName(lot)
        for again in (False, number == 1):
            if again:
                forget_last_batch(spark, f"{folder}/checkpoint")
            plans.stream_kpi_changes(spark, table, log.root, f"{folder}/checkpoint", NOW).awaitTermination()
    folders = [f for _, f in log.snapshot().folders]
    assert len(folders) == 3
    rows = [spark.read.parquet(f"{log.root}/{f}").count() for f in folders]
    assert rows[0] > 500 and rows[1] <= 6 and rows[2] <= 4
    assert log.bytes_of(folders[2]) < log.bytes_of(folders[0]) / 2
    for kpi, key in kpis.KPI_TABLES.items():
        found = plans.changed_kpi(spark, log.root, kpi)
        wanted = kpis.by_weekday(seen, key)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.select(found.columns).collect()))
    assert log.compact(plans.totals_schema(spark), plans.TOTAL_KEYS)
    assert plans.changed_kpi(spark, log.root, "arret").agg(F.sum("TOTAL_VALIDATION")).first()[0] == seen.agg(F.sum("NB_VALD")).first()[0]
