import json
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
import samples
from pyspark.sql import functions as F

from tramline import schemas, sinks, sources
from tramline.plans import messages as plans
from tramline.session import materialise, work_folder
from tramline.streaming import sources as stream_sources


def test_json_lines_are_all_read_and_multiline_is_the_lossy_option(spark, folder):
    samples.write_lines(Path(folder) / "in/a.json", [json.dumps({"value": str(i)}) for i in range(5)])
    assert sources.read_json(spark, f"{folder}/in", schemas.LANDED).count() == 5
    assert sources.read_json(spark, f"{folder}/in", schemas.LANDED, multiline=True).count() == 1


def test_json_append_and_overwrite(spark, folder):
    rows = spark.createDataFrame([("x",)], schemas.LANDED)
    for mode, count in (("append", 1), ("append", 2), ("overwrite", 1)):
        sinks.write_json(rows, f"{folder}/out", mode)
        assert spark.read.json(f"{folder}/out").count() == count


def test_csv_bad_cells_become_null(spark, folder):
    lines = [
        samples.CSV_HEADER.replace(";", ","),
        "2024-01-22,1,2,3,NATION,7,Navigo,12",
        "someday,1,,3,ÉTOILE,7,Navigo,many",
    ]
    samples.write_lines(Path(folder) / "a.csv", lines)
    good, bad = sources.read_csv(spark, f"{folder}/a.csv", schemas.VALIDATIONS).collect()
    assert (good["JOUR"], good["NB_VALD"]) == (date(2024, 1, 22), 12)
    assert (bad["JOUR"], bad["CODE_STIF_RES"], bad["LIBELLE_ARRET"], bad["NB_VALD"]) == (None, None, "ÉTOILE", None)


def test_csv_with_the_wrong_separator_is_all_null(spark, folder):
    samples.write_lines(Path(folder) / "a.csv", [samples.CSV_HEADER, *samples.csv_lines([("2024-01-22", "N", "C", 1)])])
    (row,) = sources.read_csv(spark, f"{folder}/a.csv", schemas.VALIDATIONS).collect()
    assert set(row) == {None}


def test_export_formats_and_texts_survive(spark, folder):
    rows = spark.createDataFrame(
        [(date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), 'a "quoted", é\nsecond line', None, "\\")],
        "d date, t timestamp, m string, n string, b string",
    )
    sinks.export_csv(rows, f"{folder}/out")
    files = list(Path(folder, "out").glob("*.csv"))
    text = "".join(f.read_text() for f in files)
    assert "2024-01-02,2024-01-02 03:04:05," in text and text.startswith("d,t,m,n,b")
    assert sources.read_csv(spark, f"{folder}/out", multiline=True).collect() == rows.collect()


def test_csv_goes_out_in_parts(spark, folder):
    sinks.export_csv(spark.range(0, 100, numPartitions=4), f"{folder}/many")
    assert len(list(Path(folder, "many").glob("*.csv"))) == 4


def test_tables(spark, folder, plan_of):
    sinks.ensure_database(spark, "transit")
    sinks.ensure_database(spark, "transit")
    rows = samples.messages(spark, copies=2).withColumn("year", F.year("begin"))
    old = rows.withColumn("year", F.lit(2023))
    none = rows.withColumn("year", F.lit(None).cast("int"))
    for part in (rows, old, none):
        sinks.append_table(part, "transit.messages", "year", rebalance=True)
    assert sources.table_schema(spark, "transit.messages")["year"].dataType.simpleString() == "int"
    assert sources.read_table(spark, "transit.messages").count() == 24
    pruned = sources.read_table(spark, "transit.messages", "year = 2023")
    assert pruned.count() == 8
    assert "PartitionFilters: [isnotnull(year" in plan_of(pruned)
    assert sources.read_table(spark, "transit.messages", "year IS NULL").count() == 8
    plans.export_messages(spark, "transit.messages", f"{folder}/export")
    assert sources.read_csv(spark, f"{folder}/export").count() == 24


def test_rebalanced_append_splits_a_hot_partition(spark, folder):
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("t"), F.when(F.col("id") % 10 > 0, 2024).otherwise(2023).alias("year")
    )
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    before = {k: spark.conf.get(k) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        sinks.append_table(rows, "hot_year", "year", rebalance=True, path=f"{folder}/hot")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {y: len(list(Path(folder, f"hot/year={y}").glob("*.parquet"))) for y in (2023, 2024)}
    assert files[2024] > 4 * files[2023] / 2 and spark.table("hot_year").count() == 200_000


def test_batch_load_with_and_without_inference(spark, folder):
    payload = {"id": "a", "applicationPeriods": [{"begin": "20240131T080000", "end": "20240131T100000"}],
               "cause": "TRAVAUX", "lastUpdate": "20240130T070000", "message": "m", "severity": "s", "title": "t"}
    rows = spark.createDataFrame([(json.dumps(payload),), ("{bad",)], schemas.LANDED)
    sinks.write_json(rows, f"{folder}/landing")
    fixed = plans.load_messages_batch(spark, f"{folder}/landing", "loaded", path=f"{folder}/loaded")
    inferred = plans.load_messages_batch(spark, f"{folder}/landing", infer=True)
    assert sorted(fixed.collect(), key=str) == sorted(inferred.collect(), key=str)
    assert spark.table("loaded").select(*fixed.columns).exceptAll(fixed).count() == 0
    raw = plans.load_messages_batch(spark, f"{folder}/landing", parse_update=False)
    assert "lastUpdate" in raw.columns and "year" not in raw.columns


class Recorder:
    """Stands in for a DataFrame whose JDBC write is only noted."""

    def __init__(self):
        self.write = self
        self.calls = []

    def repartition(self, tasks):
        self.tasks = tasks
        return self

    def jdbc(self, **call):
        self.calls.append(call)


def test_jdbc_write_bounds_connections():
    rows = Recorder()
    sinks.write_jdbc(rows, "jdbc:x", "arret", "overwrite", {"user": "u", "driver": "d"}, connections=3)
    (call,) = rows.calls
    assert rows.tasks == 3
    assert (call["url"], call["table"], call["mode"]) == ("jdbc:x", "arret", "overwrite")
    assert call["properties"] == {"numPartitions": "3", "batchsize": "10000", "user": "u", "driver": "d"}


def test_append_once_completes_a_partly_written_batch(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", None)], "id string, n int")
    done = []

    def written(batch_id):
        rows = spark.createDataFrame([("a", 1, 7), ("c", None, 7), ("b", 2, 6)], "id string, n int, batch_id bigint")
        return rows.filter(F.col("batch_id") == batch_id)

    sinks.append_once(batch, 7, written, done.append)
    assert sorted(tuple(r) for r in done[0].collect()) == [("a", 1, 7), ("b", 2, 7)]
    sinks.append_once(batch, 8, written, done.append)
    assert done[1].count() == 4
    sinks.append_once(batch, 0, None, done.append)
    assert done[2].count() == 4


def test_kafka_options_and_missing_connector(spark):
    options = stream_sources.kafka_options("h:9092", "t", maxOffsetsPerTrigger=5)
    assert options == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "maxOffsetsPerTrigger": 5}
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_sources.stream_kafka(spark, "h:9092", "t")
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.write_kafka(spark.createDataFrame([("x",)], "value string"), "h:9092", "t")


def test_explicit_and_footer_schema(spark, folder):
    rows = samples.validations(spark)
    sinks.write_parquet(rows, f"{folder}/v")
    assert sources.read_parquet(spark, f"{folder}/v").schema == rows.schema
    narrow = rows.select("JOUR", "NB_VALD").schema
    assert sources.read_parquet(spark, f"{folder}/v", narrow).columns == ["JOUR", "NB_VALD"]


def test_work_folders_are_new_and_shared(spark):
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_materialise_cuts_lineage(spark, plan_of):
    rows = spark.range(10).withColumn("x", F.rand(1))
    kept = materialise(rows, "test")
    assert kept.collect() == kept.collect() and "rand" not in plan_of(kept)


def test_only_plain_local_mode_may_lack_a_shared_folder():
    def session(master):
        conf = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert work_folder(session("local[4]"), "x") != work_folder(session("local"), "x")
    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="checkpoint"):
            work_folder(session(master), "x")
