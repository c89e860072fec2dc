"""Scans, tables and file round trips."""

import uuid

from pyspark.sql import functions as F

from tramline import sinks, sources
from tramline.catalogue import text, views
from tramline.operators import classify, features
from tramline.plans import messages as plans
from tramline.session import work_folder


def new_table(spark, purpose):
    """A fresh table name and a folder for its files."""
    return f"{purpose}_{uuid.uuid4().hex}", work_folder(spark, purpose)


def printable(rows):
    return rows.select(
        *[
            views.shown(f.name) if f.dataType.simpleString() in ("date", "timestamp") else f.name
            for f in rows.schema
        ]
    )


def scan_parquet(spark, sf):
    """Footer schema; of the eleven columns, the scan reads three."""
    lines = sources.read_parquet(spark, f"{sf}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag")


def scan_parquet_schema(spark, sf):
    """Given schema, a subset of the file's columns."""
    schema = spark.createDataFrame([], "o_orderkey bigint, o_orderstatus string").schema
    return sources.read_parquet(spark, f"{sf}/orders.parquet", schema)


def csv_infer_roundtrip(spark, sf):
    """Messages as CSV with markup, quotes and line breaks; types inferred on reading."""
    path = work_folder(spark, "csv")
    sinks.export_csv(views.messages(spark, sf), path)
    back = sources.read_csv(spark, path, multiline=True)
    return printable(back.withColumn("id", F.col("id").cast("bigint")))


def csv_export_formats(spark, sf):
    """The exported texts of dates and times, read as plain strings."""
    path = work_folder(spark, "csv")
    rows = views.messages(spark, sf).select("id", F.to_date("begin").alias("day"), "begin", "end")
    sinks.export_csv(rows, path)
    return spark.read.csv(path, header=True)


def table_scan_sql(spark, sf):
    """A table in a database of its own, with its columns as the catalog lists them."""
    name, path = new_table(spark, "validations")
    sinks.ensure_database(spark, "transit")
    sinks.append_table(views.validations(spark, sf), f"transit.{name}", path=path)
    columns = ", ".join(sources.table_schema(spark, f"transit.{name}").names)
    return printable(spark.sql(f"SELECT {columns} FROM transit.{name}"))


def features_json_roundtrip(spark, sf):
    path = work_folder(spark, "features")
    built = features.build(views.messages(spark, sf)).drop("message_hash", "message")
    sinks.write_json(built, path, "overwrite")
    return text.printable(sources.read_json(spark, path, built.schema))


def messages_by_year_partition(spark, sf):
    """Appended by year twice, all years read back."""
    name, path = new_table(spark, "messages")
    rows = views.messages(spark, sf).withColumn("year", F.year("begin"))
    odd = F.col("id").cast("bigint") % 2 == 1
    sinks.append_table(rows.filter(odd), name, "year", rebalance=True, path=path)
    sinks.append_table(rows.filter(~odd), name, "year", path=path)
    return printable(sources.read_table(spark, name))


def messages_export_table(spark, sf):
    """The table's CSV export."""
    name, path = new_table(spark, "messages")
    sinks.append_table(views.messages(spark, sf), name, path=path)
    out = work_folder(spark, "export")
    plans.export_messages(spark, name, out)
    schema = views.messages(spark, sf).schema
    return printable(sources.read_csv(spark, out, schema, multiline=True))


def vectors_parquet_roundtrip(spark, sf):
    """Vector columns written and read; their sizes and sums."""
    from pyspark.ml.feature import VectorAssembler

    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    vectors = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="v").transform(rows)
    path = work_folder(spark, "vectors")
    sinks.write_parquet(vectors.select("l_orderkey", "l_linenumber", "v"), path)
    back = classify.vector_to_array("v")
    return sources.read_parquet(spark, path).select(
        "l_orderkey", "l_linenumber", back[0].alias("quantity"), back[1].alias("tax")
    )


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_parquet_schema": scan_parquet_schema,
    "csv_infer_roundtrip": csv_infer_roundtrip,
    "csv_export_formats": csv_export_formats,
    "table_scan_sql": table_scan_sql,
    "features_json_roundtrip": features_json_roundtrip,
    "messages_by_year_partition": messages_by_year_partition,
    "messages_export_table": messages_export_table,
    "vectors_parquet_roundtrip": vectors_parquet_roundtrip,
}

VALIDATION_ROWS_SQL = f"""WITH {views.VALIDATIONS_SQL}
SELECT CAST(JOUR AS VARCHAR) AS JOUR, CODE_STIF_TRNS, CODE_STIF_RES, CODE_STIF_ARRET,
       LIBELLE_ARRET, ID_ZDC, CATEGORIE_TITRE, NB_VALD
FROM validations"""


def oracles():
    times = views.shown_sql("begin", "end", "update_date")
    rest = "cause, message, pattern, title"
    return {
        "scan_parquet": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
        "scan_parquet_schema": "SELECT o_orderkey, o_orderstatus FROM orders",
        "csv_infer_roundtrip": f"""WITH {views.MESSAGES_SQL}
SELECT doc_id AS id, {times}, {rest} FROM messages""",
        "csv_export_formats": f"""WITH {views.MESSAGES_SQL}
SELECT id, strftime("begin", '%Y-%m-%d') AS day, strftime("begin", '%Y-%m-%d %H:%M:%S') AS "begin",
       strftime("end", '%Y-%m-%d %H:%M:%S') AS "end"
FROM messages""",
        "table_scan_sql": VALIDATION_ROWS_SQL,
        "features_json_roundtrip": text.FEATURES_SQL,
        "messages_by_year_partition": f"""WITH {views.MESSAGES_SQL}
SELECT id, {times}, {rest}, CAST(year("begin") AS INTEGER) AS year FROM messages""",
        "messages_export_table": f"WITH {views.MESSAGES_SQL} SELECT id, {times}, {rest} FROM messages",
        "vectors_parquet_roundtrip": """
SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_tax AS tax FROM lineitem""",
    }
