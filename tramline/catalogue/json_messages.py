"""JSON payloads: decode, parse, flatten, explode, encode."""

from pyspark.sql import functions as F

from tramline import schemas, sinks
from tramline.catalogue import views
from tramline.operators import messages
from tramline.plans import messages as plans
from tramline.session import work_folder

_COMPACT = "yyyyMMdd'T'HHmmss"


def _payload():
    """A payload per message: no display period for every seventh, two for the others,
    and an unreadable update time for every eleventh."""
    begin, end = F.date_format("begin", _COMPACT), F.date_format("end", _COMPACT)
    first = F.struct(begin.alias("begin"), end.alias("end"))
    second = F.struct(end.alias("begin"), begin.alias("end"))
    number = F.col("id").cast("bigint")
    return F.struct(
        F.col("id"),
        F.when(number % 7 == 0, F.array().cast("array<struct<begin: string, end: string>>"))
        .otherwise(F.array(first, second))
        .alias("applicationPeriods"),
        F.col("cause"),
        F.when(number % 11 == 0, "soon")
        .otherwise(F.date_format("update_date", _COMPACT))
        .alias("lastUpdate"),
        F.col("message"),
        F.col("pattern").alias("severity"),
        F.col("title"),
    )


def landed(spark, sf):
    return views.messages(spark, sf).select(F.to_json(_payload()).alias("value"))


def envelope(spark, sf):
    """Landed messages as Kafka records."""
    return views.messages(spark, sf).select(
        F.col("id").cast("binary").alias("key"),
        F.to_json(_payload()).cast("binary").alias("value"),
        F.lit("messages").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").cast("bigint").alias("offset"),
        F.col("update_date").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def printable(flat):
    times = ("begin", "end", "update_date")
    return flat.select(*[views.shown(c) if c in times else c for c in flat.columns])


def kafka_value_decode(spark, sf):
    """The decoded text still holds its fields."""
    text = messages.decode_kafka(envelope(spark, sf))
    return text.select(
        *[F.get_json_object("value", f"$.{f}").alias(f) for f in ("id", "cause", "message", "title")]
    )


def json_parse_flatten(spark, sf):
    return printable(messages.flatten(messages.parse_payload(landed(spark, sf))))


def json_flatten_raw_update(spark, sf):
    return printable(messages.flatten(messages.parse_payload(landed(spark, sf)), parse_update=False))


def array_struct_first(spark, sf):
    flat = messages.flatten(messages.parse_payload(landed(spark, sf)))
    return flat.select("id", views.shown("begin"), views.shown("end"))


def json_infer_schema(spark, sf):
    """Flattening by the schema inferred from all payloads."""
    texts = landed(spark, sf)
    return printable(
        messages.flatten(messages.parse_payload(texts, messages.with_payload_types(messages.infer_payload_schema(texts))))
    )


def explode_bulk_disruptions(spark, sf):
    """Messages packed a hundred to a document, then split again."""
    packed = (
        views.messages(spark, sf)
        .groupBy(F.floor(F.col("id").cast("bigint") / 100).alias("document"))
        .agg(F.collect_list(_payload()).alias("disruptions"))
        .select(F.to_json(F.struct("disruptions")).alias("value"))
    )
    return printable(messages.flatten(messages.parse_payload(messages.explode_bulk(packed))))


def to_kafka_value(spark, sf):
    """Whole rows encoded, then decoded field by field; nulls stay."""
    rows = views.messages(spark, sf).select("id", "cause", "message", "pattern", "title")
    encoded = messages.to_kafka_value(rows)
    schema = "id string, cause string, message string, pattern string, title string"
    back = F.from_json("value", schema).alias("row")
    keys = F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("keys")
    return encoded.select(back, keys).select("row.*", "keys")


def json_landing_batch(spark, sf):
    landing = work_folder(spark, "landing")
    sinks.write_json(messages.decode_kafka(envelope(spark, sf)), landing)
    return printable(plans.load_messages_batch(spark, landing))


QUERIES = {
    "kafka_value_decode": kafka_value_decode,
    "json_parse_flatten": json_parse_flatten,
    "json_flatten_raw_update": json_flatten_raw_update,
    "array_struct_first": array_struct_first,
    "json_infer_schema": json_infer_schema,
    "explode_bulk_disruptions": explode_bulk_disruptions,
    "to_kafka_value": to_kafka_value,
    "json_landing_batch": json_landing_batch,
}

_PERIOD = """CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST("{c}" AS VARCHAR) END AS "{c}\""""
_PERIODS = f"{_PERIOD.format(c='begin')}, {_PERIOD.format(c='end')}"

FLAT_SQL = f"""WITH {views.MESSAGES_SQL}
SELECT id, {_PERIODS}, cause,
       CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(update_date AS VARCHAR) END AS update_date,
       message, pattern, title,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(year("begin") AS INTEGER) END AS year
FROM messages"""


def oracles():
    return {
        "kafka_value_decode": f"WITH {views.MESSAGES_SQL} SELECT id, cause, message, title FROM messages",
        "json_parse_flatten": FLAT_SQL,
        "json_flatten_raw_update": f"""WITH {views.MESSAGES_SQL}
SELECT id, {_PERIODS}, cause,
       CASE WHEN doc_id % 11 = 0 THEN 'soon' ELSE strftime(update_date, '%Y%m%dT%H%M%S') END AS "lastUpdate",
       message, pattern, title
FROM messages""",
        "array_struct_first": f"WITH {views.MESSAGES_SQL} SELECT id, {_PERIODS} FROM messages",
        "json_infer_schema": FLAT_SQL,
        "explode_bulk_disruptions": FLAT_SQL,
        "to_kafka_value": f"""WITH {views.MESSAGES_SQL}
SELECT id, cause, message, pattern, title, 'cause,id,message,pattern,title' AS keys FROM messages""",
        "json_landing_batch": FLAT_SQL,
    }
