"""From Kafka envelopes and JSON payloads to flat message rows, and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline import schemas
from tramline.functions.moments import compact_timestamp


def decode_kafka(envelope: DataFrame) -> DataFrame:
    """The message text of each Kafka record."""
    return envelope.select(F.col("value").cast("string").alias("value"))


def explode_bulk(documents: DataFrame) -> DataFrame:
    """One row per disruption of each bulk document, as raw JSON text."""
    disruptions = F.from_json("value", schemas.BULK_DOCUMENT)["disruptions"]
    return documents.select(F.explode(disruptions).alias("value"))


def infer_payload_schema(landed: DataFrame) -> StructType:
    """Schema that covers the JSON texts in `value`, merged by one aggregation.

    Only the schema text reaches the driver. Texts that are not JSON are skipped;
    as in Spark's JSON reader, fields that are always null or of mixed types become
    strings and fractions doubles.
    """
    merged = F.schema_of_variant_agg(F.try_parse_json("value"))
    # Variant parsing has its own names for these types; retype the leaves in SQL text.
    ddl = F.regexp_replace(merged, r"\bOBJECT<", "STRUCT<")
    ddl = F.regexp_replace(ddl, r"(?<=: |<)(?:VOID|VARIANT)(?=[,>])", "STRING")
    ddl = F.regexp_replace(ddl, r"(?<=: |<)DECIMAL\(\d+, *\d+\)(?=[,>])", "DOUBLE")
    text = landed.agg(ddl.alias("ddl")).first()["ddl"]
    if text is None or not text.startswith("STRUCT<") or text == "STRUCT<>":
        return StructType([])
    return StructType.fromDDL(f"payload {text}")["payload"].dataType


def with_payload_types(inferred: StructType) -> StructType:
    """The payload's own fields in their fixed types, then the other inferred ones.

    Rows flatten alike whatever a batch happens to hold.
    """
    known = {f.name for f in schemas.PAYLOAD}
    return StructType([*schemas.PAYLOAD, *(f for f in inferred if f.name not in known)])


def parse_payload(landed: DataFrame, schema: StructType = schemas.PAYLOAD) -> DataFrame:
    """The payload's fields as columns; a malformed text gives a row of NULLs."""
    return landed.select(F.from_json("value", schema).alias("payload")).select("payload.*")


def flatten(payload: DataFrame, parse_update: bool = True) -> DataFrame:
    """Flat message rows: first display period, cause, texts.

    `parse_update=False` keeps the update time as the raw `lastUpdate` text and
    adds no year.
    """
    period = F.get("applicationPeriods", F.lit(0))
    begin = compact_timestamp(period["begin"])
    if parse_update:
        update = compact_timestamp(F.col("lastUpdate")).alias("update_date")
    else:
        update = F.col("lastUpdate")
    flat = payload.select(
        "id",
        begin.alias("begin"),
        compact_timestamp(period["end"]).alias("end"),
        "cause",
        update,
        "message",
        F.col("severity").alias("pattern"),
        "title",
    )
    return flat.withColumn("year", F.year("begin")) if parse_update else flat


def to_kafka_value(records: DataFrame) -> DataFrame:
    """Each row as one JSON text in the column a Kafka writer expects; nulls kept."""
    whole = F.struct(*records.columns)
    return records.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))
