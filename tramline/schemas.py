"""Fixed schemas of the tables and files that the jobs exchange."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def ddl(schema: StructType) -> str:
    """The schema as a column list in SQL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


_TEXT, _INT, _TIME = StringType(), IntegerType(), TimestampType()

# Ticket-gate counts, one row per day, stop and ticket category.
VALIDATIONS = _table(
    JOUR=DateType(),
    CODE_STIF_TRNS=_INT,
    CODE_STIF_RES=_INT,
    CODE_STIF_ARRET=_INT,
    LIBELLE_ARRET=_TEXT,
    ID_ZDC=_INT,
    CATEGORIE_TITRE=_TEXT,
    NB_VALD=_INT,
)

# One landed disruption message: the JSON text of its payload.
LANDED = _table(value=_TEXT)

# The payload fields that the jobs read; any others are ignored.
PAYLOAD = _table(
    id=_TEXT,
    applicationPeriods=ArrayType(_table(begin=_TEXT, end=_TEXT)),
    cause=_TEXT,
    lastUpdate=_TEXT,
    message=_TEXT,
    severity=_TEXT,
    title=_TEXT,
)

# One document of the bulk service. Its members stay raw JSON text, so that
# fields outside PAYLOAD survive the split into single messages.
BULK_DOCUMENT = _table(disruptions=ArrayType(_TEXT))

# Flattened messages; `year` is the partition column.
MESSAGES = _table(
    id=_TEXT,
    begin=_TIME,
    end=_TIME,
    cause=_TEXT,
    update_date=_TIME,
    message=_TEXT,
    pattern=_TEXT,
    title=_TEXT,
    year=_INT,
)

KAFKA_ENVELOPE = _table(
    key=BinaryType(),
    value=BinaryType(),
    topic=_TEXT,
    partition=_INT,
    offset=LongType(),
    timestamp=_TIME,
    timestampType=_INT,
)
