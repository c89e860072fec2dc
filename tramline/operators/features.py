"""Message features: text, time, severity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.functions import causes, moments, text

_LOWERED = "__lowered"

FEATURE_COLUMNS = (
    "text_content",
    "begin_date",
    "end_date",
    "display_duration_hours",
    "words",
    "word_count",
    "message_length_category",
    "transport_types",
    "transportation_types",
    "transport_count",
    "station_list",
    "stations_mentioned",
    "stations_count",
    *fv.FLAG_PATTERNS,
    "severity_level",
    "is_urgent",
    "day_of_week",
    "month_of_year",
    "year",
    "hour_of_day",
    "is_weekend",
    "message_hash",
    "title_length",
)


def time_features(messages: DataFrame) -> DataFrame:
    """Calendar features of `begin`."""
    day = F.dayofweek("begin")
    return messages.withColumns(
        {
            "day_of_week": day,
            "month_of_year": F.month("begin"),
            "year": F.year("begin"),
            "hour_of_day": F.hour("begin"),
            "is_weekend": moments.is_weekend(day),
        }
    )


def build(messages: DataFrame, letter_lines: bool = False) -> DataFrame:
    """All features of flat message rows, as a chain of projections without a shuffle.

    Each step names what later steps use more than once, so Catalyst computes the
    cleaned and the lower-cased text once per row. The lower-cased text is never NULL: without
    tests for NULL the generated method stays below the 8,000 bytes up to which the JVM compiles it.
    """
    kept = [c for c in messages.columns if c not in FEATURE_COLUMNS]
    clean = messages.withColumn("text_content", text.strip_html(F.col("message")))
    lowered = clean.withColumn(_LOWERED, F.coalesce(F.lower("text_content"), F.lit("")))
    source = F.col(_LOWERED)
    found = lowered.withColumns(
        {
            "words": text.clean_tokens(source, lowered=True),
            "transport_types": text.transport_lines(source, letter_lines, lowered=True),
            "station_list": text.stations(source, lowered=True),
            **{name: text.flag(source, p, lowered=True) for name, p in fv.FLAG_PATTERNS.items()},
            "begin_date": F.to_date("begin"),
            "end_date": F.to_date("end"),
            "display_duration_hours": moments.hours_between(F.col("begin"), F.col("end")),
            "severity_level": causes.severity(F.col("cause")),
            "message_hash": F.hash("text_content"),
            "title_length": F.length("title"),
        }
    )
    counted = time_features(found).withColumns(
        {
            "word_count": F.size("words"),
            "message_length_category": text.length_band(F.size("words")),
            "transportation_types": text.joined(F.col("transport_types")),
            "transport_count": F.size("transport_types"),
            "stations_mentioned": text.joined(F.col("station_list")),
            "stations_count": F.size("station_list"),
            "is_urgent": causes.is_urgent(F.col("severity_level"), F.col("display_duration_hours")),
        }
    )
    return counted.select(*kept, *FEATURE_COLUMNS)


def with_defaults(messages: DataFrame, defaults=fv.FEATURE_DEFAULTS) -> DataFrame:
    """Add each default feature whose column is missing; existing columns stay as they are."""
    missing = {n: F.lit(v) for n, v in defaults.items() if n not in messages.columns}
    return messages.withColumns(missing) if missing else messages
