"""Text and cause expressions."""

from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.catalogue import views
from tramline.functions import causes, moments, text
from tramline.operators import features

_PHRASE_PREFIX = "the "


def _clean(spark, sf):
    return views.messages(spark, sf).withColumn("text_content", text.strip_html(F.col("message")))


def html_clean(spark, sf):
    return views.pages(spark, sf).select(
        "page_id", text.strip_html(F.col("message")).alias("text_content")
    )


def text_tokens(spark, sf):
    return _clean(spark, sf).select("id", text.joined(text.tokens(F.col("text_content"))).alias("words"))


def text_word_count(spark, sf):
    return _clean(spark, sf).select("id", text.word_count(F.col("text_content")).alias("word_count"))


def text_length_category(spark, sf):
    counted = text_word_count(spark, sf)
    return counted.select(
        "id", text.length_band(F.col("word_count")).alias("message_length_category")
    )


def text_flags(spark, sf):
    lowered = _clean(spark, sf).select("id", F.lower("text_content").alias("lowered"))
    flags = [text.flag(F.col("lowered"), p, lowered=True).alias(n) for n, p in fv.FLAG_PATTERNS.items()]
    return lowered.select("id", *flags)


def _mentions(array, joined, count):
    def run(spark, sf):
        found = _clean(spark, sf).select("id", array(F.col("text_content")).alias("found"))
        return found.select(
            "id", text.joined(F.col("found")).alias(joined), F.size("found").alias(count)
        )

    return run


def extract_phrases(spark, sf):
    """Station extraction with a prefix that the raw documents are full of."""
    documents = views.table(spark, sf, "documents")
    found = documents.select(
        "doc_id", text.place_mentions(F.col("text"), _PHRASE_PREFIX).alias("found")
    )
    return found.select(
        "doc_id", text.joined(F.col("found")).alias("phrases"), F.size("found").alias("phrase_count")
    )


def title_length(spark, sf):
    return views.table(spark, sf, "pages").select("page_id", F.length("html").alias("title_length"))


def severity_urgency(spark, sf):
    level = causes.severity(F.col("cause"))
    hours = moments.hours_between(F.col("begin"), F.col("end"))
    return views.messages(spark, sf).select(
        "id", level.alias("severity_level"), causes.is_urgent(level, hours).alias("is_urgent")
    )


def feature_defaults(spark, sf):
    """Only the missing features are added; `title_length` and `pattern` are there already."""
    rows = views.messages(spark, sf).select("id", "pattern", F.length("title").alias("title_length"))
    return features.with_defaults(rows)


def message_hash(spark, sf):
    return features.build(views.messages(spark, sf)).select("id", "message_hash")


def printable(built):
    """Every feature but the hash, arrays and dates as text."""
    arrays = {"words", "transport_types", "station_list"}
    dates = {"begin", "end", "update_date", "begin_date", "end_date"}
    columns = [c for c in built.columns if c not in ("message_hash", "message")]
    return built.select(
        *[
            text.joined(F.col(c)).alias(c) if c in arrays else views.shown(c) if c in dates else c
            for c in columns
        ]
    )


def message_features(spark, sf):
    return printable(features.build(views.messages(spark, sf)))


QUERIES = {
    "html_clean": html_clean,
    "text_tokens": text_tokens,
    "text_word_count": text_word_count,
    "text_length_category": text_length_category,
    "text_flags": text_flags,
    "extract_transport_lines": _mentions(
        text.transport_lines, "transportation_types", "transport_count"
    ),
    "extract_stations": _mentions(text.stations, "stations_mentioned", "stations_count"),
    "extract_phrases": extract_phrases,
    "title_length": title_length,
    "severity_urgency": severity_urgency,
    "feature_defaults": feature_defaults,
    "message_features": message_features,
    "message_hash": message_hash,
}

_BAND = """CASE WHEN len(words) < 30 THEN 'short' WHEN len(words) < 100 THEN 'medium' ELSE 'long' END"""
_FLAGS = ",\n       ".join(
    "CAST(regexp_matches(lower(text_content), '{}') AS INTEGER) AS {}".format(p.replace("'", "''"), n)
    for n, p in fv.FLAG_PATTERNS.items()
)
# RE2 has no lookbehind: the left boundary is matched with the mention and cut off,
# the right one is implied by the blank before the number.
_LINES = r"""list_transform(
         regexp_extract_all(lower(text_content),
           '(?:^|[^\p{L}\p{N}_])((?:ligne|bus|train|rer|métro|tramway|tram)\s+\p{Nd}+)', 1),
         lambda m: regexp_replace(m, '\s+', ' '))"""
_STATIONS = r"""list_transform(
         regexp_extract_all(lower(text_content), 'gare de ([^,.:;<>]+)', 1), lambda s: trim(s))"""
_SEVERITY = """CASE cause WHEN 'INFORMATION' THEN 1 WHEN 'PERTURBATION' THEN 2
         WHEN 'TRAVAUX' THEN 3 WHEN 'ACCIDENT' THEN 4 ELSE 2 END"""
_HOURS = """CAST(epoch("end") - epoch("begin") AS BIGINT) / 3600"""
_URGENT = f"""CASE WHEN ({_SEVERITY}) >= 3 AND {_HOURS} <= 24 THEN 1 ELSE 0 END"""

FEATURES_SQL = f"""WITH {views.CLEAN_SQL},
listed AS (SELECT *, {_LINES} AS lines, {_STATIONS} AS places FROM worded)
SELECT id, {views.shown_sql("begin", "end", "update_date")}, cause, pattern, title, text_content,
       CAST(CAST("begin" AS DATE) AS VARCHAR) AS begin_date,
       CAST(CAST("end" AS DATE) AS VARCHAR) AS end_date,
       {_HOURS} AS display_duration_hours,
       array_to_string(words, '|') AS words, CAST(len(words) AS INTEGER) AS word_count,
       {_BAND} AS message_length_category,
       array_to_string(lines, '|') AS transport_types,
       array_to_string(lines, '|') AS transportation_types,
       CAST(len(lines) AS INTEGER) AS transport_count,
       array_to_string(places, '|') AS station_list,
       array_to_string(places, '|') AS stations_mentioned,
       CAST(len(places) AS INTEGER) AS stations_count,
       {_FLAGS},
       {_SEVERITY} AS severity_level, {_URGENT} AS is_urgent,
       CAST(dayofweek("begin") + 1 AS INTEGER) AS day_of_week,
       CAST(month("begin") AS INTEGER) AS month_of_year, CAST(year("begin") AS INTEGER) AS year,
       CAST(hour("begin") AS INTEGER) AS hour_of_day,
       CAST(dayofweek("begin") IN (0, 6) AS INTEGER) AS is_weekend,
       CAST(length(title) AS INTEGER) AS title_length
FROM listed"""


def _default_sql(value):
    if isinstance(value, str):
        return f"'{value}'"
    return f"CAST({value} AS DOUBLE)" if isinstance(value, float) else str(value)


def _murmur_sql(source: str, column: str) -> str:
    """Spark's `hash`: Murmur3 with seed 42 over four-byte words, then single signed bytes."""
    mask = "CAST(4294967295 AS UBIGINT)"

    def times(x, factor):
        return f"((({x}) * CAST({factor} AS UBIGINT)) & {mask})"

    def rotated(x, bits):
        return f"(((({x}) << {bits}) | (({x}) >> {32 - bits})) & {mask})"

    def folded(x, bits):
        return f"xor({x}, (({x}) >> {bits}))"

    mixed = times(rotated(times("k", 0xCC9E2D51), 15), 0x1B873593)
    step = f"(({rotated('xor(h, k)', 13)} * 5 + CAST({0xE6546B64} AS UBIGINT)) & {mask})"
    return f"""
hexed AS (SELECT id, hex(encode({column})) AS h, octet_length(encode({column})) AS n FROM {source}),
words_of AS (
  SELECT id, n, list_concat(
    list_transform(regexp_extract_all(substr(h, 1, n // 4 * 8), '.{{8}}'),
      lambda x: CAST('0x' || x[7:8] || x[5:6] || x[3:4] || x[1:2] AS UBIGINT)),
    list_transform(regexp_extract_all(substr(h, n // 4 * 8 + 1), '..'),
      lambda x: CAST('0x' || CASE WHEN x >= '80' THEN 'FFFFFF' ELSE '' END || x AS UBIGINT))) AS ks
  FROM hexed),
run_0 AS (
  SELECT id, n, list_reduce(list_transform(ks, lambda k: {mixed}), lambda h, k: {step},
                            CAST(42 AS UBIGINT)) AS h FROM words_of),
run_1 AS (SELECT id, xor(h, CAST(n AS UBIGINT)) AS h FROM run_0),
run_2 AS (SELECT id, {times(folded("h", 16), 0x85EBCA6B)} AS h FROM run_1),
run_3 AS (SELECT id, {times(folded("h", 13), 0xC2B2AE35)} AS h FROM run_2),
run_4 AS (SELECT id, {folded("h", 16)} AS h FROM run_3)
SELECT id, CAST(CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE h END AS INTEGER)
         AS message_hash
FROM run_4"""


def oracles():
    clean = f"WITH {views.CLEAN_SQL}"
    defaults = ", ".join(
        f"{_default_sql(v)} AS {n}"
        for n, v in fv.FEATURE_DEFAULTS.items()
        if n not in ("pattern", "title_length")
    )
    return {
        "html_clean": f"""
SELECT page_id, {views.clean_sql("html || '&nbsp;&nbsp;end'")} AS text_content FROM pages""",
        "text_tokens": f"{clean} SELECT id, array_to_string(words, '|') AS words FROM worded",
        "text_word_count": f"{clean} SELECT id, CAST(len(words) AS INTEGER) AS word_count FROM worded",
        "text_length_category": f"{clean} SELECT id, {_BAND} AS message_length_category FROM worded",
        "text_flags": f"{clean} SELECT id, {_FLAGS} FROM clean",
        "extract_transport_lines": f"""{clean}
SELECT id, array_to_string({_LINES}, '|') AS transportation_types,
       CAST(len({_LINES}) AS INTEGER) AS transport_count FROM clean""",
        "extract_stations": f"""{clean}
SELECT id, array_to_string({_STATIONS}, '|') AS stations_mentioned,
       CAST(len({_STATIONS}) AS INTEGER) AS stations_count FROM clean""",
        "extract_phrases": r"""
WITH found AS (
  SELECT doc_id, list_transform(
           regexp_extract_all(lower(text), 'the ([^,.:;<>]+)', 1),
           lambda s: regexp_replace(s, '^[\s\x0B\x1c-\x1f\x85\p{Z}]+|[\s\x0B\x1c-\x1f\x85\p{Z}]+$', '', 'g')) AS phrases
  FROM documents)
SELECT doc_id, array_to_string(phrases, '|') AS phrases, CAST(len(phrases) AS INTEGER) AS phrase_count
FROM found""",
        "title_length": "SELECT page_id, CAST(length(html) AS INTEGER) AS title_length FROM pages",
        "severity_urgency": f"""WITH {views.MESSAGES_SQL}
SELECT id, {_SEVERITY} AS severity_level, {_URGENT} AS is_urgent FROM messages""",
        "feature_defaults": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, lang AS pattern,
       CAST(length(source) AS INTEGER) AS title_length, {defaults}
FROM documents""",
        "message_features": FEATURES_SQL,
        "message_hash": f"{clean}, {_murmur_sql('clean', 'text_content')}",
    }
