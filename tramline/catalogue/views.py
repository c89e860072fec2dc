"""Transit-shaped views of the sample tables, in Spark and as SQL for checking.

Validations come from `events`, messages from `documents`, HTML from `pages`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cue words, one per message in turn: each of the seven flags, then none.
CUES = ("Itinéraire", "FERMÉE", "Retard", "Jusqu'au", "Matinée", "SOIRÉE", "Week-end", "Rien")
# Begin times repeat after so many hours, so that years stay few however many messages.
HOURS = 2 * 366 * 24
CAUSES = ("INFORMATION", "PERTURBATION", "TRAVAUX", "ACCIDENT", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def validations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS DATE) AS JOUR",
        "CAST(user_id % 4 AS INT) AS CODE_STIF_TRNS",
        "CAST(IF(user_id % 50 = 0, NULL, user_id % 10) AS INT) AS CODE_STIF_RES",
        "CAST(user_id % 100 AS INT) AS CODE_STIF_ARRET",
        "concat('STOP_', user_id) AS LIBELLE_ARRET",
        "CAST(user_id % 1000000 AS INT) AS ID_ZDC",
        "event_type AS CATEGORIE_TITRE",
        "CAST(round(value * 100) AS INT) AS NB_VALD",
    )


VALIDATIONS_SQL = """
validations AS (
  SELECT CAST(ts AS DATE) AS JOUR,
         CAST(user_id % 4 AS INTEGER) AS CODE_STIF_TRNS,
         CAST(CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id % 10 END AS INTEGER) AS CODE_STIF_RES,
         CAST(user_id % 100 AS INTEGER) AS CODE_STIF_ARRET,
         'STOP_' || user_id AS LIBELLE_ARRET,
         CAST(user_id % 1000000 AS INTEGER) AS ID_ZDC,
         event_type AS CATEGORIE_TITRE,
         CAST(round(value * 100) AS INTEGER) AS NB_VALD
  FROM events
)"""


def _pick(values, index: str) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.expr(f"CAST({index} AS INT)"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message rows with HTML, a cue word, a bus line and a station in each text.

    Every fiftieth has no end. Times are wall-clock times, whatever the session zone.
    """
    documents = table(spark, sf_dir, "documents")
    begin = f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(doc_id % {HOURS} AS INT))"
    shown = "make_dt_interval(0, CAST(doc_id * 7 % 97 AS INT))"
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.expr(f"CAST({begin} AS TIMESTAMP)").alias("begin"),
        F.expr(f"IF(doc_id % 50 = 49, NULL, CAST({begin} + {shown} AS TIMESTAMP))").alias("end"),
        _pick(CAUSES, "doc_id % 5").alias("cause"),
        F.expr(f"CAST({begin} AS TIMESTAMP)").alias("update_date"),
        F.concat(
            F.lit("<p>"),
            "text",
            F.lit("</p>&nbsp;<b>"),
            _pick(CUES, "doc_id % 8"),
            F.lit("</b> Bus  "),
            F.expr("CAST(doc_id % 20 AS STRING)"),
            F.lit(" puis RER B, Gare de "),
            "source",
            F.lit(" ."),
        ).alias("message"),
        F.col("lang").alias("pattern"),
        F.col("source").alias("title"),
    )


def _sql_list(values) -> str:
    quoted = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return "[" + ", ".join(quoted) + "]"


MESSAGES_SQL = f"""
messages AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
         TIMESTAMP '2024-01-01' + to_hours(doc_id % {HOURS}) AS "begin",
         CASE WHEN doc_id % 50 = 49 THEN NULL
              ELSE TIMESTAMP '2024-01-01' + to_hours(doc_id % {HOURS}) + to_hours(doc_id * 7 % 97) END AS "end",
         ({_sql_list(CAUSES)})[doc_id % 5 + 1] AS cause,
         TIMESTAMP '2024-01-01' + to_hours(doc_id % {HOURS}) AS update_date,
         '<p>' || text || '</p>&nbsp;<b>' || ({_sql_list(CUES)})[doc_id % 8 + 1]
           || '</b> Bus  ' || (doc_id % 20) || ' puis RER B, Gare de ' || source || ' .' AS message,
         lang AS pattern,
         source AS title
  FROM documents
)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages as messages, with an entity at the end."""
    raw = table(spark, sf_dir, "pages")
    return raw.select("page_id", F.concat("html", F.lit("&nbsp;&nbsp;end")).alias("message"))


# Java's \s has the vertical tab, RE2's has not.
BLANKS_SQL = r"[\s\x0B]+"


def clean_sql(column: str) -> str:
    return (
        f"regexp_replace(replace(regexp_replace({column}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), "
        f"'{BLANKS_SQL}', ' ', 'g')"
    )


def words_sql(column: str) -> str:
    return f"list_filter(string_split_regex(lower({column}), '{BLANKS_SQL}'), lambda w: w <> '')"


CLEAN_SQL = f"""{MESSAGES_SQL},
clean AS (SELECT *, {clean_sql("message")} AS text_content FROM messages),
worded AS (SELECT *, {words_sql("text_content")} AS words FROM clean)"""


def shown(column: str) -> F.Column:
    """A date or timestamp as text, so that both engines print it alike."""
    return F.col(column).cast("string").alias(column)


def shown_sql(*columns: str) -> str:
    return ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
