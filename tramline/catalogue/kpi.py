"""Weekday KPIs and time expressions."""

from pyspark.sql import functions as F

from tramline.catalogue import views
from tramline.functions import moments
from tramline.operators import features, kpis


def _kpi(key, ordered=False):
    return lambda spark, sf: kpis.by_weekday(views.validations(spark, sf), key, ordered)


def kpi_tables(spark, sf):
    """Both KPI tables from one scan, stacked."""
    grain = kpis.daily_grain(views.validations(spark, sf))
    parts = [
        kpis.from_grain(grain, key)
        .withColumnRenamed(key, "LIBELLE")
        .withColumn("kpi", F.lit(table))
        for table, key in kpis.KPI_TABLES.items()
    ]
    return parts[0].unionByName(parts[1])


def weekday_name(spark, sf):
    day = F.to_date("o_orderdate")
    return views.table(spark, sf, "orders").select(
        "o_orderkey", moments.weekday_name(day).alias("weekday")
    )


def time_features(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", F.col("ts").alias("begin"))
    return features.time_features(events).drop("begin")


def display_duration(spark, sf):
    end = F.expr("ts + make_dt_interval(0, 0, 0, CAST(event_id % 5000 * 37 - 900 AS DECIMAL(18, 6)))")
    return views.table(spark, sf, "events").select(
        "event_id", moments.hours_between(F.col("ts"), end).alias("display_duration_hours")
    )


def parse_compact_ts(spark, sf):
    written = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(
        F.date_format("ts", "yyyyMMdd'T'HHmmss")
    )
    events = views.table(spark, sf, "events").select("event_id", written.alias("written"))
    return events.select(
        "event_id",
        "written",
        moments.compact_timestamp(F.col("written")).cast("string").alias("parsed"),
    )


QUERIES = {
    "kpi_ticket_weekday": _kpi(kpis.TICKET_KEY),
    "kpi_stop_weekday": _kpi(kpis.STOP_KEY),
    "kpi_sorted": _kpi(kpis.STOP_KEY, ordered=True),
    "kpi_tables_one_scan": kpi_tables,
    "weekday_name": weekday_name,
    "time_features": time_features,
    "display_duration": display_duration,
    "parse_compact_ts": parse_compact_ts,
}


def kpi_sql(key: str, alias: str | None = None) -> str:
    return f"""
SELECT {key} AS {alias or key}, dayname(JOUR) AS JOUR_DE_LA_SEMAINE,
       CAST(sum(NB_VALD) AS BIGINT) AS TOTAL_VALIDATION,
       CAST(sum(NB_VALD) AS DOUBLE) / count(NB_VALD) AS MOYEN_VALIDATION
FROM validations GROUP BY 1, 2"""


def oracles():
    ticket, stop = kpi_sql(kpis.TICKET_KEY), kpi_sql(kpis.STOP_KEY)
    return {
        "kpi_ticket_weekday": f"WITH {views.VALIDATIONS_SQL} {ticket}",
        "kpi_stop_weekday": f"WITH {views.VALIDATIONS_SQL} {stop}",
        "kpi_sorted": f"WITH {views.VALIDATIONS_SQL} {stop} ORDER BY TOTAL_VALIDATION DESC, 1, 2",
        "kpi_tables_one_scan": f"""WITH {views.VALIDATIONS_SQL}
SELECT *, 'titre_transport' AS kpi FROM ({kpi_sql(kpis.TICKET_KEY, "LIBELLE")})
UNION ALL
SELECT *, 'arret' AS kpi FROM ({kpi_sql(kpis.STOP_KEY, "LIBELLE")})""",
        "weekday_name": "SELECT o_orderkey, dayname(o_orderdate) AS weekday FROM orders",
        "time_features": """
SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month_of_year, CAST(year(ts) AS INTEGER) AS year,
       CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend
FROM events""",
        "display_duration": """
SELECT event_id,
       CAST(floor(epoch(ts + to_seconds(event_id % 5000 * 37 - 900))) - floor(epoch(ts)) AS BIGINT)
         / 3600 AS display_duration_hours
FROM events""",
        "parse_compact_ts": """
SELECT event_id,
       CASE WHEN event_id % 10 = 0 THEN 'not a time' ELSE strftime(ts, '%Y%m%dT%H%M%S') END AS written,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
FROM events""",
    }
