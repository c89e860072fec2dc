"""Weekday totals and averages of ticket validations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.moments import day_name

TICKET_KEY = "CATEGORIE_TITRE"
STOP_KEY = "LIBELLE_ARRET"
# KPI table name -> its grouping column.
KPI_TABLES = {"titre_transport": TICKET_KEY, "arret": STOP_KEY}


def daily_grain(validations: DataFrame) -> DataFrame:
    """Sum and count per ticket category, stop and weekday number.

    Every weekday KPI follows from this one small table, so a refresh of all of
    them scans and shuffles the validations once.
    """
    return validations.groupBy(TICKET_KEY, STOP_KEY, F.dayofweek("JOUR").alias("day_number")).agg(
        F.sum("NB_VALD").alias("total"), F.count("NB_VALD").alias("counted")
    )


def keyed_totals(validations: DataFrame) -> DataFrame:
    """(kpi, label, day_number, total, counted): the sums behind every KPI row.

    Each validation counts once for every KPI table; before the shuffle, rows are added
    up by key. A row depends on its own key's validations only, so a stream of them can
    emit the rows that changed.
    """
    keys = [F.struct(F.lit(kpi).alias("kpi"), F.col(key).cast("string").alias("label")) for kpi, key in KPI_TABLES.items()]
    rows = validations.select(F.explode(F.array(*keys)).alias("k"), F.dayofweek("JOUR").alias("day_number"), "NB_VALD")
    return rows.groupBy("k.kpi", "k.label", "day_number").agg(
        F.sum("NB_VALD").alias("total"), F.count("NB_VALD").alias("counted")
    )


def from_totals(totals: DataFrame, kpi: str) -> DataFrame:
    """One KPI table from `keyed_totals` rows."""
    rows = totals.filter(F.col("kpi") == kpi)
    return from_grain(rows.withColumnRenamed("label", KPI_TABLES[kpi]), KPI_TABLES[kpi])


def from_grain(grain: DataFrame, key: str, ordered: bool = False) -> DataFrame:
    """One KPI table from `daily_grain` rows.

    The average is the exact integer sum over the count, so it does not depend on
    how the rows were partitioned. Days are numbers until after the shuffle.
    """
    total, counted = F.sum("total"), F.sum("counted")
    kpi = grain.groupBy(key, "day_number").agg(
        total.alias("TOTAL_VALIDATION"), F.try_divide(total, counted).alias("MOYEN_VALIDATION")
    )
    kpi = kpi.select(
        key,
        day_name(F.col("day_number")).alias("JOUR_DE_LA_SEMAINE"),
        "TOTAL_VALIDATION",
        "MOYEN_VALIDATION",
    )
    if ordered:
        kpi = kpi.orderBy(F.desc("TOTAL_VALIDATION"), key, "JOUR_DE_LA_SEMAINE")
    return kpi


def by_weekday(validations: DataFrame, key: str, ordered: bool = False) -> DataFrame:
    """Total and average validations per `key` and weekday, largest total first if `ordered`."""
    rows = validations.select(
        key,
        F.dayofweek("JOUR").alias("day_number"),
        F.col("NB_VALD").cast("bigint").alias("total"),
        F.col("NB_VALD").isNotNull().cast("int").alias("counted"),
    )
    return from_grain(rows, key, ordered)
