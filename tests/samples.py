"""Small inputs that the tests share."""

from datetime import date, datetime, timedelta

DAY = date(2024, 1, 22)  # a Monday

# (day, category, stop, count)
COUNTS = [
    (DAY, "Navigo", "NATION", 10),
    (DAY, "Navigo", "NATION", 20),
    (DAY, "Navigo", "ÉTOILE", 5),
    (DAY, "Imagine R", "NATION", None),
    (DAY + timedelta(days=1), "Navigo", "NATION", 7),
    (DAY + timedelta(days=5), "Imagine R", "ÉTOILE", 1),
    (None, "Imagine R", "ÉTOILE", 3),
]


def validations(spark):
    from tramline import schemas

    rows = [(d, 100, 110, 1, stop, 7, cat, n) for d, cat, stop, n in COUNTS]
    return spark.createDataFrame(rows, schemas.VALIDATIONS)


CSV_HEADER = "JOUR;CODE_STIF_TRNS;CODE_STIF_RES;CODE_STIF_ARRET;LIBELLE_ARRET;ID_ZDC;CATEGORIE_TITRE;NB_VALD"


def csv_lines(rows):
    """Drop-file lines of (day, stop, category, count) rows."""
    return [f"{d};100;110;1;{stop};7;{cat};{n}" for d, stop, cat, n in rows]


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


# Texts of the four intents a classifier should tell apart, by cause.
INTENTS = {
    "INFORMATION": "<p>Pensez à valider votre titre. Les guichets de la gare de Melun ouvrent à 9h.</p>",
    "PERTURBATION": "<p>Le trafic du RER 4 est fortement perturbé : retard de 20 minutes, bus 62 dévié.</p>",
    "TRAVAUX": "<p>Travaux de nuit : la gare de Vernon est fermée ce week-end, tram 3 interrompu.</p>",
    "ACCIDENT": "<p>Accident grave de personne sur la ligne 9, circulation arrêtée jusqu'au soir.</p>",
}


def messages(spark, copies=20):
    """Message rows of every intent, with varied numbers so that texts differ."""
    rows = []
    start = datetime(2024, 3, 1, 6)
    for i in range(copies):
        for j, (cause, text) in enumerate(INTENTS.items()):
            begin = start + timedelta(hours=7 * i + j)
            rows.append(
                (f"{i}-{j}", begin, begin + timedelta(hours=i % 30), cause, begin,
                 f"{text} <b>Note {i}</b>", ("low", "high")[i % 2], f"Titre {i}")
            )
    schema = (
        "id string, begin timestamp, end timestamp, cause string, update_date timestamp, "
        "message string, pattern string, title string"
    )
    return spark.createDataFrame(rows, schema)


def payloads(messages):
    """Message rows as payload JSON texts."""
    return messages.selectExpr(
        """to_json(struct(
             id,
             array(struct(date_format(begin, "yyyyMMdd'T'HHmmss") AS begin,
                          date_format(end, "yyyyMMdd'T'HHmmss") AS end)) AS applicationPeriods,
             cause,
             date_format(update_date, "yyyyMMdd'T'HHmmss") AS lastUpdate,
             message,
             pattern AS severity,
             title)) AS value"""
    )
