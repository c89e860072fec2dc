"""Values that must be exactly these for results to be right.

Everything here is data: column names, word lists, patterns, thresholds and
model settings. No logic lives in this module.
"""

# --- fixed values: weekday names, indexed by Spark's dayofweek (1 = Sunday) ---
WEEKDAYS = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)
WEEKEND_DAYS = (1, 7)

# --- fixed values: timestamp formats ---
COMPACT_TIMESTAMP = "yyyyMMdd'T'HHmmss"
CSV_DATE = "yyyy-MM-dd"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

# --- fixed values: text patterns, applied to lower-cased text ---
TRANSPORT_MODES = ("ligne", "bus", "train", "rer", "métro", "tramway", "tram")
STATION_PREFIX = "gare de "
STATION_STOPPERS = ",.:;<>"

FLAG_PATTERNS = {
    "is_route_change": "itinéraire|dévié|déviation",
    "is_station_closure": "fermé|fermée|fermeture|non desservi",
    "is_delay_notification": "retard|perturbation|ralentissement",
    "is_schedule_change": "horaire|à partir de|jusqu'au",
    "mentions_morning": "matin|aube|matinée|avant-midi",
    "mentions_evening": "soir|soirée|nuit",
    "mentions_weekend": "week-end|weekend|samedi|dimanche",
}

# --- fixed values: the words of Spark's stop-word list for STOP_WORD_LANGUAGE, in its order ---
STOP_WORDS = """
    au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même
    mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi
    ton tu un une vos votre vous c d j l à m n s t y été étée étées étés étant étante étants
    étantes suis es est sommes êtes sont serai seras sera serons serez seront serais serait
    serions seriez seraient étais était étions étiez étaient fus fut fûmes fûtes furent sois
    soit soyons soyez soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes
    ayants eu eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais
    aurait aurions auriez auraient avais avait avions aviez avaient eut eûmes eûtes eurent aie
    aies ait ayons ayez aient eusse eusses eût eussions eussiez eussent
""".split()

# --- fixed values: message length bands (exclusive upper bounds, in words) ---
LENGTH_BANDS = (("short", 30), ("medium", 100))
LONGEST_BAND = "long"

# --- fixed values: severity of a cause, and when a message is urgent ---
SEVERITY = {"INFORMATION": 1, "PERTURBATION": 2, "TRAVAUX": 3, "ACCIDENT": 4}
DEFAULT_SEVERITY = 2
URGENT_SEVERITY = 3
URGENT_HOURS = 24

# --- fixed values: features used when a message to score lacks them ---
FEATURE_DEFAULTS = {
    "pattern": "INFORMATION",
    "display_duration_hours": 24.0,
    "is_route_change": 0,
    "is_station_closure": 0,
    "is_delay_notification": 0,
    "is_schedule_change": 0,
    "mentions_morning": 0,
    "mentions_evening": 0,
    "mentions_weekend": 0,
    "transport_count": 1,
    "stations_count": 0,
    "severity_level": 1,
    "is_urgent": 0,
    "is_weekend": 0,
    "hour_of_day": 12,
    "title_length": 20,
}

# --- fixed values: model inputs and settings ---
LABEL = "cause"
CATEGORICAL_FEATURES = ("pattern", "message_length_category")
NUMERIC_FEATURES = (
    "word_count",
    "display_duration_hours",
    "transport_count",
    "is_route_change",
    "is_station_closure",
    "is_delay_notification",
    "is_schedule_change",
    "mentions_morning",
    "mentions_evening",
    "mentions_weekend",
    "stations_count",
    "severity_level",
    "is_urgent",
    "is_weekend",
    "hour_of_day",
    "title_length",
)
# Numeric features computed from the label itself.
LEAKY_FEATURES = ("severity_level", "is_urgent")

STOP_WORD_LANGUAGE = "french"
VOCABULARY_SIZE = 10000
VOCABULARY_MIN_DF = 2.0

TRAIN_SHARE = 0.8
SAMPLE_SHARE = 0.1
SEED = 42
FOLDS = 3

MODEL_SETTINGS = {
    "random_forest": {"numTrees": 100, "maxDepth": 5, "seed": 42},
    "logistic_regression": {"maxIter": 20},
    "naive_bayes": {},
    "gbt_one_vs_rest": {"maxIter": 10},
}
TUNING_GRIDS = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15]},
    "logistic_regression": {
        "regParam": [0.01, 0.1, 0.3],
        "elasticNetParam": [0.0, 0.5, 1.0],
    },
    "naive_bayes": {"smoothing": [0.5, 1.0, 2.0]},
}
