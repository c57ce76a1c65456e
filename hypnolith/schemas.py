"""Table schemas, stage vocabulary and the rules every table has to meet."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
EPOCH_SEC = 30
STAGES = ("W", "N1", "N2", "N3", "REM", "UNKNOWN")
SLEEP_STAGES = ("N1", "N2", "N3", "REM")
DEEP_STAGES = ("N2", "N3")
WAKE = "W"
REM = "REM"
N3 = "N3"
UNKNOWN = "UNKNOWN"
NOTE_FLAGS = ("had_coffee", "had_alcohol", "has_pain", "sleep_deprived", "stress")
# ----------------------------------------------------------------------------

PATIENTS = T.StructType(
    [
        T.StructField("patients_id", T.LongType(), False),
        T.StructField("patients_code", T.StringType(), False),
        T.StructField("age", T.IntegerType(), True),
        T.StructField("sex", T.StringType(), True),
        T.StructField("bmi", T.IntegerType(), True),
    ]
)

RECORDINGS = T.StructType(
    [
        T.StructField("rec_id", T.LongType(), False),
        T.StructField("patients_id", T.LongType(), False),
        T.StructField("rec_code", T.StringType(), False),
        T.StructField("psg_filename", T.StringType(), False),
        T.StructField("hyp_filename", T.StringType(), False),
        T.StructField("rec_date", T.StringType(), False),
        T.StructField("rec_log", T.StringType(), True),
    ]
)

EPOCHS = T.StructType(
    [
        T.StructField("rec_id", T.LongType(), False),
        T.StructField("epoch_idx", T.LongType(), False),
        T.StructField("start_sec", T.LongType(), False),
        T.StructField("duration_sec", T.IntegerType(), False),
        T.StructField("stage_label", T.StringType(), False),
    ]
)

NOTES = T.StructType(
    [T.StructField("rec_id", T.LongType(), False)]
    + [T.StructField(flag, T.IntegerType(), False) for flag in NOTE_FLAGS]
)

ANNOTATIONS = T.StructType(
    [
        T.StructField("rec_id", T.LongType(), False),
        T.StructField("ann_seq", T.LongType(), False),
        T.StructField("onset", T.DoubleType(), False),
        T.StructField("duration", T.DoubleType(), False),
        T.StructField("description", T.StringType(), False),
    ]
)

TABLES = {
    "patients": PATIENTS,
    "recordings": RECORDINGS,
    "epochs": EPOCHS,
    "notes": NOTES,
}

PRIMARY_KEYS = {
    "patients": [("patients_id",), ("patients_code",)],
    "recordings": [("rec_id",), ("patients_id", "rec_code")],
    "epochs": [("rec_id", "epoch_idx")],
    "notes": [("rec_id",)],
}

FOREIGN_KEYS = (
    ("recordings", "patients_id", "patients"),
    ("epochs", "rec_id", "recordings"),
    ("notes", "rec_id", "recordings"),
)

# Domain rules as SQL conditions; a row breaks a rule when it is FALSE (not NULL).
DOMAIN_RULES = {
    "patients": {
        "age": "age BETWEEN 17 AND 100",
        "sex": "sex ILIKE 'M%' OR sex ILIKE 'F%' OR sex ILIKE 'O%'",
        "bmi": "bmi BETWEEN 1 AND 70",
    },
    "epochs": {
        "epoch_idx": "epoch_idx >= 0",
        "start_sec": "start_sec >= 0",
        "stage_label": "stage_label IN ('W', 'N1', 'N2', 'N3', 'REM', 'UNKNOWN')",
    },
    "notes": {flag: f"{flag} IN (0, 1)" for flag in NOTE_FLAGS},
}


def not_null_columns(table: str) -> list[str]:
    """Columns of ``table`` that may not be NULL."""
    return [f.name for f in TABLES[table].fields if not f.nullable]
