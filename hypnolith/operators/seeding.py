"""Seeded stand-in values for demographics and questionnaire answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.uniform import keyed_uniform
from hypnolith.schemas import NOTES

SEED = 42
# Ranges (inclusive) and rates.
AGE_RANGE = (18, 80)
BMI_RANGE = (18, 34)
FLAG_RATES = {"had_coffee": 0.35, "had_alcohol": 0.20, "has_pain": 0.15, "sleep_deprived": 0.25}
STRESS_RATE, STRESS_IF_DEPRIVED, STRESS_IF_PAIN, STRESS_LIMIT = 0.20, 0.20, 0.10, 0.80


def _integer_in(field: str, bounds: tuple[int, int], seed: int):
    low, high = bounds
    share = keyed_uniform(seed, field, F.col("patients_id"))
    return (F.floor(share * float(high - low + 1)) + low).cast("int")


def fill_demographics(patients: DataFrame, seed: int = SEED) -> DataFrame:
    """Missing age, sex and BMI filled with seeded values; present ones are kept."""
    sex = F.when(keyed_uniform(seed, "sex", F.col("patients_id")) < 0.5, "M").otherwise("F")
    return patients.select(
        "patients_id",
        "patients_code",
        F.coalesce("age", _integer_in("age", AGE_RANGE, seed)).alias("age"),
        F.coalesce("sex", sex).alias("sex"),
        F.coalesce("bmi", _integer_in("bmi", BMI_RANGE, seed)).alias("bmi"),
    )


def seed_notes(recordings: DataFrame, seed: int = SEED) -> DataFrame:
    """Seeded questionnaire flags for every recording, whatever was stored before."""
    rec = F.col("rec_id")
    flags = [
        F.when(keyed_uniform(seed, flag, rec) < rate, 1).otherwise(0).alias(flag)
        for flag, rate in FLAG_RATES.items()
    ]
    chance = (
        F.lit(STRESS_RATE)
        + F.when(F.col("sleep_deprived") == 1, STRESS_IF_DEPRIVED).otherwise(0.0)
        + F.when(F.col("has_pain") == 1, STRESS_IF_PAIN).otherwise(0.0)
    )
    stress = F.when(
        keyed_uniform(seed, "stress", rec) < F.least(chance, F.lit(STRESS_LIMIT)), 1
    ).otherwise(0)
    return (
        recordings.select("rec_id", *flags)
        .withColumn("stress", stress)
        .select(*NOTES.fieldNames())
    )
