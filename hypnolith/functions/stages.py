"""Stage vocabulary as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypnolith.schemas import SLEEP_STAGES, STAGES

# Text looked for in an annotation -> stage; first match wins.
STAGE_TEXT = (
    ("sleep stage w", "W"),
    ("sleep stage r", "REM"),
    ("sleep stage 1", "N1"),
    ("sleep stage 2", "N2"),
    ("sleep stage 3", "N3"),
    ("sleep stage 4", "N3"),
)
# Annotations that carry staging at all.
STAGING_TEXT = ("sleep stage", "movement time")


def is_sleep(label: Column) -> Column:
    return label.isin(*SLEEP_STAGES)


def is_staging(description: Column) -> Column:
    text = F.lower(description)
    hits = [text.contains(part) for part in STAGING_TEXT]
    return hits[0] | hits[1]


def map_stage(description: Column) -> Column:
    """Stage label of an annotation text; anything unrecognised is UNKNOWN."""
    text = F.lower(description)
    label = F.lit("UNKNOWN")
    for part, stage in reversed(STAGE_TEXT):
        label = F.when(text.contains(part), F.lit(stage)).otherwise(label)
    return label


def stage_code(label: Column) -> Column:
    """Position of a known label in the physiological order W, N1, N2, N3, REM, UNKNOWN."""
    code = F.lit(len(STAGES) - 1)
    for position, stage in reversed(list(enumerate(STAGES[:-1]))):
        code = F.when(label == stage, F.lit(position)).otherwise(code)
    return code.cast("long")


def stage_of_code(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STAGES]), (code + 1).cast("int"))
