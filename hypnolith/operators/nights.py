"""Sleep window and per-night metrics.

Epoch-level joins run on (rec_id, epoch_block); per-night counts are merged
map-side before they are shuffled on rec_id, and patient or recording columns are
attached to the one row per night that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.keys import (
    BLOCK,
    EPOCH_BLOCK,
    spread_over_blocks,
    with_block,
)
from hypnolith.functions.measures import fraction, hours, minutes, percent
from hypnolith.functions.stages import is_sleep
from hypnolith.schemas import DEEP_STAGES, EPOCHS, NOTE_FLAGS, REM, UNKNOWN, WAKE

NIGHT_KEYS = ("rec_id", "patients_code", "rec_code", "has_obs")
SUMMARY_COLUMNS = NIGHT_KEYS + (
    "in_bed_window_min",
    "in_bed_window_h",
    "tst_min",
    "tst_h",
    "wake_in_window_min",
    "rem_min",
    "N2_N3_min",
    "sleep_pct_window",
    "unknown_pct_window",
    "rem_pct_tst",
    "N2_N3_pct_tst",
    "wake_pct_tst",
    "sleep_eff_window",
    "sleep_onset_min_from_recording_start",
    "rem_latency_min",
)


def _observations() -> tuple[Column, Column]:
    count = sum((F.col(flag) for flag in NOTE_FLAGS[1:]), F.col(NOTE_FLAGS[0]))
    return F.when(count > 0, 1).otherwise(0), count


def notes_view(notes: DataFrame, recordings: DataFrame) -> DataFrame:
    """Questionnaire flags per recording, with their number and whether there is any."""
    has_obs, obs_count = _observations()
    return notes.join(recordings.select("rec_id", "rec_code"), "rec_id").select(
        "rec_id",
        "rec_code",
        *NOTE_FLAGS,
        has_obs.alias("has_obs"),
        obs_count.alias("obs_count"),
    )


def recording_codes(recordings: DataFrame, patients: DataFrame) -> DataFrame:
    """Patient and recording codes and the recording file, one row per recording."""
    return recordings.join(patients.select("patients_id", "patients_code"), "patients_id").select(
        "rec_id", "patients_code", "rec_code", "psg_filename"
    )


def night_labels(recordings: DataFrame, patients: DataFrame, notes: DataFrame) -> DataFrame:
    """One row per recording of a known patient: codes, demographics, flags, observations.

    A recording without notes has flags NULL and no observations.
    """
    has_obs, obs_count = _observations()
    return (
        recordings.join(patients, "patients_id")
        .join(notes, "rec_id", "left")
        .select(
            "rec_id",
            "patients_code",
            "rec_code",
            has_obs.alias("has_obs"),
            F.coalesce(obs_count, F.lit(0)).alias("obs_count"),
            "psg_filename",
            "rec_date",
            "age",
            "sex",
            "bmi",
            *NOTE_FLAGS,
        )
    )


def sleep_bounds(epochs: DataFrame) -> DataFrame:
    """First and last sleep epoch of each recording that has any."""
    return (
        epochs.filter(is_sleep(F.col("stage_label")))
        .groupBy("rec_id")
        .agg(
            F.min("epoch_idx").alias("first_sleep_epoch"),
            F.max("epoch_idx").alias("last_sleep_epoch"),
        )
    )


def sleep_boundaries(
    recordings: DataFrame, patients: DataFrame, notes: DataFrame, epochs: DataFrame
) -> DataFrame:
    """Sleep window per recording with codes and observation counts."""
    length = F.col("last_sleep_epoch") - F.col("first_sleep_epoch") + 1
    return (
        night_labels(recordings, patients, notes)
        .join(sleep_bounds(epochs), "rec_id")
        .select(
            *NIGHT_KEYS,
            "obs_count",
            minutes(length).alias("sleep_window_min"),
            "first_sleep_epoch",
            "last_sleep_epoch",
        )
    )


def within(
    epochs: DataFrame, bounds: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """Epochs between the bounds of their recording, joined on (rec_id, epoch_block).

    The bounds are one row per recording and block, so each task hashes its share
    of them and streams its epochs past; stored epochs keep their place and order.
    """
    spread = spread_over_blocks(
        bounds, "first_sleep_epoch", "last_sleep_epoch", block_epochs
    ).hint("shuffle_hash")
    return with_block(epochs, block_epochs).join(spread, ["rec_id", BLOCK]).filter(
        F.col("epoch_idx").between(F.col("first_sleep_epoch"), F.col("last_sleep_epoch"))
    )


def in_bed_window(
    boundaries: DataFrame, epochs: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """One row per epoch inside the sleep window, with the night's codes."""
    rows = epochs.select(*[c for c in epochs.columns if c in (BLOCK, "rec_id", "epoch_idx", "stage_label")])
    return within(rows, boundaries, block_epochs).select(
        *NIGHT_KEYS, "first_sleep_epoch", "sleep_window_min", "epoch_idx", "stage_label"
    )


def in_bed_epochs(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """The plain epoch rows inside the sleep window (and their block)."""
    return within(epochs, sleep_bounds(epochs), block_epochs).drop(
        "first_sleep_epoch", "last_sleep_epoch"
    )


def in_bed_window_minimal(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    return in_bed_epochs(epochs, block_epochs).select(*EPOCHS.fieldNames())


def night_counts(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Epoch counts inside the sleep window, one row per recording."""
    label = F.col("stage_label")

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return (
        in_bed_epochs(epochs, block_epochs)
        .groupBy("rec_id")
        .agg(
            F.min("epoch_idx").alias("first_sleep_epoch"),
            F.count(F.lit(1)).alias("window_epochs"),
            counted(is_sleep(label)).alias("sleep_epochs"),
            counted(label == WAKE).alias("wake_epochs"),
            counted(label == UNKNOWN).alias("unknown_epochs"),
            counted(label == REM).alias("rem_epochs"),
            counted(label.isin(*DEEP_STAGES)).alias("N2_N3_epochs"),
            F.min(F.when(label == REM, F.col("epoch_idx"))).alias("first_rem_epoch"),
        )
    )


def window_counts(
    recordings: DataFrame,
    patients: DataFrame,
    notes: DataFrame,
    epochs: DataFrame,
    block_epochs: int = EPOCH_BLOCK,
) -> DataFrame:
    """Night counts with the night's codes."""
    counts = night_counts(epochs, block_epochs)
    labels = night_labels(recordings, patients, notes).select(*NIGHT_KEYS)
    return labels.join(counts, "rec_id")


def summary_measures(counts: DataFrame) -> list[Column]:
    """The rounded night measures as columns over night counts."""
    window, sleep = F.col("window_epochs"), F.col("sleep_epochs")
    onset, first_rem = F.col("first_sleep_epoch"), F.col("first_rem_epoch")
    measures = {
        "in_bed_window_min": minutes(window),
        "in_bed_window_h": hours(window),
        "tst_min": minutes(sleep),
        "tst_h": hours(sleep),
        "wake_in_window_min": minutes(F.col("wake_epochs")),
        "rem_min": minutes(F.col("rem_epochs")),
        "N2_N3_min": minutes(F.col("N2_N3_epochs")),
        "sleep_pct_window": percent(sleep, window),
        "unknown_pct_window": percent(F.col("unknown_epochs"), window),
        "rem_pct_tst": percent(F.col("rem_epochs"), sleep),
        "N2_N3_pct_tst": percent(F.col("N2_N3_epochs"), sleep),
        "wake_pct_tst": percent(F.col("wake_epochs"), sleep),
        "sleep_eff_window": fraction(sleep, window),
        "sleep_onset_min_from_recording_start": minutes(onset),
        "rem_latency_min": minutes(first_rem - onset),
    }
    return [value.alias(name) for name, value in measures.items()]


def sleep_summary(counts: DataFrame, *extra: str) -> DataFrame:
    """Night metrics from window counts; ``extra`` columns are carried along."""
    return counts.select(*NIGHT_KEYS, *summary_measures(counts), *extra)


def nights(
    recordings: DataFrame,
    patients: DataFrame,
    notes: DataFrame,
    epochs: DataFrame,
    block_epochs: int = EPOCH_BLOCK,
) -> DataFrame:
    """One row per recording with sleep: the main analytical view."""
    return sleep_summary(window_counts(recordings, patients, notes, epochs, block_epochs))
