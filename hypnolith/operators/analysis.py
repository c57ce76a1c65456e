"""Session-level metrics and cohort statistics.

Reports that sort by a value with few distinct levels add ``rec_id`` to the sort,
so that range partitioning can split a level that many nights share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.keys import EPOCH_BLOCK
from hypnolith.functions.measures import hours, minutes, scaled
from hypnolith.functions.stages import is_sleep, stage_code
from hypnolith.operators.nights import in_bed_epochs

MIN_TST_H = 6.0
MIN_EFFICIENCY = 0.80
MAX_UNKNOWN_PCT = 5.0


def stage_counts_per_night(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Epochs per (recording, stage) inside the sleep window."""
    return (
        in_bed_epochs(epochs, block_epochs)
        .groupBy("rec_id", "stage_label")
        .agg(F.count(F.lit(1)).alias("n_epochs"))
    )


def total_sleep_minutes(per_stage: DataFrame, codes: DataFrame) -> DataFrame:
    """Minutes asleep per (patient, recording file)."""
    asleep = F.when(is_sleep(F.col("stage_label")), F.col("n_epochs")).otherwise(0)
    return (
        per_stage.join(codes.select("rec_id", "patients_code", "psg_filename"), "rec_id")
        .groupBy("patients_code", "psg_filename")
        .agg(minutes(F.sum(asleep)).alias("total_sleep_min"))
        .orderBy("patients_code", "psg_filename")
    )


def stage_minutes_session(per_stage: DataFrame, codes: DataFrame) -> DataFrame:
    """Minutes per (patient, recording file, stage), stages in physiological order."""
    return (
        per_stage.join(codes.select("rec_id", "patients_code", "psg_filename"), "rec_id")
        .groupBy("patients_code", "psg_filename", "stage_label")
        .agg(minutes(F.sum("n_epochs")).alias("minutes"))
        .orderBy("patients_code", "psg_filename", stage_code(F.col("stage_label")))
    )


def summary_report(nights: DataFrame) -> DataFrame:
    return nights.orderBy("patients_code", "rec_code").select(
        "patients_code",
        "rec_code",
        "in_bed_window_h",
        "tst_h",
        "wake_in_window_min",
        "sleep_eff_window",
        "rem_latency_min",
        "rem_pct_tst",
        "N2_N3_pct_tst",
        "unknown_pct_window",
    )


def analysis_ready(nights: DataFrame) -> DataFrame:
    """Nights with enough sleep, efficiency and known stages, on the reported values."""
    return nights.filter(
        (F.col("tst_h") >= MIN_TST_H)
        & (F.col("sleep_eff_window") >= MIN_EFFICIENCY)
        & (F.col("unknown_pct_window") <= MAX_UNKNOWN_PCT)
    ).orderBy(F.desc("tst_h"), "rec_id")


def _deep_sleep_moments(nights: DataFrame) -> DataFrame:
    """Count, sum and sum of squares of deep sleep in tenths of a percent, as integers."""
    tenths = scaled(F.col("N2_N3_pct_tst"), 1)
    return nights.agg(
        F.count("N2_N3_pct_tst").alias("n"),
        F.sum(tenths).alias("s1"),
        F.sum(tenths * tenths).alias("s2"),
    )


def deep_sleep_vs_cohort(nights: DataFrame) -> DataFrame:
    """Each night's deep-sleep share beside the cohort's mean.

    The mean is a one-row scalar subquery; a window over the whole cohort would
    pass every night through one task.
    """
    mean = _deep_sleep_moments(nights).select(F.round(F.col("s1") / F.col("n") / 10.0, 1))
    return nights.select(
        "patients_code", "tst_min", "N2_N3_pct_tst", mean.scalar().alias("avg_deep_sleep")
    )


def deep_sleep_outliers(nights: DataFrame) -> DataFrame:
    """Nights further than two population standard deviations from the cohort mean."""
    mean = F.col("s1") / F.col("n") / 10.0
    spread = F.sqrt(F.col("s2") / F.col("n") / 100.0 - mean * mean)
    cohort = _deep_sleep_moments(nights).select(
        F.struct(F.round(mean, 2).alias("mean_val"), spread.alias("sd_val"))
    )
    return (
        nights.select(
            "patients_code", "tst_min", "N2_N3_pct_tst", cohort.scalar().alias("cohort")
        )
        .select("patients_code", "tst_min", "N2_N3_pct_tst", "cohort.*")
        .filter(F.abs(F.col("N2_N3_pct_tst") - F.col("mean_val")) > 2.0 * F.col("sd_val"))
    )


def qc_ranking(nights: DataFrame) -> DataFrame:
    unknown = F.col("unknown_pct_window")
    flag = F.when(unknown <= 5, "OK").when(unknown <= 20, "REVIEW").otherwise("BAD")
    return nights.orderBy(F.desc("unknown_pct_window"), "rec_id").select(
        "patients_code",
        "unknown_pct_window",
        F.concat(unknown.cast("string"), F.lit("%")).alias("unknown_pct_label"),
        flag.alias("qc_flag"),
    )


def stage_counts(epochs: DataFrame) -> DataFrame:
    return epochs.groupBy("stage_label").agg(F.count(F.lit(1)).alias("n_epochs"))


def stage_distribution(epochs: DataFrame) -> DataFrame:
    """Epochs and hours per stage over full recordings."""
    return (
        stage_counts(epochs)
        .withColumn("hours_total", hours(F.col("n_epochs")))
        .orderBy(F.desc("n_epochs"))
    )
