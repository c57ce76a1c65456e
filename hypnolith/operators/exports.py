"""Flat tables for dashboards, and the figures a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.measures import minutes, scaled
from hypnolith.functions.stages import stage_code
from hypnolith.operators.analysis import MAX_UNKNOWN_PCT, MIN_EFFICIENCY, MIN_TST_H
from hypnolith.operators.nights import SUMMARY_COLUMNS, sleep_summary
from hypnolith.schemas import NOTE_FLAGS, STAGES


def bi_nights(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per night: metrics, demographics, questionnaire flags and the QC verdict.

    A NULL metric fails the pass flag but matches no reason, which then says 'pass'.
    """
    tst, efficiency = F.col("tst_h"), F.col("sleep_eff_window")
    unknown = F.col("unknown_pct_window")
    passed = (
        (tst >= MIN_TST_H) & (efficiency >= MIN_EFFICIENCY) & (unknown <= MAX_UNKNOWN_PCT)
    )
    # The wording of the reasons.
    reason = (
        F.when(tst < MIN_TST_H, "fail: TST < 6h")
        .when(efficiency < MIN_EFFICIENCY, "fail: efficiency < 0.80")
        .when(unknown > MAX_UNKNOWN_PCT, "fail: UNKNOWN% > 5%")
        .otherwise("pass")
    )
    details = ("rec_date", "age", "sex", "bmi", *NOTE_FLAGS)
    return (
        sleep_summary(labels.join(counts, "rec_id"), *details)
        .withColumn("pass_qc", F.when(passed, 1).otherwise(0))
        .withColumn("qc_reason", reason)
        .orderBy("patients_code", "rec_code")
    )


def bi_stage_minutes(per_stage: DataFrame, codes: DataFrame) -> DataFrame:
    """Minutes per (night, stage), stages in physiological order."""
    return (
        per_stage.join(codes.select("rec_id", "patients_code", "rec_code"), "rec_id")
        .select(
            "rec_id",
            "patients_code",
            "rec_code",
            "stage_label",
            minutes(F.col("n_epochs")).alias("minutes"),
        )
        .orderBy("patients_code", "rec_code", stage_code(F.col("stage_label")))
    )


def kpi_cards(nights: DataFrame) -> DataFrame:
    """Mean sleep time, efficiency and REM latency over the nights, and the pass rate.

    Means are taken over exact integers, so they do not depend on task order.
    """

    def mean(column: str, decimals: int):
        total = F.sum(scaled(F.col(column), decimals))
        return total / F.count(column) / float(10**decimals)

    return nights.agg(
        F.round(mean("tst_h", 2), 2).alias("avg_tst_h"),
        F.round(mean("sleep_eff_window", 3) * 100.0, 1).alias("avg_sleep_eff_pct"),
        F.round(mean("rem_latency_min", 1), 1).alias("avg_rem_latency_min"),
        F.round(F.sum("pass_qc") * 100.0 / F.count(F.lit(1)), 1).alias("qc_pass_rate_pct"),
    )


def stage_architecture(per_stage: DataFrame, codes: DataFrame) -> DataFrame:
    """Minutes per night with one column per stage; 0 where a stage does not occur."""
    wide = per_stage.groupBy("rec_id").pivot("stage_label", list(STAGES)).agg(F.sum("n_epochs"))
    return (
        wide.join(codes.select("rec_id", "patients_code", "rec_code"), "rec_id")
        .select(
            "rec_id",
            "patients_code",
            "rec_code",
            *[minutes(F.coalesce(s, F.lit(0))).alias(f"{s}_min") for s in STAGES],
        )
        .orderBy("patients_code", "rec_code")
    )


def tst_vs_efficiency(nights: DataFrame, fragmentation: DataFrame) -> DataFrame:
    """Sleep time against efficiency, with awakenings per hour and the QC flag."""
    return nights.join(
        fragmentation.select("rec_id", "awakenings_per_hour_sleep"), "rec_id"
    ).select(
        "rec_id",
        "patients_code",
        "tst_h",
        "sleep_eff_window",
        "awakenings_per_hour_sleep",
        "pass_qc",
    )


def night_detail(nights: DataFrame) -> DataFrame:
    """Per-night metrics with the QC reason and the questionnaire flags."""
    return nights.select(*SUMMARY_COLUMNS, "qc_reason", *NOTE_FLAGS)
