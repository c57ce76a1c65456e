"""Pairing of recording files with hypnograms, and recording times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.times import date_text, time_text, utc_time

# File-name patterns, matched without case, and which hypnogram code
# belongs to which recording code.
PSG_PATTERN = r"(?i)^([A-Z]{2}\d{4})(E[01])-PSG\.edf$"
HYPNOGRAM_PATTERN = r"(?i)^([A-Z]{2}\d{4})(E[A-Z])-Hypnogram\.edf$"
HYPNOGRAM_OF_RECORDING = (("E0", "EC"), ("E1", "EH"))


#: Names are unique, and files pair up, within a folder where files have one.
FOLDER = "folder"


def _folder(rows: DataFrame) -> list[str]:
    return [FOLDER] if FOLDER in rows.columns else []


def _part(pattern: str, group: int) -> Column:
    return F.upper(F.regexp_extract("name", pattern, group))


def parse_filenames(manifest: DataFrame) -> DataFrame:
    """Subject and code of every recording file; both NULL where the name does not fit."""
    psg = F.col("kind") == "psg"
    subject = F.when(psg, _part(PSG_PATTERN, 1)).otherwise(_part(HYPNOGRAM_PATTERN, 1))
    code = F.when(psg, _part(PSG_PATTERN, 2)).otherwise(_part(HYPNOGRAM_PATTERN, 2))
    return manifest.select(
        *_folder(manifest),
        "kind",
        "name",
        F.nullif(subject, F.lit("")).alias("subject"),
        F.nullif(code, F.lit("")).alias("code"),
    ).distinct()


def _outcomes(parsed: DataFrame) -> DataFrame:
    """Every PSG file with its preferred and candidate hypnograms.

    A subject's list of candidates is bounded by the name pattern: 26 codes and
    at most 16 upper/lower-case spellings of each.
    """
    hypnograms = parsed.filter("kind = 'hypnogram' AND subject IS NOT NULL")
    within = _folder(parsed)
    by_code = hypnograms.groupBy(*within, "subject", F.col("code").alias("preferred")).agg(
        F.max("name").alias("preferred_name")
    )
    by_subject = hypnograms.groupBy(*within, "subject").agg(
        F.sort_array(F.collect_list("name")).alias("candidates")
    )
    preferred = F.lit(None).cast("string")
    for recording, hypnogram in HYPNOGRAM_OF_RECORDING:
        preferred = F.when(F.col("code") == recording, hypnogram).otherwise(preferred)
    single = F.size("candidates") == 1
    status = (
        F.when(F.col("subject").isNull(), "bad name")
        .when(F.col("preferred_name").isNotNull(), "paired")
        .when(F.col("candidates").isNull(), "none")
        .when(single, "fallback")
        .otherwise("ambiguous")
    )
    return (
        parsed.filter("kind = 'psg'")
        .withColumn("preferred", preferred)
        .join(by_code, [*within, "subject", "preferred"], "left")
        .join(by_subject, [*within, "subject"], "left")
        .withColumn("status", status)
        .withColumn(
            "hyp_filename",
            F.when(F.col("status") == "paired", F.col("preferred_name")).when(
                F.col("status") == "fallback", F.element_at("candidates", 1)
            ),
        )
    )


def pair_recordings(parsed: DataFrame) -> DataFrame:
    """Recording files with the one hypnogram that belongs to them.

    The subject's hypnogram of the preferred code (the last name if there are
    several spellings), else its only hypnogram; otherwise the file is left out.
    """
    return (
        _outcomes(parsed)
        .filter("hyp_filename IS NOT NULL")
        .select(
            *_folder(parsed),
            F.col("subject").alias("patients_code"),
            F.col("code").alias("rec_code"),
            F.col("name").alias("psg_filename"),
            "hyp_filename",
        )
    )


def pairing_report(parsed: DataFrame) -> DataFrame:
    """One status per recording file, with the candidates of an ambiguous one."""
    listed = F.when(F.col("status") == "ambiguous", F.array_join("candidates", ", "))
    return _outcomes(parsed).select(
        *_folder(parsed),
        F.col("name").alias("psg_filename"),
        "status",
        "hyp_filename",
        listed.alias("candidates"),
    )


def recording_datetime(files: DataFrame) -> DataFrame:
    """Recording date and time in UTC: the header's, else the file's modification time."""
    moment = F.coalesce(utc_time(files, "meas_date"), utc_time(files, "modified"))
    return files.select(
        *_folder(files),
        F.col("name").alias("psg_filename"),
        date_text(moment).alias("rec_date"),
        F.concat(time_text(moment, fraction=True), F.lit("+00:00")).alias("rec_log"),
    )
