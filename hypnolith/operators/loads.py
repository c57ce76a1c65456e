"""Idempotent loads: rows that exist keep their ids, new rows get the next ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.keys import with_dense_ids
from hypnolith.schemas import NOTE_FLAGS, NOTES, PATIENTS, RECORDINGS

_RECORDING_VALUES = ("psg_filename", "hyp_filename", "rec_date", "rec_log")


def _highest(table: DataFrame, id_column: str) -> Column:
    return table.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()


def upsert_patients(patients: DataFrame, codes: DataFrame) -> DataFrame:
    """Patients plus a row for every new code; known ones keep id and demographics."""
    new = codes.select("patients_code").distinct().join(patients, "patients_code", "left_anti")
    numbered = with_dense_ids(
        new, ["patients_code"], "patients_id", _highest(patients, "patients_id")
    )
    blank = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in PATIENTS.fields
        if f.name not in ("patients_id", "patients_code")
    ]
    return patients.select(*PATIENTS.fieldNames()).unionByName(
        numbered.select("patients_id", "patients_code", *blank)
    )


def upsert_recordings(recordings: DataFrame, incoming: DataFrame) -> DataFrame:
    """Recordings with the values of ``incoming``, matched on (patients_id, rec_code).

    A known recording keeps its ``rec_id``; of several incoming rows for one
    recording the one with the last file name counts.
    """
    key = ["patients_id", "rec_code"]
    latest = incoming.groupBy(*key).agg(
        F.max(F.struct(*_RECORDING_VALUES)).alias("new")
    )
    merged = recordings.join(latest, key, "full_outer").select(
        "rec_id",
        *key,
        *[
            F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
            for c in _RECORDING_VALUES
        ],
    )
    known = merged.filter("rec_id IS NOT NULL")
    added = with_dense_ids(
        merged.filter("rec_id IS NULL").drop("rec_id"),
        key,
        "rec_id",
        _highest(recordings, "rec_id"),
    )
    columns = RECORDINGS.fieldNames()
    return known.select(*columns).unionByName(added.select(*columns))


def with_patient_ids(pairs: DataFrame, patients: DataFrame) -> DataFrame:
    """Paired files with the id of their patient in place of the code."""
    return pairs.join(patients.select("patients_id", "patients_code"), "patients_code").drop(
        "patients_code"
    )


def default_notes(notes: DataFrame, recordings: DataFrame) -> DataFrame:
    """Notes plus an all-zero row for every recording without one."""
    missing = recordings.select("rec_id").join(notes, "rec_id", "left_anti")
    zeros = missing.select("rec_id", *[F.lit(0).alias(flag) for flag in NOTE_FLAGS])
    return notes.select(*NOTES.fieldNames()).unionByName(zeros)


def ingest_skips(recordings: DataFrame, hypnograms: DataFrame, spans: DataFrame) -> DataFrame:
    """Recordings that got no epochs, with the reason.

    ``hypnograms`` are the names of the files found, ``spans`` the recordings
    whose annotations cover any time.
    """
    found = hypnograms.select(F.col("name").alias("hyp_filename")).distinct().withColumn(
        "has_file", F.lit(True)
    )
    covered = spans.select("rec_id").withColumn("has_span", F.lit(True))
    reason = F.when(F.col("has_file").isNull(), "missing hypnogram").when(
        F.col("has_span").isNull(), "no stage span"
    )
    return (
        recordings.select("rec_id", "hyp_filename")
        .join(found, "hyp_filename", "left")
        .join(covered, "rec_id", "left")
        .select("rec_id", "hyp_filename", reason.alias("reason"))
        .filter("reason IS NOT NULL")
    )


def require_recordings(recordings: DataFrame) -> DataFrame:
    """The same recordings, or an error if there is none to build epochs for."""
    if recordings.isEmpty():
        raise ValueError("No recordings to build epochs for; load recordings first.")
    return recordings
