"""The load as a whole: a folder's files and their annotations into the four tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.keys import EPOCH_BLOCK, lookup_by_salted_key
from hypnolith.operators.epochs import build_epochs, replace_epochs
from hypnolith.operators.files import (
    FOLDER,
    pair_recordings,
    parse_filenames,
    recording_datetime,
)
from hypnolith.operators.loads import (
    default_notes,
    require_recordings,
    upsert_patients,
    upsert_recordings,
    with_patient_ids,
)
from hypnolith.session import working_folder
from hypnolith.sources.folder import manifest
from hypnolith.sources.storage import write_epochs, write_table


def _in_folder(name: str) -> Column:
    """A name behind its folder, where it has one."""
    return F.concat_ws("/", F.nullif(F.col(FOLDER), F.lit("")), F.col(name))


def load_files(
    tables: dict[str, DataFrame], files: DataFrame, root: str | None = None
) -> dict[str, DataFrame]:
    """Patients, recordings and notes after loading ``files`` (name, meas_date, modified).

    With a column ``folder``, names are unique within a folder only: file names and
    recording codes then carry it in front (``night1/E0``), so that equal names in two
    folders are two recordings of one patient. Unpaired files are left out; ``pairing_report`` tells which and why. Each table
    is written under ``root`` (a new working folder unless given, never the folder
    ``tables`` are read from) before the next one builds on it: ids are then settled,
    and no plan carries the whole load.
    """
    root = root or working_folder(files.sparkSession, "load")
    if FOLDER in files.columns:  # names without folder pair up as well
        files = files.withColumn(FOLDER, F.coalesce(F.col(FOLDER), F.lit("")))
    listed = manifest(files)
    pairs = write_table(pair_recordings(parse_filenames(listed)), f"{root}/pairs")
    times = recording_datetime(listed.filter("kind = 'psg'"))
    if FOLDER in listed.columns:
        pairs = pairs.select(
            "patients_code", _in_folder("rec_code").alias("rec_code"),
            _in_folder("psg_filename").alias("psg_filename"), _in_folder("hyp_filename").alias("hyp_filename"),
        )
        times = times.select(_in_folder("psg_filename").alias("psg_filename"), "rec_date", "rec_log")
    patients = write_table(upsert_patients(tables["patients"], pairs), f"{root}/patients")
    incoming = with_patient_ids(pairs, patients).join(times, "psg_filename")
    recordings = write_table(
        upsert_recordings(tables["recordings"], incoming), f"{root}/recordings"
    )
    notes = write_table(default_notes(tables["notes"], recordings), f"{root}/notes")
    return {**tables, "patients": patients, "recordings": recordings, "notes": notes}


def annotations_of_recordings(recordings: DataFrame, by_file: DataFrame) -> DataFrame:
    """Annotations per hypnogram file (and folder, if they have one) as annotations per recording.

    One hypnogram may serve two recordings of a subject.
    """
    if FOLDER in by_file.columns:
        by_file = by_file.withColumn("hyp_filename", _in_folder("hyp_filename"))
    names = recordings.select("hyp_filename", "rec_id")
    return lookup_by_salted_key(by_file, names, "hyp_filename", "ann_seq").select(
        "rec_id", "ann_seq", "onset", "duration", "description"
    )


def load_epochs(
    tables: dict[str, DataFrame],
    by_file: DataFrame,
    root: str | None = None,
    block_epochs: int = EPOCH_BLOCK,
) -> dict[str, DataFrame]:
    """Tables with the epochs of every recording whose hypnogram is in ``by_file``.

    Epochs of other recordings stay; ``ingest_skips`` tells which got none. The new
    epochs and then the merged table are written under ``root``.
    """
    root = root or working_folder(by_file.sparkSession, "load")
    recordings = require_recordings(tables["recordings"])
    annotations = annotations_of_recordings(recordings, by_file)
    built = write_epochs(
        build_epochs(annotations, block_epochs, keep_block=True),
        f"{root}/new_epochs",
        block_epochs=block_epochs,
        hashed=True,
    )
    merged = replace_epochs(tables["epochs"], built, block_epochs)
    epochs = write_epochs(merged, f"{root}/epochs", block_epochs=block_epochs)
    return {**tables, "epochs": epochs}
