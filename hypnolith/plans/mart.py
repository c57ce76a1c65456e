"""The four tables of a mart, derived from a folder of raw tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from hypnolith.operators import analysis, exports, nights, partials, runs, sequences
from hypnolith.operators.epochs import build_epochs
from hypnolith.session import apply_table_settings, working_folder
from hypnolith.sources import derived
from hypnolith.sources.blocks import write_block_index
from hypnolith.sources.storage import write_bucketed, write_epochs, write_table


@dataclass(frozen=True)
class Mart:
    """Patients, recordings, notes and epochs, with the views stacked on them."""

    patients: DataFrame
    recordings: DataFrame
    notes: DataFrame
    epochs: DataFrame
    buckets: int = 0  # of the stored epochs
    root: str = ""  # folder of the stored tables

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "patients": self.patients,
            "recordings": self.recordings,
            "epochs": self.epochs,
            "notes": self.notes,
        }

    @cached_property
    def block_index(self) -> DataFrame:
        """Which files hold which recording; stored beside the epochs on first use."""
        return write_block_index(self.epochs, f"{self.root}/block_index")

    @cached_property
    def runs(self) -> DataFrame:
        """Runs of equal stage, stored in the epochs' buckets on first use."""
        stored = runs.runs_of_epochs(self.epochs)
        return write_bucketed(stored, f"{self.root}/runs", "first_epoch", self.buckets, hashed=True)

    @cached_property
    def partials(self) -> DataFrame:
        """Partial counts per recording and block, stored beside the epochs on first use."""
        return write_table(partials.partials_of_runs(self.runs), f"{self.root}/partials")

    @cached_property
    def in_bed_runs(self) -> DataFrame:
        return runs.in_bed_runs(self.runs)

    @cached_property
    def activity_of_runs(self) -> DataFrame:
        return sequences.activity_of_runs(self.in_bed_runs, self.codes)

    @cached_property
    def labels(self) -> DataFrame:
        return nights.night_labels(self.recordings, self.patients, self.notes)

    @cached_property
    def codes(self) -> DataFrame:
        return nights.recording_codes(self.recordings, self.patients)

    @cached_property
    def boundaries(self) -> DataFrame:
        return nights.sleep_boundaries(
            self.recordings, self.patients, self.notes, self.epochs
        )

    @cached_property
    def in_bed_window(self) -> DataFrame:
        return nights.in_bed_window(self.boundaries, self.epochs)

    @cached_property
    def window_counts(self) -> DataFrame:
        return nights.window_counts(
            self.recordings, self.patients, self.notes, self.epochs
        )

    @cached_property
    def nights(self) -> DataFrame:
        return nights.sleep_summary(self.window_counts)

    @cached_property
    def per_stage(self) -> DataFrame:
        return analysis.stage_counts_per_night(self.epochs)

    @cached_property
    def activity(self) -> DataFrame:
        return sequences.night_activity(self.epochs, self.codes)

    @cached_property
    def fragmentation(self) -> DataFrame:
        return sequences.fragmentation(self.activity)

    @cached_property
    def bi_nights(self) -> DataFrame:
        return exports.bi_nights(nights.night_counts(self.epochs), self.labels)

    @cached_property
    def bi_stage_minutes(self) -> DataFrame:
        return exports.bi_stage_minutes(self.per_stage, self.codes)


class RawTables:
    """The raw tables of a folder as inputs of the load operators."""

    def __init__(self, spark: SparkSession, folder: str):
        apply_table_settings(spark)
        self.spark = spark
        self.folder = folder
        self.events = derived.read_table(spark, folder, "events")
        self.customer = derived.read_table(spark, folder, "customer")

    @property
    def annotations(self) -> DataFrame:
        return derived.annotations(self.events)

    @property
    def recordings(self) -> DataFrame:
        return derived.recordings(self.events)

    @property
    def patients(self) -> DataFrame:
        return derived.patients(self.customer)

    @property
    def epoch_partitions(self) -> int:
        return epoch_partitions(self.spark, _state(self.spark, self.folder)[0][1])

    @property
    def files(self) -> DataFrame:
        return derived.file_manifest(self.events)


# Raw bytes whose epochs one task builds and one bucket holds, whatever the size of the
# whole: some ten million epochs.
RAW_BYTES_PER_BUCKET = 4 << 20

FileState = tuple[int, int, int]

_stored: dict[tuple[str, str], tuple[list[FileState], Mart]] = {}


def _state(spark: SparkSession, folder: str) -> list[FileState]:
    """File count, bytes and change time of the raw events and customers."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    states = []
    for name in ("events", "customer"):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(conf)
        summary = files.getContentSummary(path)
        changed = files.getFileStatus(path).getModificationTime()
        states.append((summary.getFileCount(), summary.getLength(), changed))
    return states


def epoch_partitions(spark: SparkSession, raw_bytes: int) -> int:
    """Partitions to build epochs in: sized by the raw data, never below the session's count."""
    session_count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(session_count, -(-raw_bytes // RAW_BYTES_PER_BUCKET))


def load_mart(spark: SparkSession, folder: str) -> Mart:
    """Load the raw tables of ``folder`` into stored tables, once per application.

    The tables go to the shared working folder, so a lost executor costs a task,
    not the load. They are written again when the raw files have changed.
    """
    apply_table_settings(spark)
    key = (spark.sparkContext.applicationId, folder)
    state = _state(spark, folder)
    if key in _stored and _stored[key][0] == state:
        return _stored[key][1]
    raw = RawTables(spark, folder)
    root = working_folder(spark, "mart")
    partitions = epoch_partitions(spark, state[0][1])
    recordings = write_table(raw.recordings, f"{root}/recordings")
    mart = Mart(
        patients=write_table(raw.patients, f"{root}/patients"),
        recordings=recordings,
        notes=write_table(derived.notes(recordings), f"{root}/notes"),
        epochs=write_epochs(
            build_epochs(raw.annotations, keep_block=True, partitions=partitions),
            f"{root}/epochs",
            buckets=partitions,
            hashed=True,
        ),
        buckets=partitions,
        root=root,
    )
    _stored[key] = (state, mart)
    return mart
