"""A load in two levels: slices of the recordings, each built and committed by itself.

A mart in one piece builds its epochs in as many partitions as the raw data ask for,
which grows without bound. Here recordings are hashed into slices of at most
MOST_PARTITIONS such partitions: no job has more of them, at any size. Annotations
are dealt out to slice folders once. A slice that has been committed is not built again
when a load is repeated under the same folder, so a failed load resumes where it ended.

Nights lie in one slice each, so per-night results of slices are those of the whole, and
cohort values come from the per-night rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypnolith.functions.keys import BLOCK
from hypnolith.operators.epochs import build_epochs
from hypnolith.plans.mart import Mart, RawTables, epoch_partitions
from hypnolith.schemas import EPOCHS
from hypnolith.session import apply_table_settings, working_folder
from hypnolith.sources import derived
from hypnolith.sources.storage import is_committed, open_bucketed, write_epochs, write_table

#: Partitions, and so buckets and files, of one slice's epochs.
MOST_PARTITIONS = 4096

SLICE = "load_slice"
_STORED = T.StructType([*EPOCHS.fields, T.StructField(BLOCK, T.LongType())])


def slice_sizes(partitions: int, least: int = 1) -> tuple[int, int]:
    """(slices, partitions of each) for a load that asks for so many partitions."""
    slices = max(least, -(-partitions // MOST_PARTITIONS))
    return slices, -(-partitions // slices)


def _slice_of(slices: int) -> Column:
    return F.pmod(F.xxhash64("rec_id"), F.lit(slices)).cast("int")


def _dealt(rows: DataFrame, path: str, slices: int, spread: str) -> DataFrame:
    """Rows in one folder per slice, written once; ``spread`` differs within a recording."""
    spark = rows.sparkSession
    if not is_committed(spark, path):
        # A recording may hold a third of the rows: those of a slice are dealt over several tasks.
        salts = max(1, min(16, MOST_PARTITIONS // slices))
        tasks = min(MOST_PARTITIONS, slices * salts)
        (
            rows.withColumn(SLICE, _slice_of(slices))
            .repartition(tasks, SLICE, F.pmod(F.xxhash64(spread), F.lit(salts)))
            .write.mode("overwrite")
            .partitionBy(SLICE)
            .parquet(path)
        )
    schema = T.StructType([*rows.schema.fields, T.StructField(SLICE, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class SlicedMart:
    """Marts of disjoint sets of recordings, and the folder they are stored in."""

    root: str
    slices: list[Mart]

    def each(self, name: str, build: Callable[[Mart], DataFrame]) -> DataFrame:
        """Per-night rows of every slice, one job after the other, as one stored table.

        Slices whose rows under this name have been committed are not computed again.
        """
        path = f"{self.root}/results/{name}"
        rows = None
        for number, mart in enumerate(self.slices):
            rows = build(mart)
            target = f"{path}/{SLICE}={number}"
            if not is_committed(rows.sparkSession, target):
                rows.write.mode("overwrite").parquet(target)
        schema = T.StructType([*rows.schema.fields, T.StructField(SLICE, T.IntegerType())])
        return rows.sparkSession.read.schema(schema).parquet(path).drop(SLICE)


def load_slices(spark: SparkSession, folder: str, root: str | None = None, least: int = 1) -> SlicedMart:
    """Load the raw tables of ``folder`` in at least ``least`` slices, or resume that under ``root``."""
    apply_table_settings(spark)
    raw = RawTables(spark, folder)
    root = root or working_folder(spark, "slices")
    slices, partitions = slice_sizes(raw.epoch_partitions, least)
    annotations = _dealt(raw.annotations, f"{root}/annotations", slices, "ann_seq")
    recordings = _dealt(raw.recordings, f"{root}/recordings", slices, "rec_id")
    notes = _dealt(derived.notes(recordings.drop(SLICE)), f"{root}/notes", slices, "rec_id")
    patients_path = f"{root}/patients"
    if not is_committed(spark, patients_path):
        write_table(raw.patients, patients_path)
    marts = []
    for number in range(slices):
        own = F.col(SLICE) == number
        path = f"{root}/epochs/{SLICE}={number}"
        if is_committed(spark, path):
            epochs = open_bucketed(spark, path, _STORED, "epoch_idx", partitions)
        else:
            built = build_epochs(annotations.filter(own).drop(SLICE), keep_block=True, partitions=partitions)
            epochs = write_epochs(built, path, buckets=partitions, hashed=True)
        marts.append(
            Mart(
                patients=spark.read.parquet(patients_path),
                recordings=recordings.filter(own).drop(SLICE),
                notes=notes.filter(own).drop(SLICE),
                epochs=epochs,
                buckets=partitions,
                root=f"{root}/derived/{SLICE}={number}",
            )
        )
    return SlicedMart(root, marts)


def partitions_asked(spark: SparkSession, raw_bytes: int) -> tuple[int, int]:
    """(slices, partitions of each) that a load of so many raw bytes takes."""
    return slice_sizes(epoch_partitions(spark, raw_bytes))
