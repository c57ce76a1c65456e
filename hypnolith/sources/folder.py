"""Recording files of a raw-data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings of the two file kinds, matched with case.
PSG_ENDING = "-PSG.edf"
HYPNOGRAM_ENDING = "-Hypnogram.edf"


def file_kind(name: Column) -> Column:
    """'psg', 'hypnogram' or NULL for any other file."""
    return F.when(name.endswith(PSG_ENDING), "psg").when(
        name.endswith(HYPNOGRAM_ENDING), "hypnogram"
    )


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Names and modification times of the folder's recording files.

    Only the listing is read; the content column is pruned from the scan.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*-{PSG,Hypnogram}.edf")
        .load(folder)
    )
    return listed.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.lit(None).cast("timestamp").alias("meas_date"),
        F.col("modificationTime").alias("modified"),
    )


def manifest(files: DataFrame) -> DataFrame:
    """The recording files among ``files``, with their kind."""
    return files.withColumn("kind", file_kind(F.col("name"))).filter("kind IS NOT NULL")
