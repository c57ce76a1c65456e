"""Night metrics from stored runs of equal stage, without any epoch.

A run store holds one row per run of equal stage within a block of a recording: its
stage, first and last epoch, and how many rows it has. A night has some fifty times
fewer runs than epochs. The sleep window starts and ends with a sleep epoch, where runs
end as well, so a window keeps or drops whole runs and none has to be cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK, as_block, spread_over_blocks, with_block
from hypnolith.functions.stages import is_sleep
from hypnolith.operators.sequences import stage_runs
from hypnolith.schemas import DEEP_STAGES, REM, UNKNOWN, WAKE

RUN_COLUMNS = ("rec_id", BLOCK, "stage_label", "first_epoch", "last_epoch", "run_epochs")


def runs_of_epochs(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Runs of equal stage over consecutive rows of whole recordings, cut at block edges."""
    runs = stage_runs(with_block(epochs, block_epochs))
    return runs.select(*[as_block(F.col(c), block_epochs) if c == BLOCK else c for c in RUN_COLUMNS])


def bounds_of_runs(runs: DataFrame) -> DataFrame:
    """First and last sleep epoch of each recording that has any."""
    return (
        runs.filter(is_sleep(F.col("stage_label")))
        .groupBy("rec_id")
        .agg(F.min("first_epoch").alias("first_sleep_epoch"), F.max("last_epoch").alias("last_sleep_epoch"))
    )


def in_bed_runs(runs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """The runs inside the sleep window, with the first and last of each block marked.

    Stored runs are joined in place; the bounds are one row per recording and block.
    """
    bounds = spread_over_blocks(
        bounds_of_runs(runs), "first_sleep_epoch", "last_sleep_epoch", block_epochs
    ).hint("shuffle_hash")
    order = Window.partitionBy("rec_id", BLOCK).orderBy("first_epoch")
    return (
        runs.join(bounds, ["rec_id", BLOCK])
        .filter("first_epoch >= first_sleep_epoch AND last_epoch <= last_sleep_epoch")
        .withColumn("opens", F.row_number().over(order) == 1)
        .withColumn("closes", F.lead("first_epoch").over(order).isNull())
        .drop("first_sleep_epoch", "last_sleep_epoch")
    )


def night_counts_of_runs(inside: DataFrame) -> DataFrame:
    """Epoch counts per night from the runs inside the sleep window."""
    label, length = F.col("stage_label"), F.col("run_epochs")

    def counted(condition):
        return F.sum(F.when(condition, length).otherwise(0))

    return inside.groupBy("rec_id").agg(
        F.min("first_epoch").alias("first_sleep_epoch"),
        F.sum(length).alias("window_epochs"),
        counted(is_sleep(label)).alias("sleep_epochs"),
        counted(label == WAKE).alias("wake_epochs"),
        counted(label == UNKNOWN).alias("unknown_epochs"),
        counted(label == REM).alias("rem_epochs"),
        counted(label.isin(*DEEP_STAGES)).alias("N2_N3_epochs"),
        F.min(F.when(label == REM, F.col("first_epoch"))).alias("first_rem_epoch"),
    )
