"""Order-dependent analysis: previous stage, transitions, awakenings, bouts.

Everything is computed on runs of equal stage within a block of a recording.
Blocks bound the size of a window group; a night has some fifty times fewer runs
than epochs, so what is stitched across block edges and shuffled is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK, with_block
from hypnolith.functions.measures import hours, minutes, per_hour
from hypnolith.functions.stages import is_sleep
from hypnolith.operators.nights import in_bed_epochs
from hypnolith.schemas import N3, REM, WAKE


def _in_block(order: str = "epoch_idx") -> WindowSpec:
    return Window.partitionBy("rec_id", BLOCK).orderBy(order)


def _over_blocks() -> WindowSpec:
    return Window.partitionBy("rec_id").orderBy(BLOCK)



def previous_stages(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Every epoch of the full recording with the stage of the row before it.

    Within a block this is a window; the first row of a block takes the last
    stage of the preceding block that has rows.
    """
    rows = with_block(epochs, block_epochs).select("rec_id", BLOCK, "epoch_idx", "stage_label")
    carried = (
        rows.groupBy("rec_id", BLOCK)
        .agg(F.max(F.struct("epoch_idx", "stage_label")).alias("tail"))
        .select(
            "rec_id",
            BLOCK,
            F.lag("tail.stage_label").over(_over_blocks()).alias("carried"),
        )
        .filter("carried IS NOT NULL")
    )
    return (
        rows.withColumn("prev_stage", F.lag("stage_label").over(_in_block()))
        .withColumn("row", F.row_number().over(_in_block()))
        .join(carried, ["rec_id", BLOCK], "left")
        .select(
            "rec_id",
            "epoch_idx",
            "stage_label",
            F.when(F.col("row") == 1, F.col("carried"))
            .otherwise(F.col("prev_stage"))
            .alias("prev_stage"),
        )
    )


def stage_runs(rows: DataFrame) -> DataFrame:
    """Runs of equal stage over consecutive rows of a block.

    ``rows`` carry their block. Output per run: stage_label, first_epoch, last_epoch,
    run_epochs, and whether it opens or closes its block.
    """
    order = _in_block()
    label = F.col("stage_label")
    starts = (F.col("row") == 1) | ~label.eqNullSafe(F.col("before"))
    ends = F.col("next_idx").isNull() | ~label.eqNullSafe(F.col("after"))
    # One pass over the epochs leaves the first and last row of every run.
    edges = (
        rows.select(
            "rec_id",
            BLOCK,
            "epoch_idx",
            "stage_label",
            F.lag("stage_label").over(order).alias("before"),
            F.lead("stage_label").over(order).alias("after"),
            F.lead("epoch_idx").over(order).alias("next_idx"),
            F.row_number().over(order).alias("row"),
        )
        .withColumn("starts", starts)
        .withColumn("ends", ends)
        .withColumn("is_last", F.col("next_idx").isNull())
        .filter("starts OR ends")
    )
    return (
        edges.withColumn(
            "end_row", F.when(F.col("ends"), F.col("row")).otherwise(F.lead("row").over(order))
        )
        .withColumn(
            "closes",
            F.when(F.col("ends"), F.col("is_last")).otherwise(F.lead("is_last").over(order)),
        )
        .withColumn(
            "last_epoch",
            F.when(F.col("ends"), F.col("epoch_idx")).otherwise(F.lead("epoch_idx").over(order)),
        )
        .filter("starts")
        .select(
            "rec_id",
            BLOCK,
            "stage_label",
            F.col("epoch_idx").alias("first_epoch"),
            "last_epoch",
            (F.col("end_row") - F.col("row") + 1).cast("long").alias("run_epochs"),
            (F.col("row") == 1).alias("opens"),
            "closes",
        )
    )


def _counted_runs(rows: DataFrame) -> DataFrame:
    """The same runs from row numbers: runs differ in (row number - row number within stage).

    The run length is a window count over the run's rows.
    """
    by_stage = Window.partitionBy("rec_id", BLOCK, "stage_label").orderBy("epoch_idx")
    run = Window.partitionBy("rec_id", BLOCK, "stage_label", "run_id")
    whole = Window.partitionBy("rec_id", BLOCK)
    numbered = (
        rows.select("rec_id", BLOCK, "epoch_idx", "stage_label")
        .withColumn("row", F.row_number().over(_in_block()))
        .withColumn("rows", F.count(F.lit(1)).over(whole))
        .withColumn("run_id", F.col("row") - F.row_number().over(by_stage))
    )
    return (
        numbered.withColumn("run_epochs", F.count(F.lit(1)).over(run))
        .withColumn("run_row", F.row_number().over(run.orderBy("epoch_idx")))
        .filter("run_row = 1")
        .select(
            "rec_id",
            BLOCK,
            "stage_label",
            F.col("epoch_idx").alias("first_epoch"),
            "run_epochs",
            (F.col("row") == 1).alias("opens"),
            (F.col("row") + F.col("run_epochs") - 1 == F.col("rows")).alias("closes"),
        )
    )


def _stitched_bouts(runs: DataFrame) -> DataFrame:
    """Longest N3, REM and single-stage sleep run per recording, across block edges.

    Per block only its opening run, its closing run and the longest run per stage
    in between matter. Runs at facing edges of consecutive blocks are joined when
    the stage goes on.
    """
    pieces = runs.groupBy("rec_id", BLOCK, "opens", "closes", "stage_label").agg(
        F.max("run_epochs").alias("run_epochs")
    )
    position = F.when(F.col("opens"), 0).when(F.col("closes"), 2).otherwise(1)
    order = Window.partitionBy("rec_id").orderBy(BLOCK, "position", "stage_label")
    goes_on = (
        F.col("opens")
        & F.lag("closes", 1, False).over(order)
        & F.col("stage_label").eqNullSafe(F.lag("stage_label").over(order))
    )
    bout = F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        pieces.withColumn("position", position)
        .withColumn("goes_on", goes_on)
        .withColumn("bout", bout)
        .groupBy("rec_id", "bout", "stage_label")
        .agg(F.sum("run_epochs").alias("bout_epochs"))
    )


def _longest(bouts: DataFrame, codes: DataFrame) -> DataFrame:
    label, length = F.col("stage_label"), F.col("bout_epochs")

    def longest(condition):
        return minutes(F.coalesce(F.max(F.when(condition, length)), F.lit(0)))

    best = bouts.groupBy("rec_id").agg(
        longest(label == N3).alias("longest_n3_min"),
        longest(label == REM).alias("longest_rem_min"),
        longest(is_sleep(label)).alias("longest_sleep_bout_min"),
    )
    return (
        best.join(codes.select("rec_id", "patients_code"), "rec_id")
        .select(
            "rec_id",
            "patients_code",
            "longest_n3_min",
            "longest_rem_min",
            "longest_sleep_bout_min",
        )
        .orderBy(F.desc("longest_sleep_bout_min"), "rec_id")
    )


def longest_bouts(
    epochs: DataFrame, codes: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """Longest uninterrupted N3, REM and single-stage sleep bout per night, in minutes."""
    return longest_bouts_of_runs(stage_runs(in_bed_epochs(epochs, block_epochs)), codes)


def longest_bouts_of_runs(runs: DataFrame, codes: DataFrame) -> DataFrame:
    """:func:`longest_bouts` from the runs inside the sleep window."""
    return _longest(_stitched_bouts(runs), codes)


def longest_bouts_counted(
    epochs: DataFrame, codes: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """:func:`longest_bouts` with run lengths from window counts."""
    runs = _counted_runs(in_bed_epochs(epochs, block_epochs))
    return _longest(_stitched_bouts(runs), codes)


def night_activity(
    epochs: DataFrame, codes: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """Transitions, awakenings and window hours per night, from one pass over the runs.

    A run that opens a block continues or follows the closing run of the block
    before; the two counts are corrected for that on one row per block.
    """
    return activity_of_runs(stage_runs(in_bed_epochs(epochs, block_epochs)), codes)


def activity_of_runs(runs: DataFrame, codes: DataFrame) -> DataFrame:
    """:func:`night_activity` from the runs inside the sleep window."""
    label = F.col("stage_label")
    before = F.lag("stage_label").over(_in_block("first_epoch"))
    per_block = (
        runs.withColumn("before", before)
        .groupBy("rec_id", BLOCK)
        .agg(
            F.sum(F.when(label != F.col("before"), 1).otherwise(0)).alias("transitions"),
            F.sum(F.when(label == WAKE, 1).otherwise(0)).alias("awakenings"),
            F.max(F.when(F.col("opens"), label)).alias("opening"),
            F.max(F.when(F.col("closes"), label)).alias("closing"),
            F.sum("run_epochs").alias("window_epochs"),
            F.sum(F.when(is_sleep(label), F.col("run_epochs")).otherwise(0)).alias("sleep_epochs"),
            F.sum(F.when(label == WAKE, F.col("run_epochs")).otherwise(0)).alias("wake_epochs"),
        )
        .withColumn("carried", F.lag("closing").over(_over_blocks()))
    )
    crossing = F.when(F.col("opening") != F.col("carried"), 1).otherwise(0)
    still_awake = F.when(
        (F.col("opening") == WAKE) & (F.col("carried") == WAKE), 1
    ).otherwise(0)
    return (
        per_block.groupBy("rec_id")
        .agg(
            F.sum(F.col("transitions") + crossing).alias("n_stage_transitions"),
            F.sum(F.col("awakenings") - still_awake).alias("n_awakenings"),
            hours(F.sum("window_epochs")).alias("in_bed_window_h"),
            hours(F.sum("sleep_epochs")).alias("tst_h"),
            minutes(F.sum("wake_epochs")).alias("wake_in_window_min"),
        )
        .join(codes.select("rec_id", "patients_code"), "rec_id")
    )


def stage_transitions(activity: DataFrame) -> DataFrame:
    """Stage changes per night, and per hour of the reported window."""
    rate = per_hour(F.col("n_stage_transitions"), F.col("in_bed_window_h"))
    return activity.select(
        "patients_code",
        "rec_id",
        "n_stage_transitions",
        rate.alias("transitions_per_hour_window"),
    ).orderBy(F.desc("transitions_per_hour_window"), "rec_id")


def awakenings(activity: DataFrame) -> DataFrame:
    """Entries into wake per night; the rate divides by hours in the window, as its source does."""
    rate = per_hour(F.col("n_awakenings"), F.col("in_bed_window_h"))
    return activity.select(
        "patients_code",
        "rec_id",
        "wake_in_window_min",
        "n_awakenings",
        rate.alias("awakenings_per_hour_sleep"),
    ).orderBy(F.desc("awakenings_per_hour_sleep"), "rec_id")


def fragmentation(activity: DataFrame) -> DataFrame:
    """Transitions per hour in the window and awakenings per hour asleep."""
    return activity.select(
        "rec_id",
        "patients_code",
        "n_stage_transitions",
        "n_awakenings",
        "in_bed_window_h",
        "tst_h",
        per_hour(F.col("n_stage_transitions"), F.col("in_bed_window_h")).alias(
            "transitions_per_hour_window"
        ),
        per_hour(F.col("n_awakenings"), F.col("tst_h")).alias("awakenings_per_hour_sleep"),
    ).orderBy(F.desc("transitions_per_hour_window"), "rec_id")
