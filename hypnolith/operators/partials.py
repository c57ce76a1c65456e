"""Nights from stored partial counts per block, refreshed only where epochs have changed.

One row per recording and block holds what its epochs add to the night: counts before,
between and after the block's first and last sleep epoch, changes of stage and awakenings
in those parts, and the stages at its edges. Where the night's window starts or ends in
a block, the part outside is left out; blocks in between count as a whole. Rows of
different blocks merge in any order, so a reload replaces the rows of its blocks and
leaves all other epochs unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK
from hypnolith.functions.measures import hours, minutes
from hypnolith.functions.stages import is_sleep
from hypnolith.operators.runs import runs_of_epochs
from hypnolith.schemas import DEEP_STAGES, REM, UNKNOWN, WAKE

PARTS = ("pre", "mid", "post")


def partials_of_runs(runs: DataFrame) -> DataFrame:
    """Partial counts of every block from its runs; runs stored in buckets stay in place."""
    block = Window.partitionBy("rec_id", BLOCK)
    label, length, first = F.col("stage_label"), F.col("run_epochs"), F.col("first_epoch")
    asleep = is_sleep(label)
    marked = (
        runs.withColumn("_first", F.min(F.when(asleep, first)).over(block))
        .withColumn("_last", F.max(F.when(asleep, F.col("last_epoch"))).over(block))
        .withColumn("_before", F.lag("stage_label").over(block.orderBy("first_epoch")))
        .withColumn("_opens", F.row_number().over(block.orderBy("first_epoch")) == 1)
    )
    # Without sleep a block is all "pre": it counts only between blocks with sleep.
    lies = F.when(first > F.col("_last"), "post").when(first >= F.col("_first"), "mid").otherwise("pre")
    # The change into the first sleep epoch is one of the part before it.
    changes = F.when(first > F.col("_last"), "post").when(first > F.col("_first"), "mid").otherwise("pre")

    def counted(test: Column, value: Column) -> Column:
        return F.sum(F.when(test, value).otherwise(0))

    one, sums = F.lit(1), []
    for part in PARTS:
        inside = lies == part
        sums += [
            counted(inside, length).alias(f"{part}_n"),
            counted(inside & (label == WAKE), length).alias(f"{part}_wake"),
            counted(inside & (label == UNKNOWN), length).alias(f"{part}_unknown"),
            counted((changes == part) & (label != F.col("_before")), one).alias(f"{part}_changes"),
            counted(inside & (label == WAKE) & ~F.col("_opens"), one).alias(f"{part}_wakes"),
        ]
    return marked.groupBy("rec_id", BLOCK).agg(
        F.min("_first").alias("first_sleep"),
        *sums,
        counted(asleep, length).alias("sleep"),
        counted(label == REM, length).alias("rem"),
        counted(label.isin(*DEEP_STAGES), length).alias("deep"),
        F.min(F.when(label == REM, first)).alias("first_rem"),
        F.min(F.struct("first_epoch", "stage_label")).stage_label.alias("opening"),
        F.max(F.struct("first_epoch", "stage_label")).stage_label.alias("closing"),
    )


def block_partials(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    return partials_of_runs(runs_of_epochs(epochs, block_epochs))


def refreshed_partials(
    partials: DataFrame, epochs: DataFrame, changed: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """Partial counts after the blocks ``changed`` (rec_id, block) of ``epochs`` were replaced.

    Of the epochs only those blocks are counted; blocks that are gone have no row.
    """
    kept = partials.join(changed, ["rec_id", BLOCK], "left_anti")
    again = epochs.join(changed, ["rec_id", BLOCK], "left_semi")
    return kept.unionByName(block_partials(again, block_epochs))


def _merged(partials: DataFrame) -> DataFrame:
    """Per night the sums of the parts inside its sleep window.

    A recording has one row per 2^18 epochs, so its blocks are few.
    """
    night = Window.partitionBy("rec_id")
    ordered = night.orderBy(BLOCK)
    begins = F.min(F.when(F.col("first_sleep").isNotNull(), F.col(BLOCK))).over(night)
    ends = F.max(F.when(F.col("first_sleep").isNotNull(), F.col(BLOCK))).over(night)
    follows = F.col(BLOCK) > F.col("_begins")
    crossing = F.when(follows & (F.col("opening") != F.col("_carried")), 1).otherwise(0)
    waking = F.when(follows & (F.col("opening") == WAKE) & ~F.col("_carried").eqNullSafe(F.lit(WAKE)), 1).otherwise(0)

    def inside(name: str) -> Column:
        pre, post = F.when(follows, F.col(f"pre_{name}")), F.when(F.col(BLOCK) < F.col("_ends"), F.col(f"post_{name}"))
        return F.coalesce(pre, F.lit(0)) + F.col(f"mid_{name}") + F.coalesce(post, F.lit(0))

    return (
        partials.withColumn("_begins", begins)
        .withColumn("_ends", ends)
        .withColumn("_carried", F.lag("closing").over(ordered))
        .filter(F.col(BLOCK).between(F.col("_begins"), F.col("_ends")))
        .groupBy("rec_id")
        .agg(
            F.min("first_sleep").alias("first_sleep_epoch"),
            *[F.sum(inside(name)).alias(f"_{name}") for name in ("n", "wake", "unknown")],
            F.sum(inside("changes") + crossing).alias("n_stage_transitions"),
            F.sum(inside("wakes") + waking).alias("n_awakenings"),
            F.sum("sleep").alias("sleep_epochs"),
            F.sum("rem").alias("rem_epochs"),
            F.sum("deep").alias("N2_N3_epochs"),
            F.min("first_rem").alias("first_rem_epoch"),
        )
        .withColumnsRenamed({"_n": "window_epochs", "_wake": "wake_epochs", "_unknown": "unknown_epochs"})
    )


def night_counts_of_partials(partials: DataFrame) -> DataFrame:
    """Epoch counts inside the sleep window, one row per recording with sleep."""
    return _merged(partials).select(
        "rec_id", "first_sleep_epoch", "window_epochs", "sleep_epochs", "wake_epochs", "unknown_epochs", "rem_epochs",
        "N2_N3_epochs", "first_rem_epoch",
    )


def activity_of_partials(partials: DataFrame, codes: DataFrame) -> DataFrame:
    """Transitions, awakenings and window hours per night."""
    return (
        _merged(partials)
        .select(
            "rec_id", "n_stage_transitions", "n_awakenings", hours(F.col("window_epochs")).alias("in_bed_window_h"),
            hours(F.col("sleep_epochs")).alias("tst_h"), minutes(F.col("wake_epochs")).alias("wake_in_window_min"),
        )
        .join(codes.select("rec_id", "patients_code"), "rec_id")
    )
