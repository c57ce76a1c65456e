"""Annotations to 30-second epochs, and replacing the epochs of a recording."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypnolith.functions.keys import (
    BLOCK,
    EPOCH_BLOCK,
    as_block,
    block_of,
    spread_over_blocks,
    with_block,
)
from hypnolith.functions.stages import map_stage, stage_code, stage_of_code
from hypnolith.operators.annotations import stage_annotations, with_first_onset
from hypnolith.schemas import EPOCH_SEC, EPOCHS, STAGES

_UNKNOWN_CODE = len(STAGES) - 1
# Code of an epoch that no interval has reached yet.
_UNCOVERED = 255
# Epochs of one Arrow batch; those of a block stay together.
_BATCH_EPOCHS = 1 << 15
#: Epochs per run, by level.
RUN_EPOCHS = (1, 64, 4096)


def _start_cells(annotations: DataFrame) -> DataFrame:
    """Annotations merged per (recording, start epoch, end epoch), end epoch NULL if inferred.

    Within a cell only the last annotation can be seen in the result: the
    others cover the same epochs and come earlier. The merge happens map-side,
    so neither copies nor dense annotations of one recording reach one task.
    """
    kept = stage_annotations(annotations).select(
        "rec_id",
        "ann_seq",
        "onset",
        "duration",
        stage_code(map_stage(F.col("description"))).alias("code"),
    )
    onset = F.col("onset") - F.col("first_onset")
    end = F.when(F.col("duration") > 0, onset + F.col("duration"))
    return (
        with_first_onset(kept)
        .withColumn("first_epoch", F.floor(onset / float(EPOCH_SEC)))
        .withColumn("end_sec", end)
        .withColumn("end_epoch", F.ceil(F.col("end_sec") / float(EPOCH_SEC)))
        .groupBy("rec_id", "first_epoch", "end_epoch")
        .agg(
            F.min("first_onset").alias("first_onset"),
            F.min("onset").alias("head_onset"),
            F.max(F.struct("onset", "ann_seq", "code")).alias("last"),
            F.max("end_sec").alias("end_sec"),
        )
    )


def _intervals(annotations: DataFrame, block_epochs: int) -> DataFrame:
    """Interval [first_epoch, end_epoch) of every annotation that can be visible.

    An annotation without duration lasts until the next onset. It is visible only
    as the last one of its start epoch: before that, the next annotation starts
    in the same epoch and overwrites it. ``next_epoch`` is where the next
    annotations of the recording start.
    """
    cells = (
        _start_cells(annotations)
        .withColumn(BLOCK, block_of("first_epoch", block_epochs))
        .filter(F.col(BLOCK).isNotNull())
    )
    later_first = Window.partitionBy("rec_id", BLOCK).orderBy(F.desc("first_epoch"))
    after = later_first.rangeBetween(Window.unboundedPreceding, -1)
    same = later_first.rangeBetween(0, 0)
    by_block = Window.partitionBy("rec_id").orderBy(BLOCK)
    # The summary keeps the whole cell and the NULL test above is explicit so that
    # both uses of the cells have the same plan and share one shuffle.
    head = F.struct("first_epoch", "head_onset", "first_onset", "last", "end_sec")
    following = (
        cells.groupBy("rec_id", BLOCK)
        .agg(F.min(head).alias("head"))
        .select("rec_id", BLOCK, F.lead("head").over(by_block).alias("following"))
    )
    inferred = F.col("end_sec").isNull()
    next_onset = F.coalesce("next_onset", "following.head_onset")
    inferred_end = (F.col("last.onset") - F.col("first_onset")) + F.coalesce(
        next_onset - F.col("last.onset"), F.lit(float(EPOCH_SEC))
    )
    end_epoch = F.ceil(F.coalesce("end_sec", inferred_end) / float(EPOCH_SEC))
    return (
        cells.withColumn("next_onset", F.min("head_onset").over(after))
        .withColumn("next_epoch", F.min("first_epoch").over(after))
        .withColumn("epoch_last", F.max("last").over(same))
        .filter(~inferred | (F.col("last") == F.col("epoch_last")))
        .join(following, ["rec_id", BLOCK])
        .select(
            "rec_id",
            "first_epoch",
            end_epoch.alias("end_epoch"),
            F.coalesce("next_epoch", "following.first_epoch").alias("next_epoch"),
            "last.onset",
            "last.ann_seq",
            "last.code",
        )
    )


def _hashed_on_blocks(pieces: DataFrame, partitions: int | None) -> DataFrame:
    """Pieces hashed on (rec_id, block) into a stated number of partitions.

    The stated count keeps adaptive execution from merging partitions by the size
    of the pieces: each of them is about to grow into the epochs it stands for.
    """
    count = partitions or int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(count, "rec_id", BLOCK)


def _between(first: Column, end: Column, level: int) -> Column:
    """Numbers of the runs first .. end - 1 of a level, each as number * 4 + level."""
    numbers = F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda n: n * 4 + level)


def _runs(first: str, end: str) -> Column:
    """The epochs first .. end - 1 as the longest aligned runs of RUN_EPOCHS that fill them.

    However long, a stretch becomes some 300 runs at most: single epochs at its ends,
    then runs of 64, then of 4,096. The build itself paints codes instead.
    """
    a, b, parts = F.col(first), F.col(end), []
    for level in range(len(RUN_EPOCHS) - 1):
        step = RUN_EPOCHS[level + 1] // RUN_EPOCHS[level]
        up, down = F.ceil(a / step), F.floor(b / step)
        whole = up < down
        parts.append(_between(a, F.when(whole, up * step).otherwise(b), level))
        parts.append(_between(F.when(whole, down * step).otherwise(b), b, level))
        a, b = F.when(whole, up).otherwise(F.lit(0)), F.when(whole, down).otherwise(F.lit(0))
    return F.concat(*parts, _between(a, b, len(RUN_EPOCHS) - 1))


def build_epochs(
    annotations: DataFrame,
    block_epochs: int = EPOCH_BLOCK,
    keep_block: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Dense epochs 0..n-1 per recording; the last annotation touching an epoch labels it.

    Shuffles stay at annotation size. Each interval covers its own epochs and, as
    UNKNOWN of lowest rank, the ones from there to the next start, so every epoch
    appears. Intervals are cut at block edges and hashed on (rec_id, block) first; the
    rest happens inside the task, one block after the other: its intervals overwrite the
    codes of their epochs in order of rank, and the block leaves as epochs. A task so
    sorts intervals and holds a block's codes, a byte each, but groups no epochs.
    ``partitions`` (the session's shuffle partitions unless given) should be sized for
    the epochs, not the annotations.
    """
    epochs = epochs_of_pieces(epoch_pieces(annotations, block_epochs), block_epochs, partitions)
    return epochs if keep_block else epochs.drop(BLOCK)


def epoch_pieces(annotations: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Intervals of epochs with their labels, cut at block edges: all that a block's epochs follow from."""
    filled_to = F.greatest("end_epoch", "next_epoch")
    return spread_over_blocks(
        _intervals(annotations, block_epochs).withColumn("_last", filled_to - 1),
        "first_epoch",
        "_last",
        block_epochs,
    ).select(
        "rec_id",
        BLOCK,
        F.greatest("first_epoch", F.col(BLOCK) * block_epochs).alias("first_epoch"),
        F.least(F.col("_last"), (F.col(BLOCK) + 1) * block_epochs - 1).alias("last_epoch"),
        "end_epoch",
        "onset",
        "ann_seq",
        "code",
    )


def epochs_of_pieces(
    pieces: DataFrame, block_epochs: int = EPOCH_BLOCK, partitions: int | None = None
) -> DataFrame:
    """The epochs (and their block) that pieces stand for; see :func:`build_epochs`."""
    after = F.col("last_epoch") + 1
    end = F.greatest("first_epoch", F.least("end_epoch", after))
    ordered = (
        _hashed_on_blocks(pieces, partitions)
        .sortWithinPartitions("rec_id", BLOCK, "onset", "ann_seq", "code")
        .select("rec_id", BLOCK, "first_epoch", end.alias("end_epoch"), after.alias("after"), "code")
    )
    schema = T.StructType(
        [pieces.schema["rec_id"], pieces.schema[BLOCK], *T.StructType.fromDDL("epoch_idx long, code long").fields]
    )
    return ordered.mapInArrow(_labelled(block_epochs), schema).select(
        "rec_id",
        "epoch_idx",
        (F.col("epoch_idx") * EPOCH_SEC).alias("start_sec"),
        F.lit(EPOCH_SEC).alias("duration_sec"),
        stage_of_code(F.col("code")).alias("stage_label"),
        as_block(F.col(BLOCK), block_epochs),
    )


def _labelled(block_epochs: int):
    """Pieces in order of (rec_id, block, rank) -> their epochs with the code of their label.

    One block's codes are held at a time, a byte each; epochs leave in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.full(block_epochs, _UNCOVERED, np.uint8)
        key, low, top = None, block_epochs, 0
        ids, blocks, places, labels, held = [], [], [], [], 0
        kinds = None

        def batch() -> pa.RecordBatch:
            of = pa.array(np.repeat(np.arange(len(ids)), [len(p) for p in places]))
            columns = [
                pa.array(ids, kinds[0]).take(of),
                pa.array(blocks, kinds[1]).take(of),
                pa.array(np.concatenate(places)),
                pa.array(np.concatenate(labels).astype(np.int64)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["rec_id", BLOCK, "epoch_idx", "code"])

        def close() -> int:
            """Take the open block's epochs over, and return their number."""
            seen = codes[low:top]
            covered = np.flatnonzero(seen != _UNCOVERED)
            ids.append(key[0])
            blocks.append(key[1])
            places.append(covered + (key[1] * block_epochs + low))
            labels.append(seen[covered])
            seen[:] = _UNCOVERED
            return len(covered)

        for pieces in batches:
            kinds = [pieces.schema.field(c).type for c in ("rec_id", BLOCK)]
            for rec, block, first, end, after, code in zip(*(c.to_pylist() for c in pieces.columns), strict=True):
                if (rec, block) != key:
                    if key is not None:
                        held += close()
                    if held >= _BATCH_EPOCHS:
                        yield batch()
                        ids, blocks, places, labels, held = [], [], [], [], 0
                    key, low, top = (rec, block), block_epochs, 0
                base = block * block_epochs
                first, end, after = first - base, end - base, after - base
                low, top = min(low, first), max(top, after)
                codes[first:end] = code
                if end < after:
                    rest = codes[end:after]
                    rest[rest == _UNCOVERED] = _UNKNOWN_CODE
        if key is not None:
            close()
            yield batch()

    return run


def default_duration(epochs: DataFrame) -> DataFrame:
    """Epochs with a missing duration set to one epoch length."""
    return epochs.withColumn(
        "duration_sec", F.coalesce(F.col("duration_sec"), F.lit(EPOCH_SEC))
    )


def replace_epochs(
    stored: DataFrame, incoming: DataFrame, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """Stored epochs with every recording in ``incoming`` replaced by its new epochs.

    The blocks to drop are looked up on block summaries, so that the row-level
    anti join runs on (rec_id, epoch_block) and a long recording is spread out.
    """
    columns = EPOCHS.fieldNames()
    blocked = with_block(stored, block_epochs)
    replaced = incoming.groupBy("rec_id").agg(F.count(F.lit(1)).alias("_n")).select("rec_id")
    dropped = blocked.select("rec_id", BLOCK).distinct().join(replaced, "rec_id", "left_semi")
    kept = blocked.join(dropped, ["rec_id", BLOCK], "left_anti")
    return kept.select(*columns).unionByName(incoming.select(*columns))
