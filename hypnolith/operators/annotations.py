"""Staging annotations: which count, how long they last, where they start."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.functions.keys import lookup_by_salted_key
from hypnolith.functions.stages import is_staging
from hypnolith.schemas import EPOCH_SEC

# Seconds of recording per group when onsets of one recording are put in order: one
# epoch, so that onsets dense in time are spread out, then a thousand epochs, so that
# the groups of a long recording are.
SLICES_SEC = (30.0, 30000.0)


def stage_annotations(annotations: DataFrame) -> DataFrame:
    """Annotations that carry staging.

    Their order within a recording is (onset, ann_seq); it is kept as columns.
    """
    return annotations.filter(is_staging(F.col("description")))


def _with_next(onsets: DataFrame, slices_sec: tuple[float, ...]) -> DataFrame:
    """Distinct (rec_id, onset) with the next later onset of the recording.

    A window orders the onsets of a time slice. The first onset of the following
    slice comes from one row per slice, put in order the same way in longer slices.
    """
    if not slices_sec:
        order = Window.partitionBy("rec_id").orderBy("onset")
        return onsets.withColumn("next_onset", F.lead("onset").over(order))
    sliced = onsets.withColumn("slice", F.floor(F.col("onset") / slices_sec[0]))
    in_slice = Window.partitionBy("rec_id", "slice").orderBy("onset")
    heads = sliced.groupBy("rec_id", "slice").agg(F.min("onset").alias("onset"))
    following = _with_next(heads.select("rec_id", "onset"), slices_sec[1:]).select(
        "rec_id",
        F.floor(F.col("onset") / slices_sec[0]).alias("slice"),
        F.col("next_onset").alias("next_head"),
    )
    return (
        sliced.withColumn("inside", F.lead("onset").over(in_slice))
        .join(following, ["rec_id", "slice"])
        .withColumn("next_onset", F.coalesce("inside", "next_head"))
        .drop("slice", "inside", "next_head")
    )


def next_onsets(
    kept: DataFrame, slices_sec: tuple[float, ...] = SLICES_SEC
) -> DataFrame:
    """Per distinct (rec_id, onset): its last annotation and the next later onset.

    Copies of an onset collapse map-side first.
    """
    distinct = kept.groupBy("rec_id", "onset").agg(F.max("ann_seq").alias("last_seq"))
    return _with_next(distinct, slices_sec)


def infer_durations(
    kept: DataFrame, slices_sec: tuple[float, ...] = SLICES_SEC
) -> DataFrame:
    """Fill durations <= 0 with the time to the next annotation, the last one with one epoch.

    Of several annotations at one onset only the last lasts until the next
    onset; the next annotation of the others starts at the same moment.
    """
    gap = F.when(F.col("ann_seq") < F.col("last_seq"), F.lit(0.0)).otherwise(
        F.coalesce(F.col("next_onset") - F.col("onset"), F.lit(float(EPOCH_SEC)))
    )
    duration = F.when(F.col("duration") > 0, F.col("duration")).otherwise(gap)
    return kept.join(next_onsets(kept, slices_sec), ["rec_id", "onset"]).select(
        *[duration.alias(c) if c == "duration" else c for c in kept.columns]
    )


def first_onsets(kept: DataFrame) -> DataFrame:
    """First staging onset per recording."""
    return kept.groupBy("rec_id").agg(F.min("onset").alias("first_onset"))


def with_first_onset(kept: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Attach the recording's first staging onset to each of its annotations."""
    return lookup_by_salted_key(
        kept, first_onsets(kept) if firsts is None else firsts, "rec_id", "ann_seq"
    )


def rebase_onsets(kept: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Shift onsets so that the first staging annotation of a recording is at 0.

    Filling durations moves no onset: give ``firsts`` from the rows before it, so that
    the fill is not computed a second time for them.
    """
    shifted = F.col("onset") - F.col("first_onset")
    return with_first_onset(kept, firsts).select(
        *[shifted.alias(c) if c == "onset" else c for c in kept.columns]
    )


def timed_annotations(annotations: DataFrame) -> DataFrame:
    """Staging annotations with durations filled and onsets from 0."""
    kept = stage_annotations(annotations)
    return rebase_onsets(infer_durations(kept), first_onsets(kept))


def recording_span(rebased: DataFrame) -> DataFrame:
    """Whole seconds and epochs covered per recording; recordings without any are left out."""
    span = F.ceil(F.max(F.col("onset") + F.col("duration")))
    return (
        rebased.groupBy("rec_id")
        .agg(span.alias("span_sec"))
        .filter(F.col("span_sec") > 0)
        .withColumn("n_epochs", F.ceil(F.col("span_sec") / float(EPOCH_SEC)))
    )


def span_of_annotations(annotations: DataFrame) -> DataFrame:
    """``recording_span`` of annotations as they come, by one aggregate per recording.

    A filled-in duration ends at the next onset, so none but the last annotation's can
    reach the end of the recording; all others that can have a duration of their own.
    """
    own_end = F.when(F.col("duration") > 0, F.struct((F.col("onset") + F.col("duration")).alias("end"), "onset", "duration"))
    whole = (
        stage_annotations(annotations)
        .groupBy("rec_id")
        .agg(
            F.min("onset").alias("first"),
            F.max(F.struct("onset", "ann_seq", "duration")).alias("last"),
            F.max(own_end).alias("longest"),
        )
    )
    last = F.when(F.col("last.duration") > 0, F.col("last.duration")).otherwise(F.lit(float(EPOCH_SEC)))
    end = F.greatest(
        (F.col("last.onset") - F.col("first")) + last,
        (F.col("longest.onset") - F.col("first")) + F.col("longest.duration"),
    )
    return (
        whole.select("rec_id", F.ceil(end).alias("span_sec"))
        .filter("span_sec > 0")
        .withColumn("n_epochs", F.ceil(F.col("span_sec") / float(EPOCH_SEC)))
    )
