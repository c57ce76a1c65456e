"""Constraint checks and load checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK, with_block
from hypnolith.functions.stages import is_sleep
from hypnolith.operators.nights import night_counts, sleep_bounds
from hypnolith.schemas import (
    DOMAIN_RULES,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    STAGES,
    UNKNOWN,
    WAKE,
    not_null_columns,
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def _broken_rules(table: DataFrame, name: str, broken: dict) -> DataFrame:
    """(table_name, rule, violations) from one pass over the table."""
    sums = table.agg(
        *[F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).alias(rule) for rule, c in broken.items()]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(rule).cast("long").alias("violations"))
            for rule in broken
        ]
    )
    return sums.select(F.lit(name).alias("table_name"), F.inline(pairs))


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs per required column."""
    return _union(
        [
            _broken_rules(table, name, {c: F.col(c).isNull() for c in not_null_columns(name)})
            for name, table in tables.items()
        ]
    )


def check_domain(tables: dict[str, DataFrame]) -> DataFrame:
    """Values outside their domain; NULL breaks no domain rule."""
    return _union(
        [
            _broken_rules(
                tables[name], name, {rule: ~F.expr(text) for rule, text in rules.items()}
            )
            for name, rules in DOMAIN_RULES.items()
            if name in tables
        ]
    )


def _repeated_keys(table: DataFrame, name: str, key: tuple[str, ...]) -> DataFrame:
    """Number of key values that occur more than once; copies are counted map-side.

    Rows with a NULL in the key are never equal to another row.
    """
    columns = list(key)
    if BLOCK in table.columns and "epoch_idx" in key:
        columns.insert(1, BLOCK)
    repeated = (
        table.dropna(subset=list(key))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(", ".join(key)).alias("rule"), "violations"
    )


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated key values per primary or unique key."""
    return _union(
        [
            _repeated_keys(table, name, key)
            for name, table in tables.items()
            for key in PRIMARY_KEYS[name]
        ]
    )


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose parent is missing. Children are counted per key before the join."""
    checks = []
    for child, key, parent in FOREIGN_KEYS:
        orphans = (
            tables[child]
            .filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .join(tables[parent].select(key), key, "left_anti")
        )
        checks.append(
            orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
                F.lit(child).alias("table_name"),
                F.lit(f"{key} in {parent}").alias("rule"),
                "violations",
            )
        )
    return _union(checks)


def rows_left(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, id, n and sum of epoch places: what each table holds per patient or recording."""
    keys = {"patients": "patients_id", "recordings": "rec_id", "epochs": "rec_id", "notes": "rec_id"}
    place = lambda name: F.sum("epoch_idx") if name == "epochs" else F.lit(0).cast("long")
    return _union(
        [
            tables[name]
            .groupBy(F.col(key).alias("id"))
            .agg(F.count(F.lit(1)).alias("n"), place(name).alias("places"))
            .select(F.lit(name).alias("table_name"), "id", "n", "places")
            for name, key in keys.items()
        ]
    )


def cascade_delete(
    tables: dict[str, DataFrame],
    deleted_patients: DataFrame,
    block_epochs: int = EPOCH_BLOCK,
) -> dict[str, DataFrame]:
    """The tables without some patients, their recordings, and the epochs and notes of those.

    Epochs are matched on (rec_id, epoch_block), looked up from the table's own
    blocks, so that no recording is joined in one piece.
    """
    gone = deleted_patients.select("patients_id").distinct()
    recordings = tables["recordings"]
    gone_recordings = recordings.join(gone, "patients_id", "left_semi").select("rec_id")
    epochs = with_block(tables["epochs"], block_epochs)
    gone_blocks = (
        epochs.select("rec_id", BLOCK).distinct().join(gone_recordings, "rec_id", "left_semi")
    )
    return {
        "patients": tables["patients"].join(gone, "patients_id", "left_anti"),
        "recordings": recordings.join(gone, "patients_id", "left_anti"),
        "epochs": epochs.join(gone_blocks, ["rec_id", BLOCK], "left_anti").select(
            *tables["epochs"].columns
        ),
        "notes": tables["notes"].join(gone_recordings, "rec_id", "left_anti"),
    }


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per table."""
    return _union(
        [
            table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, table in tables.items()
        ]
    )


def no_sleep_window(recordings: DataFrame, patients: DataFrame, epochs: DataFrame) -> DataFrame:
    """Recordings without any sleep epoch."""
    return (
        recordings.join(sleep_bounds(epochs), "rec_id", "left_anti")
        .join(patients, "patients_id")
        .select("patients_code", "psg_filename", "hyp_filename")
        .orderBy("patients_code", "psg_filename")
    )


def patients_without_recordings(patients: DataFrame, recordings: DataFrame) -> DataFrame:
    return (
        patients.join(recordings.select("patients_id").distinct(), "patients_id", "left_anti")
        .select("patients_code")
        .orderBy("patients_code")
    )


def _label_counts(epochs: DataFrame) -> DataFrame:
    """Counts over all epochs in one pass; sums are NULL when there is no row."""
    label = F.col("stage_label")
    return epochs.agg(
        F.count(F.lit(1)).alias("epochs_total"),
        F.sum(F.when(is_sleep(label), 1).otherwise(0)).alias("epochs_sleep"),
        F.sum(F.when(label == WAKE, 1).otherwise(0)).alias("epochs_wake"),
        F.sum(F.when(label == UNKNOWN, 1).otherwise(0)).alias("epochs_unknown"),
    )


def _window_label_counts(epochs: DataFrame) -> DataFrame:
    """The same counts inside the sleep windows, summed over the nights."""
    return night_counts(epochs).agg(
        F.coalesce(F.sum("window_epochs"), F.lit(0)).alias("epochs_total"),
        F.sum("sleep_epochs").alias("epochs_sleep"),
        F.sum("wake_epochs").alias("epochs_wake"),
        F.sum("unknown_epochs").alias("epochs_unknown"),
    )


def _as_metrics(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"), F.coalesce(F.col(c), F.lit(0)).alias("value")
            )
            for c, metric in names.items()
        ]
    )
    return counts.select(F.inline(pairs))


def epoch_totals(epochs: DataFrame) -> DataFrame:
    """Epochs in total, asleep, awake and unknown over full recordings."""
    return _as_metrics(
        _label_counts(epochs),
        {
            "epochs_total": "epochs_total",
            "epochs_sleep": "epochs_sleep",
            "epochs_wake": "epochs_wake",
            "epochs_unknown": "unknown_epochs",
        },
    )


def in_bed_totals(epochs: DataFrame) -> DataFrame:
    """Epochs in total, asleep, awake and unknown inside the sleep windows."""
    return _as_metrics(
        _window_label_counts(epochs),
        {
            "epochs_total": "in_bed_epochs_total",
            "epochs_sleep": "in_bed_epochs_sleep",
            "epochs_wake": "in_bed_epochs_wake",
            "epochs_unknown": "in_bed_unknown_epochs",
        },
    )


def scope_comparison(epochs: DataFrame) -> DataFrame:
    """Full recordings against sleep windows, one row each."""
    full = _label_counts(epochs).select(F.lit("full_recording").alias("scope"), "*")
    window = _window_label_counts(epochs).select(F.lit("in_bed_window").alias("scope"), "*")
    return full.unionAll(window)


def null_labels(epochs: DataFrame) -> DataFrame:
    return epochs.filter(F.col("stage_label").isNull()).agg(
        F.count(F.lit(1)).alias("n_null_stage_labels")
    )


def invalid_labels(epochs: DataFrame) -> DataFrame:
    return epochs.filter(~F.col("stage_label").isin(*STAGES)).select("stage_label").distinct()
