"""Constraint and load checks on hand-made faults."""

from __future__ import annotations

import pytest

from hypnolith.operators import quality
from hypnolith.schemas import TABLES, not_null_columns

EPOCHS = "rec_id long, epoch_idx long, start_sec long, duration_sec int, stage_label string"
NOTES = "rec_id long, had_coffee int, had_alcohol int, has_pain int, sleep_deprived int, stress int"


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "patients": spark.createDataFrame(
            [
                (1, "A", 16, "male", 20),
                (2, "B", None, "x", 71),
                (3, "B", 100, "Other", 70),
                (4, "C", 17, None, None),
            ],
            "patients_id long, patients_code string, age int, sex string, bmi int",
        ),
        "recordings": spark.createDataFrame(
            [(10, 1, "E0"), (11, 1, "E1"), (12, 2, "E0"), (13, 9, "E0")],
            "rec_id long, patients_id long, rec_code string",
        ).selectExpr("*", "'p' AS psg_filename", "'h' AS hyp_filename", "'d' AS rec_date", "NULL AS rec_log"),
        "epochs": spark.createDataFrame(
            [
                (10, 0, 0, 30, "N1"),
                (10, 0, 0, 30, "N1"),
                (10, 1, 30, None, None),
                (11, 0, 0, 30, "N4"),
                (11, 1, 30, 30, "w"),
                (12, -1, -30, 30, "W"),
                (99, 0, 0, 30, "W"),
                (99, 1, 30, 30, "W"),
            ],
            EPOCHS,
        ),
        "notes": spark.createDataFrame(
            [(10, 2, 0, 0, 0, 0), (11, 0, 0, 0, 0, None), (98, 0, 0, 0, 0, 1)], NOTES
        ),
    }


def _violations(df):
    return {(r.table_name, r.rule): r.violations for r in df.collect()}


def test_not_null(tables):
    found = _violations(quality.check_not_null(tables))
    broken = {k: v for k, v in found.items() if v}
    assert broken == {
        ("epochs", "duration_sec"): 1,
        ("epochs", "stage_label"): 1,
        ("notes", "stress"): 1,
    }
    assert len(found) == sum(len(not_null_columns(name)) for name in TABLES)


def test_domain(tables):
    found = {k: v for k, v in _violations(quality.check_domain(tables)).items() if v}
    assert found == {
        ("patients", "age"): 1,
        ("patients", "sex"): 1,
        ("patients", "bmi"): 1,
        ("epochs", "epoch_idx"): 1,
        ("epochs", "start_sec"): 1,
        ("epochs", "stage_label"): 2,
        ("notes", "had_coffee"): 1,
    }


def test_unique(tables):
    found = {k: v for k, v in _violations(quality.check_unique(tables)).items() if v}
    assert found == {("patients", "patients_code"): 1, ("epochs", "rec_id, epoch_idx"): 1}


def test_foreign_keys(tables):
    assert _violations(quality.check_foreign_keys(tables)) == {
        ("recordings", "patients_id in patients"): 1,
        ("epochs", "rec_id in recordings"): 2,
        ("notes", "rec_id in recordings"): 1,
    }


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_cascade(spark, tables, block):
    deleted = spark.createDataFrame([(1,), (1,)], "patients_id long")
    left = quality.cascade_delete(tables, deleted, block)
    assert sorted(r.patients_id for r in left["patients"].collect()) == [2, 3, 4]
    assert sorted(r.rec_id for r in left["recordings"].collect()) == [12, 13]
    assert sorted((r.rec_id, r.epoch_idx) for r in left["epochs"].collect()) == [
        (12, -1),
        (99, 0),
        (99, 1),
    ]
    assert [r.rec_id for r in left["notes"].collect()] == [98]
    assert left["epochs"].columns == tables["epochs"].columns


def test_labels(tables):
    assert quality.null_labels(tables["epochs"]).first().n_null_stage_labels == 1
    assert {r.stage_label for r in quality.invalid_labels(tables["epochs"]).collect()} == {"N4", "w"}


def test_totals(tables):
    totals = {r.metric: r.value for r in quality.epoch_totals(tables["epochs"]).collect()}
    assert totals == {
        "epochs_total": 8,
        "epochs_sleep": 2,
        "epochs_wake": 3,
        "unknown_epochs": 0,
    }


def test_empty_tables(spark):
    empty = spark.createDataFrame([], EPOCHS)
    assert {r.value for r in quality.epoch_totals(empty).collect()} == {0}
    assert {r.value for r in quality.in_bed_totals(empty).collect()} == {0}
    for row in quality.scope_comparison(empty).collect():
        assert row.epochs_total == 0 and row.epochs_sleep is None


def test_missing_rows(spark, tables):
    no_sleep = quality.no_sleep_window(tables["recordings"], tables["patients"], tables["epochs"])
    assert [r.patients_code for r in no_sleep.collect()] == ["A", "B"]
    lonely = quality.patients_without_recordings(tables["patients"], tables["recordings"])
    assert [r.patients_code for r in lonely.collect()] == ["B", "C"]
