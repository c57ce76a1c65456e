"""Windows, transitions, awakenings and bouts against brute force, with tiny blocks."""

from __future__ import annotations

import random

import pytest
from brute import activity as brute_activity
from brute import bouts as brute_bouts
from brute import window as brute_window

from hypnolith.operators.nights import in_bed_window_minimal, night_counts, sleep_bounds
from hypnolith.operators.sequences import (
    awakenings,
    fragmentation,
    longest_bouts,
    longest_bouts_counted,
    night_activity,
    previous_stages,
    stage_transitions,
)

SCHEMA = "rec_id long, epoch_idx long, start_sec long, duration_sec int, stage_label string"


def _nights(seed, count, gaps=False, faults=False):
    rng = random.Random(seed)
    labels = ["W", "N1", "N2", "N3", "REM", "UNKNOWN"] + ([None, "N4"] if faults else [])
    nights = {}
    for rec in range(count):
        rows, index = [], 0
        while len(rows) < rng.choice([1, 5, 20, 60]):
            label = rng.choice(labels)
            for _ in range(rng.choice([1, 1, 2, 5, 9])):
                rows.append((index, label))
                index += rng.choice([1, 1, 1, 12]) if gaps else 1
        nights[rec] = rows
    nights[count] = [(i, "W") for i in range(5)]
    nights[count + 1] = list(enumerate(["W", "N1", "W", "UNKNOWN", "W", "REM", "W"]))
    nights[count + 2] = list(enumerate(["N2", "N2", "N3", "N2", "N3", "N3", "N3"]))
    nights[count + 3] = [(i, "N2") for i in range(40)]
    return nights


def _table(spark, nights):
    return spark.createDataFrame(
        [(rec, i, 30 * i, 30, label) for rec, rows in nights.items() for i, label in rows], SCHEMA
    )


def _codes(spark, nights):
    return spark.createDataFrame(
        [(rec, f"P{rec}", "E0", f"{rec}.edf") for rec in nights],
        "rec_id long, patients_code string, rec_code string, psg_filename string",
    )


VARIANTS = [(1, False), (3, False), (7, True), (1 << 20, True)]


@pytest.mark.parametrize("block,gaps", VARIANTS)
def test_activity(spark, block, gaps):
    nights = _nights(block, 60, gaps, faults=True)
    found = {
        r.rec_id: r
        for r in night_activity(_table(spark, nights), _codes(spark, nights), block).collect()
    }
    for rec, rows in nights.items():
        inside = brute_window(rows)
        if not inside:
            assert rec not in found
            continue
        assert (found[rec].n_stage_transitions, found[rec].n_awakenings) == brute_activity(rows), rows
        assert found[rec].wake_in_window_min == sum(l == "W" for _, l in inside) / 2


@pytest.mark.parametrize("block,gaps", VARIANTS)
def test_bouts_in_both_forms(spark, block, gaps):
    nights = _nights(block + 1, 60, gaps)
    epochs, codes = _table(spark, nights), _codes(spark, nights)
    for operator in (longest_bouts, longest_bouts_counted):
        found = {
            r.rec_id: (r.longest_n3_min, r.longest_rem_min, r.longest_sleep_bout_min)
            for r in operator(epochs, codes, block).collect()
        }
        expected = {rec: brute_bouts(rows) for rec, rows in nights.items() if brute_window(rows)}
        assert found == expected, operator.__name__


@pytest.mark.parametrize("block,gaps", VARIANTS)
def test_previous_stages(spark, block, gaps):
    nights = _nights(block + 2, 40, gaps, faults=True)
    found = {
        (r.rec_id, r.epoch_idx): r.prev_stage
        for r in previous_stages(_table(spark, nights), block).collect()
    }
    expected = {
        (rec, index): before
        for rec, rows in nights.items()
        for (index, _), before in zip(rows, [None] + [label for _, label in rows])
    }
    assert found == expected


@pytest.mark.parametrize("block", [2, 1 << 20])
def test_window_rows_and_counts(spark, block):
    nights = _nights(11, 40, gaps=True, faults=True)
    epochs = _table(spark, nights)
    inside = {(r.rec_id, r.epoch_idx) for r in in_bed_window_minimal(epochs, block).collect()}
    expected = {rec: brute_window(rows) for rec, rows in nights.items()}
    assert inside == {(rec, i) for rec, rows in expected.items() for i, _ in rows}
    for r in night_counts(epochs, block).collect():
        labels = [label for _, label in expected[r.rec_id]]
        assert r.window_epochs == len(labels)
        assert r.first_sleep_epoch == expected[r.rec_id][0][0]
        assert r.sleep_epochs == sum(l in ("N1", "N2", "N3", "REM") for l in labels)
        assert r.wake_epochs == labels.count("W")
        assert r.unknown_epochs == labels.count("UNKNOWN")
        assert r.rem_epochs == labels.count("REM")
        assert r.N2_N3_epochs == labels.count("N2") + labels.count("N3")
        rem = [i for i, l in expected[r.rec_id] if l == "REM"]
        assert r.first_rem_epoch == (rem[0] if rem else None)


def test_night_without_sleep_has_no_bounds(spark):
    epochs = _table(spark, {1: [(0, "W"), (1, "W"), (2, "UNKNOWN")], 2: [(0, "N1"), (1, "N2")]})
    assert [r.rec_id for r in sleep_bounds(epochs).collect()] == [2]


def test_rates_use_the_reported_hours(spark):
    activity = spark.createDataFrame(
        [(1, "SC4001", 110, 10, 6.01, 5.44, 34.0), (2, "X", 1, 1, 0.0, 0.0, 0.0)],
        "rec_id long, patients_code string, n_stage_transitions long, n_awakenings long,"
        "in_bed_window_h double, tst_h double, wake_in_window_min double",
    )
    rows = {r.rec_id: r for r in fragmentation(activity).collect()}
    assert rows[1].transitions_per_hour_window == 18.3
    assert rows[1].awakenings_per_hour_sleep == 1.84
    assert rows[2].transitions_per_hour_window is None
    assert awakenings(activity).filter("rec_id = 1").first().awakenings_per_hour_sleep == 1.66
    assert stage_transitions(activity).first().rec_id == 1
