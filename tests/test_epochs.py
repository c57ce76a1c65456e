"""Annotations to epochs: edge cases by hand, random recordings by brute force."""

from __future__ import annotations

import random

import pytest
from brute import epochs as brute_epochs
from brute import timed as brute_timed

from hypnolith.functions.keys import BLOCK
from hypnolith.operators import epochs as epochs_module
from hypnolith.operators.annotations import (
    infer_durations,
    rebase_onsets,
    recording_span,
    span_of_annotations,
    stage_annotations,
)
from hypnolith.operators.epochs import build_epochs, default_duration, replace_epochs
from hypnolith.schemas import ANNOTATIONS, EPOCHS

W, N1, N2, R = "Sleep stage W", "Sleep stage 1", "Sleep stage 2", "Sleep stage R"

CASES = {
    "zero duration": ([(0, 0, W), (60, 0, N1), (90, 0, R)], ["W", "W", "N1", "REM"]),
    "misaligned, last wins": ([(0, 40, W), (40, 50, N2)], ["W", "N2", "N2"]),
    "gap": ([(0, 30, W), (90, 30, N1)], ["W", "UNKNOWN", "UNKNOWN", "N1"]),
    "equal onsets": ([(0, 30, N1), (0, 30, N2)], ["N2"]),
    "equal onsets, first zero": ([(0, 0, N1), (0, 30, N2)], ["N2"]),
    "equal onsets, last zero": ([(0, 60, N1), (0, 0, N2), (31, 5, W)], ["N2", "W"]),
    "first onset not 0": ([(120, 30, W), (150, 30, N1)], ["W", "N1"]),
    "irrelevant annotation": ([(0, 30, "Lights off"), (30, 30, W)], ["W"]),
    "nested": ([(0, 300, W), (60, 60, N1), (180, 30, R)], list("WW") + ["N1"] * 2 + list("WW") + ["REM"] + ["W"] * 3),
    "order of rows": ([(90, 30, N1), (0, 90, W)], ["W", "W", "W", "N1"]),
    "label map": (
        [
            (0, 30, "Sleep stage 3"),
            (30, 30, "sleep STAGE 4"),
            (60, 30, "Movement time"),
            (90, 30, "Sleep stage ?"),
            (120, 30, "Sleep stage N2"),
        ],
        ["N3", "N3", "UNKNOWN", "UNKNOWN", "UNKNOWN"],
    ),
    "only irrelevant": ([(0, 30, "Lights off")], []),
}


def _annotations(spark, recordings):
    rows = [
        (rec, seq, float(onset), float(duration), text)
        for rec, annotations in recordings.items()
        for seq, onset, duration, text in annotations
    ]
    return spark.createDataFrame(rows, ANNOTATIONS)


def _by_recording(epochs):
    found: dict[int, dict[int, str]] = {}
    for row in epochs.collect():
        assert row.start_sec == 30 * row.epoch_idx and row.duration_sec == 30
        labels = found.setdefault(row.rec_id, {})
        assert row.epoch_idx not in labels
        labels[row.epoch_idx] = row.stage_label
    for labels in found.values():
        assert sorted(labels) == list(range(len(labels)))
    return {rec: [labels[i] for i in range(len(labels))] for rec, labels in found.items()}


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 20])
def test_edge_cases(spark, block):
    recordings = {
        rec: [(seq, *row) for seq, row in enumerate(rows)]
        for rec, (rows, _) in enumerate(CASES.values())
    }
    found = _by_recording(build_epochs(_annotations(spark, recordings), block))
    for rec, (name, (_, expected)) in enumerate(CASES.items()):
        assert found.get(rec, []) == expected, name
        assert brute_epochs(recordings[rec]) == expected, name


def _random_recordings(seed, count):
    rng = random.Random(seed)
    texts = [W, N1, N2, "Sleep stage 3", "Sleep stage 4", R, "Sleep stage ?", "Movement time", "Lights off"]
    recordings = {}
    for rec in range(count):
        span = rng.choice([60, 600, 3000, 12000])
        rows = []
        for seq in range(rng.randint(1, 40)):
            onset = rng.choice([rng.randrange(0, span, 30), rng.uniform(0, span), rng.randrange(0, span)])
            duration = rng.choice([0, 0, -1, 30, 45, rng.uniform(0.5, 90), rng.uniform(100, span)])
            rows.append((seq, float(onset), float(duration), rng.choice(texts)))
        rows += [(100 + i, *rows[0][1:]) for i in range(rng.choice([0, 0, 5]))]
        rng.shuffle(rows)
        recordings[rec] = rows
    return recordings


@pytest.mark.parametrize("block", [1, 7, 50, 1 << 20])
def test_random_recordings(spark, block):
    recordings = _random_recordings(block, 150)
    found = _by_recording(build_epochs(_annotations(spark, recordings), block))
    for rec, rows in recordings.items():
        assert found.get(rec, []) == brute_epochs(rows), rows


@pytest.mark.parametrize("slices_sec", [(), (30.0,), (30.0, 300.0), (20.0, 100.0, 1000.0), (1e9,)])
def test_durations_and_spans(spark, slices_sec):
    recordings = _random_recordings(3, 60)
    kept = stage_annotations(_annotations(spark, recordings))
    shifted = rebase_onsets(infer_durations(kept, slices_sec))
    found: dict[int, list] = {}
    for row in shifted.collect():
        found.setdefault(row.rec_id, []).append(
            (row.ann_seq, row.onset, row.duration, row.description)
        )
    spans = {row.rec_id: row.n_epochs for row in recording_span(shifted).collect()}
    raw = span_of_annotations(_annotations(spark, recordings))
    assert raw._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1
    assert {row.rec_id: row.n_epochs for row in raw.collect()} == spans
    for rec, rows in recordings.items():
        expected = brute_timed(rows)
        assert sorted(found.get(rec, [])) == sorted(expected)
        assert spans.get(rec, 0) == len(brute_epochs(rows))


def test_one_recording_dense_in_time(spark):
    """Thousands of annotations in a few epochs, a third of them copies, are merged first."""
    rng = random.Random(5)
    rows = [(i, rng.uniform(0, 90), 0.0, rng.choice([W, N1, N2, R])) for i in range(2000)]
    rows += [(2000 + i, 45.0, 45.0, R) for i in range(1000)]
    found = _by_recording(build_epochs(_annotations(spark, {1: rows})))
    assert found == {1: brute_epochs(rows)}


def test_result_does_not_depend_on_partitioning(spark):
    annotations = _annotations(spark, _random_recordings(9, 30))
    once = build_epochs(annotations.repartition(1), 5)
    twice = build_epochs(annotations.repartition(7), 5)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_block_column_follows_the_index(spark):
    epochs = build_epochs(_annotations(spark, _random_recordings(2, 10)), 16, keep_block=True)
    assert epochs.filter(f"{BLOCK} <> epoch_idx div 16").isEmpty()


@pytest.mark.parametrize("block", [2, 1 << 20])
def test_replace_epochs_is_idempotent(spark, block):
    def table(rows):
        return spark.createDataFrame(
            [(rec, i, 30 * i, 30, label) for rec, labels in rows.items() for i, label in enumerate(labels)],
            EPOCHS,
        )

    stored = table({1: ["W"] * 5, 2: ["N1"] * 3})
    incoming = table({2: ["N2", "N2"], 3: ["REM"]})
    once = replace_epochs(stored, incoming, block)
    twice = replace_epochs(once, incoming, block)
    expected = {1: ["W"] * 5, 2: ["N2", "N2"], 3: ["REM"]}
    assert _by_recording(once) == expected
    assert _by_recording(twice) == expected


def test_default_duration(spark):
    rows = spark.createDataFrame([(1, None), (2, 20)], "rec_id long, duration_sec int")
    assert {r.rec_id: r.duration_sec for r in default_duration(rows).collect()} == {1: 30, 2: 20}


def test_nested_intervals_cost_their_number_and_the_epochs(spark):
    """3,000 intervals inside each other: runs, not every interval's every epoch."""
    n = 3000
    rows = spark.range(n).selectExpr(
        "1L AS rec_id", "id AS ann_seq", "cast(id * 30 AS double) AS onset",
        f"cast(({2 * n} - 2 * id) * 30 AS double) AS duration",
        "CASE WHEN id % 2 = 0 THEN 'Sleep stage 1' ELSE 'Sleep stage 2' END AS description",
    )
    stretch = spark.range(1).selectExpr("5L AS a", f"{2 * n}L AS b").select(epochs_module._runs("a", "b").alias("r"))
    runs = stretch.first().r
    held = [e for r in runs for e in range((r // 4) * 64 ** (r % 4), (r // 4 + 1) * 64 ** (r % 4))]
    assert sorted(held) == list(range(5, 2 * n)) and len(runs) < 320
    found = [r.stage_label for r in build_epochs(rows).orderBy("epoch_idx").collect()]
    # Interval i covers i .. 2n - i - 1; the last one that touches an epoch labels it.
    wanted = ["N1" if min(e, 2 * n - 1 - e, n - 1) % 2 == 0 else "N2" for e in range(2 * n)]
    assert found == wanted


def test_a_task_groups_no_epochs(spark):
    """Blocks are painted one after the other: neither aggregates nor windows over epochs, one shuffle."""
    pieces = epochs_module.epoch_pieces(_annotations(spark, _random_recordings(4, 40)), 50).localCheckpoint()
    built = epochs_module.epochs_of_pieces(pieces, 50, 4)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_blocks_that_cross_arrow_batches(spark):
    recordings, setting = _random_recordings(6, 40), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        found = _by_recording(build_epochs(_annotations(spark, recordings), 50))
    finally:
        spark.conf.set(setting, before)
    for rec, rows in recordings.items():
        assert found.get(rec, []) == brute_epochs(rows), rows
