"""Night metrics recomputed from published stage minutes of nine real recordings.

Expected values are literals: published epochs per stage, and the published
metrics of each night. One published ``tst_h`` was rounded differently (7.475 hours
given as 7.47), so hours compare with a tolerance of 0.01 for that night.
"""

from __future__ import annotations

import pytest

from hypnolith.operators.analysis import analysis_ready, deep_sleep_outliers
from hypnolith.operators.exports import bi_nights, kpi_cards, night_detail
from hypnolith.operators.nights import SUMMARY_COLUMNS, sleep_summary
from hypnolith.operators.sequences import fragmentation

# Fixed values, as published: rec_id, code, minutes in W, N1, N2, N3, REM, UNKNOWN
STAGE_MINUTES = [
    (1, "SC4001", 34.0, 29.0, 125.0, 110.0, 62.5, 0.0),
    (2, "SC4002", 31.5, 29.5, 186.5, 148.5, 107.5, 0.5),
    (3, "SC4011", 18.5, 54.5, 281.0, 52.5, 85.0, 0.0),
    (4, "SC4012", 21.0, 46.0, 330.0, 48.0, 88.0, 0.0),
    (5, "SC4021", 4.0, 47.0, 272.5, 47.5, 81.5, 0.0),
    (6, "SC4022", 2.5, 92.0, 201.0, 59.5, 89.5, 0.5),
    (7, "SC4031", 10.0, 30.5, 242.5, 28.5, 104.5, 0.0),
    (8, "SC4032", 8.0, 22.5, 200.0, 65.5, 99.5, 0.0),
    (9, "SC4041", 40.0, 83.0, 310.0, 26.5, 98.0, 0.5),
]
# Fixed values, as published: rec_id -> in_bed_min, in_bed_h, tst_min, tst_h, wake_min, rem_min, N2_N3_min,
#           sleep%, unknown%, rem%, N2_N3%, wake%, efficiency
METRICS = {
    1: (360.5, 6.01, 326.5, 5.44, 34.0, 62.5, 235.0, 90.6, 0.0, 19.1, 72.0, 10.4, 0.906),
    2: (504.0, 8.4, 472.0, 7.87, 31.5, 107.5, 335.0, 93.7, 0.1, 22.8, 71.0, 6.7, 0.937),
    3: (491.5, 8.19, 473.0, 7.88, 18.5, 85.0, 333.5, 96.2, 0.0, 18.0, 70.5, 3.9, 0.962),
    4: (533.0, 8.88, 512.0, 8.53, 21.0, 88.0, 378.0, 96.1, 0.0, 17.2, 73.8, 4.1, 0.961),
    5: (452.5, 7.54, 448.5, 7.47, 4.0, 81.5, 320.0, 99.1, 0.0, 18.2, 71.3, 0.9, 0.991),
    6: (445.0, 7.42, 442.0, 7.37, 2.5, 89.5, 260.5, 99.3, 0.1, 20.2, 58.9, 0.6, 0.993),
    7: (416.0, 6.93, 406.0, 6.77, 10.0, 104.5, 271.0, 97.6, 0.0, 25.7, 66.7, 2.5, 0.976),
    8: (395.5, 6.59, 387.5, 6.46, 8.0, 99.5, 265.5, 98.0, 0.0, 25.7, 68.5, 2.1, 0.98),
    9: (558.0, 9.3, 517.5, 8.63, 40.0, 98.0, 336.5, 92.7, 0.1, 18.9, 65.0, 7.7, 0.927),
}
# rec_id -> transitions, awakenings, in_bed_h, tst_h, transitions/h, awakenings/h
EVENTS = {
    1: (110, 10, 6.01, 5.44, 18.3, 1.84),
    2: (119, 21, 8.4, 7.87, 14.17, 2.67),
    3: (107, 13, 8.19, 7.88, 13.06, 1.65),
    4: (152, 15, 8.88, 8.53, 17.12, 1.76),
    5: (132, 7, 7.54, 7.47, 17.51, 0.94),
    6: (154, 4, 7.42, 7.37, 20.75, 0.54),
    7: (113, 12, 6.93, 6.77, 16.31, 1.77),
    8: (90, 11, 6.59, 6.46, 13.66, 1.7),
    9: (157, 28, 9.3, 8.63, 16.88, 3.24),
}


@pytest.fixture(scope="module")
def counts(spark):
    rows = []
    for rec, _, *minutes in STAGE_MINUTES:
        w, n1, n2, n3, rem, unknown = (int(m * 2) for m in minutes)
        sleep = n1 + n2 + n3 + rem
        rows.append((rec, 100, w + sleep + unknown, sleep, w, unknown, rem, n2 + n3, 150))
    return spark.createDataFrame(
        rows,
        "rec_id long, first_sleep_epoch long, window_epochs long, sleep_epochs long,"
        "wake_epochs long, unknown_epochs long, rem_epochs long, N2_N3_epochs long, first_rem_epoch long",
    )


@pytest.fixture(scope="module")
def labels(spark):
    rows = [
        (rec, code, "E0", 0 if rec == 6 else 1, 1, "p", "1989-04-24", 50, "M", 20, 0, 1, 0, 0, 0)
        for rec, code, *_ in STAGE_MINUTES
    ]
    return spark.createDataFrame(
        rows,
        "rec_id long, patients_code string, rec_code string, has_obs int, obs_count int,"
        "psg_filename string, rec_date string, age int, sex string, bmi int, had_coffee int,"
        "had_alcohol int, has_pain int, sleep_deprived int, stress int",
    )


def test_metrics(counts, labels):
    names = SUMMARY_COLUMNS[4:17]
    for row in sleep_summary(labels.join(counts, "rec_id")).collect():
        for name, expected in zip(names, METRICS[row.rec_id]):
            tolerance = 0.0101 if (row.rec_id, name) == (5, "tst_h") else 0.0
            assert abs(row[name] - expected) <= tolerance, (row.rec_id, name)
        assert row.sleep_onset_min_from_recording_start == 50.0
        assert row.rem_latency_min == 25.0


def test_verdicts(counts, labels):
    nights = bi_nights(counts, labels)
    assert len(nights.columns) == 30
    verdicts = {r.rec_id: (r.pass_qc, r.qc_reason) for r in nights.collect()}
    assert verdicts.pop(1) == (0, "fail: TST < 6h")
    assert set(verdicts.values()) == {(1, "pass")}
    assert analysis_ready(nights).count() == 8
    assert night_detail(nights).count() == 9
    card = kpi_cards(nights).first()
    assert card.qc_pass_rate_pct == 88.9 and card.avg_rem_latency_min == 25.0


def test_null_metric_fails_without_a_reason(counts, labels):
    from pyspark.sql import functions as F

    blank = counts.withColumn("sleep_epochs", F.lit(None).cast("long"))
    row = bi_nights(blank, labels).first()
    assert (row.pass_qc, row.qc_reason) == (0, "pass")


def test_no_rem_has_no_latency(counts, labels):
    from pyspark.sql import functions as F

    without = counts.withColumn("first_rem_epoch", F.lit(None).cast("long"))
    assert sleep_summary(labels.join(without, "rec_id")).filter("rem_latency_min IS NOT NULL").isEmpty()


def test_outlier(counts, labels):
    rows = deep_sleep_outliers(sleep_summary(labels.join(counts, "rec_id"))).collect()
    assert [(r.patients_code, r.N2_N3_pct_tst, r.mean_val) for r in rows] == [("SC4022", 58.9, 68.63)]
    assert round(rows[0].sd_val, 2) == 4.29


def test_rates(spark):
    activity = spark.createDataFrame(
        [(rec, f"c{rec}", *values[:4]) for rec, values in EVENTS.items()],
        "rec_id long, patients_code string, n_stage_transitions long, n_awakenings long,"
        "in_bed_window_h double, tst_h double",
    )
    rows = fragmentation(activity).collect()
    for r in rows:
        assert (r.transitions_per_hour_window, r.awakenings_per_hour_sleep) == EVENTS[r.rec_id][4:]
    assert [r.rec_id for r in rows] == [6, 1, 5, 4, 9, 7, 2, 8, 3]
