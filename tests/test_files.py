"""File names, pairing and recording times."""

from __future__ import annotations

from datetime import datetime

import pytest

from hypnolith.operators.files import (
    pair_recordings,
    pairing_report,
    parse_filenames,
    recording_datetime,
)
from hypnolith.session import working_folder
from hypnolith.sources import derived
from hypnolith.sources.folder import manifest, scan_folder

NAMES = [
    "SC4001E0-PSG.edf",
    "SC4001EC-Hypnogram.edf",
    "SC4001EH-Hypnogram.edf",
    "SC4001E1-PSG.edf",
    "sc4002e0-PSG.edf",
    "SC4002EC-Hypnogram.edf",
    "sc4002ec-Hypnogram.edf",
    "SC4003E0-PSG.edf",
    "SC4003EA-Hypnogram.edf",
    "SC4003E1-PSG.edf",
    "SC4004E0-PSG.edf",
    "SC4004EA-Hypnogram.edf",
    "SC4004EB-Hypnogram.edf",
    "SC4005E0-PSG.edf",
    "SC4006E9-PSG.edf",
    "SC4007E0-psg.edf",
    "badly-named-Hypnogram.edf",
    "notes.txt",
]


def _parsed(spark, names=NAMES):
    files = spark.createDataFrame([(n,) for n in names], "name string")
    return parse_filenames(manifest(files))


def test_manifest_matches_endings_with_case(spark):
    files = spark.createDataFrame([(n,) for n in NAMES], "name string")
    kinds = {r.name: r.kind for r in manifest(files).collect()}
    assert kinds["SC4001E0-PSG.edf"] == "psg"
    assert kinds["badly-named-Hypnogram.edf"] == "hypnogram"
    assert "SC4007E0-psg.edf" not in kinds and "notes.txt" not in kinds


def test_names_are_parsed_without_case(spark):
    parsed = {r.name: (r.subject, r.code) for r in _parsed(spark).collect()}
    assert parsed["sc4002e0-PSG.edf"] == ("SC4002", "E0")
    assert parsed["SC4006E9-PSG.edf"] == (None, None)
    assert parsed["badly-named-Hypnogram.edf"] == (None, None)


def test_outcomes(spark):
    report = {r.psg_filename: r for r in pairing_report(_parsed(spark)).collect()}
    status = {name: r.status for name, r in report.items()}
    assert status == {
        "SC4001E0-PSG.edf": "paired",
        "SC4001E1-PSG.edf": "paired",
        "sc4002e0-PSG.edf": "paired",
        "SC4003E0-PSG.edf": "fallback",
        "SC4003E1-PSG.edf": "fallback",
        "SC4004E0-PSG.edf": "ambiguous",
        "SC4005E0-PSG.edf": "none",
        "SC4006E9-PSG.edf": "bad name",
    }
    assert report["SC4004E0-PSG.edf"].candidates == "SC4004EA-Hypnogram.edf, SC4004EB-Hypnogram.edf"
    assert report["SC4001E0-PSG.edf"].candidates is None


def test_pairs(spark):
    pairs = {
        (r.patients_code, r.rec_code): r.hyp_filename
        for r in pair_recordings(_parsed(spark)).collect()
    }
    assert pairs == {
        ("SC4001", "E0"): "SC4001EC-Hypnogram.edf",
        ("SC4001", "E1"): "SC4001EH-Hypnogram.edf",
        ("SC4002", "E0"): "sc4002ec-Hypnogram.edf",
        ("SC4003", "E0"): "SC4003EA-Hypnogram.edf",
        ("SC4003", "E1"): "SC4003EA-Hypnogram.edf",
    }


def test_two_spellings_are_two_candidates(spark):
    names = ["SC4008E1-PSG.edf", "SC4008EC-Hypnogram.edf", "sc4008ec-Hypnogram.edf"]
    assert [r.status for r in pairing_report(_parsed(spark, names)).collect()] == ["ambiguous"]


def test_header_time_wins_over_modification_time(spark):
    changed = datetime(2020, 5, 6, 7, 8, 9)
    files = spark.createDataFrame(
        [
            ("a", datetime(1989, 4, 24, 16, 13), changed),
            ("b", None, changed),
            ("c", datetime(1989, 12, 31, 23, 59, 59, 250), changed),
        ],
        "name string, meas_date timestamp_ntz, modified timestamp_ntz",
    )
    rows = {r.psg_filename: (r.rec_date, r.rec_log) for r in recording_datetime(files).collect()}
    assert rows == {
        "a": ("1989-04-24", "1989-04-24T16:13:00+00:00"),
        "b": ("2020-05-06", "2020-05-06T07:08:09+00:00"),
        "c": ("1989-12-31", "1989-12-31T23:59:59.000250+00:00"),
    }


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        files = spark.range(1).selectExpr(
            "'a' AS name", "timestamp_ntz'1989-04-02 02:30:00' AS meas_date",
            "timestamp_micros(609300780000250) AS modified",
        )
        rows = recording_datetime(files.union(files.selectExpr("'b'", "NULL", "modified"))).collect()
        assert {r.psg_filename: (r.rec_date, r.rec_log) for r in rows} == {
            "a": ("1989-04-02", "1989-04-02T02:30:00+00:00"),
            "b": ("1989-04-23", "1989-04-23T02:13:00.000250+00:00"),
        }
        events = spark.range(1).selectExpr(
            "1L AS event_id", "'view' AS event_type", "timestamp_ntz'2024-03-10 02:30:00' AS ts", "7L AS user_id"
        )
        later = events.selectExpr("2L", "event_type", "timestamp_ntz'2024-03-10 03:30:00'", "user_id")
        onsets = [r.onset for r in derived.annotations(events.union(later)).orderBy("ann_seq").collect()]
        assert onsets == [0.0, 180.0]
        assert derived.recordings(events).first().rec_log == "2024-03-10T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_user_week_or_month_is_merged(spark):
    users = [1000, 10000, 1000000, 6761000, 100010000]
    days = ["2024-01-01", "2024-01-09", "2024-01-16", "2024-01-30", "2024-02-01", "2025-01-01"]
    rows = [(n, "view", datetime.fromisoformat(d), u) for n, (u, d) in enumerate((u, d) for u in users for d in days)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz, user_id long")
    recordings = derived.recordings(events).collect()
    assert len({r.rec_id for r in recordings}) == len({r.psg_filename for r in recordings}) == len(rows)
    files = manifest(derived.file_manifest(events))
    psg = parse_filenames(files).filter("kind = 'psg' AND subject IS NOT NULL").collect()
    assert len({(r.folder, r.subject, r.code) for r in psg}) == len(psg) == len(rows)
    assert len({(r.folder[4:], r.subject) for r in psg}) == len(users)
    customers = spark.createDataFrame([(u,) for u in users], "c_custkey long")
    assert derived.patients(customers).select("patients_code").distinct().count() == len(users)


def test_shared_folder_is_needed_beyond_one_machine(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_folder(Session, "x")


def test_scan_folder_reads_only_the_listing(spark, tmp_path):
    for name in NAMES:
        (tmp_path / name).write_bytes(b"x" * 10)
    files = scan_folder(spark, str(tmp_path))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]
    names = {r.name for r in manifest(files).collect()}
    assert names == {n for n in NAMES if n.endswith(("-PSG.edf", "-Hypnogram.edf"))}
    assert recording_datetime(files).filter("rec_date IS NULL").isEmpty()
