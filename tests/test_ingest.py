"""The load from file names and annotations to nights, run twice."""

from __future__ import annotations

from datetime import datetime

import pytest

from hypnolith.operators.files import pairing_report, parse_filenames
from hypnolith.operators.nights import nights
from hypnolith.plans.ingest import load_epochs, load_files
from hypnolith.schemas import EPOCHS, NOTES, PATIENTS, RECORDINGS, TABLES
from hypnolith.sources.folder import manifest
from hypnolith.sources.storage import create_tables

FILES = [
    ("SC4001E0-PSG.edf", datetime(1989, 4, 24, 16, 13)),
    ("SC4001E1-PSG.edf", datetime(1989, 4, 25, 16, 13)),
    ("SC4001EC-Hypnogram.edf", None),
    ("SC4002E0-PSG.edf", None),
    ("SC4002EA-Hypnogram.edf", None),
    ("SC4003E0-PSG.edf", None),
]
ANNOTATIONS = [
    ("SC4001EC-Hypnogram.edf", 0, 100.0, 0.0, "Sleep stage W"),
    ("SC4001EC-Hypnogram.edf", 1, 160.0, 0.0, "Sleep stage 2"),
    ("SC4001EC-Hypnogram.edf", 2, 460.0, 0.0, "Sleep stage R"),
    ("SC4001EC-Hypnogram.edf", 3, 520.0, 0.0, "Sleep stage W"),
    ("SC4002EA-Hypnogram.edf", 0, 0.0, 0.0, "Lights off"),
]


@pytest.fixture(scope="module")
def files(spark):
    rows = [(name, meas, datetime(2020, 1, 2)) for name, meas in FILES]
    return spark.createDataFrame(rows, "name string, meas_date timestamp, modified timestamp")


@pytest.fixture(scope="module")
def annotations(spark):
    return spark.createDataFrame(
        ANNOTATIONS,
        "hyp_filename string, ann_seq long, onset double, duration double, description string",
    )


def _rows(table):
    return sorted(map(str, table.collect()))


def test_created_tables_are_empty_and_typed(spark, tmp_path):
    tables = create_tables(spark, str(tmp_path))
    assert set(tables) == set(TABLES)
    for name, table in tables.items():
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in TABLES[name]
        ]
        assert table.isEmpty()


def test_load_twice(spark, tmp_path, files, annotations):
    empty = create_tables(spark, str(tmp_path))
    once = load_epochs(load_files(empty, files), annotations, block_epochs=4)
    assert {r.patients_code for r in once["patients"].collect()} == {"SC4001", "SC4002"}
    recordings = {r.psg_filename: r for r in once["recordings"].collect()}
    # the fallback hypnogram serves the second night
    assert recordings["SC4001E1-PSG.edf"].hyp_filename == "SC4001EC-Hypnogram.edf"
    assert recordings["SC4001E0-PSG.edf"].rec_date == "1989-04-24"
    assert recordings["SC4002E0-PSG.edf"].rec_log == "2020-01-02T00:00:00+00:00"
    assert once["notes"].count() == 3
    labels = ["W"] * 2 + ["N2"] * 10 + ["REM"] * 2 + ["W"]
    for name in ("SC4001E0-PSG.edf", "SC4001E1-PSG.edf"):
        found = once["epochs"].filter(f"rec_id = {recordings[name].rec_id}").orderBy("epoch_idx")
        assert [r.stage_label for r in found.collect()] == labels
    assert once["epochs"].count() == 30

    twice = load_epochs(load_files(once, files), annotations, block_epochs=4)
    for name, schema in TABLES.items():
        columns = schema.fieldNames()
        assert _rows(once[name].select(*columns)) == _rows(twice[name].select(*columns))

    night = nights(once["recordings"], once["patients"], once["notes"], once["epochs"]).collect()
    assert len(night) == 2
    assert {(r.tst_min, r.in_bed_window_min, r.rem_latency_min, r.has_obs) for r in night} == {
        (6.0, 6.0, 5.0, 0)
    }
    status = {r.psg_filename: r.status for r in pairing_report(parse_filenames(manifest(files))).collect()}
    assert status["SC4003E0-PSG.edf"] == "none" and status["SC4002E0-PSG.edf"] == "fallback"


def test_equal_names_in_two_folders_are_two_recordings(spark, tmp_path):
    rows = [
        (folder, name, datetime(year, 1, 1), datetime(2020, 1, 2))
        for folder, year in (("a", 2001), ("b", 2002), (None, 2003))
        for name in ("SC4001E0-PSG.edf", "SC4001EC-Hypnogram.edf")
    ]
    files = spark.createDataFrame(rows, "folder string, name string, meas_date timestamp, modified timestamp")
    by_file = spark.createDataFrame(
        [(f, "SC4001EC-Hypnogram.edf", 0, 0.0, d, "Sleep stage 2") for f, d in (("a", 60.0), ("b", 90.0), (None, 30.0))],
        "folder string, hyp_filename string, ann_seq long, onset double, duration double, description string",
    )
    empty = create_tables(spark, str(tmp_path))
    once = load_epochs(load_files(empty, files), by_file)
    twice = load_epochs(load_files(once, files), by_file)
    for tables in (once, twice):
        found = tables["recordings"].join(tables["epochs"].groupBy("rec_id").count(), "rec_id").collect()
        assert {(r.rec_code, r.psg_filename, r.rec_date, r["count"]) for r in found} == {
            ("a/E0", "a/SC4001E0-PSG.edf", "2001-01-01", 2), ("b/E0", "b/SC4001E0-PSG.edf", "2002-01-01", 3),
            ("E0", "SC4001E0-PSG.edf", "2003-01-01", 1),
        }
        assert tables["patients"].count() == 1


def test_nothing_to_load(spark, annotations):
    tables = {
        "patients": spark.createDataFrame([], PATIENTS),
        "recordings": spark.createDataFrame([], RECORDINGS),
        "notes": spark.createDataFrame([], NOTES),
        "epochs": spark.createDataFrame([], EPOCHS),
    }
    with pytest.raises(ValueError):
        load_epochs(tables, annotations)
