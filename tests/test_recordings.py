"""Recording files on disk: listing of sub-folders, header dates, and the load from them."""

from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest

from hypnolith.plans.ingest import load_files
from hypnolith.sources.recordings import scan_recordings, start_of_header
from hypnolith.sources.storage import create_tables


def _header(date="24.04.89", time="16.13.00", recording="X X X X"):
    return f"{'0':<8}{'X':<80}{recording:<80}{date:<8}{time:<8}{'256':<8}{'':<44}{'-1':<8}{'1':<8}{'0':<4}".encode()


def test_header_starts():
    utc = lambda *a: datetime(*a, tzinfo=timezone.utc)
    assert len(_header()) == 256
    assert start_of_header(_header()) == utc(1989, 4, 24, 16, 13)
    assert start_of_header(_header("02.03.84")) == utc(2084, 3, 2, 16, 13)
    assert start_of_header(_header("02.03.yy", recording="Startdate 02-MAR-2085 x x x")) == utc(2085, 3, 2, 16, 13)
    assert start_of_header(_header("01.01.02", recording="Startdate X x x x")) == utc(2002, 1, 1, 16, 13)
    for bad in (_header("31.02.99"), _header("xx.01.99"), _header(time="25.00.00"), b"short", b"", _header("02.03.yy")):
        assert start_of_header(bad) is None


@pytest.mark.parametrize("uri", [False, True])
def test_folders_are_scanned_and_dated(spark, tmp_path, uri):
    written = {
        "SC4001E0-PSG.edf": _header(), "SC4001EC-Hypnogram.edf": _header("01.01.11"), "notes.txt": b"no",
        "a/SC4001E0-PSG.edf": _header("01.02.03"), "a/SC4001EC-Hypnogram.edf": b"", "a/b/SC4002E1-PSG.edf": b"damaged",
        "a/b/SC4002EH-Hypnogram.edf": b"", "c d/x-PSG.edf.bak": b"no",
    }
    for name, content in written.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        os.utime(path, (1_600_000_000, 1_600_000_000))
    root = f"file://{tmp_path}" if uri else str(tmp_path)
    files = scan_recordings(spark, root)
    utc = lambda t: t and t.astimezone(timezone.utc).replace(tzinfo=None)
    found = {(r.folder, r.name): (utc(r.meas_date), utc(r.modified)) for r in files.collect()}
    changed = datetime(2020, 9, 13, 12, 26, 40)
    assert found == {
        (None, "SC4001E0-PSG.edf"): (datetime(1989, 4, 24, 16, 13), changed), (None, "SC4001EC-Hypnogram.edf"): (None, changed),
        ("a", "SC4001E0-PSG.edf"): (datetime(2003, 2, 1, 16, 13), changed), ("a", "SC4001EC-Hypnogram.edf"): (None, changed),
        ("a/b", "SC4002E1-PSG.edf"): (None, changed), ("a/b", "SC4002EH-Hypnogram.edf"): (None, changed),
    }
    loaded = load_files(create_tables(spark, str(tmp_path / "tables")), files)["recordings"].collect()
    # The header's date wins over the time of change, which stands in where a header is damaged.
    assert {(r.psg_filename, r.rec_date) for r in loaded} == {
        ("SC4001E0-PSG.edf", "1989-04-24"), ("a/SC4001E0-PSG.edf", "2003-02-01"), ("a/b/SC4002E1-PSG.edf", "2020-09-13")
    }


def test_empty_folder(spark, tmp_path):
    assert scan_recordings(spark, str(tmp_path)).isEmpty()
