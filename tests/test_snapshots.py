"""Commits of all tables at once: failures, conflicts, pinned readers, removal of old folders."""

from __future__ import annotations

import os

import pytest
from test_storage import _epochs

from hypnolith.schemas import NOTE_FLAGS, NOTES, PATIENTS, RECORDINGS
from hypnolith.sources import snapshots


def _tables(spark, patients=4):
    people = [(p, f"SC{p:04d}", None, None, None) for p in range(patients)]
    nights = [(10 * p + k, p, f"E{k}", "p", "h", "2020-01-01", None) for p in range(patients) for k in (0, 1)]
    return {
        "patients": spark.createDataFrame(people, PATIENTS),
        "recordings": spark.createDataFrame(nights, RECORDINGS),
        "notes": spark.createDataFrame([(r[0], *[0] * len(NOTE_FLAGS)) for r in nights], NOTES),
        "epochs": _epochs(spark, {r[0]: ["W", "N1", "N2", "W"] for r in nights}),
    }


def _sizes(tables):
    return {name: rows.count() for name, rows in tables.items()}


FULL = {"patients": 4, "recordings": 8, "notes": 8, "epochs": 32}
LESS = {"patients": 3, "recordings": 6, "notes": 6, "epochs": 24}


@pytest.fixture()
def kept(spark, tmp_path):
    out = snapshots.Snapshots(spark, str(tmp_path / "mart"))
    assert out.numbers() == [] and out.commit(_tables(spark), buckets=3) == 1
    return out


def test_delete_shows_in_all_tables_and_pinned_readers_keep_theirs(spark, kept):
    pinned = kept.read()
    assert _sizes(pinned) == FULL
    assert kept.delete_patients(spark.createDataFrame([(2,)], "patients_id long")) == 2
    assert _sizes(kept.read()) == LESS and _sizes(pinned) == FULL == _sizes(kept.read(1))
    plan = kept.read()["epochs"].groupBy("rec_id", "epoch_block").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


@pytest.mark.parametrize("at", ["recordings", "notes", "epochs", "manifest"])
def test_failure_at_any_point_shows_nothing(spark, kept, monkeypatch, at):
    write, epochs = snapshots.write_table, snapshots.write_epochs

    def failing(rows, path, *rest):
        if path.endswith(at):
            raise RuntimeError("lost")
        return (epochs if path.endswith("epochs") else write)(rows, path, *rest)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "write_table", failing)
        patch.setattr(snapshots, "write_epochs", failing)
        if at == "manifest":
            patch.setattr(snapshots.Snapshots, "_publish", lost)
        with pytest.raises(RuntimeError):
            kept.delete_patients(spark.createDataFrame([(2,)], "patients_id long"))
    assert kept.numbers() == [1] and _sizes(kept.read()) == FULL
    assert kept.delete_patients(spark.createDataFrame([(2,)], "patients_id long")) == 2
    assert _sizes(kept.read()) == LESS


def test_two_commits_on_one_snapshot_conflict(spark, kept):
    tables = _tables(spark, 2)
    assert kept.commit({"patients": tables["patients"]}, base=1) == 2
    with pytest.raises(snapshots.SnapshotConflict):
        kept.commit({"patients": tables["patients"].limit(1)}, base=1)
    assert kept.numbers() == [1, 2] and kept.read()["patients"].count() == 2
    # Tables that were not given are those of the snapshot before.
    assert kept.read()["epochs"].count() == 32
    with pytest.raises(ValueError):
        snapshots.Snapshots(spark, f"{kept.root}/other").commit({"patients": tables["patients"]})


def test_expire_removes_what_no_snapshot_names(spark, kept):
    kept.delete_patients(spark.createDataFrame([(2,)], "patients_id long"))
    kept.commit({"patients": _tables(spark, 2)["patients"]})
    os.makedirs(f"{kept.root}/data/00000009-failed/patients")
    assert _sizes(kept.read(2)) == LESS
    removed = kept.expire()
    assert len([r for r in removed if r.startswith("00000001-")]) == 4 and any("failed" in r for r in removed)
    assert [r.split("/")[1] for r in removed if r.startswith("00000002-")] == ["patients"]
    assert kept.numbers() == [3] and _sizes(kept.read()) == {**LESS, "patients": 2}
    assert kept.expire() == []
    with pytest.raises(ValueError):
        kept.expire(0)
