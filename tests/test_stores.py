"""Block index, run store, merge on read and sliced loads: results, plans and failures."""

from __future__ import annotations

import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F
from test_storage import _epochs, _plan

from hypnolith.functions.keys import BLOCK
from hypnolith.operators import nights, partials, runs, sequences
from hypnolith.operators.epochs import build_epochs
from hypnolith.plans import mart as mart_plan
from hypnolith.plans import refresh, slices
from hypnolith.sources import blocks, storage, versions


def _labels(seed, recordings=30, most=60):
    rng = random.Random(seed)
    stages = ["W", "N1", "N2", "N3", "REM", "UNKNOWN"]
    out = {}
    for rec in range(recordings):
        row = []
        while len(row) < rng.randrange(1, most):
            row += [rng.choice(stages)] * rng.randrange(1, 6)
        out[rec] = row
    out[recordings] = ["W", "UNKNOWN"] * 5  # no sleep
    return out


def _rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


# --- block index --------------------------------------------------------------------


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("indexed"))
    epochs = storage.write_epochs(_epochs(spark, _labels(1)), f"{root}/epochs", buckets=8, block_epochs=16)
    return epochs, blocks.write_block_index(epochs, f"{root}/index"), f"{root}/epochs"


def test_lookup_opens_only_files_that_hold_the_recording(spark, indexed):
    epochs, index, _ = indexed
    every = {os.path.basename(f) for f in epochs.inputFiles()}
    for rec in (0, 7, 30):
        holders = {
            os.path.basename(f) for f in epochs.inputFiles() if not spark.read.parquet(f).filter(f"rec_id = {rec}").isEmpty()
        }
        found = blocks.recording_epochs(epochs, index, [rec])
        assert {os.path.basename(f) for f in found.inputFiles()} == holders < every
        assert _rows(found) == _rows(epochs.filter(f"rec_id = {rec}").drop(BLOCK))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[[^\]]*(In\(rec_id|EqualTo\(rec_id|rec_id)", plan) and "Exchange" not in plan


def test_lookup_of_a_stretch_opens_its_blocks(spark, indexed):
    epochs, index, _ = indexed
    rec = blocks.longest_recording(index)[0]
    part = blocks.recording_epochs(epochs, index, [rec], 20, 25)
    assert [r.epoch_idx for r in part.orderBy("epoch_idx").collect()] == list(range(20, 26))
    assert len(part.inputFiles()) == 1 <= len(blocks.recording_epochs(epochs, index, [rec]).inputFiles())


def test_lookup_edges(spark, indexed, monkeypatch):
    epochs, index, _ = indexed
    assert blocks.recording_epochs(epochs, index, [999]).isEmpty()
    assert blocks.recording_epochs(epochs, index, []).isEmpty()
    with pytest.raises(ValueError):
        blocks.recording_epochs(epochs, index, list(range(1001)))
    monkeypatch.setattr(blocks, "MOST_FILES", 1)
    assert _rows(blocks.recording_epochs(epochs, index, [1, 2])) == _rows(epochs.filter("rec_id IN (1, 2)").drop(BLOCK))
    assert blocks.longest_recording(index.limit(0)) == []


def test_stage_counts_come_from_the_summary_while_it_is_true(spark, tmp_path):
    labels = _labels(2, 10)
    epochs = storage.write_epochs(_epochs(spark, labels), str(tmp_path / "epochs"), buckets=4)
    index, folder = blocks.write_block_index(epochs, str(tmp_path / "index")), str(tmp_path / "epochs")
    counted = blocks.stage_epochs(index, epochs, folder)
    wanted = _rows(epochs.groupBy("stage_label").agg(F.count("*").alias("n_epochs")))
    assert _rows(counted) == wanted and {os.path.dirname(f) for f in counted.inputFiles()} == {f"file://{tmp_path}/index"}
    # A further file in the folder: the summary no longer describes the table.
    extra = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    shutil.copy(f"{folder}/{extra}", f"{folder}/further.parquet")
    assert not blocks.describes(index, folder)
    scanned = blocks.stage_epochs(index, spark.read.parquet(folder), folder)
    assert {os.path.dirname(f) for f in scanned.inputFiles()} == {f"file://{folder}"}
    # Labels outside the vocabulary are counted by a scan.
    odd = storage.write_epochs(_epochs(spark, {1: ["W", "N4", "N4"]}), str(tmp_path / "odd"), buckets=2)
    index = blocks.write_block_index(odd, str(tmp_path / "odd_index"))
    assert {tuple(r) for r in blocks.stage_epochs(index, odd, str(tmp_path / "odd")).collect()} == {("W", 1), ("N4", 2)}


# --- runs ------------------------------------------------------------------------------


@pytest.mark.parametrize("block_epochs", [1 << 18, 7, 1])
def test_metrics_of_runs_equal_those_of_epochs(spark, block_epochs):
    epochs = _epochs(spark, _labels(3)).filter("epoch_idx % 11 <> 4")  # with gaps
    codes = spark.range(31).selectExpr("id AS rec_id", "concat('P', id) AS patients_code")
    inside = runs.in_bed_runs(runs.runs_of_epochs(epochs, block_epochs), block_epochs)
    assert _rows(runs.night_counts_of_runs(inside)) == _rows(nights.night_counts(epochs, block_epochs))
    assert _rows(sequences.activity_of_runs(inside, codes)) == _rows(sequences.night_activity(epochs, codes, block_epochs))
    assert _rows(sequences.longest_bouts_of_runs(inside, codes)) == _rows(sequences.longest_bouts(epochs, codes, block_epochs))
    assert runs.in_bed_runs(runs.runs_of_epochs(epochs.limit(0))).isEmpty()


def test_stored_runs_are_read_in_place_and_no_epochs_are(spark, tmp_path):
    epochs = storage.write_epochs(_epochs(spark, _labels(4)), str(tmp_path / "epochs"), buckets=4)
    stored = storage.write_bucketed(runs.runs_of_epochs(epochs), str(tmp_path / "runs"), "first_epoch", 4, hashed=True)
    codes = spark.range(31).selectExpr("id AS rec_id", "'x' AS patients_code")
    activity = sequences.activity_of_runs(runs.in_bed_runs(stored), codes)
    assert {os.path.dirname(f) for f in activity.inputFiles()} == {f"file://{tmp_path}/runs"}
    plan = _plan(spark, activity)
    assert "Bucketed: true" in plan and "first_epoch" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "first_epoch" not in line and "stage_label" not in line
    assert stored.count() < epochs.count() / 2


@pytest.mark.parametrize("block_epochs", [1 << 18, 9, 2])
def test_nights_of_partials_equal_those_of_epochs(spark, block_epochs):
    epochs = _epochs(spark, _labels(9, 40)).filter("epoch_idx % 13 <> 5")
    codes = spark.range(41).selectExpr("id AS rec_id", "concat('P', id) AS patients_code")
    held = partials.block_partials(epochs, block_epochs)
    assert _rows(partials.night_counts_of_partials(held)) == _rows(nights.night_counts(epochs, block_epochs))
    activity = partials.activity_of_partials(held, codes)
    assert _rows(activity) == _rows(sequences.night_activity(epochs, codes, block_epochs))
    # Blocks that change are counted anew; the rows of others stay.
    after = _epochs(spark, {**_labels(9, 40), 3: ["N2", "W"] * 15, 5: ["W"] * 8}).filter("epoch_idx % 13 <> 5")
    with_block = lambda df: partials.runs_of_epochs(df, block_epochs).select("rec_id", BLOCK)
    changed = with_block(epochs).unionByName(with_block(after)).filter("rec_id IN (3, 5)").distinct()
    blocked = after.withColumn(BLOCK, F.expr(f"epoch_idx div {block_epochs}"))
    now = partials.refreshed_partials(held, blocked, changed, block_epochs)
    assert _rows(partials.night_counts_of_partials(now)) == _rows(nights.night_counts(after, block_epochs))
    assert _rows(partials.activity_of_partials(now, codes)) == _rows(sequences.night_activity(after, codes, block_epochs))
    assert partials.night_counts_of_partials(held.limit(0)).isEmpty()


# --- merge on read -----------------------------------------------------------------------


def _replaced(old, new):
    return {**old, **new}


@pytest.fixture()
def versioned(spark, tmp_path):
    return versions.create_versioned(_epochs(spark, _labels(5)), str(tmp_path / "table"), buckets=4, block_epochs=16)


def test_reloads_replace_recordings(spark, versioned, tmp_path):
    labels = _labels(5)
    assert _rows(versioned.read().drop(BLOCK)) == _rows(_epochs(spark, labels))
    for new in ({3: ["REM"] * 40, 4: ["W"]}, {4: ["N1", "N2"] * 20, 77: ["W"] * 3}, {3: ["N3"]}, {3: ["N3"]}):
        versioned.reload(_epochs(spark, new))
        labels = _replaced(labels, new)
        assert _rows(versioned.read().drop(BLOCK)) == _rows(_epochs(spark, labels))
    versioned.reload(_epochs(spark, {}))
    compacted = versioned.compact(str(tmp_path / "compacted"))
    assert _rows(compacted.read()) == _rows(versioned.read())
    assert len(spark.table(compacted.table).inputFiles()) <= 4 < len(spark.table(versioned.table).inputFiles())


def test_windows_over_reloaded_epochs_do_not_shuffle_them(spark, versioned):
    versioned.reload(_epochs(spark, {3: ["REM"] * 40}))
    plan = _plan(spark, sequences.previous_stages(versioned.read(), 16))
    assert "Bucketed: true" in plan and "Window" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "epoch_idx" not in line and "start_sec" not in line


def test_a_reload_that_fails_half_way_shows_nothing(spark, versioned, monkeypatch):
    before = _rows(versioned.read())
    append = versions.VersionedEpochs._append

    def failing(self, *args):
        append(self, *args)
        raise RuntimeError("lost between epochs and versions")

    with monkeypatch.context() as patch:
        patch.setattr(versions.VersionedEpochs, "_append", failing)
        with pytest.raises(RuntimeError):
            versioned.reload(_epochs(spark, {3: ["REM"] * 40}))
    assert _rows(versioned.read()) == before
    os.makedirs(f"{versioned.root}/versions/00000001-begun")  # not committed
    assert _rows(versioned.read()) == before
    versioned.reload(_epochs(spark, {3: ["REM"] * 40}))
    assert versioned.read().filter("rec_id = 3").count() == 40


def _annotations(spark, changes=(), without=()):
    rng = random.Random(6)
    rows = []
    for rec in range(6):
        onset = 0.0
        for seq in range(25):
            rows.append([rec, seq, onset, 30.0 * rng.randrange(1, 5), f"Sleep stage {rng.choice('W123R')}"])
            onset += rows[-1][3]
    for rec, seq, label in changes:
        next(r for r in rows if r[:2] == [rec, seq])[4] = f"Sleep stage {label}"
    rows = [r for r in rows if r[0] not in without]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "rec_id long, ann_seq long, onset double, duration double, description string")


def test_refresh_builds_changed_blocks_only(spark, tmp_path, monkeypatch):
    built = []
    build = refresh.epochs_of_pieces
    monkeypatch.setattr(refresh, "epochs_of_pieces", lambda *a, **k: built.append(1) or build(*a, **k))
    table, known = refresh.first_load(_annotations(spark), str(tmp_path / "table"), 4, 16)
    assert _rows(table.read().drop(BLOCK)) == _rows(build_epochs(_annotations(spark))) and len(built) == 1
    known, changed = refresh.refresh(table, known, _annotations(spark))
    assert changed.isEmpty() and len(built) == 1 and not os.path.exists(f"{table.root}/versions")
    # One annotation changes its label: its blocks are built, and those of its recording alone.
    one = next(r.description[-1] for r in _annotations(spark).collect() if (r.rec_id, r.ann_seq) == (2, 7))
    other = [(2, 7, "4" if one != "3" else "1")]
    before = {r.rec_id: r for r in table.read().groupBy("rec_id").count().collect()}
    known, changed = refresh.refresh(table, known, _annotations(spark, other))
    assert {r.rec_id for r in changed.collect()} == {2} and 1 <= changed.count() <= 2 < before[2]["count"] / 16 + 1
    assert _rows(table.read().drop(BLOCK)) == _rows(build_epochs(_annotations(spark, other)))
    # Recordings that are not in a load stay; shorter ones lose their last blocks.
    known, changed = refresh.refresh(table, known, _annotations(spark, other, without=(0, 2)))
    assert changed.isEmpty() and table.read().filter("rec_id = 0").count() == before[0]["count"]
    short = _annotations(spark).filter("rec_id = 4 AND ann_seq < 3")
    known, _ = refresh.refresh(table, known, short)
    wanted = build_epochs(_annotations(spark, other)).filter("rec_id <> 4").unionByName(build_epochs(short))
    assert _rows(table.read().drop(BLOCK)) == _rows(wanted)
    assert refresh.refresh(table, known, short)[1].isEmpty()


# --- slices ------------------------------------------------------------------------------


def test_partitions_of_a_job_are_bounded_at_any_size(spark):
    for raw in (0, 1, 10**9, 10**12, 10**14, 10**15):
        number, each = slices.partitions_asked(spark, raw)
        assert each <= slices.MOST_PARTITIONS
        assert number * each >= -(-raw // mart_plan.RAW_BYTES_PER_BUCKET)
        assert (number - 1) * each < max(each, mart_plan.epoch_partitions(spark, raw))


def test_sliced_load_resumes_and_equals_the_whole(spark, raw_folder, tmp_path, monkeypatch):
    root, built = str(tmp_path / "slices"), []
    monkeypatch.setattr(slices, "MOST_PARTITIONS", 4)
    monkeypatch.setattr(slices, "epoch_partitions", lambda *_: 10)
    build = slices.build_epochs

    def counting(annotations, **kw):
        if len(built) == 2 and not os.environ.get("SLICES_GO_ON"):
            raise RuntimeError("lost")
        built.append(kw["partitions"])
        return build(annotations, **kw)

    monkeypatch.setattr(slices, "build_epochs", counting)
    monkeypatch.setattr(mart_plan.RawTables, "epoch_partitions", property(lambda self: 10))
    with pytest.raises(RuntimeError):
        slices.load_slices(spark, raw_folder, root)
    assert built == [4, 4]
    monkeypatch.setenv("SLICES_GO_ON", "1")
    loaded = slices.load_slices(spark, raw_folder, root)
    assert built == [4, 4, 4] and len(loaded.slices) == 3
    whole = mart_plan.load_mart(spark, raw_folder)
    ids = [{r.rec_id for r in m.epochs.select("rec_id").distinct().collect()} for m in loaded.slices]
    assert all(not a & b for k, a in enumerate(ids) for b in ids[:k])
    union = loaded.slices[0].epochs.unionByName(loaded.slices[1].epochs).unionByName(loaded.slices[2].epochs)
    assert union.exceptAll(whole.epochs).isEmpty() and whole.epochs.exceptAll(union).isEmpty()
    assert all(len(m.epochs.inputFiles()) <= 4 for m in loaded.slices)
    assert _rows(loaded.each("nights", lambda m: m.nights)) == _rows(whole.nights)
    # Slices opened again keep the layout: no epoch is shuffled for a window.
    again = slices.load_slices(spark, raw_folder, root)
    plan = _plan(spark, sequences.previous_stages(again.slices[0].epochs))
    assert built == [4, 4, 4] and "Bucketed: true" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "epoch_idx" in x]
    assert _rows(again.each("nights", lambda m: m.nights.limit(0))) == _rows(whole.nights)  # committed results stay
