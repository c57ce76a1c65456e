"""Stored tables: layout, reload, exports, and the plans they allow."""

from __future__ import annotations

import re
import shutil

import pytest
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK
from hypnolith.operators.nights import in_bed_window_minimal, night_counts, sleep_bounds
from hypnolith.operators.sequences import longest_bouts, previous_stages
from hypnolith.plans.mart import load_mart
from hypnolith.schemas import EPOCHS, TABLES
from hypnolith.session import working_folder
from hypnolith.sources import storage


def _epochs(spark, labels_of):
    rows = [
        (rec, i, 30 * i, 30, label)
        for rec, labels in labels_of.items()
        for i, label in enumerate(labels)
    ]
    return spark.createDataFrame(rows, EPOCHS)


def _plan(spark, df):
    """Physical plan as for large inputs: no broadcast, no runtime changes."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        text = df._jdf.sparkSession().sessionState().executePlan(
            df._jdf.queryExecution().logical(),
            df._jdf.queryExecution().mode(),
        ).executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    labels = {rec: ["W", "N1", "N1", "W", "N3", "REM", "W"] * 5 for rec in range(20)}
    path = str(tmp_path_factory.mktemp("epochs") / "table")
    return storage.write_epochs(_epochs(spark, labels), path, buckets=4)


def test_one_sorted_file_per_bucket(spark, stored):
    files = stored.inputFiles()
    assert 1 < len(files) <= 4
    for name in files:
        rows = spark.read.parquet(name).select("rec_id", BLOCK, "epoch_idx").collect()
        assert rows == sorted(rows)
    assert stored.count() == 20 * 35


@pytest.mark.parametrize("operator", ["bouts", "previous"])
def test_sequences_neither_shuffle_nor_sort_stored_epochs(spark, stored, operator):
    codes = spark.createDataFrame([(0, "A")], "rec_id long, patients_code string")
    df = longest_bouts(stored, codes) if operator == "bouts" else previous_stages(stored)
    plan = _plan(spark, df)
    assert "Bucketed: true" in plan
    assert "Window" in plan
    assert not re.search(r"Sort \[[^\]]*epoch_idx", plan)
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "epoch_idx" not in line


def test_counts_join_in_place(spark, stored):
    plan = _plan(spark, night_counts(stored))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # bounds by recording, bounds by block, counts by recording: all small
    assert plan.count("Exchange hashpartitioning") == 3


def test_label_filter_and_columns_reach_the_scan(spark, stored):
    plan = _plan(spark, sleep_bounds(stored))
    assert "In(stage_label, [N1,N2,N3,REM])" in plan
    assert "ReadSchema: struct<rec_id:bigint,epoch_idx:bigint,stage_label:string>" in plan


def test_stored_blocks_of_another_length_are_not_trusted(spark, tmp_path):
    labels = {rec: ["W"] * 3 + ["N1", "W", "REM"] * 4 + ["W"] for rec in range(3)}
    plain = _epochs(spark, labels)
    short = storage.write_epochs(plain, str(tmp_path / "short"), buckets=2, block_epochs=4)
    assert short.schema[BLOCK].metadata == {"block_epochs": 4}
    for block in (4, 5, 1 << 18):
        expected = sorted(night_counts(plain, block).collect())
        assert sorted(night_counts(short, block).collect()) == expected
        assert {r.window_epochs for r in expected} == {12}


def test_window_rows_keep_the_table_schema(stored):
    assert in_bed_window_minimal(stored).columns == EPOCHS.fieldNames()


def test_reload_replaces_whole_recordings(spark, tmp_path):
    path = str(tmp_path / "epochs")
    storage.write_replaceable_epochs(_epochs(spark, {1: ["W"] * 5, 2: ["N1"] * 3, 3: ["N2"]}), path, 4)
    incoming = _epochs(spark, {2: ["REM"] * 2, 9: ["N3"]})
    for _ in range(2):
        storage.reload_epochs(spark, path, incoming, 4)
        rows = storage.read_replaceable_epochs(spark, path)
        found = {
            r.rec_id: (r.n, r.label)
            for r in rows.groupBy("rec_id")
            .agg(F.count("epoch_idx"), F.max("stage_label"))
            .toDF("rec_id", "n", "label")
            .collect()
        }
        assert found == {1: (5, "W"), 2: (2, "REM"), 3: (1, "N2"), 9: (1, "N3")}


def test_a_long_recording_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "epochs")
    rows = _epochs(spark, {1: ["W"] * 64})
    storage.write_replaceable_epochs(rows, path, rec_buckets=1, block_epochs=2)
    files = list((tmp_path / "epochs").glob("rec_bucket=0/*.parquet"))
    assert 1 < len(files) <= 4
    assert storage.read_replaceable_epochs(spark, path).count() == 64


def test_reload_reads_only_the_buckets_it_rewrites(spark, tmp_path):
    path = str(tmp_path / "epochs")
    storage.write_replaceable_epochs(_epochs(spark, {rec: ["W"] for rec in range(40)}), path, 8)
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "epochs").glob("rec_bucket=*/*.parquet")}
    storage.reload_epochs(spark, path, _epochs(spark, {3: ["N1"]}), 8)
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "epochs").glob("rec_bucket=*/*.parquet")}
    assert len(set(before) - set(after)) == 1
    assert storage.read_replaceable_epochs(spark, path).count() == 40


def test_csv_round_trip(spark, tmp_path):
    schema = "rec_id long, patients_code string, minutes double, qc_reason string"
    rows = spark.createDataFrame(
        [(1, "SC4001", 34.0, "fail: TST < 6h"), (2, 'Ü,"x"', None, None)], schema
    )
    path = str(tmp_path / "export")
    storage.export_csv(rows, path)
    back = storage.read_csv(spark, path, schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_quoted_and_bare_fields_read_alike(spark, tmp_path):
    (tmp_path / "bare.csv").write_text("rec_id,rec_date,minutes\n1,1989-04-24,34.0\n")
    (tmp_path / "quoted.csv").write_text('"rec_id","rec_date","minutes"\n1,"1989-04-24",34.0\n')
    schema = "rec_id long, rec_date string, minutes double"
    found = {tuple(r) for r in storage.read_csv(spark, str(tmp_path), schema).collect()}
    assert found == {(1, "1989-04-24", 34.0)}


def test_working_folder_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = working_folder(spark, "x"), working_folder(spark, "x")
    assert first.startswith(shared) and first != second


def test_mart_is_loaded_once_and_again_after_a_change(spark, raw_folder, tmp_path):
    for name in ("events", "customer"):
        shutil.copy(f"{raw_folder}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = load_mart(spark, str(tmp_path))
    assert load_mart(spark, str(tmp_path)) is first
    half = spark.read.parquet(f"{raw_folder}/events.parquet").filter("user_id < 5").toPandas()
    (tmp_path / "events.parquet").unlink()
    half.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    second = load_mart(spark, str(tmp_path))
    assert second is not first
    assert 0 < second.recordings.count() < first.recordings.count()


def test_mart_tables_have_the_declared_columns(spark, raw_folder):
    for name, table in load_mart(spark, raw_folder).tables.items():
        declared = {f.name: f.dataType for f in TABLES[name].fields}
        stored = {f.name: f.dataType for f in table.schema.fields if f.name != BLOCK}
        assert stored == declared


def test_layout_counts_faults(spark, tmp_path):
    rows = [(r, k, k * 30, 30, "W") for r in range(20) for k in range(6)]
    stored = storage.write_epochs(spark.createDataFrame(rows, EPOCHS), str(tmp_path / "good"), buckets=4)
    good = storage.layout(stored, 4)
    assert good.filter("missing <> 0 OR misplaced <> 0 OR n_epochs <> 6").isEmpty() and good.count() == 20
    assert not storage.layout(stored, 3).filter("misplaced > 0").isEmpty()
    bad = [(1, 0, 0, 30, "W"), (1, 2, 60, 30, "W"), (2, 0, 30, 30, "W")]
    found = storage.layout(storage.write_epochs(spark.createDataFrame(bad, EPOCHS), str(tmp_path / "bad"), buckets=4), 4)
    assert {r.rec_id: (r.missing, r.misplaced) for r in found.collect()} == {1: (1, 0), 2: (0, 1)}
