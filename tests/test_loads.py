"""Idempotent loads, stable ids and seeded values."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from hypnolith.functions.keys import lookup_by_salted_key, with_dense_ids
from hypnolith.operators.loads import (
    default_notes,
    ingest_skips,
    require_recordings,
    upsert_patients,
    upsert_recordings,
    with_patient_ids,
)
from hypnolith.operators.seeding import fill_demographics, seed_notes
from hypnolith.schemas import NOTES, PATIENTS, RECORDINGS


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dense_ids_match_one_global_numbering(spark):
    codes = [f"SC{i:04d}" for i in range(3000)]
    rows = spark.createDataFrame([(c,) for c in codes], "code string").repartition(7)
    found = {r.code: r.id for r in with_dense_ids(rows, ["code"], "id", F.lit(10)).collect()}
    order = sorted(codes, key=lambda c: (hashlib.md5(c.encode()).hexdigest()[:4], c))
    assert found == {c: 11 + i for i, c in enumerate(order)}


def test_salted_lookup_is_a_plain_join(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("key"), "id"
    )
    values = rows.groupBy("key").agg(F.min("id").alias("first"))
    salted = lookup_by_salted_key(rows, values, "key", "id")
    plain = rows.join(values, "key")
    assert _rows(salted.select("key", "id", "first")) == _rows(plain.select("key", "id", "first"))


def test_upsert_patients(spark):
    known = spark.createDataFrame([(4, "SC4001", 58, "M", 18)], PATIENTS)
    codes = spark.createDataFrame([("SC4001",), ("SC4002",), ("SC4002",), ("SC4003",)], "patients_code string")
    once = upsert_patients(known, codes)
    rows = {r.patients_code: r for r in once.collect()}
    assert tuple(rows["SC4001"]) == (4, "SC4001", 58, "M", 18)
    assert sorted(r.patients_id for r in rows.values()) == [4, 5, 6]
    assert rows["SC4002"].age is None and rows["SC4002"].sex is None
    assert _rows(upsert_patients(once, codes).fillna(0).fillna("")) == _rows(once.fillna(0).fillna(""))


def test_upsert_into_an_empty_table_starts_at_one(spark):
    empty = spark.createDataFrame([], PATIENTS)
    codes = spark.createDataFrame([("SC4001",)], "patients_code string")
    assert [r.patients_id for r in upsert_patients(empty, codes).collect()] == [1]


def test_upsert_recordings(spark):
    known = spark.createDataFrame([(7, 1, "E0", "old.edf", "h", "1989-04-24", "x")], RECORDINGS)
    columns = "patients_id long, rec_code string, psg_filename string, hyp_filename string, rec_date string, rec_log string"
    incoming = spark.createDataFrame(
        [
            (1, "E0", "SC4001E0-PSG.edf", "h1", "1989-04-25", None),
            (1, "E0", "sc4001e0-PSG.edf", "h2", "1989-04-26", None),
            (1, "E1", "SC4001E1-PSG.edf", "h3", "1989-04-27", "z"),
        ],
        columns,
    )
    once = upsert_recordings(known, incoming)
    rows = {r.rec_code: r for r in once.collect()}
    assert tuple(rows["E0"]) == (7, 1, "E0", "sc4001e0-PSG.edf", "h2", "1989-04-26", None)
    assert tuple(rows["E1"]) == (8, 1, "E1", "SC4001E1-PSG.edf", "h3", "1989-04-27", "z")
    assert _rows(upsert_recordings(once, incoming).fillna("")) == _rows(once.fillna(""))


def test_pairs_get_patient_ids(spark):
    pairs = spark.createDataFrame([("SC4001", "E0")], "patients_code string, rec_code string")
    patients = spark.createDataFrame([(4, "SC4001", None, None, None)], PATIENTS)
    assert [r.asDict() for r in with_patient_ids(pairs, patients).collect()] == [
        {"rec_code": "E0", "patients_id": 4}
    ]


def test_default_notes_never_overwrite(spark):
    notes = spark.createDataFrame([(1, 1, 1, 1, 1, 1)], NOTES)
    recordings = spark.createDataFrame([(1,), (2,)], "rec_id long")
    once = default_notes(notes, recordings)
    assert _rows(once) == [(1, 1, 1, 1, 1, 1), (2, 0, 0, 0, 0, 0)]
    assert _rows(default_notes(once, recordings)) == _rows(once)


def test_ingest_skips(spark):
    recordings = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c")], "rec_id long, hyp_filename string"
    )
    found = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    spans = spark.createDataFrame([(1,), (3,)], "rec_id long")
    assert _rows(ingest_skips(recordings, found, spans)) == [
        (2, "b", "no stage span"),
        (3, "c", "missing hypnogram"),
    ]


def test_no_recordings_is_an_error(spark):
    with pytest.raises(ValueError):
        require_recordings(spark.createDataFrame([], RECORDINGS))
    one = spark.createDataFrame([(7, 1, "E0", "p", "h", "d", "l")], RECORDINGS)
    assert require_recordings(one) is one


def test_demographics_fill_only_gaps(spark):
    patients = spark.range(2000).selectExpr(
        "id AS patients_id",
        "concat('P', id) AS patients_code",
        "IF(id % 2 = 0, 33, CAST(NULL AS INT)) AS age",
        "IF(id % 3 = 0, 'O', NULL) AS sex",
        "CAST(NULL AS INT) AS bmi",
    )
    filled = fill_demographics(patients)
    for r in filled.collect():
        assert r.age == 33 if r.patients_id % 2 == 0 else 18 <= r.age <= 80
        assert r.sex == "O" if r.patients_id % 3 == 0 else r.sex in ("M", "F")
        assert 18 <= r.bmi <= 34
    assert _rows(fill_demographics(patients.repartition(9))) == _rows(filled)
    assert _rows(fill_demographics(patients, seed=1)) != _rows(filled)


def test_note_rates(spark):
    recordings = spark.range(20000).select(F.col("id").alias("rec_id"))
    notes = seed_notes(recordings)
    rates = notes.selectExpr(
        "avg(had_coffee)", "avg(had_alcohol)", "avg(has_pain)", "avg(sleep_deprived)",
        "avg(IF(sleep_deprived = 0 AND has_pain = 0, stress, NULL))",
        "avg(IF(sleep_deprived = 1 AND has_pain = 0, stress, NULL))",
        "avg(IF(sleep_deprived = 1 AND has_pain = 1, stress, NULL))",
    ).first()
    for rate, expected in zip(rates, (0.35, 0.20, 0.15, 0.25, 0.20, 0.40, 0.50)):
        assert abs(rate - expected) < 0.03
    assert _rows(seed_notes(recordings.repartition(3))) == _rows(notes)
