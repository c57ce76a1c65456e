"""Every registered query against its SQL equivalent in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.QUERIES
ORACLES = entry_points.ORACLES


@pytest.fixture(scope="module")
def duck(raw_folder):
    connection = duckdb.connect()
    for name in ("events", "customer"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{raw_folder}/{name}.parquet'")
    return connection


def _normal(rows):
    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v
        return float(v) if isinstance(v, int) else v

    return sorted(repr([value(v) for v in row]) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, raw_folder, name):
    df = QUERIES[name](spark, raw_folder)
    relation = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    assert {f.name: types[f.dataType.simpleString()] for f in df.schema.fields} == {
        c: str(t) for c, t in zip(relation.columns, relation.types)
    }
    found = [tuple(r) for r in df.select(*columns).collect()]
    expected = relation.select(*[f'"{c}"' for c in columns]).fetchall()
    assert _normal(found) == _normal(expected)


def test_dashboards_agree_with_each_other(spark, raw_folder):
    nights = QUERIES["v_sleep_summary"](spark, raw_folder)
    minutes = QUERIES["bi_stage_minutes"](spark, raw_folder)
    total = minutes.groupBy("rec_id").agg({"minutes": "sum"}).toDF("rec_id", "total")
    assert nights.join(total, "rec_id").filter("abs(total - in_bed_window_min) > 1e-9").isEmpty()
    first, second = (
        QUERIES[name](spark, raw_folder) for name in ("longest_bouts", "longest_bouts_window")
    )
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 30 and df.count() == 75
