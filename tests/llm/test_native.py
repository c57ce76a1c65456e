"""Quality rules, license scans, URL filters and mixing: edge cases and plain versions."""

from __future__ import annotations

import datetime
import random
import re

import duckdb
import pytest
from brute_llm import lower, words

from hypnolith.llm import license_scan, mixing, quality_rules, url_filters
from hypnolith.llm.queries import ORACLES, QUERIES

DAY = datetime.date


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, raw_folder, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{raw_folder}/{table}.parquet'")
    found = QUERIES[name](spark, raw_folder)
    columns = sorted(found.columns)
    wanted = duck.sql(ORACLES[name]).select(*columns).fetchall()
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("name", ["op1_url_filters", "op2_quality_rules", "op5_license_scan", "op6_mixing"])
def test_native_plans_have_no_python(spark, raw_folder, name):
    plan = QUERIES[name](spark, raw_folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def _rules_plain(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    at = {}
    for k in range(len(w) - 4):
        at.setdefault(tuple(w[k : k + 5]), []).append(k)
    covered = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def test_quality_measures(edge_docs, no_docs, crafted, crafted_docs):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = {r.doc_id: tuple(r[c] for c in columns) for r in quality_rules.judged(crafted_docs).collect()}
    assert found == {d: _rules_plain(t) for d, t in crafted}
    edge = quality_rules.judged(edge_docs).collect()
    texts = {r.doc_id: r.text for r in edge_docs.collect() if r.doc_id is not None}
    for row in edge:
        if row.doc_id is not None:
            assert tuple(row[c] for c in columns) == _rules_plain(texts[row.doc_id])
        assert not (row.kept and row.base_failed)
    assert len(edge) == edge_docs.count()
    assert quality_rules.judged(no_docs).isEmpty()


def test_quality_verdict_filters_rows(edge_docs):
    kept = quality_rules.passing(edge_docs)
    assert kept.schema == edge_docs.schema
    rows = kept.collect()
    assert len(rows) == quality_rules.judged(edge_docs).filter("kept").count()
    assert all(len(words(r.text)) >= 10 for r in rows)


def test_rule_on_missing_ratio_breaks_nothing(spark):
    rule = quality_rules.Rule("any", "mean_word_chars", least=1.0)
    row = quality_rules.judged(spark.createDataFrame([(1, "")], "doc_id long, text string"), (rule,)).first()
    assert row.broken == [] and row.base_failed and not row.kept


def test_license_places(edge_docs, no_docs):
    rows = {r.doc_id: r for r in license_scan.scan(edge_docs).collect() if r.doc_id is not None}
    odd = rows[14]
    assert (odd.n_base, odd.first_word, odd.last_word) == (3, 0, 10)
    assert odd.base_labels == "cc-by,reserved" and "cc-by-nc" in odd.labels.split(",") and odd.score == 1.0
    assert (rows[0].n_words, rows[0].n_base, rows[0].first_word, rows[0].labels) == (0, 0, None, "")
    assert license_scan.scan(edge_docs).count() == edge_docs.count()
    assert license_scan.scan(no_docs).isEmpty()


def test_license_join_finds_every_pair(spark):
    templates = (("x", "alpha beta gamma delta epsilon"), ("y", "alpha beta"), ("z", "omega"))
    lines = ["alpha beta gamma delta", "beta alpha", "epsilon gamma delta alpha", "omega omega", "none", "gamma delta"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {(r.doc_id, label) for r in license_scan.scan(docs, templates).collect() for label in r.labels.split(",") if label}
    wanted = set()
    for k, line in enumerate(lines):
        for label, text in templates:
            t = set(text.split())
            if len(t & set(line.split())) >= 0.8 * len(t):
                wanted.add((k, label))
    assert found == wanted


MIT = "Permission is hereby granted, free of charge,\n * to any person obtaining a copy\n# of this software and associated\n documentation files"
BSD = "Redistribution and use in source and binary\r\nforms, with or without modification,\n\n are permitted"


def test_license_blocks_cross_lines_but_do_not_scatter(spark):
    filler = " ".join(f"w{k}" for k in range(3000))
    texts = [
        MIT,
        "x " * 250 + BSD,  # over the end of a stretch
        f" {filler} ".join(["released", "under", "the", "license"]),
        "released under the quite new MIT license",  # two words put in, of which a block has room for one
        "released under the new MIT license",
        "license " * 5000 + "released under mit",
    ]
    rows = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[k].labels for k in range(len(texts))] == ["mit", "bsd", "", "mit", "mit", "mit"]
    assert [rows[k].score for k in range(len(texts))] == [1.0, 1.0, 0.0, 0.8, 1.0, 0.8]


def test_license_blocks_equal_plain_version(spark):
    draw = random.Random(5)
    templates = (("x", "alpha beta gamma delta epsilon alpha"), ("y", "beta gamma"), ("z", "omega alpha omega beta zeta eta theta iota kappa"))
    known = "alpha beta gamma delta epsilon omega zeta eta theta iota kappa".split()
    texts = [
        "".join(draw.choice(known + ["other", "word"] * draw.choice([0, 3, 9])) + draw.choice([" ", "\n", ", "]) for _ in range(n))
        for n in (1, 3, 8, 20, 40, 255, 256, 257, 300, 700) * 3
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {}
    for k, text in enumerate(texts):
        found = re.findall("[a-z]+", text)
        for label, template in templates:
            t = set(template.split())
            width = int(len(template.split()) / 0.8)
            best = max(len(t & set(found[i : i + width])) / len(t) for i in range(len(found)))
            if best >= 0.8:
                wanted.setdefault(k, {})[label] = best
    for row in license_scan.scan(docs, templates).collect():
        got = wanted.get(row.doc_id, {})
        assert (set(row.labels.split(",")) - {""}, row.score) == (set(got), max(got.values(), default=0.0))


def test_license_phrases_are_counted_like_plain_text(edge_docs):
    for row in license_scan.scan(edge_docs.filter("text IS NOT NULL AND doc_id IS NOT NULL")).collect():
        texts = [r.text for r in edge_docs.filter(f"doc_id = {row.doc_id}").collect()]
        tokens = [t for t in re.split(license_scan.SEPARATORS, lower(texts[0])) if t]
        places = [
            k for p in license_scan.PHRASES.values() for k in range(len(tokens)) if tuple(tokens[k : k + len(p)]) == p
        ]
        assert (row.n_words, row.n_base) == (len(tokens), len(places))


def test_entries_become_intervals(spark):
    entries = [
        ("a.com", "block", DAY(2024, 1, 5)), ("A.com", "clear", DAY(2024, 1, 9)), ("a.com", "allow", DAY(2024, 1, 5)),
        ("b.a.com", "allow", DAY(2024, 1, 6)), (None, "block", DAY(2024, 1, 1)), ("c.com", "block", None),
        ("d.com", "odd", DAY(2024, 1, 1)),
    ]
    captures = [
        (1, "http://a.com/x", DAY(2024, 1, 4)), (2, "HTTP://User:p@WWW.A.com:80/", DAY(2024, 1, 5)),
        (3, "http://b.a.com?q", DAY(2024, 1, 6)), (4, "http://a.com", DAY(2024, 1, 9)), (5, None, DAY(2024, 1, 6)),
        (6, "no url", DAY(2024, 1, 6)), (7, "http://a.com", None), (2, "HTTP://User:p@WWW.A.com:80/", DAY(2024, 1, 5)),
        (8, "http://xa.com", DAY(2024, 1, 6)), (9, "http://c.com", DAY(2024, 1, 6)), (None, "http://a.com.", DAY(2024, 1, 8)),
    ]
    entries = spark.createDataFrame(entries, "pattern string, verdict string, dated date")
    captures = spark.createDataFrame([(*c, "v") for c in captures], "page_id long, url string, fetched date, verdict string")
    rows = url_filters.filter_urls(captures, entries).collect()
    got = {(r.page_id, r.host, r.verdict, r.kept) for r in rows}
    assert (2, "www.a.com", "block", False) in got and (3, "b.a.com", "allow", True) in got
    assert (None, "a.com", "block", False) in got and (4, "a.com", None, True) in got and (8, "xa.com", None, True) in got
    assert len(rows) == 11 and sum(not r.kept for r in rows) == 3
    assert url_filters.filter_urls(captures.limit(0), entries).isEmpty()
    assert url_filters.filter_urls(captures, entries.limit(0)).filter("NOT kept").isEmpty()


def _water(sizes, weights, epochs=3):
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        rest = total - sum(target[k] for k in range(len(sizes)) if k not in open_)
        share = {k: rest * weights[k] / sum(weights[j] for j in open_) for k in open_}
        over = {k for k in open_ if share[k] > epochs * sizes[k]}
        if not over:
            return [share.get(k, target[k]) for k in range(len(sizes))]
        for k in over:
            target[k] = float(epochs * sizes[k])
        open_ -= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 0, 100, 5], [7], [1, 1, 1, 1000], [50, 2, 9, 1, 30]])
def test_targets_equal_rounds_of_resharing(spark, sizes):
    rows = [(f"s{k}", n, 1 + k % 3) for k, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "source string, source_size long, weight long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    wanted = _water(sizes, [1 + k % 3 for k in range(len(sizes))])
    assert [found[f"s{k}"] for k in range(len(sizes))] == pytest.approx(wanted)


def test_mix_meets_targets(crafted_docs, edge_docs, no_docs, monkeypatch):
    docs = crafted_docs.unionByName(crafted_docs.withColumn("doc_id", crafted_docs.doc_id + 1000))
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0 for r in own)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    salted = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.taken) for r in salted) == sorted((r.doc_id, r.taken) for r in rows)
    taken = mixing.mixed_documents(docs)
    assert taken.columns == docs.columns
    assert sum(len(words(r.text)) for r in taken.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(edge_docs).count() == edge_docs.count()
    copies = mixing.mixed_documents(edge_docs)
    assert copies.schema == edge_docs.schema and copies.subtract(edge_docs).isEmpty()
    assert mixing.mix(no_docs).isEmpty() and mixing.mixed_documents(no_docs).isEmpty()


@pytest.mark.parametrize("ids", ["null", "one", "copies"])
def test_mix_meets_targets_without_telling_ids(spark, ids):
    """Rows without id, with one id, and equal rows: every source comes within half a document of its target."""
    rows = []
    for k in range(240):
        words_ = 10 if ids == "copies" else 5 + k % 11
        text = "same text " * 5 if ids == "copies" and k % 2 else " ".join(f"w{k}" for _ in range(words_))
        source = None if k < 20 else f"s{sum(k >= edge for edge in (60, 120, 150))}"
        rows.append((7 if ids == "one" else None, text, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs).groupBy("target", "source_size").agg({"taken": "sum", "size": "max"}).collect()
    assert len(found) == 5
    for r in found:
        assert abs(r["sum(taken)"] - r.target) <= r["max(size)"] / 2 + 1e-6
    again = sorted(map(tuple, mixing.mix(docs.repartition(2)).collect()), key=repr)
    assert again == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert sum(len(words(r.text)) for r in copies.collect()) == sum(r["sum(taken)"] for r in found)
    duck = duckdb.connect()
    duck.register("documents", docs.toPandas())
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    wanted = duck.sql(mixing.ORACLE).select(*columns).fetchall()
    number = lambda v: None if v is None or v != v else float(v)
    assert sorted(repr([number(v) for v in r]) for r in again) == sorted(repr([number(v) for v in r]) for r in wanted)
