"""Periodic runs: tiles against a plain version, the planted documents, edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute_llm import words
from pyspark.sql import functions as F

from hypnolith.llm import periodic_runs
from hypnolith.llm.queries import QUERIES
from hypnolith.llm.words import mixed


def runs_of(x, least=12):
    """(start, length, period) of all runs, one period after the other."""
    n, out = len(x), []
    codes = {}
    x = np.array([codes.setdefault(w, len(codes)) for w in x], np.int64)
    for q in range(1, n // 2 + 1):
        equal = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(least, 2 * q):
                run = x[i : j + q]
                if not any(q % p == 0 and (run[:-p] == run[p:]).all() for p in range(1, q)):
                    out.append((i, j - i + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(text):
    w = words(text)
    runs = runs_of(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *best, best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not w:
        return text
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return " ".join(x if i < a else w[a + (i - a) % p] for i, x in enumerate(w))


def _values(row):
    return tuple(row)[1:]


@pytest.mark.parametrize("shape", ["binary", "repeated", "fibonacci", "pieces"])
def test_tiles_find_every_run_once(monkeypatch, shape):
    rng = random.Random(shape)
    for _ in range(60):
        monkeypatch.setattr(periodic_runs, "CORE", rng.choice([8, 16, 64, 8192]))
        monkeypatch.setattr(periodic_runs, "SHARED_OCTAVES", rng.choice([1, 2, 3, 12]))
        least, n = rng.choice([2, 3, 5, 12, 12, 20]), rng.randrange(1, 160)
        if shape == "binary":
            x = [rng.randrange(2) for _ in range(n)]
        elif shape == "repeated":
            base = [rng.randrange(9) for _ in range(rng.randrange(1, 12))]
            x = [rng.randrange(9) for _ in range(rng.randrange(20))] + (base * 160)[:n]
        elif shape == "fibonacci":
            a, x = [0], [0, 1]
            while len(x) < n:
                a, x = x, x + a
            x = x[:n]
        else:
            base, x = [rng.randrange(3) for _ in range(20)], []
            while len(x) < n:
                x += base[: rng.randrange(1, 20)] * rng.randrange(1, 4)
        hashes, found = mixed(np.array(x, np.uint64)), set()
        for core, a, b, low, high in periodic_runs.tiles_of(len(x), least):
            found |= set(periodic_runs.solve_tile(hashes[a:b], core, a, len(x), low, high, least))
        out = []
        for q, s, e in sorted(found):
            if out and out[-1][0] == q and s <= out[-1][2]:
                out[-1] = q, out[-1][1], max(e, out[-1][2])
            else:
                out.append((q, s, e))
        assert sorted((s, e - s + q, q) for q, s, e in out) == sorted(runs_of(x, least))


def test_query_equals_plain_version(spark, raw_folder):
    docs = spark.read.parquet(f"{raw_folder}/documents.parquet").collect()
    found = {r.doc_id: _values(r) for r in QUERIES["op11_periodic_runs"](spark, raw_folder).collect()}
    assert found == {d.doc_id: plain(planted(d.doc_id, d.text)) for d in docs}
    assert sum(v[0] > 0 for v in found.values()) >= 10


def test_fragments_of_many_tiles_are_stitched(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"b{rng.randrange(50)}" for _ in range(900)]
    texts = [
        " ".join((base * 40)[: 30_000]), "x " * 20_000, " ".join(f"u{k}" for k in range(25_000)),
        " ".join([f"u{k}" for k in range(9000)] + ["y"] * 11 + ["z"] * 12 + ["a", "b"] * 6000),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.start, r.length, r.period) for r in periodic_runs.find_runs(docs).collect()}
    assert got == {(0, 0, 30_000, 900), (1, 0, 20_000, 1), (3, 9011, 12, 1), (3, 9023, 12_000, 2)}
    kept = {r.doc_id: r.kept_text.split() for r in periodic_runs.collapse_runs(docs).collect()}
    assert [len(kept[k]) for k in range(4)] == [900, 1, 25_000, 9000 + 11 + 1 + 2]


def test_edge_cases(spark, edge_docs, no_docs):
    found = periodic_runs.report(periodic_runs.collapse_runs(edge_docs)).collect()
    wanted = [(r.doc_id, *plain(r.text)) for r in edge_docs.collect()]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    assert any(r.n_runs for r in found)
    for texts in (True, False):
        assert periodic_runs.report(periodic_runs.collapse_runs(no_docs, texts=texts)).isEmpty()
    assert periodic_runs.find_runs(no_docs).isEmpty() and periodic_runs.with_planted_runs(no_docs).isEmpty()
    wanted = {(r.doc_id, planted(r.doc_id, r.text)) for r in edge_docs.collect()}
    assert {tuple(r) for r in periodic_runs.with_planted_runs(edge_docs).collect()} == wanted


def test_rows_without_or_with_one_id_stay_apart(spark):
    texts = ["a b c " * 5, "k " * 14, "no runs here", None, "a b c " * 5]
    docs = spark.createDataFrame([(i, t) for i in (None, 4) for t in texts], "doc_id long, text string")
    rows = periodic_runs.collapse_runs(docs).collect()
    wanted = ["a b c", "k", "no runs here", "", "a b c"]
    for key in (None, 4):
        assert sorted(r.kept_text for r in rows if r.doc_id == key) == sorted(wanted)
    assert periodic_runs.find_runs(docs).filter(F.col("doc_id").isNull()).count() == 3
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, 1)
