"""The pipeline against its stages' plain versions, and on odd input."""

from __future__ import annotations

import zlib

import brute_llm
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from hypnolith.llm import quality_rules, signature_trees
from hypnolith.llm.queries import QUERIES, vocabulary
from hypnolith.llm.tables import read_table, stored


def test_one_query_per_operator():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.fixture(scope="module")
def stages(spark, raw_folder):
    frames = [read_table(spark, raw_folder, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], raw_folder), name))
    return frames


def test_stages_keep_columns_and_take_effect(spark, raw_folder, stages):
    docs, good, single, clean, mixed, tokens = stages
    assert all(f.columns == docs.columns for f in stages[:-1])
    verdict = quality_rules.judged(docs).filter("kept").select("doc_id")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in verdict.collect()}
    pairs = [(r.doc_id, r.text) for r in good.collect()]
    least = {c for _, c in brute_llm.jaccard_components(pairs).values()}
    assert {r.doc_id for r in single.collect()} == least
    items = [" ".join(brute_llm.words(brute_llm.lower(r.text))) for r in read_table(spark, raw_folder, "benchmark").collect()]
    left = {r.doc_id for r in clean.collect()}
    for r in single.collect():
        text = " ".join(brute_llm.words(brute_llm.lower(r.text)))
        assert not (any(item in text for item in items) and r.doc_id in left)
    assert left < {r.doc_id for r in single.collect()}
    assert {r.doc_id for r in mixed.collect()} <= left


def test_tokens_are_those_of_the_mix(stages):
    from tokenizers import Tokenizer

    mixed, tokens = stages[-2:]
    tokenizer = Tokenizer.from_file(vocabulary())
    source = sorted((r.doc_id, r.text) for r in mixed.collect())
    start, wanted = 0, []
    for doc_id, text in source:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokens.collect())) == sorted(wanted)


def test_run_equals_stages(spark, raw_folder, stages):
    rows = corpus_pipeline.run(spark, raw_folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[-1].collect()))


def test_stages_on_odd_and_no_documents(spark, raw_folder, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, raw_folder), "edge")
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert docs.isEmpty()


def test_jaccard_query_on_given_documents(spark, raw_folder):
    docs = [(r.doc_id, r.text) for r in read_table(spark, raw_folder, "documents").collect()]
    rows = signature_trees.jaccard_components(read_table(spark, raw_folder, "documents")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_llm.jaccard_components(docs)


@pytest.mark.parametrize("name", ["op3_substring_dedup", "op7_line_dedup", "op8_class_lm", "op9_token_files"])
def test_queries_cover_every_document(spark, raw_folder, name):
    assert QUERIES[name](spark, raw_folder).count() == read_table(spark, raw_folder, "documents").count()
