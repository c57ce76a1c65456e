"""Alignment of two tokenizers against a plain version; corpus-wide pair counts; edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hypnolith.llm import token_alignment
from hypnolith.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def paths():
    return vocabulary(), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain(paths):
    """Results for a list of texts, one token after the other, with the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    alphabet = token_alignment._byte_of_char()
    names = {i: t for t, i in a.get_vocab().items()}

    def tokens(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
        parts_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            parts_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        raw = (" " + text).encode()
        return (ids_a, ids_b, parts_a, parts_b) if b"".join(parts_a) == raw == b"".join(parts_b) else None

    def run(texts):
        links, first = [], []
        for text in texts:
            found = tokens(text)
            if found is None:
                links.append([])
                first.append((0, 0, 0, 0, ""))
                continue
            ids_a, ids_b, parts_a, parts_b = found
            ends_a, ends_b = (np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b))
            groups, own, i, j = [], [], 0, 0
            for cut in sorted(set(ends_a) & set(ends_b)):
                m, n = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
                groups.append(",".join(map(str, ids_a[i:m])) + "|" + ",".join(map(str, ids_b[j:n])))
                for x in range(i, m):
                    for y in range(j, n):
                        if max(ends_a[x] - len(parts_a[x]), ends_b[y] - len(parts_b[y])) < min(ends_a[x], ends_b[y]):
                            own.append((ids_a[x], ids_b[y]))
                i, j = m, n
            links.append(own)
            first.append((len(ids_a), len(ids_b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held = Counter(p for own in links for p in set(own))
        most: dict = {}
        for (i, _), n in held.items():
            most[i] = max(n, most.get(i, 0))
        return [
            (*f[:4], sum(held[p] == most[p[0]] for p in own), sum(held[p] for p in own), f[4])
            for f, own in zip(first, links)
        ]

    return run


ODD = [
    None, "", "a", "<|endoftext|> hi <s> </s> <unk> <|im_end|>", "\x00a b", "  two  spaces\n\n", "日本語テキスト mixed",
    "é́ ﬁ ½ Å", "▁x ▁", "　wide", "퟿ \U0001f600 smile", "<0x41>A", "tab\tend ", "  line\x85next\xa0",
]


def test_query_equals_plain_version(spark, raw_folder, plain):
    docs = spark.read.parquet(f"{raw_folder}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_token_alignment"](spark, raw_folder).collect()}
    assert found == dict(zip((d.doc_id for d in docs), plain([d.text for d in docs])))


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 1 << 22])
def test_odd_texts_and_chunks(spark, paths, plain, chunk_bytes):
    texts = ODD * 2 + ["lorem ipsum dolor " * 200, "一二三四五六七八九十" * 300]
    docs = spark.createDataFrame([(k % 20 if k % 7 else None, t, "p", 1) for k, t in enumerate(texts)],
                                 "doc_id long, text string, pair string, count int").repartition(3)
    found = sorted(tuple(r)[1:] for r in token_alignment.align(docs, *paths, chunk_bytes=chunk_bytes).collect())
    assert found == sorted(plain(texts))
    assert sum(r[0] > 0 for r in found) >= 20


def test_edges(spark, paths, edge_docs, no_docs, plain):
    rows = edge_docs.collect()
    found = sorted(map(repr, map(tuple, token_alignment.align(edge_docs, *paths).collect())))
    assert found == sorted(repr((r.doc_id, *p)) for r, p in zip(rows, plain([r.text for r in rows])))
    assert token_alignment.align(no_docs, *paths).isEmpty()


def test_shared_cuts_are_the_common_ends():
    rng = random.Random(9)
    for _ in range(300):
        ends, first, last, wanted, begin = [[], []], [], [], [], 0
        for _ in range(rng.randrange(1, 6)):
            size, rate = rng.randrange(1, 90), rng.choice([0.1, 0.5, 0.95])
            own = [sorted({begin + k + 1 for k in range(size) if rng.random() < rate} | {begin + size}) for _ in range(2)]
            first.append(len(ends[0]))
            for all_, part in zip(ends, own):
                all_ += part
            last.append(len(ends[0]) - 1)
            wanted += sorted(set(own[0]) & set(own[1]))[:-1]
            begin += size
        a, b = (np.array(e) for e in ends)
        cuts = token_alignment.shared_cuts(a, b, np.array(first), np.array(last))
        assert a[cuts].tolist() == wanted


def test_counts_cover_the_corpus(spark, paths):
    """A pair is counted once per document, over all chunks."""
    docs = spark.createDataFrame([(k, "same words here " * (1 + k % 3)) for k in range(60)], "doc_id long, text string")
    rows = token_alignment.align(docs.repartition(4), *paths, chunk_bytes=100).collect()
    assert {r.count_sum for r in rows if r.n_a} == {60 * r.n_links for r in rows} and all(r.n_best == r.n_links for r in rows)
