from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

#: Columns whose names operators use inside, to clash with theirs.
EXTRA = "key string, size int, component int, removed string, _key string, tokens int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd white space."""
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(400)] + ["the", "of", "Ünï", "é"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, long_ = prose(120), prose(60_000)
    near = base.split()
    near[60] = "changed"
    texts = [
        None, "", "   \n\t ", "one", "a b c d", base, base, " ".join(near), base.upper(), long_,
        long_ + " tail", prose(55) + "\n" + base + "\n" + prose(20), "x " * 300, "\n".join([prose(12)] * 4),
        "All Rights\x0bReserved\r\nLicensed under CC BY-NC 4.0.\nCC\nBY", "a\x00b \x1f \x85 \xa0 c d e f g h i j k",
        "tab\tseparated  double   spaces\n\nlines " + prose(15),
    ]
    rows = [(k, t, "en", rng.choice(["s1", "s2", None])) for k, t in enumerate(texts)]
    rows += [(5, base, "en", "s1"), (None, base, None, None), (None, None, None, None)]
    rows = [(*r, "k", 1, 2, "r", None, 3) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + EXTRA)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def crafted():
    """(doc_id, text) with exact and near copies, shared passages and edited lines."""
    rng = random.Random(11)
    vocabulary = ["v%d" % k for k in range(900)] + ["the", "of", "and"] * 40
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, docs = prose(80), []
    bases = [prose(rng.randrange(20, 300)) for _ in range(12)]
    for k in range(150):
        kind = k % 6
        words = list(rng.choice(bases)) if kind < 3 else prose(rng.randrange(1, 200))
        if kind == 1:
            for _ in range(rng.randrange(1, 8)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if kind == 2 and len(words) > 30:
            del words[5 : 5 + rng.randrange(1, 6)]
        if kind == 4:
            at = rng.randrange(len(words))
            words[at:at] = passage[: rng.randrange(45, 81)]
        if kind == 5:
            words = (words[:7] + ["same"] * 70)[:90]
        lines = [" ".join(words[i : i + 14]) for i in range(0, len(words), 14)]
        docs.append((k, "\n".join(lines)))
    rng.shuffle(docs)
    return docs


@pytest.fixture(scope="session")
def crafted_docs(spark, crafted):
    rows = [(d, t, "en", f"s{d % 4}", len(t)) for d, t in crafted]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
