"""Operators on words, lines, shingles and tokens against plain versions, and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import brute_llm
import numpy as np
import pyarrow as pa
import pytest
from brute_llm import lower, words
from pyspark.sql import functions as F

from hypnolith.llm import class_lm, decontamination, line_dedup, signature_trees, substring_dedup, token_files
from hypnolith.llm.components import components
from hypnolith.llm.queries import vocabulary
from hypnolith.llm.tables import LAST_ID
from hypnolith.llm.words import NOT_ALNUM, PRIME, ModularSums, mixed, product, run_hashes, steps, whole_hashes


def test_words_are_runs_of_other_bytes(edge_docs):
    texts = [r.text for r in edge_docs.collect()]
    seen = []
    for row, end, found in steps(pa.array(texts, pa.string()), lower=True):
        raw = found.data.tobytes()
        for k in range(row, end):
            a, b = found.first[k - row], found.first[k - row + 1]
            seen.append([raw[x:y].decode() for x, y in zip(found.starts[a:b], found.ends[a:b])])
    assert seen == [words(lower(t)) for t in texts]


def test_hash_does_not_depend_on_place():
    one = [w for _, _, w in steps(pa.array(["a bc def", "x bc"]))][0].hashes()
    two = [w for _, _, w in steps(pa.array(["", None, "zz   bc\tdef a"]))][0].hashes()
    assert one[1] == one[4] == two[1] and one[2] == two[2] and one[0] == two[3] and len(set(one.tolist())) == 4
    assert run_hashes(one[1:3], 2)[0] == run_hashes(two[1:3], 2)[0]


def _thue_morse(size: int, zero: str, one: str) -> list[str]:
    return [one if bin(k).count("1") % 2 else zero for k in range(size)]


def test_patterns_do_not_cancel_in_hashes():
    """Words and texts in Thue-Morse order, which any polynomial modulo 2^64 maps to one value."""
    for size in (1024, 4096):
        one, two = _thue_morse(size, "alpha", "beta"), _thue_morse(size, "beta", "alpha")
        lines = ["".join(_thue_morse(size, "a", "b")), "".join(_thue_morse(size, "b", "a")), " ".join(one), " ".join(two)]
        (_, _, found), = steps(pa.array(lines))
        for which in (0, 1):
            hashes = found.hashes(which)
            assert len(set(hashes.tolist())) == 4 and len(set(whole_hashes(hashes, found.first).tolist())) == 4
            sums = ModularSums(hashes, which)
            assert len(set(sums.digest(found.first[:-1], found.counts).tolist())) == 4


def test_range_digests_do_not_depend_on_place():
    rng = random.Random(12)
    line = [rng.choice("abcdef") for _ in range(40)]
    (_, _, one), = steps(pa.array(["x y z", " ".join(line)]))
    (_, _, two), = steps(pa.array([" ".join(["q"] * 500 + line)]))
    for which in (0, 1):
        a, b = (ModularSums(w.hashes(which), which) for w in (one, two))
        size = np.arange(1, 41)
        assert (a.digest(np.full(40, 3), size) == b.digest(np.full(40, 500), size)).all()
        at = np.arange(40)
        (_, _, cut), = steps(pa.array([" ".join(line[:k] + line[k + 1 :]) for k in at]))
        whole = ModularSums(cut.hashes(which), which).digest(cut.first[:-1], cut.counts)
        assert (a.without(np.full(40, 3), np.full(40, 40), at) == whole).all()
    terms = [(rng.getrandbits(61) % PRIME, rng.getrandbits(61) % PRIME) for _ in range(500)] + [(PRIME - 1, PRIME - 1)]
    a, b = np.array(terms, np.uint64).T
    assert product(a, b).tolist() == [x * y % PRIME for x, y in terms]


def test_swapped_patterns_are_different_texts(spark):
    one, two = _thue_morse(4096, "alpha", "beta"), _thue_morse(4096, "beta", "alpha")
    letters = ["".join(_thue_morse(4096, *pair)) for pair in ("ab", "ba")]
    docs = spark.createDataFrame(
        [(1, " ".join(one)), (2, " ".join(two)), (3, letters[0]), (4, letters[1])], "doc_id long, text string"
    )
    lines = {r.doc_id: (r.n_equal, r.n_near) for r in line_dedup.repeated_lines(docs).collect()}
    assert set(lines.values()) == {(0, 0)}
    groups = {r.doc_id: r.component_id for r in signature_trees.jaccard_components(docs.filter("doc_id > 2")).collect()}
    assert groups == {3: 3, 4: 4}
    texts = [(d, " ".join(one if d == 1 else two)) for d in (1, 2)]
    cut = substring_dedup.remove_repeats(docs.filter("doc_id < 3")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in cut} == brute_llm.remove_repeats(texts)
    scores = {r.doc_id: r.n_known for r in class_lm.score_documents(docs.filter("doc_id > 2")).collect()}
    assert sum(scores.values()) == sum(v[2] for v in brute_llm.base_scores([(3, letters[0]), (4, letters[1])]).values())


# --- substring dedup ----------------------------------------------------------------


@pytest.mark.parametrize("window", [50, 7])
def test_repeats_equal_plain_version(crafted, crafted_docs, window):
    rows = substring_dedup.remove_repeats(crafted_docs, window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute_llm.remove_repeats(crafted, window)


def test_repeats_edges(spark, edge_docs, no_docs):
    rows = substring_dedup.remove_repeats(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id != 5}
    assert by_id[6].n_removed == 120 and by_id[10].n_removed == 60_000 and by_id[10].kept_text == "tail"
    assert by_id[0].n_words == 0 and by_id[8].n_removed == 0
    assert all(r.n_removed == 0 for r in rows if r.doc_id == 5)
    missing = sorted(r.n_removed for r in rows if r.doc_id is None)
    assert missing == [0, 120]
    assert substring_dedup.remove_repeats(no_docs).isEmpty()


def test_repeats_of_rows_that_share_an_id(spark):
    """Each row without an id, or with the id of another text, is cut by itself."""
    rng = random.Random(21)
    prose = lambda n: [f"p{rng.randrange(5000)}" for _ in range(n)]
    passage, origin, copied = prose(60), prose(70), prose(80)
    rows = [(1, prose(10) + passage + prose(10)), (2, copied), (9, prose(7) + passage), (9, prose(4))]
    rows += [(None, prose(n) + passage + prose(k)) for n, k in ((3, 0), (90, 5), (40, 200))]
    rows += [(None, prose(12)), (None, prose(300)), (None, copied), (None, []), (7, copied), (7, origin), (8, prose(5) + origin)]
    docs = [(d, " ".join(w)) for d, w in rows]
    ordered = [(LAST_ID if d is None else d, t) for d, t in docs]
    first = {}
    for d, t in ordered:
        for k in range(len(t.split()) - 49):
            run = tuple(t.split()[k : k + 50])
            first[run] = min(first.get(run, d), d)
    wanted = []
    for d, t in ordered:
        w = t.split()
        gone = {x for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < d for x in range(k, k + 50)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        wanted.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((LAST_ID if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == sorted(wanted)
    assert sum(r.n_removed > 0 for r in found) == 7


def test_symbols_of_equal_windows_agree():
    rng = np.random.RandomState(3)
    middle = rng.randint(0, 9, 60).astype(np.uint64)
    keys = []
    for _ in range(30):
        text = np.concatenate([rng.randint(0, 9, rng.randint(0, 40)), middle, rng.randint(0, 9, rng.randint(0, 40))])
        words_ = [w for _, _, w in steps(pa.array([" ".join(f"t{x}" for x in text)]))][0]
        at, key, digest = substring_dedup.window_keys(words_, words_.hashes(), 50, 3)
        keys.append(dict(zip(digest.tolist(), key.tolist())))
    shared = set.intersection(*[set(k) for k in keys])
    assert len(shared) >= 11 and all(len({k[d] for k in keys}) == 1 for d in shared)


# --- n-gram Jaccard join ------------------------------------------------------------


def test_components_of_graph(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert found == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "x long, y long")).isEmpty()


def test_jaccard_equals_plain_version(crafted, crafted_docs):
    rows = signature_trees.jaccard_components(crafted_docs).collect()
    wanted = brute_llm.jaccard_components(crafted)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert 5 < len({c for _, c in wanted.values()}) < len(crafted)


def test_jaccard_edges(edge_docs, no_docs):
    rows = signature_trees.jaccard_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert found[0] == (0, 0) and found[2] == (0, 2) and found[3] == (1, 3) and found[4] == (1, 4)
    assert found[6][1] == found[7][1] == found[8][1] == 5 and found[10][1] == 9
    assert {r.component_id for r in rows if r.doc_id is None} == {5, None}
    assert signature_trees.jaccard_components(no_docs).isEmpty()


def test_jaccard_in_blocks(spark, crafted, crafted_docs):
    """Roots of more than a few members are split: no task's tree holds a whole one, no link is lost."""
    rows = signature_trees.jaccard_components(crafted_docs, block_rows=3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_llm.jaccard_components(crafted)


def test_block_pairs_meet_once(spark):
    """Members of the largest component meet all others, and others each other, in one block pair each."""
    members = [(7, k, 1 if k < 60 else k) for k in range(75)]
    labelled = spark.createDataFrame(members, "root long, class_id long, comp long")
    several = spark.createDataFrame([(7, 1, 75)], "root long, lo long, rows long")
    split = labelled.join(signature_trees._in_blocks(labelled, several, 6), "root")
    found = split.select("class_id", F.inline(signature_trees._block_pairs())).collect()
    blocks = {}
    for r in found:
        blocks.setdefault(r.block, []).append((r.class_id, r.side))
    meet = Counter()
    for held in blocks.values():
        assert len(held) < 40
        meet.update((a, b) for a, x in held for b, y in held if a < b and (x != y or x < 0))
    assert meet == Counter({(a, b): 1 for a in range(75) for b in range(a + 1, 75) if b >= 60})


def test_jaccard_rows_without_id_join_nothing_else(spark):
    """Two rows without id, each near another document, are no link between these."""
    rng = random.Random(31)
    one, two, three, four = ([f"r{rng.randrange(9000)}" for _ in range(120)] for _ in range(4))
    rows = [(1, one), (2, two), (None, one + ["x"]), (None, two + ["y"]), (None, three), (None, three + ["z"]), (None, four), (None, [])]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = sorted((r.n_shingles, r.doc_id or 0, r.component_id or 0) for r in signature_trees.jaccard_components(docs).collect())
    assert found == sorted(
        [(116, 1, 1), (116, 2, 2), (117, 0, 1), (117, 0, 2), (116, 0, 0), (117, 0, 0), (116, 0, 0), (0, 0, 0)]
    )
    assert {r.doc_id for r in signature_trees.one_of_each(docs).collect()} == {1, 2, None}


def test_one_of_each(edge_docs, no_docs):
    kept = signature_trees.one_of_each(edge_docs)
    assert kept.schema.simpleString() == edge_docs.schema.simpleString()
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == [-1, -1, *[k for k in range(17) if k not in (6, 7, 8, 10)]]
    assert signature_trees.one_of_each(no_docs).isEmpty()


def test_trees_lose_no_pair():
    """Dual traversal against all pairs, with bitmaps far too small for the sets."""
    rng = random.Random(4)
    sets, tree = [], []
    for t in range(6):
        base = rng.sample(range(10_000), 60)
        for _ in range(rng.randrange(1, 60)):
            own = [x for x in base if rng.random() < rng.choice([0.97, 0.85, 0.3])]
            sets.append({rng.getrandbits(60) if rng.random() < 0.05 else x * 0x9E3779B97F4A7C15 % (1 << 64) for x in own} or {1})
            tree.append(t)
    bits = signature_trees._folded([signature_trees._bitmap(np.array(sorted(s), np.uint64)) for s in sets], 8)
    size = np.array([len(s) for s in sets])
    hidden = np.maximum(0, size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
    ids, partner = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    found = set()
    for a, b in signature_trees.tree_pairs(np.array(tree), bits, size, hidden, ids, partner, step=64):
        found |= set(zip(a.tolist(), b.tolist()))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if tree[a] == tree[b] and 100 * common >= 80 * (size[a] + size[b] - common):
                assert (a, b) in found or (b, a) in found


# --- decontamination ----------------------------------------------------------------


def test_fitting_distance_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 80))]
        text = [rng.randrange(6) for _ in range(rng.randrange(0, 60))]
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(text, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert decontamination.fitting_distance(np.array(item), np.array(text))[0] == min(row)


def _edited(rng, passage, edits, vocabulary):
    passage = list(passage)
    for _ in range(edits):
        at, kind = rng.randrange(len(passage)), rng.randrange(3)
        if kind == 0:
            passage[at] = rng.choice(vocabulary)
        elif kind == 1:
            del passage[at]
        else:
            passage.insert(at, rng.choice(vocabulary))
    return passage


def test_leaks_reach_recall_and_are_exact(spark):
    rng = random.Random(8)
    vocabulary = [f"q{k}" for k in range(800)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 60))] for _ in range(60)]
    docs, wanted = [], 0
    for k in range(300):
        words_ = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 150))]
        if k % 3:
            item = items[k % 60]
            at = rng.randrange(len(words_) + 1)
            words_[at:at] = _edited(rng, item, rng.randrange(decontamination.edit_bound(len(item)) + 1), vocabulary)
        docs.append((k, ", ".join(words_).upper()))
    spans = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontamination.find_leaks(frame, spans).collect()}
    hashes = lambda text: [w.hashes() for _, _, w in steps(pa.array([text]), True, NOT_ALNUM)][0]
    coded = [hashes(" ".join(x)) for x in items]
    for k, text in docs:
        for number, item in enumerate(coded):
            distance, _ = decontamination.fitting_distance(item, hashes(text))
            if distance <= decontamination.edit_bound(len(item)):
                wanted += 1
                assert found.get((k, number), distance) >= distance
            else:
                assert (k, number) not in found
    assert wanted > 150 and len(found) >= 0.95 * wanted
    clean = decontamination.without_leaks(frame, spans)
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in docs} - {k for k, _ in found}
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, spans, group_chars=2000).collect()} == set(found)


def test_leak_edges(spark, edge_docs, no_docs):
    base = edge_docs.filter("doc_id = 6").first().text
    items = spark.createDataFrame(
        [(1, base), (1, base), (2, None), (3, ""), (4, "one"), (None, base), (7, " ".join(base.split()[10:40]))],
        "item_id long, text string",
    ).selectExpr("item_id", "text", "'x' as doc_id")
    rows = decontamination.find_leaks(edge_docs, items).collect()
    near = {(d, i) for d in (5, 6, 7, 8, 11, None) for i in (1, 7)}
    assert {(r.doc_id, r.item_id) for r in rows} == near | {(3, 4)}  # the text "one" has the item "one"
    kept = decontamination.without_leaks(edge_docs, items)
    assert kept.schema == edge_docs.schema and kept.count() == edge_docs.count() - 8
    assert decontamination.find_leaks(no_docs, items).isEmpty()
    assert decontamination.find_leaks(edge_docs, items.limit(0)).isEmpty()
    assert decontamination.without_leaks(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_short_items_are_found_as_they_are(spark):
    rng = random.Random(14)
    vocabulary = [f"s{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(1 + k % 7))) for k in range(40)]
    docs = [(k, ", ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))).upper()) for k in range(80)]
    found = {
        (r.doc_id, r.item_id): (r.distance, r.end_word)
        for r in decontamination.find_leaks(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        ).collect()
    }
    wanted = {}
    for d, text in docs:
        tokens = text.lower().split(", ") if text else []
        for i, item in items:
            w = item.split()
            ends = [k + len(w) for k in range(len(tokens) - len(w) + 1) if tokens[k : k + len(w)] == w]
            if ends:
                wanted[d, i] = (0, ends[0])
    assert found == wanted and len(found) > 400


def test_very_long_items_stay_small_in_memory(spark):
    import resource

    rng = random.Random(15)
    item = [f"l{rng.randrange(50_000)}" for _ in range(20_000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    made = decontamination.Items([(1, " ".join(item)), *[(k, " ".join(item[k * 9 : k * 9 + 60])) for k in range(2, 1200)]])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # KB
    assert made.draws.nbytes < 450 * len(made.pair)
    near = [w for k, w in enumerate(item) if k % 9]
    docs = [(1, " ".join(["x"] * 50 + item + ["y"] * 50)), (2, " ".join(near)), (3, " ".join(item[:9000])), (4, "unlike this")]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.distance) for r in found} == {(1, 0), (2, len(item) - len(near))}


# --- line dedup ---------------------------------------------------------------------


def test_lines_equal_plain_version(crafted, crafted_docs):
    rows = line_dedup.repeated_lines(crafted_docs).collect()
    wanted = brute_llm.repeated_lines(crafted)
    assert {r.doc_id: [r.n_lines, r.n_equal, r.n_near, r.removed] for r in rows} == wanted
    assert sum(w[2] for w in wanted.values()) > 5


def test_lines_within_one_edit(spark):
    rng = random.Random(6)
    lines, base = [], [[rng.choice("abcd") for _ in range(rng.randrange(8, 12))] for _ in range(25)]
    for _ in range(250):
        line = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            line = _edited(rng, line, 1, "abcd")
        lines.append(" ".join(line))
    docs = [(k, "\n".join(lines[k * 5 : k * 5 + 5])) for k in range(50)]
    rows = line_dedup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: [r.n_lines, r.n_equal, r.n_near, r.removed] for r in rows} == brute_llm.repeated_lines(docs)


@pytest.mark.parametrize("least", [2, 5])
def test_lines_with_another_least_length(spark, least):
    docs = [(1, "a b c\na b d\nx y\nx z"), (2, "a b c d e\na b c d\nq w e r t"), (3, "q w e t\nx y z\na\nb")]
    rows = line_dedup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), least).collect()
    assert {r.doc_id: [r.n_lines, r.n_equal, r.n_near, r.removed] for r in rows} == brute_llm.repeated_lines(docs, least)


def test_line_edges(edge_docs, no_docs):
    rows = line_dedup.repeated_lines(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    found = {r.doc_id: r for r in rows if r.doc_id not in (5, None)}
    assert found[0].n_lines == 0 and found[6].n_equal == 1 and found[7].n_near == 1 and found[10].n_near == 1
    assert found[13].n_equal == 3 and found[13].removed == [1, 2, 3]
    clean = line_dedup.without_lines(edge_docs)
    assert clean.schema == edge_docs.schema and clean.count() == edge_docs.count()
    texts = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert texts[0] is None and texts[6] == "" and len(texts[13].split("\n")) == 1
    assert line_dedup.repeated_lines(no_docs).isEmpty()


def test_lines_of_rows_that_share_or_lack_an_id(spark):
    """Each row has its own counts; earlier is the lesser doc_id, then line, then the digest of the row's text."""
    rng = random.Random(33)
    same, other = " ".join(f"e{k}" for k in range(9)), " ".join(f"f{k}" for k in range(9))
    texts = ["only one", f"{same}\nmine", f"{same}\nyours\n{other}", f"x y\n{other}", None, ""]
    rows = [(i, t) for i in (None, 4) for t in texts] + [(9, f"{same}\n{other}"), (9, f"{same}\n{other}")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.repeated_lines(docs).join(docs.select("doc_id").distinct(), "doc_id", "left").collect()
    assert sorted(r.n_lines for r in found if r.doc_id is None) == [0, 0, 1, 2, 2, 3] == sorted(r.n_lines for r in found if r.doc_id == 4)
    assert [(r.n_lines, r.n_equal, r.removed) for r in found if r.doc_id == 9] == [(2, 2, [0, 1])] * 2
    # Of the rows of id 4 one keeps each shared line, all rows without id lose theirs.
    assert sum(r.n_equal for r in found if r.doc_id == 4) == 2 and sum(r.n_equal for r in found if r.doc_id is None) == 8
    kept = [(r.doc_id, line) for r in line_dedup.without_lines(docs).collect() for line in (r.text or "").split("\n") if line]
    assert Counter(kept) == Counter({(4, line): 1 for line in ("only one", "mine", "yours", "x y", same, other)})


# --- language model -----------------------------------------------------------------


def test_base_scores_equal_plain_version(crafted, crafted_docs):
    rows = class_lm.score_documents(crafted_docs).collect()
    wanted = brute_llm.base_scores(crafted)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == wanted[r.doc_id][:4]
        assert r.base_score == pytest.approx(wanted[r.doc_id][4])
    assert len(rows) == len(crafted)


def test_classes_find_grammar(spark):
    """Text of alternating word kinds: the model tells it from a shuffle, word counts cannot."""
    rng = random.Random(9)
    kinds = [[f"{c}{k}" for k in range(40)] for c in "abcd"]
    text = lambda n: [rng.choice(kinds[k % 4]) for k in range(n)]
    docs = [(k, " ".join(text(200))) for k in range(200)]
    held = [k for k in range(200, 400) if zlib.crc32(str(k).encode()) % 10 == 0]
    for k in held:
        words_ = text(200)
        if k % 2:
            rng.shuffle(words_)
        docs.append((k, " ".join(words_)))
    rows = class_lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    mean = lambda odd, name: np.mean([r[name] for r in rows if r.doc_id in held and r.doc_id % 2 == odd])
    assert mean(0, "score") > mean(0, "base_score") + 50
    assert mean(0, "score") > mean(1, "score") + 100
    assert abs(mean(0, "base_score") - mean(1, "base_score")) < 5


def test_probabilities_sum_to_one():
    table = class_lm.transition_logs(np.random.RandomState(1).randint(0, 50, (65, 65)).astype(float))
    assert (10**table).sum(axis=1) == pytest.approx(np.ones(65))


def test_lm_edges(spark, edge_docs, no_docs):
    rows = class_lm.score_documents(edge_docs, bucket_bytes=10_000).collect()
    assert len(rows) == edge_docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    whole = {(r.doc_id, r.n_tokens): r.score for r in class_lm.score_documents(edge_docs).collect()}
    assert all(whole[r.doc_id, r.n_tokens] == pytest.approx(r.score) for r in rows)
    assert class_lm.score_documents(no_docs).isEmpty()
    only_held = class_lm.score_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first()
    assert (only_held.n_known, only_held.train_tokens) == (0, 0)


@pytest.mark.parametrize("most", [30, class_lm.FREQUENT])
def test_class_scores_equal_plain_version(crafted, crafted_docs, most):
    """The model's own score, from counts to clusters to transitions, against one word at a time."""
    docs = []
    for d, text in crafted:
        (_, _, found), = steps(pa.array([text]), lower=True)
        docs.append((d, [int(t) for t in class_lm.text_tokens(found)[0]]))
    held = {d for d, _ in crafted if zlib.crc32(str(d).encode()) % 10 == 0}
    wanted = brute_llm.class_scores(
        docs, held, int(class_lm.END), class_lm.CLASSES, class_lm.ROUNDS, class_lm.PRIOR, most
    )
    found = {r.doc_id: r.score for r in class_lm.score_documents(crafted_docs, most=most).collect()}
    assert found.keys() == wanted.keys() and all(found[d] == pytest.approx(wanted[d]) for d in wanted)


# --- token files --------------------------------------------------------------------


def _ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return [[*x.ids, 0] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("planes,block_ids", [("byte", 1 << 16), ("bit", 1000), ("byte", 37)])
def test_token_files_round_trip(edge_docs, planes, block_ids):
    docs = edge_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).filter("doc_id <> 10")
    source = sorted(((r.doc_id, r.text) for r in docs.collect()))
    blocks = token_files.write_token_files(docs, vocabulary(), parts=3, planes=planes, block_ids=block_ids)
    rows = sorted(map(tuple, token_files.read_token_files(blocks).collect()))
    start, wanted = 0, []
    for (doc_id, _), ids in zip(source, _ids([t for _, t in source])):
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows == wanted
    index = blocks.orderBy("part", "block").collect()
    assert all(r.n_ids <= block_ids and len(r.payload) == sum(r.plane_bytes) for r in index)
    assert all(len(r.plane_bytes) == (32 if planes == "bit" else 4) for r in index)


def test_planes_are_inverse():
    ids = np.random.RandomState(0).randint(0, 1 << 32, 1003, dtype=np.uint64).astype(np.uint32)
    for planes in ("bit", "byte"):
        assert (token_files.from_planes(token_files.to_planes(ids, planes), len(ids), planes) == ids).all()


def test_pieces_encode_like_whole_texts():
    texts = [
        "a  b", "a\n\nb c", "  lead", "tail  ", "x\t\ty\n z", "it's  don't", "\n", " ", "a \n b", "nul\0byte here",
        "é ü x", "\x1f\x1c a", "1234 56,78!! ??", "Ünï…cødé 🙂🙂 ok",
    ]
    texts += ["wide　space", "　", "a b c", "x\x85y ", "<|endoftext|> in a text", "lone \x0b\x0c end"]
    rng = random.Random(17)
    texts += ["".join(rng.choice(["a", "é", " ", " ", "\n", "\t", "1", "!", "\xa0", "—"]) for _ in range(60)) for _ in range(300)]
    encoder = token_files.Encoder(vocabulary())
    for _ in range(2):
        found = encoder.encode_column(pa.array([*texts, None], pa.string()))
        assert [[*x.tolist(), token_files.END_ID] for x in found] == _ids([*texts, None])


def test_encoder_survives_equal_digests(monkeypatch):
    """Pieces whose first digests agree are told apart by the second, and the texts encoded whole."""
    whole = token_files.span_hashes
    monkeypatch.setattr(token_files, "span_hashes", lambda d, s, e, seed=0: whole(d, s, e, seed) if seed else whole(d, s, e) % np.uint64(7))
    texts = [" ".join(f"w{k * j % 31}" for k in range(40)) for j in range(20)]
    found = token_files.Encoder(vocabulary()).encode_column(pa.array(texts))
    assert [[*x.tolist(), 0] for x in found] == _ids(texts)


def test_special_strings_can_be_plain_text():
    text = "a <|endoftext|> b"
    special, plain = (token_files.Encoder(vocabulary(), p).encode_column(pa.array([text]))[0].tolist() for p in (False, True))
    assert 50256 in special and 50256 not in plain


def test_rows_of_one_id_are_split_over_parts(spark):
    docs = spark.range(10_000).selectExpr("IF(id % 2 = 0, 7L, NULL) AS doc_id", "concat('text ', id) AS text")
    blocks = token_files.write_token_files(docs, vocabulary(), parts=4, block_ids=1000)
    parts = blocks.groupBy("part").sum("n_ids").collect()
    assert len(parts) == 4 and max(r[1] for r in parts) < 2 * min(r[1] for r in parts)
    rows = token_files.read_token_files(blocks).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * 5000 + [7] * 5000
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]


def test_token_file_edges(edge_docs, no_docs):
    blocks = token_files.write_token_files(edge_docs, vocabulary(), parts=2, block_ids=500)
    rows = token_files.read_token_files(blocks).orderBy("start").collect()
    assert len(rows) == edge_docs.count()
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    assert token_files.read_token_files(token_files.write_token_files(no_docs, vocabulary())).isEmpty()


def test_missing_ids_come_last():
    assert LAST_ID == 2**63 - 1 and Counter([LAST_ID])[LAST_ID] == 1


def test_line_dedup_memory_does_not_grow_with_the_batch():
    """One text after the other: 4 MB of texts take what a few of them take."""
    rng = random.Random(3)
    texts = ["\n".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(30)) for _ in range(2000)]
    ids = pa.array(range(len(texts)))
    lines = pa.array([list(range(30))] * len(texts), pa.list_(pa.int32()))
    for task, extra in ((line_dedup._describe(8), {}), (line_dedup._variants, {"lines": lines})):
        batch = pa.RecordBatch.from_pydict({"doc_id": ids, "row": ids, "text": pa.array(texts)} | extra)
        tracemalloc.start()
        try:
            rows = sum(b.num_rows for b in task(iter([batch])))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert rows == len(texts) * 30 * (13 if extra else 1)
        assert peak < 40 << 20
