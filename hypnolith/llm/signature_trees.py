"""N-gram Jaccard join with signature trees.

A document's set is that of its distinct word shingles; two documents link when
100 * intersection >= 80 * union.

1. Documents with equal sets form a class; one document stands for it.
2. Shingles get one global order: by the count in their cell of a table of fixed
   size (counted over all documents), then by value. Two linked sets share one of
   their size - ceil(0.8 * size) + 1 first shingles. Each such prefix shingle is the
   root of a tree of the classes that have it; roots of one class are dropped.
3. Every class is compared with the least class of the root it shares most of with.
   Those links join the bulk of copies; roots within one component are dropped.
4. What is left of a root is a signature tree: nodes hold the OR of the members'
   shingle bitmaps, the range of sizes and the largest number of shingles that a
   bitmap hides. Two nodes are descended together; a pair of nodes whose bitmaps and
   sizes leave no room for the overlap needed, or which is of one component, is cut.
5. Pairs that survive are verified on their whole sets, and linked classes joined.

Level one of a tree is by size: a member goes to its size class and, as a partner
only, to the next, so that the members of a frequent shingle are spread over tasks.
Roots of more than ``BLOCK_ROWS`` members are searched as pairs of blocks, one pair a
task: the root's largest component has blocks of its own, which are not paired with
each other, and all other members meet all blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.components import components
from hypnolith.llm.tables import LAST_ID, ordered_id, rows_with_ids, stored, with_batches
from hypnolith.llm.words import Words, run_hashes, signed, steps, whole_hashes

SHINGLE = 5
PERCENT = 80
# Cells of the table that orders shingles: 2 MB of counts, whatever the input.
CELLS = 1 << 18
SLICES = 64
FANOUT = 8
# Roots of one least component make a family, or several of so many members; their
# members are searched together, because most roots of two components repeat the same pairs.
FAMILY_ROWS = 1 << 13
MOST_ROWS = 1 << 17
# Members of a larger root are dealt into blocks of so many; a task sees two blocks.
BLOCK_ROWS = 1 << 15
LEAST_BITS, MOST_BITS = 64, 4096

SETS = "doc_id long, missing boolean, n_shingles long, digest binary, prefix array<long>, bitmap binary"


def overlap_needed(total):
    """Least intersection of linked sets whose sizes sum to ``total``."""
    return -(-PERCENT * total // (100 + PERCENT))


def text_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    hashes = words.hashes()
    at = words.spans(size)
    runs = run_hashes(hashes, size)[at]
    cuts = np.searchsorted(at, words.first)
    whole = whole_hashes(hashes, words.first)
    counts = words.counts
    return [
        np.unique(runs[a:b]) if b > a else whole[k : k + 1] if counts[k] else runs[:0]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
    ]


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def _count_cells(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, words in steps(batch.column("text"), lower=True):
                for found in text_sets(words, size):
                    np.add.at(total, _cells(found), 1)
        parts = total.reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["slice", "counts"],
        )

    return run


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
            total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
        names=["slice", "counts"],
    )


def cell_ranks(texts: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Place of every cell in the global order, fewest shingles first."""
    schema = "slice int, counts binary"
    rows = texts.select("text").mapInArrow(_count_cells(size), schema).repartition(SLICES, "slice")
    total = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for row in rows.mapInArrow(_sum_cells, schema).collect():
        total[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    ranks = np.empty(CELLS, np.int32)
    ranks[np.argsort(total.reshape(-1), kind="stable")] = np.arange(CELLS, dtype=np.int32)
    return ranks


def _bitmap(found: np.ndarray) -> bytes:
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(2 * len(found) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(found >> np.uint64(40)).astype(np.int64) & (bits - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _describe(ranks, size: int):
    """Documents -> their set's size, digest, prefix in the global order, and bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = ranks.value
        for batch in batches:
            for row, end, words in steps(batch.column("text"), lower=True):
                out = {name: [] for name in ("n", "digest", "prefix", "bitmap")}
                for found in text_sets(words, size):
                    n = len(found)
                    order = np.argsort(place[_cells(found)], kind="stable")
                    prefix = found[order[: n - -(-PERCENT * n // 100) + 1]]
                    out["n"].append(n)
                    out["digest"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    out["prefix"].append(signed(prefix))
                    out["bitmap"].append(_bitmap(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, end - row),
                        batch.column("missing").slice(row, end - row),
                        pa.array(out["n"], pa.int64()),
                        pa.array(out["digest"], pa.binary()),
                        pa.array(out["prefix"], pa.list_(pa.int64())),
                        pa.array(out["bitmap"], pa.binary()),
                    ],
                    names=["doc_id", "missing", "n_shingles", "digest", "prefix", "bitmap"],
                )

    return run


# --- signature trees ---------------------------------------------------------------


class _Level:
    """Nodes of one level of many trees: ranges over members, least to most."""

    def __init__(self, tree, bits, low, high, excess, comp_low, comp_high, partner, side_low, side_high, first):
        self.tree, self.bits, self.low, self.high = tree, bits, low, high
        self.excess, self.comp_low, self.comp_high, self.partner = excess, comp_low, comp_high, partner
        self.side_low, self.side_high = side_low, side_high  # block of a pair of two, else -1
        self.first = first  # first child in the level below, and one more for the end

    def above(self) -> _Level:
        """Nodes of FANOUT consecutive nodes of one tree each."""
        begins = np.ones(len(self.tree), bool)
        begins[1:] = self.tree[1:] != self.tree[:-1]
        starts = np.flatnonzero(begins)
        place = np.arange(len(self.tree)) - np.repeat(starts, np.diff(np.append(starts, len(self.tree))))
        first = np.flatnonzero(place % FANOUT == 0)
        return _Level(
            self.tree[first],
            np.bitwise_or.reduceat(self.bits, first, axis=0),
            np.minimum.reduceat(self.low, first),
            np.maximum.reduceat(self.high, first),
            np.maximum.reduceat(self.excess, first),
            np.minimum.reduceat(self.comp_low, first),
            np.maximum.reduceat(self.comp_high, first),
            np.minimum.reduceat(self.partner, first),
            np.minimum.reduceat(self.side_low, first),
            np.maximum.reduceat(self.side_high, first),
            np.append(first, len(self.tree)),
        )

    def possible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether members of nodes a and b may link (what is known of the nodes allows it)."""
        fits = (100 * self.high[a] >= PERCENT * self.low[b]) & (100 * self.high[b] >= PERCENT * self.low[a])
        fits &= (self.partner[a] == 0) | (self.partner[b] == 0)
        one = (self.comp_low[a] == self.comp_high[a]) & (self.comp_low[b] == self.comp_high[b])
        fits &= ~(one & (self.comp_low[a] == self.comp_low[b]))
        one = (self.side_low[a] == self.side_high[a]) & (self.side_low[b] == self.side_high[b])
        fits &= ~(one & (self.side_low[a] == self.side_low[b]) & (self.side_low[a] >= 0))
        at = np.flatnonzero(fits)
        x, y = a[at], b[at]
        common = np.bitwise_count(self.bits[x] & self.bits[y]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(self.excess[x], self.excess[y])
        fits[at] = most >= overlap_needed(self.low[x] + self.low[y])
        return fits


def tree_pairs(tree, bits, size, excess, comp, partner, step: int = 1 << 15, side=None):
    """Pairs of members of one tree that their signatures allow to link, in pieces.

    Members are in order of tree; all trees are descended at once, at most ``step``
    node pairs at a time. Members of one ``side`` from 0 on are not paired.
    """
    side = np.full(len(tree), -1) if side is None else side
    levels = [_Level(tree, bits, size, size, excess, comp, comp, partner, side, side, None)]
    while len(levels[-1].tree) > len(np.unique(levels[-1].tree)):
        levels.append(levels[-1].above())
    roots = np.arange(len(levels[-1].tree))
    stack = [(len(levels) - 1, roots[k : k + step], roots[k : k + step]) for k in range(0, len(roots), step)]
    while stack:
        depth, a, b = stack.pop()
        level = levels[depth]
        fits = level.possible(a, b)
        a, b = a[fits], b[fits]
        if not depth:
            apart = a != b
            if apart.any():
                yield a[apart], b[apart]
            continue
        n_a, n_b = level.first[a + 1] - level.first[a], level.first[b + 1] - level.first[b]
        total = n_a * n_b
        which = np.repeat(np.arange(len(a)), total)
        place = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        x = level.first[a][which] + place // n_b[which]
        y = level.first[b][which] + place % n_b[which]
        once = (a[which] != b[which]) | (x <= y)
        x, y = x[once], y[once]
        stack += [(depth - 1, x[k : k + step], y[k : k + step]) for k in range(0, len(x), step)]


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps brought to ``width`` bytes by OR-ing their parts."""
    out = np.zeros((len(bitmaps), width), np.uint8)
    for k, raw in enumerate(bitmaps):
        out[k] = np.bitwise_or.reduce(np.frombuffer(raw, np.uint8).reshape(-1, width), axis=0)
    return out


def _tree_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members sorted by (family, root, block pair, size class) -> candidate pairs, once per family."""
    held: list[pa.RecordBatch] = []

    def search(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table.column(name).to_numpy()
        roots, sizes, blocks = column("root"), column("size_class"), column("block")
        change = np.ones(len(roots), bool)
        change[1:] = (roots[1:] != roots[:-1]) | (sizes[1:] != sizes[:-1]) | (blocks[1:] != blocks[:-1])
        tree = np.cumsum(change) - 1
        bitmaps = table.column("bitmap").to_pylist()
        lengths = np.array([len(x) for x in bitmaps], np.int64)
        # A tree's bitmaps have the width of its shortest; trees of one width go together.
        width = np.minimum.reduceat(lengths, np.flatnonzero(change))[tree]
        n = column("n_shingles")
        comp, partner, ids, side = column("comp"), column("partner"), column("class_id"), column("side")
        found = [np.zeros((0, 2), np.int64)]
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            bits = _folded([bitmaps[k] for k in at], int(w))
            hidden = n[at] - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            for a, b in tree_pairs(tree[at], bits, n[at], np.maximum(hidden, 0), comp[at], partner[at], side=side[at]):
                x, y = ids[at][a], ids[at][b]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)[x != y])
                if len(found) > 100:
                    found = [np.unique(np.concatenate(found), axis=0)]
        pairs = np.unique(np.concatenate(found), axis=0)
        for k in range(0, len(pairs), 100_000):
            cut = np.ascontiguousarray(pairs[k : k + 100_000].T)
            yield pa.RecordBatch.from_arrays([pa.array(cut[0]), pa.array(cut[1])], names=["a", "b"])

    def flush(last: bool, rows: int) -> Iterator[pa.RecordBatch]:
        nonlocal held
        table = pa.Table.from_batches(held)
        # Roots of one family stay together, if they are not too many.
        family, roots = table.column("family").to_numpy(), table.column("root").to_numpy()
        cut = int(np.searchsorted(family == family[-1], True))
        if not cut and rows >= MOST_ROWS:
            cut = len(roots) - int(np.searchsorted((roots != roots[-1])[::-1], True))
        cut = len(roots) if last else cut
        if cut:
            yield from search(table.slice(0, cut))
        held = table.slice(cut).combine_chunks().to_batches() if cut < len(roots) else []

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows = sum(b.num_rows for b in held)
            if rows >= 20_000:
                yield from flush(False, rows)
    if held:
        yield from flush(True, 0)


def _room(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the signatures of both -> those whose signatures leave room for a link."""
    for batch in batches:
        a, b, n_a, n_b = (batch.column(k).to_numpy() for k in range(4))
        fits = (100 * n_a >= PERCENT * n_b) & (100 * n_b >= PERCENT * n_a)
        one, two = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        for k in np.flatnonzero(fits).tolist():
            width = min(len(one[k]), len(two[k]))
            bits = _folded([one[k], two[k]], width)
            held = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            hidden = max(0, min(int(n_a[k] - held[0]), int(n_b[k] - held[1])))
            common = int(np.bitwise_count(bits[0] & bits[1]).sum(dtype=np.int64)) + hidden
            fits[k] = common >= overlap_needed(int(n_a[k] + n_b[k]))
        yield pa.RecordBatch.from_arrays([pa.array(a[fits]), pa.array(b[fits])], names=["a", "b"])


def with_room(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow a link; a bitmap is far smaller than its set."""
    one = signatures.select(F.col("class_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("bitmap").alias("bits_a"))
    two = signatures.select(F.col("class_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("bitmap").alias("bits_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(_room, "a long, b long")


def _in_blocks(labelled: DataFrame, several: DataFrame, block_rows: int) -> DataFrame:
    """``several`` with each root's largest component and how many blocks it and the rest have."""
    large = several.filter(F.col("rows") > block_rows).select("root")
    if large.isEmpty():
        return several.select("*", F.lit(None).cast("long").alias("main"), F.lit(1).alias("rest"), F.lit(0).alias("whole"))
    counts = labelled.join(large, "root").groupBy("root", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("root").agg(F.max(F.struct("n", "comp")).alias("_main"), F.sum("n").alias("_all"))
    blocks = lambda n: F.ceil(n / block_rows).cast("int")
    shares = main.select(
        "root",
        F.col("_main.comp").alias("main"),
        blocks(F.col("_all") - F.col("_main.n")).alias("rest"),
        blocks(F.col("_main.n")).alias("whole"),
    )
    return several.join(shares, "root", "left").fillna({"rest": 1, "whole": 0})


def _block_pairs() -> Column:
    """(block pair, side) of every pair of blocks that a member is in; blocks of ``main`` follow the others."""
    is_main = F.col("comp").eqNullSafe(F.col("main"))
    deal = lambda n: F.pmod(F.xxhash64("class_id"), F.greatest(n, F.lit(1))).cast("int")
    block = F.when(is_main, F.col("rest") + deal(F.col("whole"))).otherwise(deal(F.col("rest")))
    last = F.when(is_main, F.col("rest") - 1).otherwise(F.col("rest") + F.col("whole") - 1)
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda other: F.struct(
            (F.least(block, other).cast("long") * (1 << 20) + F.greatest(block, other)).alias("block"),
            F.when(other == block, -1).when(block < other, 0).otherwise(1).alias("side"),
        ),
    )


# --- verification --------------------------------------------------------------------


def _sets_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, words in steps(batch.column("text"), lower=True):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, end - row),
                        pa.array([signed(x) for x in text_sets(words, size)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "shingles"],
                )

    return run


def _linked(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose whole sets meet the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stored(rows_with_ids(texts, stored(ids, "jaccard-ids")).mapInArrow(_sets_of(size), "doc_id long, shingles array<long>"), "jaccard-sets")
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = F.size("set_a") + F.size("set_b")
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(100 * common >= PERCENT * (both - common))
        .select("a", "b")
    )


def jaccard_components(docs: DataFrame, size: int = SHINGLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable by links).

    A-Z count as a-z. A text with fewer than ``size`` words is one shingle; null and
    blank texts have none and link with nothing, their component is their own id.
    Rows that share a doc_id are one node of the graph. Rows without doc_id come
    last, each for itself (inside, a 64-bit digest of the text is their node); their
    component is null unless they are linked with a document that has an id.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with_batches(spark)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).select(
        F.coalesce("doc_id", F.xxhash64("text")).alias("doc_id"), "text", F.col("doc_id").isNull().alias("missing")
    )
    ranks = spark.sparkContext.broadcast(cell_ranks(texts, size))
    sets = stored(texts.mapInArrow(_describe(ranks, size), SETS), "jaccard-described")

    filled = sets.filter("n_shingles > 0")
    known = F.min(F.when(~F.col("missing"), F.col("doc_id")))
    least = filled.groupBy("digest").agg(
        F.coalesce(known, F.min("doc_id")).alias("class_id"), known.isNull().alias("nameless")
    )
    members = stored(
        sets.select("doc_id", "missing", "n_shingles", "digest").join(least, "digest", "left").select(
            "doc_id",
            "missing",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("class_id")).alias("class_id"),
            F.coalesce("nameless", "missing").alias("nameless"),
        ),
        "jaccard-members",
    )
    classes = filled.join(
        least.select(F.col("digest").alias("_digest"), F.col("class_id").alias("_least")),
        (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_least")),
        "left_semi",
    )
    postings = classes.select(F.col("doc_id").alias("class_id"), F.explode("prefix").alias("root"))
    shared = (
        postings.groupBy("root")
        .agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
        .filter("lo <> hi")
        .select("root", "lo")
    )
    rooted = stored(postings.join(shared, "root"), "jaccard-roots")

    # Links with the least class of the root that is shared most.
    nearest = (
        rooted.filter("lo <> class_id")
        .groupBy("class_id", "lo")
        .agg(F.count("*").alias("times"))
        .groupBy("class_id")
        .agg(F.max(F.struct(F.col("times"), (-F.col("lo")).alias("minus"))).alias("best"))
        .select((-F.col("best.minus")).alias("a"), F.col("class_id").alias("b"))
    )
    signatures = stored(
        classes.select(F.col("doc_id").alias("class_id"), "n_shingles", "bitmap"), "jaccard-signatures"
    )
    nearest = stored(with_room(nearest, signatures).distinct(), "jaccard-nearest")
    first = stored(_linked(nearest, texts, size), "jaccard-links")
    joined = stored(components(first), "jaccard-components")

    # Roots that still hold several components.
    labelled = rooted.join(joined, rooted["class_id"] == joined["node"], "left").select(
        "root", "class_id", F.coalesce("component", "class_id").alias("comp")
    )
    several = (
        labelled.groupBy("root")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows"))
        .filter("lo <> hi")
    )
    several = stored(several.select("root", "lo", "rows"), "jaccard-open-roots")
    parts = several.groupBy("lo").agg(F.ceil(F.sum("rows") / FAMILY_ROWS).alias("parts"))
    families = _in_blocks(labelled, several, block_rows).join(parts, "lo").select(
        "root", "lo", F.pmod(F.xxhash64("root"), F.col("parts")).alias("part"), "main", "rest", "whole"
    )
    open_ = labelled.join(families, "root")
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    member = (
        open_.join(signatures, "class_id")
        .select(
            "lo", "part", "root", "class_id", "comp", "n_shingles", "bitmap", size_class.alias("_own"),
            F.explode(_block_pairs()).alias("_in"),
        )
        .withColumn("_place", F.explode(F.array(*[
            F.struct((F.col("_own") + k).alias("size_class"), F.lit(k).alias("partner")) for k in (0, 1)
        ])))
        .select(
            F.xxhash64("lo", "part", "_in.block").alias("family"), "root", "_in.block", "_in.side",
            "_place.size_class", "_place.partner", "class_id", "comp", "n_shingles", "bitmap",
        )
    )
    candidates = (
        member.repartition("family", "size_class")
        .sortWithinPartitions("family", "root", "block", "size_class", "comp", "n_shingles", "class_id")
        .mapInArrow(_tree_candidates, "a long, b long")
        .distinct()
    )
    second = _linked(stored(candidates, "jaccard-candidates"), texts, size)

    repeated = members.filter("class_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("class_id").alias("lo"), F.max("class_id").alias("hi")
    )
    twice = members.join(repeated.filter("lo <> hi").select("doc_id"), "doc_id").filter("class_id IS NOT NULL")
    links = first.unionByName(second).unionByName(twice.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")))
    final = stored(components(links), "jaccard-final")
    # A component has the name of its least document with an id, if any.
    nameless = members.filter("nameless").select(F.coalesce("class_id", "doc_id").alias("node")).distinct()
    named = final.join(nameless, "node", "left_anti").groupBy("component").agg(F.min("node").alias("found"))
    final = final.join(named, "component", "left").select("node", "found")
    whole = members.join(final, F.coalesce("class_id", "doc_id") == F.col("node"), "left")
    own = F.when(~F.col("nameless"), F.coalesce("class_id", "doc_id"))
    return whole.select(
        F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.coalesce("found", own).alias("component_id"),
    )


def one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose document is the least of its component, one row per doc_id.

    Rows without doc_id cannot be told apart by it; all of them stay.
    """
    found = jaccard_components(docs, size)
    kept = found.filter(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    kept = stored(
        kept.groupBy(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")).agg(F.count("*").alias("times")),
        "jaccard-kept",
    )
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(ordered_id(docs).alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    repeated = kept.filter((F.col("times") > 1) & (F.col("doc_id") != LAST_ID)).select("doc_id")
    single = rows_with_ids(rows, kept.join(repeated, "doc_id", "left_anti").select("doc_id"))
    if repeated.isEmpty():
        return single.select(*columns)
    # Which of the rows with one id stays is settled by their values.
    several = rows_with_ids(rows, repeated).groupBy("doc_id").agg(F.min("_row").alias("_row"))
    return single.unionByName(several).select(*columns)
