"""Line deduplication within one edit, by a deletion-neighbourhood join.

A line is its words. Lines with equal words form a class; the earliest place of a
class, by (doc_id, line, digest of the row's text), is kept unless an earlier line lies within one edit (a word
put in, taken out or replaced). Lines of fewer than ``LEAST_WORDS`` words must be equal.

The neighbourhood of a line is itself and all its variants with one word deleted, as
128-bit digests. Two lines are within one edit if and only if they have a variant
with the same place deleted in common (a replaced word) or the one is a variant of the
other (a word put in). A group of equal variants therefore needs no pairs: the least
place among the whole lines, and among the deletions of each position, decide for
every member. A line stands for its class by its place, which no other class has.

Before variants are made, lines that cannot have a neighbour are left out: of two
lines within one edit the first or the last half, by the shorter one's length, is
equal. Only lines that share such a half with a different line make variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import LAST_ID, ordered_id, stored, with_batches
from hypnolith.llm.words import ModularSums, Words, mixed, signed, steps

LEAST_WORDS = 8

_OTHER = np.uint64(0xA0761D6478BD642F)
# Bytes of text whose lines, or variants of lines, are worked out at a time.
_STEP_BYTES = 1 << 18


class _Lines:
    """Lines with words of a step's texts, as ranges of words."""

    def __init__(self, words: Words):
        feeds = np.flatnonzero(words.data == 10)
        # The line of a word within its text: line feeds between the text's start and the word.
        before = np.searchsorted(feeds, words.starts)
        text = words.text_of
        base = np.searchsorted(feeds, words.bounds[:-1])
        number = before - base[text]
        begins = np.ones(len(text), bool)
        begins[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
        self.first = np.flatnonzero(begins)
        self.size = np.diff(np.append(self.first, len(text)))
        self.text, self.number = text[self.first], number[self.first]
        self.sums = [ModularSums(words.hashes(which), which) for which in (0, 1)]

    def digest(self, which: int, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Digest of words begin .. begin + size - 1."""
        return self.sums[which].digest(begin, size)

    def without(self, which: int, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Digest of a line without its word ``at``: the same as that of those words in a row."""
        return self.sums[which].without(first, size, at)


LINES = "doc_id long, row long, line int, h1 long, h2 long, halves array<long>"


def _describe(least_words: int):
    """Documents -> their lines: digests, and digests of their halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
            for row, end, words in steps(batch.column("text"), step_bytes=_STEP_BYTES):
                lines = _Lines(words)
                if not len(lines.first):
                    continue
                n, first = lines.size, lines.first
                halves = []
                for h in (n // 2, (n - 1) // 2):
                    for side, begin in ((0, first), (1, first + n - h)):
                        tag = np.uint64(2) * h.astype(np.uint64) + np.uint64(side)
                        halves.append(mixed(lines.digest(0, begin, h) + mixed(tag + _OTHER)))
                flat = np.stack(halves, axis=1)
                long_ = n >= least_words
                # An odd length has one half only; short lines have none.
                count = np.where(long_, np.where(n % 2 == 0, 4, 2), 0)
                flat = flat[np.arange(4)[None] < count[:, None]]
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row:end][lines.text]),
                        pa.array(keys[row:end][lines.text]),
                        pa.array(lines.number.astype(np.int32)),
                        pa.array(signed(lines.digest(0, first, n))),
                        pa.array(signed(lines.digest(1, first, n))),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(flat))),
                    ],
                    names=["doc_id", "row", "line", "h1", "h2", "halves"],
                )

    return run


VARIANTS = "v1 long, v2 long, position int, doc_id long, row long, line int"


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with chosen lines -> the neighbourhood of those lines."""
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
        chosen = batch.column("lines")
        for row, end, words in steps(batch.column("text"), step_bytes=_STEP_BYTES):
            lines = _Lines(words)
            part = chosen.slice(row, end - row)
            of = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy())).astype(np.int64)
            wanted = (of << 32) + part.flatten().to_numpy().astype(np.int64)
            held = np.isin((lines.text.astype(np.int64) << 32) + lines.number, wanted)
            first, n = lines.first[held], lines.size[held]
            if not len(n):
                continue
            line = np.repeat(np.arange(len(n)), n + 1)
            position = np.arange(len(line)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1) - 1
            whole = position < 0
            names = []
            for which in (0, 1):
                deleted = lines.without(which, first[line], n[line], np.maximum(position, 0))
                names.append(np.where(whole, lines.digest(which, first, n)[line], deleted))
            for k in range(0, len(line), 50_000):
                cut = slice(k, k + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(names[0][cut])),
                        pa.array(signed(names[1][cut])),
                        pa.array(position[cut].astype(np.int32)),
                        pa.array(ids[row:end][lines.text[held][line[cut]]]),
                        pa.array(keys[row:end][lines.text[held][line[cut]]]),
                        pa.array(lines.number[held][line[cut]].astype(np.int32)),
                    ],
                    names=["v1", "v2", "position", "doc_id", "row", "line"],
                )


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_equal, n_near and the removed lines' numbers.

    Lines are split at line feeds and numbered from 0; lines without words are not
    counted and never removed. ``n_equal`` counts removed lines whose words stand in
    an earlier line as they are, ``n_near`` other removed lines. What is earlier is
    judged on the input, also against lines that are removed themselves. Null and
    empty texts have no lines. Every row is a document of its own; lines with one number
    of rows that share a doc_id are in order of a digest of the rows' texts, and those
    of equal rows equally early. Rows without doc_id come last. Other columns are
    ignored; an empty table gives an empty result. Lines of fewer than ``least_words``
    words are compared as they are.
    """
    found = _repeated(docs, least_words)
    return found.select(
        F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "n_lines", "n_equal", "n_near", "removed"
    )


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, row (a digest of the text) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(ordered_id(docs).alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _repeated(docs: DataFrame, least_words: int) -> DataFrame:
    """The result per row with doc_id as a long and ``row``."""
    spark = docs.sparkSession
    with_batches(spark)
    texts = _texts(docs)
    lines = stored(texts.mapInArrow(_describe(least_words), LINES), "lines")
    place = F.struct("doc_id", "line", "row")
    classes = stored(
        lines.groupBy("h1", "h2").agg(F.min(place).alias("origin"), F.first("halves").alias("halves")),
        "line-classes",
    )
    halves = classes.select("h1", "h2", "origin", F.explode("halves").alias("half"))
    shared = (
        halves.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("half")
    )
    chosen = (
        halves.join(shared, "half")
        .select("origin.doc_id", "origin.line", "origin.row")
        .groupBy("doc_id", "row")
        .agg(F.collect_set("line").alias("lines"))
    )
    variants = stored(texts.join(chosen, ["doc_id", "row"]).mapInArrow(_variants, VARIANTS), "line-variants")
    at = place
    # Least places per variant: of the whole line, of deletions of each position, of all deletions.
    by_position = variants.groupBy("v1", "v2", "position").agg(F.min(at).alias("least"), F.count("*").alias("times"))
    per_variant = by_position.groupBy("v1", "v2").agg(
        F.min(F.when(F.col("position") < 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("position") >= 0, F.col("least"))).alias("deleted"),
        F.sum("times").alias("all"),
    ).filter("`all` > 1").drop("all")
    met = (
        variants.join(per_variant, ["v1", "v2"])
        .join(by_position.select("v1", "v2", "position", "least"), ["v1", "v2", "position"])
        .withColumn("earlier", F.when(F.col("position") < 0, F.col("deleted")).otherwise(F.least("whole", "least")))
    )
    near = (
        met.filter(F.col("earlier") < at)
        .select(at.alias("origin"))
        .distinct()
        .withColumn("near", F.lit(True))
    )
    judged = lines.select("doc_id", "row", "line", "h1", "h2").join(
        classes.select("h1", "h2", "origin").join(near, "origin", "left"), ["h1", "h2"]
    )
    equal = F.col("origin") < at
    removed = equal | F.coalesce(F.col("near"), F.lit(False))
    counted = judged.groupBy("doc_id", "row").agg(
        F.count("*").alias("n_lines"),
        F.count_if(equal).alias("n_equal"),
        F.count_if(removed & ~equal).alias("n_near"),
        F.array_sort(F.collect_set(F.when(removed, F.col("line")))).alias("removed"),
    )
    # Equal rows have been counted together.
    rows = texts.select("doc_id", "row")
    times = rows.groupBy("doc_id", "row").agg(F.count("*").alias("times"))
    every = rows.join(times.join(counted, ["doc_id", "row"], "left"), ["doc_id", "row"])
    share = lambda name: F.coalesce(F.expr(f"{name} div times"), F.lit(0)).cast("long").alias(name)
    return every.select(
        "doc_id", "row", share("n_lines"), share("n_equal"), share("n_near"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` with their repeated lines taken out of the text."""
    found = _repeated(docs, least_words).filter("size(removed) > 0").select(
        F.col("doc_id").alias("_found"), F.col("row").alias("_found_row"), F.col("removed").alias("_removed")
    ).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    kept = F.filter(
        F.split("_row.text", "\n"), lambda line, k: ~F.coalesce(F.array_contains("_removed", k), F.lit(False))
    )
    text = F.when(F.col("_removed").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns]
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(row, ordered_id(docs).alias("_id"), digest.alias("_digest"))
    same = (F.col("_id") == F.col("_found")) & (F.col("_digest") == F.col("_found_row"))
    return rows.join(found, same, "left").select(*columns)
