"""Substring deduplication by recompression.

A text is shortened in rounds. Each round first replaces every run of one symbol by a
symbol of its own, then merges neighbours (a, b) where a coin drawn from a's name is
0 and the one from b's name is 1. Names are 64-bit digests of what was merged, so all
tasks give equal parts of any two texts the same names and no table of names is kept.
Whether symbols merge depends on their names and their neighbours' only; every symbol
carries the range of words that decided it, its context.

Equal windows of ``WINDOW`` words thus hold the same symbols wherever the context lies
inside the window. Of the phrases of ``PHRASE`` neighbouring last-round symbols there,
the least in a scrambled order is the window's key, long ones first; a window that
holds no phrase with its context has its own digest as key. Keys that no second document has, nearly all, rule their windows out. The
others' windows are compared by (key, digest of the words), 128 bits.

Documents whose words are all equal are settled by a digest of the whole first, so
that groups of copies do not take part.

Rows are told apart by (doc_id, row): where rows with different texts share a doc_id, or
have none, ``row`` is a 64-bit digest of the text; elsewhere it is 0, which takes no room.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import BROADCAST_IDS, LAST_ID, ordered_id, rows_with_ids, stored, with_batches
from hypnolith.llm.words import Words, mixed, run_hashes, signed, steps, whole_hashes

WINDOW = 50
ROUNDS = 3
PHRASE = 3
# Phrases of fewer words are a key only where a window has no longer one.
LONG_PHRASE = 8

_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Symbols:
    """Symbols of flat texts: name, words covered, words that decided it, and text."""

    def __init__(self, name, start, end, low, high, text):
        self.name, self.start, self.end = name, start, end
        self.low, self.high, self.text = low, high, text

    @classmethod
    def of_words(cls, hashes: np.ndarray, text: np.ndarray) -> Symbols:
        at = np.arange(len(hashes))
        return cls(hashes, at, at + 1, at, at + 1, text)

    def _neighbours(self):
        """Contexts of the symbols before and after; beyond a text, one word outside it."""
        same = self.text[1:] == self.text[:-1]
        low, high = self.start - 1, self.end + 1
        low[1:] = np.where(same, self.low[:-1], low[1:])
        high[:-1] = np.where(same, self.high[1:], high[:-1])
        return same, np.minimum(low, self.low), np.maximum(high, self.high)

    def runs_replaced(self) -> Symbols:
        """Every maximal run of one symbol as one symbol."""
        if not len(self.name):
            return self
        same, low, high = self._neighbours()
        begins = np.ones(len(self.name), bool)
        begins[1:] = ~(same & (self.name[1:] == self.name[:-1]))
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(begins)) - 1
        length = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        name = np.where(length > 1, mixed(name * _LEFT + length), name)
        return Symbols(name, self.start[first], self.end[last], low[first], high[last], self.text[first])

    def pairs_merged(self, number: int) -> Symbols:
        """Neighbours with coins 0 and 1 as one symbol."""
        if not len(self.name):
            return self
        same, low, high = self._neighbours()
        coin = (mixed(self.name + np.uint64(number)) & np.uint64(1)).astype(bool)
        merged = np.zeros(len(self.name), bool)
        merged[:-1] = same & ~coin[:-1] & coin[1:]
        gone = np.zeros(len(self.name), bool)
        gone[1:] = merged[:-1]
        following = np.minimum(np.arange(len(merged)) + 1, len(merged) - 1)
        # A pair is decided by its own names, a single symbol by its coin's side as well.
        low = np.where(merged | ~coin, self.low, low)
        high = np.where(merged, self.high[following], np.where(coin, self.high, high))
        name = np.where(merged, mixed(self.name * _LEFT ^ mixed(self.name[following] * _RIGHT)), self.name)
        end = np.where(merged, self.end[following], self.end)
        kept = ~gone
        return Symbols(name[kept], self.start[kept], end[kept], low[kept], high[kept], self.text[kept])


    def phrases(self, length: int) -> Symbols:
        """Every ``length`` neighbouring symbols of one text as one symbol."""
        count = len(self.name) - length + 1
        if count < 1:
            return Symbols(*[x[:0] for x in (self.name, self.start, self.end, self.low, self.high, self.text)])
        name = self.name[:count]
        for k in range(1, length):
            name = mixed(name * _LEFT ^ mixed(self.name[k : count + k] * _RIGHT))
        last = slice(length - 1, None)
        one = self.text[:count] == self.text[last]
        return Symbols(
            name[one], self.start[:count][one], self.end[last][one], self.low[:count][one],
            self.high[last][one], self.text[:count][one],
        )


def _range_minimum(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[begin:end] for ranges that are not empty."""
    out = np.empty(len(begin), values.dtype)
    size = end - begin
    width, table = 1, values
    while len(size):
        here = (size >= width) & (size < 2 * width)
        if here.any():
            a, b = begin[here], end[here]
            out[here] = np.minimum(table[a], table[b - width])
        if not (size >= 2 * width).any():
            return out
        table = np.minimum(table[: len(table) - width], table[width:])
        width *= 2
    return out


def window_keys(words: Words, hashes: np.ndarray, window: int, rounds: int):
    """(first word, key, digest) of every window."""
    at = words.spans(window)
    digest = run_hashes(hashes, window)[at]
    # A window without a phrase has a second digest, independent of the first, as its key.
    key = run_hashes(words.hashes(1), window)[at]
    symbols = Symbols.of_words(hashes, words.text_of)
    for number in range(rounds):
        symbols = symbols.runs_replaced().pairs_merged(number)
    symbols = symbols.phrases(PHRASE)
    short = (symbols.end - symbols.start < LONG_PHRASE).astype(np.uint64)
    rank = (mixed(symbols.name) >> np.uint64(1)) | (short << np.uint64(63))
    begin = np.searchsorted(symbols.low, at, "left")
    end = np.searchsorted(symbols.high, at + window, "right")
    held = begin < end
    key[held] = _range_minimum(rank, begin[held], end[held])
    return at, key, digest


def _parsed(window: int, rounds: int):
    """Documents -> digest of all words, digest of the kept text, and distinct window keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, end, words in steps(batch.column("text")):
                hashes = words.hashes()
                at, key, _ = window_keys(words, hashes, window, rounds)
                text = words.text_of[at] if len(at) else at
                other = np.ones(len(at), bool)
                other[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                key, text = key[other], text[other]
                order = np.lexsort((key, text))
                key, text = key[order], text[order]
                other = np.ones(len(key), bool)
                other[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                key, text = key[other], text[other]
                offsets = np.searchsorted(text, np.arange(words.texts + 1)).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(key)))
                data = words.data.tobytes()
                bounds = [(words.starts[a], words.ends[b - 1]) if b > a else (0, 0)
                          for a, b in zip(words.first[:-1], words.first[1:])]
                shas = [hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in bounds]
                whole = whole_hashes(hashes, words.first)
                again = whole_hashes(words.hashes(1), words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row),
                        batch.column("row").slice(row, end - row),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(signed(whole)),
                        pa.array(signed(again)),
                        pa.array(shas, pa.string()),
                        keys,
                    ],
                    names=["doc_id", "row", "n_words", "whole", "again", "sha", "keys"],
                )

    return run


PARSED = "doc_id long, row long, n_words long, whole long, again long, sha string, keys array<long>"


def _windows(window: int, rounds: int):
    """Documents with their shared keys -> the windows that have one of those keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            shared = batch.column("shared")
            for row, end, words in steps(batch.column("text")):
                at, key, digest = window_keys(words, words.hashes(), window, rounds)
                if not len(at):
                    continue
                text = words.text_of[at]
                part = shared.slice(row, end - row)
                wanted = part.flatten().to_numpy().view(np.uint64)
                of = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
                held = np.isin(_tagged(key, text), _tagged(wanted, of))
                at, key, digest, text = at[held], key[held], digest[held], text[held]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(key)),
                        pa.array(signed(digest)),
                        pa.array(ids[row:end][text]),
                        batch.column("row").slice(row, end - row).take(pa.array(text)),
                        pa.array((at - words.first[text]).astype(np.int32)),
                    ],
                    names=["key", "digest", "doc_id", "row", "at"],
                )

    return run


def _tagged(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Key and text as one number; a chance match only adds a window that is then compared."""
    return key * _LEFT + mixed(text.astype(np.uint64) + _RIGHT)


def _kept(window: int):
    """Documents with the starts of their repeated windows -> what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, texts = [], []
            for text, starts in zip(
                batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True
            ):
                words = text.encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.array(starts, np.int64))
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                gone = np.cumsum(edges[:-1]) > 0
                removed.append(int(gone.sum()))
                texts.append(b" ".join([words[k] for k in np.flatnonzero(~gone)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "row", "n_removed", "kept_text"],
            )

    return run


def _told_apart(rows: DataFrame, several: DataFrame, digest: Column) -> DataFrame:
    """``rows`` with ``row``: the digest where the doc_id is missing or among ``several``, else 0."""
    few = several.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    several = several.withColumn("_several", F.lit(True))
    marked = rows.join(F.broadcast(several) if few else several, "doc_id", "left")
    differ = F.coalesce(F.col("_several"), F.col("doc_id") == LAST_ID)
    return marked.withColumn("row", F.when(differ, digest).otherwise(F.lit(0).cast("long"))).drop("_several")


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept_text.

    A word goes if a window of ``window`` words around it starts in a document with a
    smaller doc_id as well; windows are judged on the input. ``kept_text`` holds the
    kept words joined by one space and is null where nothing was removed. Null and
    empty texts have no words. Every row is cut by itself; rows that share a doc_id do
    not remove from each other. Rows without doc_id come after all others and do not
    remove from each other either. Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    with_batches(spark)
    texts = docs.select(ordered_id(docs).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    every = texts.withColumn("row", F.xxhash64("text"))
    parsed = stored(every.mapInArrow(_parsed(window, rounds), PARSED), "substring-parsed")
    several = stored(
        parsed.filter(F.col("doc_id") != LAST_ID)
        .groupBy("doc_id")
        .agg(F.min("row").alias("low"), F.max("row").alias("high"))
        .filter("low <> high")
        .select("doc_id"),
        "substring-several",
    )
    parsed = _told_apart(parsed, several, F.col("row"))
    texts = _told_apart(texts, several, F.xxhash64("text"))
    first = (
        parsed.filter(F.col("n_words") >= window)
        .groupBy(F.col("whole").alias("w"), F.col("again").alias("a"))
        .agg(F.min("doc_id").alias("first_id"))
    )
    classed = stored(
        parsed.join(first, (F.col("whole") == F.col("w")) & (F.col("again") == F.col("a")), "left").select(
            "doc_id", "row", "n_words", "sha", (F.col("first_id") < F.col("doc_id")).alias("copy")
        ),
        "substring-classes",
    )
    # Only one document of each class of equal ones takes part from here on.
    copies = stored(classed.filter("copy").select("doc_id", "row").distinct(), "substring-copies")
    keyed = rows_with_ids(parsed.select("doc_id", "row", "keys"), copies, "left_anti")
    keyed = keyed.select("doc_id", "row", F.explode("keys").alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low <> high")
        .select("key")
    )
    wanted = keyed.join(shared, "key").groupBy("doc_id", "row").agg(F.collect_set("key").alias("shared"))
    suspects = stored(texts.join(wanted, ["doc_id", "row"]), "substring-suspects")
    windows = stored(
        suspects.mapInArrow(_windows(window, rounds), "key long, digest long, doc_id long, row long, at int"),
        "substring-windows",
    )
    origin = (
        windows.groupBy("key", "digest")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low <> high")
        .drop("high")
    )
    starts = (
        windows.join(origin, ["key", "digest"])
        .filter("low < doc_id")
        .groupBy("doc_id", "row")
        .agg(F.collect_set("at").alias("starts"))
    )
    cut = (
        suspects.select("doc_id", "row", "text")
        .join(starts, ["doc_id", "row"])
        .mapInArrow(_kept(window), "doc_id long, row long, n_removed long, kept_text string")
        .groupBy("doc_id", "row")
        .agg(F.max(F.struct("n_removed", "kept_text")).alias("_cut"))
        .withColumnsRenamed({"doc_id": "cut_id", "row": "cut_row"})
    )
    copy = F.coalesce(F.col("copy"), F.lit(False))
    text = F.when(copy, F.lit("")).otherwise(F.col("_cut.kept_text"))
    return classed.join(cut, (F.col("doc_id") == F.col("cut_id")) & (F.col("row") == F.col("cut_row")), "left").select(
        F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("_cut.n_removed", F.lit(0))).alias("n_removed"),
        F.coalesce(F.sha2(text, 256), F.col("sha")).alias("kept_sha256"),
        text.alias("kept_text"),
    )
