"""Maximal periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of words with smallest period q (words q apart are equal), at least
2 * q and at least ``least`` words long, that no neighbouring word extends. Put
differently: an *equality interval* [s, e) of shift q, in which word i equals word
i + q, is a run s .. e + q - 1 if it is long enough and no shorter period fits.

Scale-tiled distribution:

* A document is exploded into overlapping tiles per octave of periods, 2^k <= q <
  2^(k+1). A tile's core holds the boundaries it answers for; its margins reach as far
  as extensions are followed. Periods below 2^12 share a tile, so most documents have one.
* Tiles are solved independently. Boundaries lie so close that every run of the octave
  has one with a whole window of its interval to the right. Extensions of a boundary to
  both sides at every period of the octave are its Z values (of the text behind it, and
  of the reversed text before it). They are found for all boundaries and periods of a
  tile at once, by doubling over names of windows of 2^j words, instead of one Z scan
  per boundary; values are the same, cut off at the margins.
* What a tile finds are interval fragments. They are shuffled by document and period
  and stitched where they meet; a run is as long as its fragments together.
* A fragment whose first q words repeat a shorter word sequence has a smaller period and
  is dropped in the tile; all fragments of a run decide alike.

A document without two equal windows of least / 2 words has no run and is finished where
it is read; only the texts of others are stored and shuffled.

Every row is a document of its own, whatever its ``doc_id``: rows without one or with
equal ones, and repeated rows, each get their result. Null and empty texts have no words.
Columns other than ``doc_id`` and ``text`` are ignored. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.llm.tables import stored, with_batches
from hypnolith.llm.words import Words, mixed, run_hashes, steps

LEAST = 12
#: Words of a tile's core, and the octaves that share such tiles.
CORE = 1 << 13
SHARED_OCTAVES = 12

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

TILES = "row_id long, n_words long, core long, at long, low int, high int, words binary"
FRAGMENTS = "row_id long, period long, first long, last long"
RUN = "struct<start:long,length:long,period:long>"


def _needed(period: np.ndarray, least: int) -> np.ndarray:
    """Length of the equality interval of a run with this period."""
    return np.maximum(period, least - period)


def _grid(octave: int, least: int) -> tuple[int, int, int]:
    """(level of the window names to start from, distance of boundaries, words followed)."""
    short = int(_needed(np.arange(1 << octave, 2 << octave), least).min())
    level = max(0, short.bit_length() - 2)
    return level, short - (1 << level) + 1, max(2 << octave, least)


class _Names:
    """Names of the windows of 2^j words of a tile: equal exactly if the words are."""

    def __init__(self, words: np.ndarray):
        self.levels = [words]

    def __getitem__(self, level: int) -> np.ndarray:
        while len(self.levels) <= level:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            if len(last) <= half:
                self.levels.append(last[:0])
            else:
                self.levels.append(mixed((last[:-half] * _LEFT) ^ mixed(last[half:] + _RIGHT)))
        return self.levels[level]

    def equal(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at a and b agree; False if one leaves the tile."""
        names = self[level]
        if not len(names):
            return np.zeros(len(a), bool)
        inside = (a >= 0) & (b < len(names))
        return inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])

    def extended(self, a: np.ndarray, b: np.ndarray, top: int, back: bool) -> np.ndarray:
        """Words that agree from a and b on (or, ``back``, before them), up to 2^(top + 1) - 1."""
        size = np.zeros(len(a), np.int64)
        for level in range(top, -1, -1):
            step = 1 << level
            go = -size - step if back else size
            size += step * self.equal(level, a + go, b + go)
        return size


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _is_primitive(names: _Names, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the ``period`` words at ``at`` are no repetition of fewer words."""
    out = np.ones(len(at), bool)
    for q in np.unique(period):
        here = np.flatnonzero(period == q)
        for prime in _primes(int(q)):
            part = int(q) // prime
            size = int(q) - part
            level = size.bit_length() - 1
            a, end = at[here], at[here] + size - (1 << level)
            out[here] &= ~(names.equal(level, a, a + part) & names.equal(level, end, end + part))
    return out


def solve_tile(words: np.ndarray, core: int, at: int, n_words: int, low: int, high: int, least: int):
    """(period, first, last) of the equality intervals found from a tile's boundaries.

    words: hashes of words ``at`` .. of a text of n_words; boundaries are those from word
    ``core`` on, up to the next core.
    """
    names, found = _Names(words), []
    for octave in range(low, high + 1):
        periods = np.arange(1 << octave, min(2 << octave, n_words // 2 + 1))
        if not len(periods):
            break
        level, apart, reach = _grid(octave, least)
        begin = -(-core // apart) * apart
        cuts = np.arange(begin, min(core + _core_words(octave), n_words), apart) - at
        window = names[level]
        cuts = cuts[cuts < len(window) - int(periods[0])]
        if not len(cuts):
            continue
        other = cuts[:, None] + periods[None]
        same = (window[np.minimum(other, len(window) - 1)] == window[cuts][:, None]) & (other < len(window))
        row, column = np.nonzero(same)
        if not len(row):
            continue
        a, q = cuts[row], periods[column]
        top = reach.bit_length() - 1
        first = a - names.extended(a, a + q, top, back=True)
        last = a + names.extended(a, a + q, top, back=False)
        long_ = last - first >= _needed(q, least)
        if long_.any():
            q, first, last = _merged(q[long_], first[long_], last[long_])
            whole = _is_primitive(names, first, q)
            found += [
                (p, f + at, e + at)
                for p, f, e in zip(q[whole].tolist(), first[whole].tolist(), last[whole].tolist())
                if np.array_equal(words[f:e], words[f + p : e + p])
            ]
    return found


def _merged(period: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Intervals of one period that meet, as one."""
    wide = int(last.max()) + 2
    a, b = period * wide + first, period * wide + last
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    begins = np.ones(len(a), bool)
    begins[1:] = a[1:] > b[:-1]
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(a)) - 1
    return a[start] // wide, a[start] % wide, b[end] % wide


def _core_words(octave: int) -> int:
    return CORE if octave < SHARED_OCTAVES else 4 << octave


def tiles_of(n_words: int, least: int = LEAST) -> Iterator[tuple[int, int, int, int, int]]:
    """(core, first word, end word, lowest octave, highest octave) of a text's tiles."""
    top = (n_words // 2).bit_length() - 1
    low = 0
    while low <= top and n_words >= least:
        high = max(low, min(top, SHARED_OCTAVES - 1))
        reach = 2 * max(_grid(k, least)[2] for k in range(low, high + 1))
        for core in range(0, n_words, _core_words(high)):
            end = core + _core_words(high) + (2 << high) + 2 * reach
            yield core, max(0, core - reach), min(n_words, end), low, high
        low = high + 1


def _repeats_windows(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Texts of which a window of ``size`` words occurs twice."""
    at, text = words.spans(size), words.text_of
    out = np.zeros(words.texts, bool)
    if len(at):
        text = text[at]
        window = run_hashes(hashes, size)[at]
        order = np.argsort(mixed(window + text.astype(np.uint64) * _LEFT), kind="stable")
        again = (window[order][1:] == window[order][:-1]) & (text[order][1:] == text[order][:-1])
        out[text[order][1:][again]] = True
    return out


def _parsed(least: int, texts: bool):
    """Documents -> rows with an id of their own; the words of those that may have runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("doc_id")
            for row, end, words in steps(batch.column("text")):
                open_ = _repeats_windows(words, words.hashes(), max(1, least // 2))
                raw = words.data.tobytes()
                joined = [b" ".join(raw[a:b].split()) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + end - row)),
                        ids.slice(row, end - row),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(open_),
                        pa.array([None if o else hashlib.sha256(j).hexdigest() for o, j in zip(open_, joined)], pa.string()),
                        pa.array([j.decode() if o or texts else None for o, j in zip(open_, joined)], pa.string()),
                    ],
                    names=["row_id", "doc_id", "n_words", "open", "collapsed_sha256", "text"],
                )
                number += end - row

    return run


def _tiled(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, words in steps(batch.column("text")):
                hashes = words.hashes()
                for k in range(row, end):
                    own = hashes[words.first[k - row] : words.first[k - row + 1]]
                    row_id = batch.column("row_id")[k].as_py()
                    tiles = [(row_id, len(own), c, a, lo, hi, own[a:b].tobytes()) for c, a, b, lo, hi in tiles_of(len(own), least)]
                    for part in range(0, len(tiles), 16):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip(zip(*tiles[part : part + 16]), _TILE_TYPES)], names=_TILE_NAMES
                        )

    return run


_TILE_NAMES = [c.split()[0] for c in TILES.split(", ")]
_TILE_TYPES = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]


def _solved(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tile in batch.to_pylist():
                words = np.frombuffer(tile["words"], np.uint64)
                found = solve_tile(words, tile["core"], tile["at"], tile["n_words"], tile["low"], tile["high"], least)
                rows += [(tile["row_id"], *f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["row_id", "period", "first", "last"]
            )

    return run


def stitched(fragments: DataFrame) -> DataFrame:
    """row_id, start, length, period of the runs that interval fragments make up."""
    order = Window.partitionBy("row_id", "period").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        fragments.withColumn("begins", F.when(F.col("first") <= reached, 0).otherwise(1))
        .withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row_id", "period", "run")
        .agg(F.min("first").alias("start"), F.max("last").alias("last"))
        .select("row_id", "start", (F.col("last") - F.col("start") + F.col("period")).alias("length"), "period")
    )


def _with_row_ids(docs: DataFrame, least: int, texts: bool) -> DataFrame:
    with_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "row_id long, doc_id long, n_words long, open boolean, collapsed_sha256 string, text string"
    return stored(rows.mapInArrow(_parsed(least, texts), schema), "runs-parsed")


def _runs_of(parsed: DataFrame, least: int) -> DataFrame:
    tiles = parsed.filter("open").select("row_id", "text").mapInArrow(_tiled(least), TILES)
    return stitched(tiles.mapInArrow(_solved(least), FRAGMENTS))


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, start (word number), length, period of every run, one row each.

    Rows that share a doc_id each contribute their runs. ``least`` is the least length.
    """
    parsed = _with_row_ids(docs, _valid(least), False)
    return _runs_of(parsed, least).join(parsed.select("row_id", "doc_id"), "row_id").drop("row_id")


def _valid(least: int) -> int:
    if least < 2:
        raise ValueError("a run has at least 2 words")
    return least


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with runs -> the words that stay: each run but its first period goes."""
    for batch in batches:
        kept, sums = [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = text.split(" ") if text else []
            edge = np.zeros(len(words) + 1, np.int64)
            for r in runs or ():
                edge[r["start"] + r["period"]] += 1
                edge[r["start"] + r["length"]] -= 1
            stays = np.cumsum(edge[:-1]) == 0
            kept.append(" ".join(w for w, s in zip(words, stays.tolist()) if s))
            sums.append(hashlib.sha256(kept[-1].encode()).hexdigest())
        arrays = [batch.column(c) for c in ("doc_id", "n_words", "runs")]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(kept, pa.string()), pa.array(sums, pa.string())],
            names=["doc_id", "n_words", "runs", "kept_text", "collapsed_sha256"],
        )


def collapse_runs(docs: DataFrame, least: int = LEAST, texts: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period), kept_text, collapsed_sha256.

    kept_text are the words, joined by one space, that are in the first period of every
    run that holds them or in no run; collapsed_sha256 is its digest. Without ``texts``
    only texts that may hold runs are carried, and kept_text is NULL for the others.
    """
    parsed = _with_row_ids(docs, _valid(least), texts)
    runs = _runs_of(parsed, least).groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    )
    by_period = F.array_sort("runs", lambda a, b: F.when(a.start == b.start, (a.period - b.period).cast("int")).otherwise(F.when(a.start < b.start, -1).otherwise(1)))
    none = F.array().cast(f"array<{RUN}>")
    schema = f"doc_id long, n_words long, runs array<{RUN}>, kept_text string, collapsed_sha256 string"
    open_ = (
        parsed.filter("open").join(runs.withColumn("runs", by_period), "row_id", "left")
        .select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "text")
        .mapInArrow(_collapsed, schema)
    )
    rest = parsed.filter("NOT open").select(
        "doc_id", "n_words", none.alias("runs"), F.col("text").alias("kept_text"), "collapsed_sha256"
    )
    return open_.unionByName(rest)


def report(collapsed: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests per row of :func:`collapse_runs`."""
    first = lambda a, b: F.when(a.length != b.length, F.when(a.length > b.length, -1).otherwise(1)).otherwise(
        F.when(a.start != b.start, F.when(a.start < b.start, -1).otherwise(1)).otherwise(F.when(a.period < b.period, -1).otherwise(1))
    )
    longest = F.aggregate("runs", F.lit(None).cast(RUN), lambda best, r: F.when(best.isNull() | (first(r, best) == -1), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return collapsed.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_longest.start").alias("start"),
        F.col("_longest.length").alias("length"),
        F.col("_longest.period").alias("period"),
        F.expr("1000 * _longest.length div _longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document, by its id's checksum, turns periodic.

    With h = crc32 of the decimal id and g = h div 10: if h % 10 = 0, words from place
    g % n on repeat the first 1 + (n - g % n) div (3 + g % 8) of them. Rows without
    doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(h % 10 == 0, F.lit(False)).alias("_planted"), F.floor(h / 10).alias("_g"),
    )
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = marked.filter("_planted").withColumn("_words", split)
    n, g = F.size("_words"), F.col("_g")
    shape = F.expr("CAST(IF(size(_words) > 0, _g % size(_words), 0) AS INT)")
    placed = words.withColumn("_a", shape).withColumn("_p", (F.floor((n - F.col("_a")) / (3 + g % 8)) + 1).cast("int"))
    periodic = F.expr("transform(_words, (w, i) -> IF(i < _a, w, _words[_a + (i - _a) % _p]))")
    planted = placed.select("doc_id", F.array_join(periodic, " ").alias("text"))
    return marked.filter("NOT _planted").select("doc_id", "text").unionByName(planted)
