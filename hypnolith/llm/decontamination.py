"""Benchmark decontamination: windows within an edit bound of a benchmark item.

Words are compared, with A-Z lower-cased and other ASCII characters as separators. An
item of m words may differ by up to k = EDIT_RATE * m words from a window. Items of fewer
than EXACT_BELOW words allow no edit: they are found by the digest of all their words,
which is compared with that of every window of their length, and the rest does not
concern them.

* Of the k + 1 pairs of words at an item's places 0, 2, .., 2k one is untouched by k
  edits. A window therefore starts, in step with the item, at a place of the text
  where one of those pairs stands; no other window can match.
* The window and the item from that pair on are walked through the CGK embedding: a
  walk stays on a word or goes on by a coin drawn from (step, word), so that two
  texts near in edits give sequences near in Hamming distance.
* Bit-sampling LSH: a window is a candidate if for one of WALKS * SAMPLES draws it
  agrees with the item at all BITS sampled steps, which lie among the first MOST_STEPS.
  That many draws reach the target recall (tests measure it). Of an item's walks
  only digests of the draws are kept, some 400 bytes per pair of the item.
* Candidates that place an item within its edit bound of each other are verified
  together, by the exact edit distance of the whole item to any part of the text around.

Items are sent to all executors in groups of bounded size, one pass over the text per
group; documents are neither shuffled nor gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import LAST_ID, ordered_id, with_batches
from hypnolith.llm.words import NOT_ALNUM, Words, mixed, run_hashes, steps

EDIT_RATE = 0.2
#: Shorter items are looked for as they are.
EXACT_BELOW = 8
WALKS, SAMPLES, BITS = 4, 12, 3
#: Steps of a walk that are sampled; longer items are told by the exact distance.
MOST_STEPS = 4096
#: Characters of items in one group (some 30 MB in a task).
GROUP_CHARS = 1 << 21
_PAD = np.uint64(0x5BD1E9955BD1E995)
_FILTER_BITS = 20
# Walks taken at a time, and steps of all of them.
_PAIRS, _STEPS = 1 << 15, 1 << 22


def edit_bound(words: int) -> int:
    """Edits allowed to an item, such that its pairs lie inside it."""
    return 0 if words < EXACT_BELOW else min(int(EDIT_RATE * words), words // 2 - 1)


def walk(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, steps_: int, seed: int) -> np.ndarray:
    """CGK embedding of symbols[begin:end] (one row each): the symbol at every step."""
    out = np.empty((len(begin), steps_), np.uint64)
    at = begin.copy()
    last = max(0, len(symbols) - 1)
    for step in range(steps_):
        here = np.where(at < end, symbols[np.minimum(at, last)], _PAD)
        out[:, step] = here
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * (step + 1000 * seed) + 1)) % (1 << 64))
        at = at + ((here * odd) >> np.uint64(63)).astype(np.int64)
    return out


def fitting_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least edit distance of the whole item to any part of the text, end of that part).

    Bit-parallel: one step per word of text, columns of the table as two integers.
    """
    masks: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | (1 << k)
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, where = size, 0
    for k, word in enumerate(text.tolist()):
        equal = masks.get(word, 0)
        x = equal | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        right_up = down | (full & ~(d0 | up))
        right_down = up & d0
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = (right_up << 1) & full
        right_down = (right_down << 1) & full
        up = right_down | (full & ~(d0 | right_up))
        down = right_up & d0
        if score < best:
            best, where = score, k + 1
    return best, where


#: Places of the samples, as parts of the walked steps.
_DRAW = np.random.RandomState(7).random_sample((WALKS, SAMPLES, BITS))


def _draws(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
    """Digests of the SAMPLES draws of a walk over symbols[begin:end]; ``length`` is the item's."""
    walked = np.minimum(2 * length, MOST_STEPS)
    at = (_DRAW[number].reshape(1, -1) * walked[:, None]).astype(np.int64)
    seen = np.take_along_axis(walk(symbols, begin, end, int(walked.max()), number), at, axis=1)
    seen = seen.reshape(len(begin), SAMPLES, BITS)
    digest = seen[:, :, 0]
    for k in range(1, BITS):
        digest = mixed(digest * np.uint64(0x9E3779B97F4A7C15) ^ mixed(seen[:, :, k]))
    return digest


def _portions(length: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of walks, by length, in portions whose walks fit in memory."""
    order, k = np.argsort(length, kind="stable"), 0
    while k < len(order):
        part = order[k : k + _PAIRS]
        walked = np.minimum(2 * length[part], MOST_STEPS)
        part = part[: max(1, int(np.searchsorted(walked * np.arange(1, len(part) + 1), _STEPS, "right")))]
        yield part
        k += len(part)


class Items:
    """Items in a form that tasks search with: in memory they grow with the items' words alone."""

    def __init__(self, rows: list[tuple[int, str]]):
        texts = pa.array([text or "" for _, text in rows], pa.string())
        self.ids, self.words, entries = [], [], []
        self.exact: dict[int, list] = {}
        for row, _, found in steps(texts, lower=True, separators=NOT_ALNUM):
            hashes = found.hashes()
            for k in range(found.texts):
                item = hashes[found.first[k] : found.first[k + 1]]
                if not len(item):
                    continue
                if len(item) < EXACT_BELOW:
                    self.exact.setdefault(len(item), []).append((int(run_hashes(item, len(item))[0]), len(self.ids)))
                else:
                    entries += [(len(self.ids), 2 * j) for j in range(edit_bound(len(item)) + 1)]
                self.ids.append(rows[row + k][0])
                self.words.append(item)
        self.exact = {
            size: (np.array([d for d, _ in sorted(own)], np.uint64), np.array([i for _, i in sorted(own)], np.int64))
            for size, own in self.exact.items()
        }
        entry = np.array(entries, np.int64).reshape(-1, 2)
        sizes = np.array([len(w) for w in self.words], np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.concatenate([*self.words, np.zeros(2, np.uint64)])
        begin = first[entry[:, 0]] + entry[:, 1]
        pair = run_hashes(flat, 2)[begin]
        order = np.argsort(pair, kind="stable")
        self.pair, self.item, self.offset = pair[order], entry[order, 0], entry[order, 1]
        begin, self.length = begin[order], sizes[self.item] - self.offset
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.pair >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.draws = np.zeros((WALKS, len(order), SAMPLES), np.uint64)
        for part in _portions(self.length):
            for w in range(WALKS):
                self.draws[w, part] = _draws(flat, begin[part], begin[part] + self.length[part], self.length[part], w)

    def candidates(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat word place, entry) of windows that agree with an entry in some sample."""
        at = words.spans(2)
        pairs = run_hashes(hashes, 2)[at]
        some = self.maybe[(pairs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        at, pairs = at[some], pairs[some]
        low, high = np.searchsorted(self.pair, pairs, "left"), np.searchsorted(self.pair, pairs, "right")
        times = high - low
        place = np.repeat(at, times)
        entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        last = np.repeat(words.first[1:], words.counts)
        places, entries = [place[:0]], [entry[:0]]
        for part in _portions(self.length[entry]):
            p, e = place[part], entry[part]
            end = np.minimum(last[p], p + self.length[e] + 8)
            hit = np.zeros(len(p), bool)
            for w in range(WALKS):
                hit |= (_draws(hashes, p, end, self.length[e], w) == self.draws[w, e]).any(axis=1)
            places.append(p[hit])
            entries.append(e[hit])
        return np.concatenate(places), np.concatenate(entries)

    def _as_they_are(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, end in words) of the first place of every short item in every text."""
        for size, (digest, item) in self.exact.items():
            at = words.spans(size)
            window = run_hashes(hashes, size)[at]
            low, high = np.searchsorted(digest, window, "left"), np.searchsorted(digest, window, "right")
            times = high - low
            place = np.repeat(at, times)
            number = item[np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            text = words.text_of[place]
            _, first = np.unique(text * len(self.ids) + number, return_index=True)
            for k in first.tolist():
                if np.array_equal(hashes[place[k] : place[k] + size], self.words[number[k]]):
                    yield int(text[k]), int(number[k]), int(place[k] + size - words.first[text[k]])

    def leaks(self, words: Words) -> dict[tuple[int, int], tuple[int, int]]:
        """{(text, item): (distance, end of the passage in words)} of verified matches."""
        hashes = words.hashes()
        found = {(t, number): (0, end) for t, number, end in self._as_they_are(words, hashes)}
        place, entry = self.candidates(words, hashes)
        text, number = words.text_of[place], self.item[entry]
        start = place - self.offset[entry]
        order = np.lexsort((start, number, text))
        begin = end = last = None
        key: tuple[int, int] | None = None
        for k in [*order.tolist(), None]:
            own = None if k is None else (int(text[k]), int(number[k]))
            if key is not None and (own != key or start[k] - last > edit_bound(len(self.words[key[1]]))):
                self._verified(words, hashes, key, begin, end, found)
                key = None
            if own is None:
                break
            bound = edit_bound(len(self.words[own[1]]))
            if key is None:
                key, begin, end = own, int(start[k]) - bound, 0
            last = int(start[k])
            end = max(end, last + len(self.words[own[1]]) + bound)
        return found

    def _verified(self, words: Words, hashes: np.ndarray, key: tuple[int, int], begin: int, end: int, found: dict) -> None:
        """Note the item in the text between two places, if it is near enough there."""
        text, number = key
        item, first = self.words[number], int(words.first[text])
        if found.get(key, (1, 0))[0] == 0:
            return
        begin, end = max(first, begin), min(int(words.first[text + 1]), end)
        distance, where = fitting_distance(item, hashes[begin:end])
        if distance <= edit_bound(len(item)):
            best = (distance, begin + where - first)
            found[key] = min(best, found.get(key, best))


def _item_groups(items: DataFrame, group_chars: int) -> list[DataFrame]:
    """The items in groups of some ``group_chars``, by digest of the id."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-chars // group_chars))
    if groups == 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == k) for k in range(groups)]


def _find(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for row, _, words in steps(batch.column("text"), lower=True, separators=NOT_ALNUM):
                found = items.value.leaks(words)
                if found:
                    rows = [
                        (ids[row + t], items.value.ids[i], d, len(items.value.words[i]), end)
                        for (t, i), (d, end) in sorted(found.items())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(r[k]) for r in rows], pa.int64()) for k in range(5)],
                        names=["doc_id", "item_id", "distance", "item_words", "end_word"],
                    )

    return run


LEAKS = "doc_id long, item_id long, distance long, item_words long, end_word long"


def find_leaks(docs: DataFrame, items: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """Per document and item found in it: doc_id, item_id, distance, item_words, end_word.

    ``distance`` is the least edit distance in words of the item to a part of the
    text, ``end_word`` that part's end. Null and empty texts hold nothing; items that
    are null, without id or without words are not looked for. A short item is found
    wherever its words stand in a row, a single word in every text that has it.
    Repeated rows and rows that share a doc_id count once, with the best match; rows
    without doc_id are reported together under null. Other columns are ignored, empty
    tables on either side give an empty result.
    """
    spark = docs.sparkSession
    with_batches(spark)
    texts = docs.select(
        ordered_id(docs).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    found = None
    for group in _item_groups(items, group_chars):
        sent = spark.sparkContext.broadcast(Items([tuple(r) for r in group.collect()]))
        part = texts.mapInArrow(_find(sent), LEAKS)
        found = part if found is None else found.unionByName(part)
    best = found.groupBy("doc_id", "item_id", "item_words").agg(F.min(F.struct("distance", "end_word")).alias("_m"))
    return best.select(
        F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"),
        "item_id", "_m.distance", "item_words", "_m.end_word",
    )


def _clean(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            text = batch.column(batch.schema.get_field_index("text"))
            for row, _, words in steps(text, lower=True, separators=NOT_ALNUM):
                for t, _ in items.value.leaks(words):
                    kept[row + t] = False
            yield batch.filter(pa.array(kept))

    return run


def without_leaks(docs: DataFrame, items: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns as they were."""
    spark = docs.sparkSession
    with_batches(spark)
    for group in _item_groups(items, group_chars):
        sent = spark.sparkContext.broadcast(Items([tuple(r) for r in group.collect()]))
        docs = docs.mapInArrow(_clean(sent), docs.schema)
    return docs
