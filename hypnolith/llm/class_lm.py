"""Scores by a class-based n-gram model: P(word | previous) = P(class | previous class) * P(word | class).

* Exchange clustering on class bigrams: a word's contexts are the classes of the words
  before and after it. The ``FREQUENT`` most frequent words are dealt to classes by rank
  and exchanged: in each round their contexts are counted over all training text, and
  every word moves to the class under which its contexts are most likely, given the
  class counts of the round before. All words move at once, so that a round is one
  pass; tasks share the classes of those words only, at 9 bytes a word, a bound that
  does not depend on the input.
* All other words then take the class that is likeliest for their contexts, counted once
  over all training text. Where a neighbour is not frequent, its class is the one more of
  rare words, here as context. Words seen once form that class, from which unseen words
  are drawn as well; no number of words limits the vocabulary.
* Documents are dealt into buckets of some ``BUCKET_BYTES``. A bucket asks for its
  distinct words' counts and classes (a join on the word), and its documents are
  read against the answer; no vocabulary is held whole by anyone. What is left per
  document is its sequence of classes, one byte a word, from which transitions are
  counted and then scored.

Words are known by 60 bits of a digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import stored, with_batches
from hypnolith.llm.words import Words, mixed, steps

CLASSES = 64  # and one more, of words seen once
CONTEXTS = 2 * (CLASSES + 1)  # class before, class after
#: Words whose classes are exchanged; a bound on what tasks share, not on the vocabulary.
FREQUENT = 1 << 14
ROUNDS = 3
BUCKET_BYTES = 16 << 20
#: Weight of the class frequencies in a transition probability, in observations.
PRIOR = 10.0
# Tokens that a task counts before it hands on what it has.
FLUSH_TOKENS = 1 << 21

_KEEP = ~np.uint64(15)
END = mixed(np.array([0x656E64], np.uint64))[0] & _KEEP


def text_tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(token of every word and the end after each text, first token of each text and the end)."""
    counts = words.counts + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.full(int(first[-1]), END, np.uint64)
    tokens[np.arange(len(words.starts)) + words.text_of] = words.hashes() & _KEEP
    return tokens, first


@dataclass(frozen=True)
class Frequent:
    """Digests of frequent words, ascending, and the class of each."""

    words: np.ndarray
    classes: np.ndarray

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is frequent, class: ``CLASSES`` if it is not) of each token."""
        if not len(self.words):
            return np.zeros(len(tokens), bool), np.full(len(tokens), CLASSES, np.uint64)
        place = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        held = self.words[place] == tokens
        return held, np.where(held, self.classes[place], CLASSES).astype(np.uint64)


def _pairs(tokens: np.ndarray, first: np.ndarray, frequent: Frequent, chosen: bool) -> tuple[np.ndarray, np.ndarray]:
    """(word, context) of the frequent words (``chosen``) or of all others. Texts begin after an end."""
    held, kind = frequent.find(tokens)
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[first[:-1]] = kind[first[1:] - 1]
    after = np.empty_like(kind)
    after[:-1] = kind[1:]
    inner = np.ones(len(tokens), bool)
    inner[first[1:] - 1] = False  # nothing stands after an end
    held = held == chosen
    words = np.concatenate([tokens[held], tokens[held & inner]])
    return words, np.concatenate([before[held], after[held & inner] + np.uint64(CLASSES + 1)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts -> (word, n) of what one task has seen."""
    held: list[np.ndarray] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for _, _, words in steps(batch.column("text"), lower=True):
            tokens, _ = text_tokens(words)
            held.append(tokens)
            waiting += len(tokens)
            if waiting >= FLUSH_TOKENS:
                yield flush()
                held, waiting = [], 0
    if waiting:
        yield flush()


def _count(frequent: Frequent, chosen: bool):
    """Training texts -> (word, context, n) of what one task has seen."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        # Digests leave no room for a context: number the words of this flush.
        words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        key, n = np.unique(at * CONTEXTS + np.concatenate([c for _, c in held]).astype(np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(words[key // CONTEXTS].view(np.int64)),
                pa.array((key % CONTEXTS).astype(np.int16)),
                pa.array(n.astype(np.int64)),
            ],
            names=["word", "context", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        waiting = 0
        for batch in batches:
            for _, _, words in steps(batch.column("text"), lower=True):
                held.append(_pairs(*text_tokens(words), frequent, chosen))
                waiting += len(held[-1][0])
                if waiting >= FLUSH_TOKENS:
                    yield flush(held)
                    held, waiting = [], 0
        if waiting:
            yield flush(held)

    return run


def _dense(batch: pa.RecordBatch) -> np.ndarray:
    """Counts of a batch of words by context."""
    n = batch.column("n")
    row = np.repeat(np.arange(len(n)), np.diff(n.offsets.to_numpy()))
    counts = np.zeros((len(n), CONTEXTS))
    np.add.at(counts, (row, batch.column("contexts").flatten().to_numpy()), n.flatten().to_numpy())
    return counts


def classes_of(counts: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """The class that is likeliest for the contexts of each word."""
    return np.argmax(counts @ gain, axis=1).astype(np.int16)


def _gain(matrix: np.ndarray) -> np.ndarray:
    """log P(context | class), smoothed, by context and class."""
    smooth = matrix[:, :CLASSES] + 0.5
    return np.log(smooth / smooth.sum(axis=0))


def _sum_classes(frequent: Frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CONTEXTS, CLASSES + 1))
        for batch in batches:
            _, kind = frequent.find(batch.column("word").to_numpy().view(np.uint64))
            np.add.at(total.T, kind.astype(np.int64), _dense(batch))
        c, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[c, k].astype(np.int64))],
            names=["i", "j", "n"],
        )

    return run


def _matrix(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sums of n by (i, j); as many rows come to the driver as the shape has cells."""
    out = np.zeros(shape)
    for row in rows.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[row["i"], row["j"]] = row["n"]
    return out


def _moved(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(classes_of(_dense(batch), gain))], names=["word", "class"]
            )

    return run


def _vectors(train: DataFrame, frequent: Frequent, chosen: bool, purpose: str) -> DataFrame:
    """word, contexts and their counts n, over all training text."""
    counted = train.mapInArrow(_count(frequent, chosen), "word long, context short, n long")
    # Frequent words are in every task's counts: each of their contexts is summed by itself.
    return stored(
        (counted if chosen else counted.repartition("word"))
        .groupBy("word", "context")
        .agg(F.sum("n").alias("n"))
        .groupBy("word")
        .agg(F.collect_list(F.struct("context", "n")).alias("_v"))
        .select("word", F.col("_v.context").alias("contexts"), F.col("_v.n").alias("n")),
        purpose,
    )


def _frequent(rows: pa.Table) -> Frequent:
    words = rows.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return Frequent(words[order], rows.column("class").to_numpy()[order].astype(np.int64))


def exchange(train: DataFrame, counts: DataFrame, rounds: int = ROUNDS, most: int = FREQUENT) -> tuple[Frequent, np.ndarray]:
    """Classes of the ``most`` most frequent words, and the class preferences by context.

    ``counts`` has word and n. Only the words exchanged and a contexts x classes matrix
    come to the driver, whatever the number of words.
    """
    top = counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(most).select("word").toArrow()
    frequent = _frequent(top.append_column("class", pa.array(np.arange(len(top)) % CLASSES)))
    gain = _gain(np.zeros((CONTEXTS, CLASSES + 1)))
    for _ in range(rounds):
        vectors = _vectors(train, frequent, True, "lm-frequent")
        gain = _gain(_matrix(vectors.mapInArrow(_sum_classes(frequent), "i int, j int, n long"), (CONTEXTS, CLASSES + 1)))
        frequent = _frequent(vectors.mapInArrow(_moved(gain), "word long, class short").toArrow())
    return frequent, gain


def _classified(train: DataFrame, counts: DataFrame, rounds: int, most: int) -> DataFrame:
    """word, n and class of every training word."""
    spark = train.sparkSession
    frequent, gain = exchange(train, counts, rounds, most)
    rest = _vectors(train, frequent, False, "lm-vectors").mapInArrow(_moved(gain), "word long, class short")
    exchanged = spark.createDataFrame(
        pa.table({"word": frequent.words.view(np.int64), "class": frequent.classes.astype(np.int16)})
    )
    kinds = rest.unionByName(exchanged)
    kind = F.when(F.col("n") > 1, F.col("class")).otherwise(F.lit(CLASSES)).cast("short")
    return counts.join(kinds, "word").select("word", "n", kind.alias("class"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by bucket -> distinct words of each bucket (as far as one task holds them)."""
    held: dict[int, list[np.ndarray]] = {}
    waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for bucket, found in held.items():
            words = np.unique(np.concatenate(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), bucket, np.int32)), pa.array(words.view(np.int64))],
                names=["bucket", "word"],
            )

    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        for row, _, words in steps(batch.column("text"), lower=True):
            tokens, first = text_tokens(words)
            of = np.repeat(buckets[row : row + words.texts], np.diff(first))
            for bucket in np.unique(of):
                found = np.unique(tokens[of == bucket])
                held.setdefault(int(bucket), []).append(found)
                waiting += len(found)
            if waiting >= 2 * FLUSH_TOKENS:
                yield from flush()
                held.clear()
                waiting = 0
    yield from flush()


ENCODED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emission double, classes binary"


def _encode(total: float, distinct: float, class_sizes: np.ndarray, rare: float):
    floor = np.log10(total + 0.1 * (distinct + 1))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        # A batch's flush may have asked for a word twice.
        known, at = np.unique(answers.column("word").to_numpy().view(np.uint64), return_index=True)
        counts = np.append(answers.column("n").to_numpy()[at], 0).astype(np.float64)
        classes = np.append(answers.column("class").to_numpy()[at], CLASSES).astype(np.int64)
        frequent = classes < CLASSES
        emission = np.full(len(counts), -np.log10(rare + 1))
        emission[frequent] = np.log10(counts[frequent]) - np.log10(class_sizes[classes[frequent]])
        base = np.log10(counts + 0.1) - floor
        out = []
        for batch in docs.combine_chunks().to_batches():
            for row, end, words in steps(batch.column("text"), lower=True):
                tokens, first = text_tokens(words)
                place = np.minimum(np.searchsorted(known, tokens), max(0, len(known) - 1))
                found = known[place] == tokens if len(known) else np.zeros(len(tokens), bool)
                place = np.where(found, place, len(known))
                starts = first[:-1]
                kinds = classes[place].astype(np.uint8)
                raw = pa.py_buffer(kinds.tobytes())
                offsets = pa.py_buffer(first.astype(np.int32).tobytes())
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(row, end - row),
                            batch.column("held_out").slice(row, end - row),
                            pa.array(np.diff(first).astype(np.int64)),
                            pa.array(np.add.reduceat(found.astype(np.int64), starts)),
                            pa.array(np.add.reduceat(base[place], starts)),
                            pa.array(np.add.reduceat(emission[place], starts)),
                            pa.Array.from_buffers(pa.binary(), words.texts, [None, offsets, raw]),
                        ],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "classes"],
                    )
                )
        return pa.Table.from_batches(out) if out else _EMPTY

    return run


_EMPTY = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("emission", pa.float64()),
        ("classes", pa.binary()),
    ]
).empty_table()


def _flat_classes(column: pa.Array, start: int):
    """(class before, class) of every token, and the first token of each text."""
    from hypnolith.llm.words import text_bytes

    data, bounds = text_bytes(column)
    before = np.empty(len(data), np.int64)
    before[1:] = data[:-1]
    before[bounds[:-1]] = start
    return before, data.astype(np.int64), bounds[:-1]


def _count_transitions(start: int):
    side = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            before, now, _ = _flat_classes(batch.column("classes"), start)
            total += np.bincount(before * side + now, minlength=side * side)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((cell // side).astype(np.int32)),
                pa.array((cell % side).astype(np.int32)),
                pa.array(total[cell]),
            ],
            names=["i", "j", "n"],
        )

    return run


def _score(table: np.ndarray, start: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            before, now, first = _flat_classes(batch.column("classes"), start)
            moves = np.add.reduceat(table[before, now], first)
            score = moves + batch.column("emission").to_numpy()
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(score)], names=[*names, "score"]
            )

    return run


def transition_logs(counts: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), backed by the class frequencies."""
    overall = (counts.sum(axis=0) + 1) / (counts.sum() + len(counts))
    return np.log10((counts + PRIOR * overall) / (counts.sum(axis=1, keepdims=True) + PRIOR))


def score_documents(
    docs: DataFrame, rounds: int = ROUNDS, bucket_bytes: int = BUCKET_BYTES, most: int = FREQUENT
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A document is held out, and not learnt from, if crc32 of its doc_id as text is 0
    modulo 10 (a missing id counts as empty text, which is held out). Tokens are the
    words with A-Z lower-cased and one end. ``base_score`` is that of smoothed word
    frequencies, ``score`` the model's log10 probability of the text. Null texts are
    empty: their only token is the end. Every row is scored by itself, repeated ones
    too; other columns are ignored. An empty table gives an empty result; without
    training documents every word is unseen.
    """
    spark = docs.sparkSession
    with_batches(spark)
    doc_id = F.col("doc_id").cast("long")
    remainder = F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10
    texts = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (remainder == 0).alias("held_out"),
    )
    train = texts.filter("NOT held_out").select("text")
    counts = stored(
        train.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts"
    )
    dictionary = stored(_classified(train, counts, rounds, most), "lm-dictionary")
    sizes = dictionary.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    class_sizes, rare, distinct = np.ones(CLASSES + 1), 0, 0
    for row in sizes:
        class_sizes[row["class"]] = row["n"]
        distinct += row["words"]
        rare = row["words"] if row["class"] == CLASSES else rare
    total = sum(row["n"] for row in sizes)
    end = dictionary.filter(F.col("word") == int(END.view(np.int64))).collect()
    start = end[0]["class"] if end else CLASSES

    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    dealt = texts.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(buckets)).cast("int")
    ).repartition("bucket")
    asked = dealt.select("bucket", "text").mapInArrow(_asked, "bucket int, word long")
    answers = asked.join(dictionary, "word").select("bucket", "word", "n", "class")
    encoded = stored(
        dealt.groupBy("bucket")
        .cogroup(answers.groupBy("bucket"))
        .applyInArrow(_encode(float(total), float(distinct), class_sizes, float(rare)), ENCODED),
        "lm-encoded",
    )
    moves = encoded.filter("NOT held_out").select("classes").mapInArrow(
        _count_transitions(start), "i int, j int, n long"
    )
    table = transition_logs(_matrix(moves, (CLASSES + 1, CLASSES + 1)))
    return encoded.mapInArrow(
        _score(table, start),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
