"""Alignment of two tokenizers' tokens of the same texts.

Tokenizer A is a byte-level BPE, tokenizer B a sentencepiece model with byte fallback.
Both cut the bytes of a space and the text; where both end a token, the text can be cut
so that neither has a token across.

* Groups, by divide and conquer at shared cuts: an interval of tokens that starts and
  ends at shared cuts is searched from its middle outwards for a token end of A that a
  bisection finds among the ends of B. The nearest one cuts the interval in two, which
  are searched in turn; an interval without one is a leaf group. All intervals of a batch
  of documents take each step together, and the search widens by doubling.
* Links inside groups are the pairs of tokens whose byte ranges overlap: one per stretch
  between neighbouring ends of either tokenizer.
* How many documents hold a pair linked is counted over the whole corpus. Documents are
  packed into chunks of bounded size; a chunk brings each pair once, with the number
  of its documents, and gets back each pair's count. So shuffles carry distinct pairs
  per chunk, not links, and no table of all pairs is broadcast.

Rows are documents of their own, whatever their ``doc_id``. Texts that are null or empty,
or whose tokens' bytes are not a space and the text (the model normalises some characters
away), have no tokens. Columns other than ``doc_id`` and ``text`` are ignored; an empty
table has an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import stored, with_batches
from hypnolith.llm.token_files import Encoder

#: Bytes of text in a chunk (a longer document is a chunk of its own).
CHUNK_BYTES = 4 << 20
#: Bytes of text tokenized in one step.
STEP_BYTES = 1 << 18

#: Ids have so many bits; a pair is A's id above B's.
ID_BITS = 20

CHUNKS = (
    "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pair array<long>, docs array<long>, held binary"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars = _byte_of_char()
        # An added token's text that is not in the byte alphabet never comes out of a plain text.
        vocabulary = {i: bytes(chars.get(c, 0) for c in t) for t, i in self.a.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = _ByteTable([vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)])
        size = self.b.get_piece_size()
        self.bytes_b = _ByteTable([self._piece(i) for i in range(size)])

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:-1], 16)])
        if self.b.is_control(number) or self.b.is_unknown(number):
            return b""
        return self.b.id_to_piece(number).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of a space and each text by A, and of each text by B, which adds the space."""
        spaced = pa.array([" " + t for t in texts], pa.string())
        return self.a.encode_column(spaced), self.b.encode(texts, num_threads=1)


class _ByteTable:
    """Bytes of every token, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens) + b"\0", np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = np.repeat(self.at[ids] - (np.cumsum(size) - size), size)
        return self.flat[np.arange(len(shift)) + shift]


@cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """The worker's tokenizers; they live as long as the worker."""
    return Tokenizers(path_a, path_b)


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers begin .. begin + size - 1 of every range, number of their range)."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + begin[owner], owner


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tokens of A, inside the intervals first .. last, whose end is an end of B as well.

    ends: ascending byte offsets. An interval's tokens are first .. last, and the end
    of the last one is known to be shared; it is not returned.
    """
    cuts = []
    low, high = first, last - 1  # tokens whose ends may cut
    while True:
        open_ = low <= high
        low, high = low[open_], high[open_]
        if not len(low):
            break
        middle = (low + high) >> 1
        nearest = np.where(_shared(ends_a, ends_b, middle), middle, -1)
        searching = np.flatnonzero((nearest < 0) & (low < high))
        near, width = 0, 1  # ends up to ``near`` tokens from the middle have been tried
        while len(searching):
            m, lo, hi = middle[searching], low[searching], high[searching]
            below, above = np.maximum(lo, m - near - width), np.minimum(hi, m + near + width)
            left, of_left = _ranges(below, np.maximum(m - near - below, 0))
            right, of_right = _ranges(m + near + 1, np.maximum(above - m - near, 0))
            best = np.full(len(m), -1, np.int64)
            hit = np.flatnonzero(_shared(ends_a, ends_b, right))[::-1]
            best[of_right[hit]] = right[hit]  # written last: the nearest
            hit = np.flatnonzero(_shared(ends_a, ends_b, left))
            closest = np.full(len(m), -1, np.int64)
            closest[of_left[hit]] = left[hit]
            left_wins = (closest >= 0) & ((best < 0) | (m - closest <= best - m))
            nearest[searching] = np.where(left_wins, closest, best)
            near += width
            more = (nearest[searching] < 0) & ((m - near > lo) | (m + near < hi))
            searching = searching[more]
            width *= 2
        found = nearest >= 0
        cut, low, high = nearest[found], low[found], high[found]
        cuts.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut - 1, high])
    return np.sort(np.concatenate(cuts)) if cuts else np.zeros(0, np.int64)


def _shared(ends_a: np.ndarray, ends_b: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Whether tokens of A end where one of B does, by bisection."""
    end = ends_a[tokens]
    place = np.searchsorted(ends_b, end)
    return ends_b[np.minimum(place, len(ends_b) - 1)] == end


_DIGITS = 6


@cache
def _decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits of the numbers below size, right-aligned, and room for a separator; used places)."""
    numbers = np.arange(size)
    digits = np.stack([numbers // 10**k % 10 + 48 for k in range(_DIGITS - 1, -1, -1)], axis=1).astype(np.uint8)
    used = np.stack([numbers >= 10**k for k in range(_DIGITS - 1, 0, -1)] + [numbers >= 0] * 2, axis=1)
    return np.concatenate([digits, np.zeros((size, 1), np.uint8)], axis=1), used


def _decimals(ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(characters of all ids in decimal, each with its separator behind it; where each ends)."""
    digits, used = _decimal_table(1 << 17)
    out, mask = digits[ids], used[ids]
    out[:, -1] = separators
    return out[mask], np.cumsum(mask.sum(axis=1))


def _before(flags: np.ndarray) -> np.ndarray:
    """Number of flags before each place."""
    return np.cumsum(flags) - flags


class Aligned:
    """Tokens, groups and links of some texts, end to end."""

    def __init__(self, tokens: Tokenizers, texts: list[str | None]):
        ids_a, ids_b = tokens.encode([t or "" for t in texts])
        raw = [(" " + t).encode() if t else b"" for t in texts]
        for k, text in enumerate(raw):
            a, b = np.array(ids_a[k], np.int64), np.array(ids_b[k], np.int64)
            same = text and tokens.bytes_a.joined(a).tobytes() == text and tokens.bytes_b.joined(b).tobytes() == text
            # A token without bytes would have no place in the text; the tables have none that can come.
            ids_a[k], ids_b[k] = (a, b) if same else (a[:0], b[:0])
        none = np.zeros(0, np.int64)
        self.texts = len(texts)
        self.a, self.b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        self.first_a = np.cumsum([0, *map(len, ids_a)])
        self.first_b = np.cumsum([0, *map(len, ids_b)])
        self.ends_a = np.cumsum(tokens.bytes_a.size[self.a])
        self.ends_b = np.cumsum(tokens.bytes_b.size[self.b])
        held = np.flatnonzero(np.diff(self.first_a))
        last = self.first_a[held + 1] - 1
        inner = shared_cuts(self.ends_a, self.ends_b, self.first_a[held], last)
        #: last tokens of every group
        self.group_a = np.sort(np.concatenate([inner, last]))
        self.group_b = np.searchsorted(self.ends_b, self.ends_a[self.group_a])
        ends_a, ends_b = np.zeros((2, int(self.ends_a[-1]) + 1 if len(self.a) else 0), bool)
        ends_a[self.ends_a] = ends_b[self.ends_b] = True
        ends = np.flatnonzero(ends_a | ends_b)
        self.link_a, self.link_b = _before(ends_a)[ends], _before(ends_b)[ends]
        self.link_doc = np.repeat(np.arange(self.texts), np.diff(self.first_a))[self.link_a]
        self.pair = (self.a[self.link_a] << ID_BITS) | self.b[self.link_b]

    def counts(self) -> tuple[np.ndarray, ...]:
        """Tokens of A and B, groups and links of every text."""
        groups = np.diff(np.searchsorted(self.group_a, self.first_a))
        return np.diff(self.first_a), np.diff(self.first_b), groups, np.bincount(self.link_doc, minlength=self.texts)

    def formatted(self) -> list[bytes]:
        """Groups of every text as a1,a2|b1;a3|b2,b3."""
        ends_a, ends_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        ends_a[self.group_a] = ends_b[self.group_b] = True
        in_a, in_b = _before(ends_a), _before(ends_b)
        before_b = np.append(0, self.group_b + 1)  # tokens of B before each group
        at_a = np.arange(len(self.a)) + before_b[in_a]
        at_b = np.arange(len(self.b)) + self.group_a[in_b] + 1
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        separators = np.full(len(ids), ord(","), np.uint8)
        separators[at_a[self.group_a]] = ord("|")
        separators[at_b[self.group_b]] = ord(";")
        chars, ends = _decimals(ids, separators)
        ends = np.append(0, ends)
        chars, cut = chars.tobytes(), ends[self.first_a + self.first_b]
        return [chars[x : max(x, y - 1)] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _steps(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text or "") > STEP_BYTES:
            yield begin, k
            begin, size = k, 0
        size += len(text or "") + 1
    if begin < len(texts):
        yield begin, len(texts)


class _Chunk:
    """Documents of a chunk under way."""

    def __init__(self):
        self.size = 0
        self.rows = []  # per step: ids, counts, digests
        self.doc, self.pair, self.links = [], [], []
        self.docs = 0

    def add(self, ids: list[int | None], aligned: Aligned) -> None:
        shas = [hashlib.sha256(g).hexdigest() if g else "" for g in aligned.formatted()]
        self.rows.append((ids, *[c.tolist() for c in aligned.counts()], shas))
        # A step has few documents: one number holds document and pair.
        held = np.sort((aligned.link_doc << (2 * ID_BITS)) | aligned.pair)
        at = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
        self.doc.append((held[at] >> (2 * ID_BITS)) + self.docs)
        self.pair.append(held[at] & ((1 << (2 * ID_BITS)) - 1))
        self.links.append(np.diff(np.append(at, len(held))))
        self.docs += len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        doc, pair, links = (np.concatenate(x) for x in (self.doc, self.pair, self.links))
        code, distinct = pd.factorize(pair, sort=True)
        docs = np.bincount(code, minlength=len(distinct))
        parts = [np.ascontiguousarray(x, "<u4").tobytes() for x in (doc, code, links)]
        columns = [[x for r in self.rows for x in r[k]] for k in range(6)]
        values = [number, *columns, distinct, docs, zstandard.compress(b"".join(parts), 3)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _CHUNK_TYPES)], names=_CHUNK_NAMES)


_CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]
_CHUNK_TYPES = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 2, pa.binary()]


def _chunked(path_a: str, path_b: str, chunk_bytes: int):
    """Documents -> chunks: digests per document, distinct pairs, and which document holds which."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, chunk = tokenizers(path_a, path_b), _Chunk()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for begin, end in _steps(texts):
                part = texts[begin:end]
                chunk.add(ids[begin:end], Aligned(tokens, part))
                chunk.size += sum(len(t or "") + 64 for t in part)
                if chunk.size >= chunk_bytes:
                    yield chunk.row(number)
                    number, chunk = number + 1, _Chunk()
        if chunk.docs:
            yield chunk.row(number)

    return run


def _scored(chunks: pa.Table, pairs: pa.Table) -> pa.Table:
    """A chunk and the counts of its pairs -> its documents' results."""
    if not chunks.num_rows:
        return _EMPTY
    row = chunks.to_pylist()[0]
    order = np.argsort(pairs.column("pair").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy()[order]
    held = np.frombuffer(zstandard.decompress(row["held"]), "<u4").astype(np.int64).reshape(3, -1)
    doc, code, links = held
    size = len(row["doc_id"])
    n_best, sums = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(n_best, doc, links * best[code])
    np.add.at(sums, doc, links * count[code])
    columns = [row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays(
        [*[pa.array(c, pa.int64()) for c in (*columns, n_best, sums)], pa.array(row["groups_sha256"], pa.string())],
        names=[c.split()[0] for c in RESULT.split(", ")],
    )


_EMPTY = pa.table(
    {c.split()[0]: pa.array([], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")}
)


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: its tokens, groups and links, and how common its linked pairs are in the corpus.

    n_best counts links whose pair is held by as many documents as any pair of its A
    id; count_sum adds, over links, the number of documents that hold the pair.
    groups_sha256 is the digest of the groups, '' without tokens.
    """
    with_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = stored(rows.mapInArrow(_chunked(path_a, path_b, chunk_bytes), CHUNKS), "alignment-chunks")
    counts = stored(pair_counts(chunks), "alignment-counts")
    pairs = chunks.select(F.col("chunk").alias("held_by"), F.explode("pair").alias("pair")).join(counts, "pair")
    return (
        chunks.drop("pair", "docs")
        .groupBy("chunk")
        .cogroup(pairs.select("held_by", "pair", "count", F.col("best").cast("long").alias("best")).groupBy("held_by"))
        .applyInArrow(_scored, RESULT)
    )


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, a, b, count (documents that hold it linked), best (no pair of its A id has more)."""
    counted = (
        chunks.select(F.inline(F.arrays_zip("pair", "docs")))
        .groupBy("pair")
        .agg(F.sum("docs").alias("count"))
        .withColumn("a", F.shiftright("pair", ID_BITS))
        .withColumn("b", F.col("pair").bitwiseAND((1 << ID_BITS) - 1))
    )
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
