"""Token ids in bit-plane shuffled blocks, and reading them back.

Layout of a token file (a folder written by Spark, one row per block):

* Documents are in ascending order over the parts of the folder; ``part`` numbers
  them in that order, ``block`` counts a part's blocks.
* A block holds ``block_ids`` ids (a part's last block may hold fewer), across
  documents. Its ids are transposed into planes, least significant first: byte
  planes, or bit planes with 8 ids a byte. Each plane is compressed with zstandard
  on its own; ``payload`` is the planes end to end.
* The chunk index is in the other columns: ``plane_bytes`` (length of each plane),
  ``n_ids``, ``first_id`` (position in the part), and the document pieces of the
  block (``doc_id``, ``doc_seq`` in the part, ``doc_start``, ``doc_total`` and
  ``piece_ids``), so that a reader finds a document without decoding others.

Only what compresses well is in a plane of its own: high bytes of ids are nearly
constant. Spark's commit protocol makes the write safe against lost executors.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hypnolith.llm.tables import stored, with_batches
from hypnolith.llm.words import STEP_BYTES, Words, span_hashes, text_bytes

BLOCK_IDS = 1 << 16
END_ID = 0
# Distinct pieces of text whose ids a Python worker remembers before it starts anew.
# A piece takes some 50 bytes.
REMEMBERED = 1 << 21

BLOCKS = (
    "part int, block long, first_id long, n_ids int, planes string, plane_bytes array<int>, "
    "payload binary, doc_id array<long>, doc_seq array<long>, doc_start array<long>, "
    "doc_total array<long>, piece_ids array<int>"
)

# Unicode white space, as the tokenizer's pre-tokenizer sees it.
_WIDE = "\x85\xa0  -     　"
_WS = f"\t-\r {_WIDE}"
_PIECE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_ASCII_SPACE = b"\t\n\x0b\x0c\r "
_WIDE_SPACE = re.compile(f"[{_WIDE}]")


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Planes of unsigned 32-bit ids, least significant first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [rows[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(parts: list[bytes], count: int, planes: str) -> np.ndarray:
    if planes == "byte":
        rows = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:count] for p in parts]
        rows = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


def piece_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the pieces of UTF-8 texts, cut where the byte-level pre-tokenizer always cuts.

    A word takes one space before it along. What is left of the white space before it is
    a piece, but for a last character that is no space, which is one of its own; white
    space at a text's end is one piece. Texts with white space beyond ASCII are cut by
    the pattern itself.
    """
    words = Words(data, bounds)
    starts, ends, text = words.starts, words.ends, words.text_of
    before = np.empty_like(starts)
    before[1:] = ends[:-1]
    leads = np.ones(len(starts), bool)
    leads[1:] = text[1:] != text[:-1]
    before[leads] = bounds[text[leads]]
    space = (starts > before) & (data[np.maximum(starts - 1, 0)] == 32)
    begin = starts - space
    left = begin - before
    one = (left > 0) & (space | (left == 1))
    two = (left > 1) & ~space
    last = bounds[:-1].copy()
    held = words.counts > 0
    last[held] = ends[words.first[1:][held] - 1]
    tail = last < bounds[1:]
    parts = [
        (begin, ends), (before[one], begin[one]), (before[two], begin[two] - 1), (begin[two] - 1, begin[two]),
        (last[tail], bounds[1:][tail]),
    ]
    for k in _texts_with_wide_spaces(data, bounds):
        parts = [(a[~x], b[~x]) for a, b in parts for x in [(a >= bounds[k]) & (a < bounds[k + 1])]]
        sizes = [len(p.encode()) for p in _PIECE.findall(data[bounds[k] : bounds[k + 1]].tobytes().decode())]
        end = bounds[k] + np.cumsum(np.array(sizes, np.int64))
        parts.append((end - sizes, end))
    start = np.concatenate([a for a, _ in parts])
    order = np.argsort(start, kind="stable")
    return start[order], np.concatenate([b for _, b in parts])[order]


def _texts_with_wide_spaces(data: np.ndarray, bounds: np.ndarray) -> list[int]:
    """Texts that hold white space beyond ASCII: none but those whose bytes may start one."""
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    lead = lead[lead + 1 < len(data)]
    first, second = data[lead], data[lead + 1]
    may = ((first == 0xC2) & ((second == 0x85) | (second == 0xA0))) | ((first == 0xE1) & (second == 0x9A))
    may |= ((first == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((first == 0xE3) & (second == 0x80))
    texts = np.unique(np.searchsorted(bounds, lead[may], "right") - 1)
    return [k for k in texts.tolist() if _WIDE_SPACE.search(data[bounds[k] : bounds[k + 1]].tobytes().decode())]


class Encoder:
    """Ids of texts, each distinct piece of text being encoded once in a worker.

    Ids of a text are those of its pieces end to end, the same as for the text as a
    whole. Pieces are known by 128 bits of digests of their bytes; only those not seen
    before are turned into strings. ``plain_specials``: strings of special tokens
    inside texts are ordinary text.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # a character of the byte alphabet is a byte
            self.id_bytes[number] = len(token.encode()) if number in added else len(token)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # digests of pieces, ascending
        self.codes = np.zeros(0, np.int32)  # number of each
        self.other = np.zeros(1 << 12, np.uint64)  # second digest per piece
        self.at = np.zeros((1 << 12) + 1, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)

    @staticmethod
    def _grown(table: np.ndarray, size: int) -> np.ndarray:
        """The table with room for ``size`` entries; it doubles, so that growth costs little."""
        if size <= len(table):
            return table
        return np.concatenate([table, np.zeros(max(size, 2 * len(table)) - len(table), table.dtype)])

    def _ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces end to end, ids of each).

        Pieces are encoded as a few long texts, behind a line feed where no space makes
        the pre-tokenizer cut; the bytes of the ids tell where each piece ends.
        """
        texts, sizes, held = [], np.fromiter(map(len, pieces), np.int64, len(pieces)), []
        plain = [k for k, p in enumerate(pieces) if p.strip(_ASCII_SPACE)]
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            held.append(part)
            texts.append(b"".join(p if p[0] == 32 else b"\n" + p for p in map(pieces.__getitem__, part)).decode())
        found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts, kept = np.zeros(len(pieces), np.int64), []
        for part, ids in zip(held, found):
            led = np.array([pieces[k][0] != 32 for k in part], np.int64)
            size = sizes[part]
            ends = np.cumsum(size + led)
            after = np.cumsum(self.id_bytes[ids])
            last = np.searchsorted(after, ends)
            begin = np.append(0, last[:-1] + 1) + led
            good = (after[np.minimum(last, len(after) - 1)] == ends) & (after[begin] - self.id_bytes[ids[begin]] == ends - size)
            if not good.all():
                return self._one_by_one(pieces)
            counts[part] = last + 1 - begin
            feeds = np.ones(len(ids), bool)
            feeds[begin[led > 0] - 1] = False
            kept.append(ids[feeds])
        spaces = [k for k, p in enumerate(pieces) if not p.strip(_ASCII_SPACE)]
        if not spaces:
            return np.concatenate(kept), counts
        # White space pieces, and pieces of white space beyond ASCII, are few.
        own, number = self._one_by_one([pieces[k] for k in spaces])
        counts[spaces] = number
        flat = np.empty(int(counts.sum()), np.uint32)
        is_space = np.zeros(len(pieces), bool)
        is_space[spaces] = True
        of = np.repeat(is_space, counts)
        flat[of] = own
        if kept:
            flat[~of] = np.concatenate(kept)
        return flat, counts

    def _one_by_one(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        ids = [x.ids for x in found]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn(self, pieces: list[bytes], digests: np.ndarray, other: np.ndarray) -> None:
        """Number new pieces, given by ascending digests."""
        flat, sizes = self._ids_of(pieces)
        count, total = len(self.known), len(flat)
        end = int(self.at[count])
        self.at = self._grown(self.at, count + len(sizes) + 1)
        self.flat = self._grown(self.flat, end + total)
        self.other = self._grown(self.other, count + len(sizes))
        self.at[count + 1 : count + len(sizes) + 1] = end + np.cumsum(sizes)
        self.flat[end : end + total] = flat
        self.other[count : count + len(sizes)] = other
        place = np.searchsorted(self.known, digests)
        self.known = np.insert(self.known, place, digests)
        self.codes = np.insert(self.codes, place, np.arange(count, count + len(sizes), dtype=np.int32))

    def encode_bytes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of UTF-8 texts end to end, where each text's ids start and the last one's end)."""
        if len(self.known) > REMEMBERED:
            self.clear()
        starts, ends = piece_spans(data, bounds)
        digest = span_hashes(data, starts, ends)
        other = span_hashes(data, starts, ends, 1)
        number, distinct = pd.factorize(digest)
        first = np.zeros(len(distinct), np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        order = np.argsort(distinct)
        keys = distinct[order]
        place = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != keys[inside]
        if new.any():
            raw, at = data.tobytes(), first[order[new]]
            self._learn([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], keys[new], other[at])
            place = np.searchsorted(self.known, keys)
        code = np.empty(len(keys), np.int32)
        code[order] = self.codes[place]
        code = code[number]
        if not np.array_equal(self.other[code], other):
            return self._encode_whole(data, bounds)
        sizes = self.at[code + 1] - self.at[code]
        before = np.append(0, np.cumsum(sizes))
        ids = self.flat[np.arange(before[-1]) + np.repeat(self.at[code] - before[:-1], sizes)]
        return ids, before[np.searchsorted(starts, bounds)]

    def _encode_whole(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without memory: two different pieces had one digest."""
        texts = [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.cumsum([0, *map(len, ids)])

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a column; null is an empty text."""
        data, bounds = text_bytes(texts)
        out, row = [], 0
        while row < len(bounds) - 1:
            end = int(np.searchsorted(bounds, bounds[row] + STEP_BYTES, "right")) - 1
            end = min(len(bounds) - 1, max(row + 1, end))
            ids, cuts = self.encode_bytes(data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
            out += np.split(ids, cuts[1:-1])
            row = end
        return out


@cache
def encoder(path: str, plain_specials: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    return Encoder(path, plain_specials)


def _blocks(path: str, planes: str, block_ids: int):
    """Rows of one part in order -> its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        part, seq, written, block = None, 0, 0, 0
        held: list[np.ndarray] = []  # ids not yet in a block
        docs: list[list] = []  # [doc_id, seq, start, total, ids not yet in a block]
        waiting = 0
        schema = None

        def cut(size: int) -> pa.RecordBatch:
            nonlocal written, block, waiting, held, docs
            ids = np.concatenate(held)
            now, rest = ids[:size], ids[size:]
            held, waiting = [rest] if len(rest) else [], len(rest)
            left, pieces = size, []
            while left:
                doc = docs[0]
                take = min(left, doc[4])
                pieces.append((*doc[:4], take))
                doc[4] -= take
                left -= take
                if not doc[4]:
                    docs.pop(0)
            packed = [squeeze.compress(p) for p in to_planes(now, planes)]
            row = {
                "part": [part],
                "block": [block],
                "first_id": [written],
                "n_ids": [size],
                "planes": [planes],
                "plane_bytes": [[len(p) for p in packed]],
                "payload": [b"".join(packed)],
            }
            for k, name in enumerate(("doc_id", "doc_seq", "doc_start", "doc_total", "piece_ids")):
                row[name] = [[p[k] for p in pieces]]
            written += size
            block += 1
            return pa.RecordBatch.from_pydict(row, schema=_SCHEMA)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            keys = batch.column("doc_id").to_pylist()
            for key, ids in zip(keys, encoder(path).encode_column(batch.column("text")), strict=True):
                ids = np.append(ids, np.uint32(END_ID))
                docs.append([key, seq, written + waiting, len(ids), len(ids)])
                seq += 1
                held.append(ids)
                waiting += len(ids)
                if waiting >= block_ids:
                    while waiting >= block_ids:
                        yield cut(block_ids)
        if waiting:
            yield cut(waiting)

    return run


_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int32()),
        ("planes", pa.string()),
        ("plane_bytes", pa.list_(pa.int32())),
        ("payload", pa.binary()),
        *[(name, pa.list_(pa.int64())) for name in ("doc_id", "doc_seq", "doc_start", "doc_total")],
        ("piece_ids", pa.list_(pa.int32())),
    ]
)


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    parts: int | None = None,
    planes: str = "byte",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode ``text`` of every row, in ascending ``doc_id`` order, and return the stored blocks.

    Each text's ids are followed by the end id 0; null and empty texts have only
    that. Rows with a null doc_id come first; rows that repeat a doc_id are all
    written, next to each other and ordered by a digest of the text, by which very many
    of them are split over parts. Columns other than ``doc_id`` and ``text`` are
    ignored, an empty table gives an empty folder.
    """
    if planes not in ("byte", "bit"):
        raise ValueError("planes are 'byte' or 'bit'")
    spark = docs.sparkSession
    with_batches(spark)
    count = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = (
        rows.withColumn("digest", F.xxhash64("text"))
        .repartitionByRange(count, "doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest", "text")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    return stored(ordered.mapInArrow(_blocks(vocabulary, planes, block_ids), BLOCKS), "token-files")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> per document piece: its checksum if whole, else its ids as bytes."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in batch.to_pylist():
            at, parts = 0, []
            for size in row["plane_bytes"]:
                parts.append(unpack.decompress(row["payload"][at : at + size]))
                at += size
            ids = from_planes(parts, row["n_ids"], row["planes"])
            lengths = np.array(row["piece_ids"], np.int64)
            ends = np.cumsum(lengths)
            whole = lengths == np.array(row["doc_total"], np.int64)
            raw = memoryview(ids.tobytes())
            spans = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([row["part"]] * len(spans), pa.int32()),
                    "doc_seq": pa.array(row["doc_seq"], pa.int64()),
                    "doc_id": pa.array(row["doc_id"], pa.int64()),
                    "doc_start": pa.array(row["doc_start"], pa.int64()),
                    "n_tokens": pa.array(row["doc_total"], pa.int64()),
                    "block": pa.array([row["block"]] * len(spans), pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(s) if w else None for s, w in zip(spans, whole)], pa.int64()
                    ),
                    "ids": pa.array([None if w else bytes(s) for s, w in zip(spans, whole)], pa.binary()),
                }
            )


PIECES = (
    "part int, doc_seq long, doc_id long, doc_start long, n_tokens long, block long, "
    "ids_crc32 long, ids binary"
)


def read_token_pieces(blocks: DataFrame) -> DataFrame:
    """Documents decoded from blocks; one that crosses a block edge comes in several rows."""
    return blocks.mapInArrow(_pieces, PIECES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pieces in order, next to each other per document -> a checksum per document."""
    last, crc, row = None, 0, None

    def out():
        return pa.RecordBatch.from_pydict(
            {name: pa.array([value], kind) for (name, kind), value in zip(_DOC, (*row, crc))}
        )

    for batch in batches:
        for piece in batch.to_pylist():
            key = piece["part"], piece["doc_seq"]
            if key != last:
                if last is not None:
                    yield out()
                last, crc = key, 0
                row = tuple(piece[k] for k in ("part", "doc_seq", "doc_id", "doc_start", "n_tokens"))
            crc = zlib.crc32(piece["ids"], crc)
    if last is not None:
        yield out()


_DOC = [
    ("part", pa.int32()),
    *[(name, pa.int64()) for name in ("doc_seq", "doc_id", "doc_start", "n_tokens", "ids_crc32")],
]


def read_token_files(blocks: DataFrame) -> DataFrame:
    """Per document read back: doc_id, start (ids before it in the whole), n_tokens, ids_crc32.

    Pieces of documents that cross block edges meet by document; all others are
    finished where their block is decoded. The number of ids before a part comes
    from the chunk index, one sum per part.
    """
    pieces = read_token_pieces(blocks)
    columns = ["part", "doc_seq", "doc_id", "doc_start", "n_tokens", "ids_crc32"]
    whole = pieces.filter("ids IS NULL").select(*columns)
    split = (
        pieces.filter("ids IS NOT NULL")
        .repartition("part", "doc_seq")
        .sortWithinPartitions("part", "doc_seq", "block")
        .mapInArrow(_joined, "part int, doc_seq long, doc_id long, doc_start long, n_tokens long, ids_crc32 long")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum("n_ids").alias("ids"))
        .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    )
    return whole.unionByName(split).join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("doc_start")).alias("start"), "n_tokens", "ids_crc32"
    )
