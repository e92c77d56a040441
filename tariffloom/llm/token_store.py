"""Token ids in files of patched frame-of-reference blocks.

A segment holds the ids of some documents in order. Its bytes are

    magic "PFR1" | ids (u32) | blocks (u32) | block starts (u32 each) | blocks

and a block of up to 1,024 ids is

    minimum (u32) | width (u8) | ids (u16) | exceptions (u16)
    | exception places (u16 each) | exception values (u32 each) | packed low bits

All numbers are little-endian. Ids are stored less the minimum of their block,
packed at a width that a percentile of their bit lengths gives (the one with
the fewest bytes); what needs more bits goes whole to the exception lists. The
block starts give access to any id without unpacking what stands before it.

Segments lie in Parquet files in the shared folder: Spark's own commit
protocol then holds for them, so lost executors and repeated tasks leave
neither gaps nor doubles.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import LONG, MARKS, PLAIN_LIMIT, byte_alphabet
from .common import bound_batches, light_task, shared_dir

MAGIC = b"PFR1"
BLOCK = 1024
#: Distinct pieces of words that a worker remembers.
TABLE_PIECES = 1 << 19
#: Ids after which a segment ends (with a whole document).
SEGMENT_IDS = 1 << 18
#: Percentiles of the bit lengths that are tried as width.
PERCENTILES = (50, 75, 85, 90, 95, 98, 100)
#: Kinds of bytes: white space, letters (beyond ASCII all bytes), marks, others.
_WHITE, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.array([_WHITE if b in b" \t\n\x0b\x0c\r" else _LETTER if b >= 0x80 or chr(b).isalpha() else _MARK if chr(b) in MARKS else _OTHER for b in range(256)], np.uint8)


_LENGTHS = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of unsigned 32-bit values, by a table of the halves."""
    high = values >> np.uint32(16)
    low = _LENGTHS[values & np.uint32(0xFFFF)]
    return np.where(high > 0, _LENGTHS[high] + 16, low).astype(np.uint8) if high.any() else low


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low bits of each row's values, packed: one row of bytes for each row."""
    rows, n = values.shape
    if width in (8, 16, 32):
        return np.ascontiguousarray(values, f"<u{width // 8}").view(np.uint8).reshape(rows, -1)
    size = 2 if width < 16 else 4
    raw = np.ascontiguousarray(values, f"<u{size}").view(np.uint8).reshape(-1, size)
    bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width].reshape(rows, n * width)
    return np.packbits(bits, axis=1, bitorder="little")


def _unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(data, bitorder="little", count=n * width).reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def _widths(lengths: np.ndarray) -> np.ndarray:
    """For each row the width, among those at the percentiles of its bit lengths, that takes the fewest bits."""
    n = lengths.shape[1]
    over = np.stack([(lengths > w).sum(axis=1) for w in range(int(lengths.max(initial=0)) + 1)], axis=1)
    at = np.stack([(over <= int(n * (100 - p) / 100)).argmax(axis=1) for p in PERCENTILES], axis=1)
    cost = at * n + 8 * 6 * np.take_along_axis(over, at, axis=1)
    return np.take_along_axis(at, cost.argmin(axis=1)[:, None], axis=1)[:, 0]


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of rows of ids of equal length, all rows at once."""
    least = ids.min(axis=1)
    values = (ids - least[:, None]).astype(np.uint32)
    lengths = _bits(values)
    widths = _widths(lengths)
    out = [b""] * len(ids)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        packed = _pack(values[rows] & np.uint32((1 << width) - 1), width) if width else np.zeros((len(rows), 0), np.uint8)
        beyond = lengths[rows] > width
        for k, row in enumerate(rows.tolist()):
            places = np.flatnonzero(beyond[k])
            out[row] = b"".join([struct.pack("<IBHH", int(least[row]), width, ids.shape[1], len(places)), places.astype("<u2").tobytes(), values[row, places].astype("<u4").tobytes(), packed[k].tobytes()])
    return out


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    least, width, n, out = struct.unpack_from("<IBHH", data, at)
    at += 9
    places = np.frombuffer(data, "<u2", out, at)
    high = np.frombuffer(data, "<u4", out, at + 2 * out)
    values = _unpack(np.frombuffer(data, np.uint8, (n * width + 7) // 8, at + 6 * out), n, width)
    values[places] = high
    return values + np.uint32(least)


def encode_segment(ids: np.ndarray) -> bytes:
    """The bytes of one segment. No ids: a segment without blocks."""
    full = len(ids) // BLOCK * BLOCK
    blocks = encode_blocks(ids[:full].reshape(-1, BLOCK)) if full else []
    if full < len(ids):
        blocks += encode_blocks(ids[full:][None, :])
    head = 12 + 4 * len(blocks)
    starts = head + np.cumsum([0, *map(len, blocks[:-1])]) if blocks else np.zeros(0)
    return b"".join([MAGIC, struct.pack("<II", len(ids), len(blocks)), starts.astype("<u4").tobytes(), *blocks])


def decode_segment(data: bytes, first: int = 0, n: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of a segment; only the blocks they lie in are unpacked."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    total, blocks = struct.unpack_from("<II", data, 4)
    n = total - first if n is None else n
    if not n:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data, "<u4", blocks, 12)
    low, high = first // BLOCK, (first + n - 1) // BLOCK + 1
    got = np.concatenate([decode_block(data, int(s)) for s in starts[low:high]])
    return got[first - low * BLOCK :][:n]


def _after_letter(data: np.ndarray) -> np.ndarray:
    """For each byte but the first: does a letter stand before it that stays one in lower case, of ASCII or Latin (U+00C0 to U+023F)?"""
    lead = np.append(np.uint8(0), data[:-2]) if len(data) > 1 else data[:0]
    last = data[:-1]
    odd = (lead == 0xC3) & ((last == 0x97) | (last == 0xB7)) | (lead == 0xC4) & (last == 0xB0)  # two signs, and one that gets a mark of its own
    latin = (lead >= 0xC3) & (lead <= 0xC8) & (last >= 0x80) & ~odd
    return (_KIND[last] == _LETTER) & (last < 0x80) | latin


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space: exact for each piece by itself.

    A batch is cut at ASCII white space, all texts at once. Words of letters
    with marks behind are cut once more before the marks, as the tokenizer's
    pre-tokenizer does, and made lower case, as its normalizer does. Each
    distinct piece of the batch is looked up once; new ones go to the library,
    those of plain letters straight to its BPE model, others through all of it.
    """

    def __init__(self, path: str, entries: int = TABLE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.alphabet = {b: c for c, b in byte_alphabet().items()}
        self.entries = entries
        self._forget()

    def _forget(self) -> None:
        """Start with empty tables: the place of each piece, and where the ids of each place lie."""
        self.places: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        plain, odd = [], []
        for p in pieces:
            (plain if (low := p.lower()).isalpha() and max(low) < PLAIN_LIMIT else odd).append(p)
        tokenize, shown = self.library.model.tokenize, self.alphabet.__getitem__
        found = [[t.id for t in tokenize(p if p.isascii() else "".join(map(shown, p.lower().encode())))] for p in plain]
        found += [e.ids for e in self.library.encode_batch_fast(odd, add_special_tokens=False)]
        self.places.update(zip(plain + odd, range(len(self.starts) - 1, len(self.starts) - 1 + len(found)), strict=True))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1]))
        self.ids, self.starts = np.concatenate([self.ids, flat]), np.concatenate([self.starts, self.starts[-1] + ends])

    def _look_up(self, pieces: list[str]) -> np.ndarray:
        """The place of each piece."""
        found = list(map(self.places.get, pieces))
        if None in found:
            if len(self.starts) + found.count(None) > self.entries or len(self.ids) > 16 * self.entries:
                self._forget()
                found = [None] * len(pieces)
            self._learn([p for p, k in zip(pieces, found, strict=True) if k is None])
            found = list(map(self.places.__getitem__, pieces))
            for p in pieces:
                if len(p) > LONG:
                    del self.places[p]
        return np.array(found, np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, ``end_id`` behind each, and how many each has. Nulls count as empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        kinds = _KIND[data]
        inside = kinds != _WHITE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = bounds[:-1][bounds[:-1] < bounds[1:]]
        first[begins] = inside[begins]
        # cut where marks follow a letter and fill the word up to its end
        marked = kinds == _MARK
        turns = np.flatnonzero(marked[1:] & _after_letter(data) & ~first[1:]) + 1
        others = np.append(np.flatnonzero(~marked), len(data))
        behind = others[np.searchsorted(others, turns)]
        first[turns[(behind == len(data)) | ~np.append(inside, False)[behind] | np.append(first, True)[behind]]] = True
        starts = np.flatnonzero(first)
        ends = np.searchsorted(starts, bounds[1:])
        letters = data[inside]
        offsets = np.append((np.cumsum(inside) - 1)[starts], len(letters)).astype(np.int64)
        upper = (letters >= 65) & (letters <= 90)
        for k in np.unique(np.searchsorted(offsets, np.flatnonzero(letters == ord("<")), side="right") - 1):
            upper[offsets[k] : offsets[k + 1]] = False  # the strings of special tokens are case-sensitive
        letters[upper] += 32
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        known = self._look_up(pieces.dictionary.to_pylist())
        table = np.append(self.ids, np.uint32(end_id))
        table_starts = np.append(self.starts[known], len(self.ids))
        lengths = np.append(self.starts[known + 1] - self.starts[known], 1)
        order = np.insert(pieces.indices.to_numpy(zero_copy_only=False), ends, len(known))
        sizes = lengths[order]
        total = np.cumsum(sizes)
        ids = table[np.repeat(table_starts[order] - (total - sizes), sizes) + np.arange(total[-1])]
        return ids, np.diff(total[ends + np.arange(len(ends))], prepend=0)


@lru_cache(maxsize=2)
def _words(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_store(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int) -> None:
    """Write the ids of all texts, each with ``end_id`` behind, in ascending doc_id order.

    The documents are dealt by ranges of doc_id and sorted within them; null
    doc_ids come first, and rows with the same doc_id stand in the order of
    their texts. Each row of the files is a segment: part and segment give
    the order, doc_ids and sizes the documents in it.
    """
    kind = dict(docs.dtypes)["doc_id"]

    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _words(tokenizer_path), TaskContext.get().partitionId()
        with light_task():
            segment, in_part, ids, sizes, raw, held = 0, 0, [], [], [], 0

            def row() -> pa.RecordBatch:
                tokens = np.concatenate(raw)
                columns = [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([in_part], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())), pa.array([len(tokens)], pa.int64()), pa.array([encode_segment(tokens)], pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=["part", "segment", "in_part", "doc_ids", "sizes", "n_ids", "data"])

            for batch in batches:
                id_type = batch.schema.field(0).type
                tokens, each = encoder.encode(batch.column(1), end_id)
                at = 0
                for doc_id, size in zip(batch.column(0).to_pylist(), each.tolist(), strict=True):
                    ids.append(doc_id)
                    sizes.append(size)
                    raw.append(tokens[at : at + size])
                    at, held = at + size, held + size
                    if held >= SEGMENT_IDS:
                        yield row()
                        segment, in_part, ids, sizes, raw, held = segment + 1, in_part + held, [], [], [], 0
            if ids:
                yield row()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, f"part int, segment int, in_part bigint, doc_ids array<{kind}>, sizes array<bigint>, n_ids bigint, data binary").write.option("compression", "none").parquet(path)


def read_store(spark: SparkSession, path: str, *, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, unpacked from the files.

    ``start`` counts the ids of all documents before it. Parts are few (as
    many as tasks that wrote), so their sums are what one small task adds up.
    """
    stored = spark.read.parquet(path)
    kind = dict(stored.dtypes)["doc_ids"].removeprefix("array<")[:-1]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select(F.col("part").alias("of_part"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("of_part_start"))
    extra = ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, in_part, doc_ids, sizes, data in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                tokens = decode_segment(data)
                ends = np.cumsum(np.array(sizes, np.int64))
                starts = ends - np.array(sizes, np.int64)
                if len(tokens) != (ends[-1] if len(ends) else 0):
                    raise ValueError(f"a segment of part {part} is damaged")
                slices = [tokens[a:b] for a, b in zip(starts, ends, strict=True)]
                columns = [pa.array([part] * len(doc_ids), pa.int32()), pa.array(doc_ids, batch.schema.field(2).type.value_type), pa.array(starts + in_part), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in slices], pa.int64())]
                columns += [pa.array([x.astype(np.int32) for x in slices], pa.list_(pa.int32()))] if keep_ids else []
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "in_part", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    read = stored.select("part", "in_part", "doc_ids", "sizes", "data").mapInArrow(run, f"part int, doc_id {kind}, in_part bigint, n_tokens bigint, ids_crc32 bigint{extra}")
    joined = read.join(parts, F.col("part") == F.col("of_part"))
    return joined.select("doc_id", (F.col("of_part_start") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def store_round_trip(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write a store (in the shared folder unless ``path`` is given) and read every document back.

    Null and empty texts hold only the end id. Repeated rows each get their
    own place; other columns are ignored; an empty table gives no rows.
    """
    path = path or shared_dir(docs.sparkSession, "tokens")
    write_store(docs, path, tokenizer_path, end_id=end_id)
    return read_store(docs.sparkSession, path)
