"""Token-id files as wavelet matrices: succinct bit planes with rank and select.

A shard of token ids is stored as one block: for every bit of the vocabulary a plane of the ids
in the order the planes above leave them in, with a directory of counts per 512 bits. The
directory of a plane and every 32 KB of its bits are compressed frames of their own behind an
index, so reading a token, counting an id in a prefix or finding its n-th occurrence opens one
or two frames a plane and decodes nothing else.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.base import parallelism, text_or_empty
from tabreg.llm.tokens import encoder

MAGIC = b"WVM2"
BLOCK = 512                        # bits per directory entry
WORDS = BLOCK // 64
CHUNK = 512                        # blocks per compressed frame of bits


class Plane:
    """One bit plane: ``zeros`` in front of the next plane, ``counts`` of ones before every block,
    and its blocks in frames that are opened when they are first read."""

    def __init__(self, zeros: int, blocks: int, counts, frames: list):
        self.zeros, self.blocks, self._counts, self._frames = zeros, blocks, counts, frames

    @property
    def counts(self) -> np.ndarray:
        if isinstance(self._counts, bytes):
            self._counts = np.frombuffer(_unpacked(self._counts), "<u4").astype(np.int64)
        return self._counts

    def frame(self, i: int) -> np.ndarray:
        """The words of frame ``i``, one row a block."""
        if isinstance(self._frames[i], bytes):
            self._frames[i] = np.frombuffer(_unpacked(self._frames[i]), "<u8").reshape(-1, WORDS)
        return self._frames[i]

    def words(self, block: np.ndarray) -> np.ndarray:
        out = np.empty((len(block), WORDS), np.uint64)
        of = block // CHUNK
        for i in np.unique(of):
            here = of == i
            out[here] = self.frame(int(i))[block[here] - i * CHUNK]
        return out

    def bits(self, n: int) -> np.ndarray:
        """All ``n`` bits."""
        if not n:
            return np.zeros(0, bool)
        whole = np.concatenate([self.frame(i) for i in range(len(self._frames))])
        return np.unpackbits(whole.view(np.uint8).ravel(), count=n, bitorder="little").view(bool)

    def bit(self, pos: np.ndarray) -> np.ndarray:
        words = self.words(pos // BLOCK)
        word = words[np.arange(len(pos)), pos % BLOCK // 64]
        return (word >> (pos % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64)

    def rank1(self, pos: np.ndarray) -> np.ndarray:
        """Ones before each position: the directory, then the words of one block."""
        block = pos // BLOCK
        out = self.counts[block]
        inside = np.flatnonzero(pos % BLOCK)
        if len(inside):
            p = pos[inside]
            words, at = self.words(p // BLOCK), p % BLOCK // 64
            before = np.arange(WORDS) < at[:, None]
            last = words[np.arange(len(p)), at] & ((np.uint64(1) << (p % 64).astype(np.uint64)) - np.uint64(1))
            out[inside] += (np.bitwise_count(words) * before).sum(axis=1, dtype=np.int64) + np.bitwise_count(last)
        return out

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) bit of this value: the directory by binary search, then one
        block."""
        before = self.counts if bit else np.arange(self.blocks + 1) * BLOCK - self.counts
        block = np.searchsorted(before, k, side="right") - 1
        out = np.empty(len(k), np.int64)
        for lo in range(0, len(k), 4096):                          # 512 bytes a hit
            b = block[lo:lo + 4096]
            bits = np.unpackbits(self.words(b).view(np.uint8).reshape(len(b), -1), axis=1, bitorder="little") == bit
            nth = np.cumsum(bits, axis=1, dtype=np.int16) == (k[lo:lo + 4096] - before[b] + 1)[:, None]
            out[lo:lo + 4096] = b * BLOCK + nth.argmax(axis=1)
        return out


def _unpacked(frame: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(frame)


class WaveletMatrix:
    """Rank and select over a sequence of unsigned ids below ``2 ** bits``."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes, self.bits = n, planes, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        a, n = np.ascontiguousarray(ids), len(ids)
        if n and int(a.max()) >> bits:
            raise ValueError(f"id {int(a.max())} needs more than {bits} bits")
        planes = []
        for shift in range(bits - 1, -1, -1):
            one = (a >> shift & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)]).view("<u8").reshape(-1, WORDS)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).sum(axis=1, dtype=np.int64))])
            planes.append(Plane(n - int(counts[-1]), len(packed), counts,
                                [packed[i:i + CHUNK] for i in range(0, len(packed), CHUNK)]))
            a = np.concatenate([np.compress(~one, a), np.compress(one, a)])
        return cls(n, planes)

    def to_bytes(self) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        parts, index = [], []
        for p in self.planes:
            frames = [pack(p.counts.astype("<u4").tobytes()), *[pack(p.frame(i).tobytes()) for i in range(len(p._frames))]]
            index.append(struct.pack("<Q", p.zeros) + np.array([len(f) for f in frames], "<u4").tobytes())
            parts += frames
        return b"".join([struct.pack("<4sIQ", MAGIC, self.bits, self.n), *index, *parts])

    @classmethod
    def from_bytes(cls, block: bytes) -> WaveletMatrix:
        """Reads the index; frames stay compressed until something in them is asked for."""
        magic, bits, n = struct.unpack_from("<4sIQ", block)
        if magic != MAGIC:
            raise ValueError("not a token block")
        blocks = -(-n // BLOCK)
        frames = -(-blocks // CHUNK)
        at, index = 16, []
        for _ in range(bits):
            index.append((struct.unpack_from("<Q", block, at)[0], np.frombuffer(block, "<u4", frames + 1, at + 8).tolist()))
            at += 8 + 4 * (frames + 1)
        planes = []
        for zeros, lengths in index:
            held = []
            for size in lengths:
                held.append(block[at:at + size])
                at += size
            planes.append(Plane(zeros, blocks, held[0], held[1:]))
        return cls(n, planes)

    def opened(self) -> int:
        """Frames that have been decompressed so far."""
        return sum(not isinstance(f, bytes) for p in self.planes for f in [p._counts, *p._frames])

    def access(self, positions) -> np.ndarray:
        """The ids at the positions."""
        pos = np.asarray(positions, dtype=np.int64)
        if len(pos) and not 0 <= pos.min() <= pos.max() < self.n:
            raise IndexError("position outside of the block")
        out = np.zeros(len(pos), np.int64)
        for p in self.planes:
            one, before = p.bit(pos), p.rank1(pos)
            out = out << 1 | one
            pos = np.where(one == 1, p.zeros + before, pos - before)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences before ``end`` lie below the last plane."""
        if token < 0 or token >> self.bits or not self.n:
            return 0, 0
        ends = np.array([0, min(max(end, 0), self.n)])
        for k, p in enumerate(self.planes):
            before = p.rank1(ends)
            ends = p.zeros + before if token >> (self.bits - 1 - k) & 1 else ends - before
        return int(ends[0]), int(ends[1])

    def rank(self, token: int, end: int) -> int:
        """How often the id occurs before position ``end``."""
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _up(self, token: int, pos: np.ndarray) -> np.ndarray:
        """From places below the last plane back to positions in the sequence."""
        for k in range(self.bits - 1, -1, -1):
            bit, p = token >> (self.bits - 1 - k) & 1, self.planes[k]
            pos = p.select(bit, pos - p.zeros if bit else pos)
        return pos

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of the id; -1 where there is none."""
        lo, hi = self._range(token, self.n)
        return int(self._up(token, np.array([lo + k]))[0]) if 0 <= k < hi - lo else -1

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of the id, ascending."""
        lo, hi = self._range(token, self.n)
        return self._up(token, np.arange(lo, hi))

    def tokens(self) -> np.ndarray:
        """The whole sequence, from the last plane up: each plane undoes its stable split."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for k in range(self.bits - 1, -1, -1):
            one, zeros = self.planes[k].bits(self.n), self.planes[k].zeros
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~one)] = a[:zeros]
            up[np.flatnonzero(one)] = a[zeros:] | kind(1 << (self.bits - 1 - k))
            a = up
        return a


def bits_of(tokenizer_path: str, end_id: int) -> int:
    """Bits that hold every id of a tokenizer file and the end id."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True)
    return max([1, end_id.bit_length(), *(i.bit_length() for i in vocabulary.values())])


FILE_SCHEMA = "part int, seq int, n long, doc_ids array<long>, lengths array<int>, block binary"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", bits: int | None = None, shard_tokens: int = 1 << 21,
                      partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending id order.

    Rows are range-partitioned on (id, hash of the text) and sorted, so files follow each
    other in id order; a null id sorts first, rows of equal id by their text's hash, and a
    null text is the empty text. A task closes a shard at the first document end after
    ``shard_tokens`` ids, so its memory is bounded by that plus one document. One file of
    the folder holds the shards of one range; a rerun of a lost task writes the same shards.
    Other columns are ignored; an empty table writes no shard. ``bits`` is taken from the
    vocabulary; an id that needs more than the given ones is an error.
    """
    spark = docs.sparkSession
    bits = bits or bits_of(tokenizer_path, end_id)
    n = partitions or parallelism(spark)
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    key = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(n, *key).sortWithinPartitions(*key, "text")
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, parts, total = [], [], [], 0
        enc = encoder(tokenizer_path)

        def close() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(parts), "<u4")
            if len(flat) and int(flat.max()) >> bits:
                raise ValueError(f"id {int(flat.max())} needs more than {bits} bits")
            block = WaveletMatrix.build(flat.astype(np.uint16) if bits <= 16 else flat, bits).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([block], pa.binary())],
                names=["part", "seq", "n", "doc_ids", "lengths", "block"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = enc.encode(text.as_py()) + end
                ids.append(doc)
                lengths.append(len(one) // 4)
                parts.append(one)
                total += len(one) // 4
                if total >= shard_tokens:
                    yield close()
                    seq, ids, lengths, parts, total = seq + 1, [], [], [], 0
        if ids:
            yield close()

    rows.mapInArrow(encode, FILE_SCHEMA).write.mode("overwrite").option("compression", "none").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start`` (ids of all documents before it),
    ``n_tokens, ids`` (little-endian unsigned 32-bit). The shards are placed by running sums in
    two levels, within a part and over the parts (one row a task of the writer)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("first"))
    base = files.select("part", "seq", within.alias("within")).join(parts, "part").select(
        "part", "seq", (F.col("first") + F.col("within")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, seq, ids, lengths, block = (batch.column(c)[k].as_py() for c in range(5))
                flat = WaveletMatrix.from_bytes(block).tokens()
                ends = np.cumsum(np.array(lengths, np.int64))
                starts = ends - np.array(lengths, np.int64)
                for lo in range(0, len(ids), 512):
                    hi = min(len(ids), lo + 512)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * (hi - lo), pa.int32()), pa.array([seq] * (hi - lo), pa.int32()),
                         pa.array(ids[lo:hi], pa.int64()), pa.array(starts[lo:hi]),
                         pa.array(lengths[lo:hi], pa.int64()),
                         pa.array([flat[starts[i]:ends[i]].astype("<u4").tobytes() for i in range(lo, hi)],
                                  pa.binary())],
                        names=["part", "seq", "doc_id", "local", "n_tokens", "ids"])

    docs = files.select("part", "seq", "doc_ids", "lengths", "block").mapInArrow(
        decode, "part int, seq int, doc_id long, local long, n_tokens long, ids binary")
    return (docs.select("part", "seq", "doc_id", "local", "n_tokens", "ids")
            .join(F.broadcast(base) if _few(files) else base, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"))


def _few(files: DataFrame, limit: int = 200_000) -> bool:
    """Whether the table of shard offsets (24 bytes a row) is small enough to broadcast."""
    return files.select("part").count() <= limit


def lookup(spark, path: str, token: int) -> DataFrame:
    """Occurrences of one id, shard by shard, from the bit planes: ``part, seq, n, positions``."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                w = WaveletMatrix.from_bytes(batch.column(2)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[k:k + 1], batch.column(1)[k:k + 1], pa.array([w.count(token)], pa.int64()),
                     pa.array([w.occurrences(token)], pa.list_(pa.int64()))],
                    names=["part", "seq", "n", "positions"])

    return (spark.read.schema(FILE_SCHEMA).parquet(path).select("part", "seq", "block")
            .mapInArrow(find, "part int, seq int, n long, positions array<long>"))


def ids_crc(ids: bytes) -> int:
    return zlib.crc32(ids)
