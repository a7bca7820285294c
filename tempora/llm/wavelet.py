"""Token ids in wavelet-matrix files.

A shard is one compressed file: a header, the doc ids and lengths of its documents, and one bit-plane for each bit of an
id. Plane b holds bit b (from the top) of all ids in an order that sorts them stably by the bits above. With counts of
set bits before every block, access, rank, count and select take one step a plane, without the ids themselves.

Documents lie in ascending id order over the shards (null ids first, equal ids by a hash of the text). Every document ends
with the end id. Shards are written under a temporary name and then renamed, so a task that runs again replaces its
own files. The start of a document counts the ids of all documents before it, in all shards.

Defined results: a null or empty text has the end id alone; rows that repeat are documents of their own; an empty table
writes no shard; columns besides id and text are not stored.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import slices, utf8
from .bpe import Encoder
from .storage import read_file, stash, text_bytes, write_file

#: Fixed value: the first bytes of a shard.
MAGIC = b"WVM1"
PART_BYTES = 16 << 20
SHARD_TOKENS = 8 << 20
BLOCK = 512
#: Ids that move from a plane's order to the next one's at a time: their places stay in cache, whatever the size of a shard.
STEP = 1 << 16

_MANIFEST = "shard string, n_docs long, n_tokens long"


class WaveletMatrix:
    """Bit-planes over ids under 2**bits."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int):
        self.planes, self.zeros, self.n, self.bits = planes, zeros, n, len(planes)
        self._before: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, current = [], [], np.ascontiguousarray(ids)
        for b in range(bits - 1, -1, -1):
            one = (current & current.dtype.type(1 << b)) != 0
            planes.append(np.packbits(one))
            zeros.append(len(one) - int(np.count_nonzero(one)))
            below, low, high = np.empty_like(current), 0, zeros[-1]
            for a in range(0, len(one), STEP):
                part, bits_set = current[a : a + STEP], one[a : a + STEP]
                clear, rest = part.compress(~bits_set), part.compress(bits_set)
                below[low : low + len(clear)] = clear
                below[high : high + len(rest)] = rest
                low, high = low + len(clear), high + len(rest)
            current = below
        return cls(planes, zeros, len(ids))

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        current = np.zeros(self.n, dtype)
        for level in range(self.bits - 1, -1, -1):
            above, low, high = np.empty(self.n, dtype), 0, self.zeros[level]
            for a in range(0, self.n, STEP):
                one = np.unpackbits(self.planes[level][a // 8 : (a + STEP) // 8], count=min(STEP, self.n - a)).view(bool)
                clear, rest = np.flatnonzero(~one), np.flatnonzero(one)
                part = above[a : a + STEP]
                part[clear] = current[low : low + len(clear)]
                part[rest] = current[high : high + len(rest)] | dtype(1 << (self.bits - 1 - level))
                low, high = low + len(clear), high + len(rest)
            current = above
        return current

    def _ones(self, level: int, position: int) -> int:
        """Set bits of a plane before a position."""
        if self._before[level] is None:
            padded = np.zeros(-(-self.n // BLOCK) * BLOCK // 8 + BLOCK // 8, np.uint8)
            padded[: len(self.planes[level])] = self.planes[level]
            counts = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(1, dtype=np.int64)
            self._before[level] = np.concatenate([[0], np.cumsum(counts)])
        block = position // BLOCK
        part = self.planes[level][block * BLOCK // 8 : (position + 7) // 8]
        return int(self._before[level][block]) + int(np.unpackbits(part, count=position - block * BLOCK).sum())

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        value = 0
        for level in range(self.bits):
            ones = self._ones(level, position)
            bit = (int(self.planes[level][position >> 3]) >> (7 - (position & 7))) & 1
            value = value << 1 | bit
            position = self.zeros[level] + ones if bit else position - ones
        return value

    def _span(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before a position lie below the last plane."""
        low, high = 0, end
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            low, high = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, position: int) -> int:
        """Occurrences of a token before a position."""
        if token >> self.bits:
            return 0
        low, high = self._span(token, position)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The position of the k-th (from 0) bit of that value in a plane."""
        self._ones(level, 0)
        before = self._before[level]
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of a token."""
        if token >> self.bits or not 0 <= k < self.count(token):
            raise IndexError(k)
        position = self._span(token, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            position = self._select_bit(level, bit, position - self.zeros[level] if bit else position)
        return position

    def occurrences(self, token: int) -> list[int]:
        """All positions of a token: select of every occurrence at once, a pass a plane."""
        if token >> self.bits:
            return []
        low, high = self._span(token, self.n)
        at = np.arange(low, high)
        for level in range(self.bits - 1, -1, -1):
            if not len(at):
                break
            bit = token >> (self.bits - 1 - level) & 1
            same = np.flatnonzero(np.unpackbits(self.planes[level], count=self.n) == bit)
            at = same[at - self.zeros[level] if bit else at]
        return at.tolist()


def pack(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """The bytes of a shard."""
    import zstandard

    matrix, press = WaveletMatrix.build(ids, bits), zstandard.ZstdCompressor(level=1)
    parts = [json.dumps(doc_ids).encode(), lengths.astype("<u4").tobytes(), *(p.tobytes() for p in matrix.planes)]
    parts = [press.compress(p) for p in parts]
    head = json.dumps({"n": len(ids), "bits": bits, "zeros": matrix.zeros, "sizes": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])


def unpack(raw: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Doc ids, lengths and matrix of a shard."""
    import zstandard

    if raw[:4] != MAGIC:
        raise ValueError("not a shard")
    (size,) = struct.unpack("<I", raw[4:8])
    head, at, parts = json.loads(raw[8 : 8 + size]), 8 + size, []
    for n in head["sizes"]:
        parts.append(zstandard.ZstdDecompressor().decompress(raw[at : at + n]))
        at += n
    planes = [np.frombuffer(p, np.uint8) for p in parts[2:]]
    return json.loads(parts[0]), np.frombuffer(parts[1], "<u4"), WaveletMatrix(planes, head["zeros"], head["n"])


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and write all texts; gives a row a shard: shard (path, in order), n_docs, n_tokens."""
    parts = max(8, -(-text_bytes(docs, text) // PART_BYTES))
    light = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    tie = F.xxhash64("__text")
    dealt = light.repartitionByRange(parts, F.col("__key"), tie).sortWithinPartitions(F.col("__key"), tie)

    def write(batches):
        from pyspark import TaskContext

        encoder, part, shard = Encoder.kept(tokenizer_path), TaskContext.get().partitionId(), 0
        keys, lengths, ids, held = [], [], [], 0

        def flush():
            nonlocal keys, lengths, ids, held, shard
            path = f"{folder}/part-{part:07d}-{shard:04d}.wvm"
            flat, sizes = np.concatenate(ids), np.concatenate(lengths)
            write_file(path, pack(keys, sizes, flat, encoder.bits))
            row = pa.RecordBatch.from_pydict({"shard": pa.array([path]), "n_docs": pa.array([len(keys)]), "n_tokens": pa.array([len(flat)])})
            keys, lengths, ids, held, shard = [], [], [], 0, shard + 1
            return row

        for batch in batches:
            data, offsets = utf8(batch["__text"])
            names = batch["__key"].to_pylist()
            for i, j in slices(offsets, 4 << 20):
                flat, counts = encoder.rows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ends = np.cumsum(counts)
                ids.append(np.insert(flat, ends, end_id))
                lengths.append(counts + 1)
                keys += names[i:j]
                held += len(ids[-1])
                if held >= SHARD_TOKENS:
                    yield flush()
        if keys:
            yield flush()

    return stash(dealt.mapInArrow(write, _MANIFEST))


def read_shards(manifest: DataFrame, key_type: str = "long") -> DataFrame:
    """All documents of the shards, from their files: doc_id, start, n_tokens and ids."""
    return _read(manifest, key_type, "ids array<int>")


def _read(manifest: DataFrame, key_type: str, wanted: str, tasks: int | None = None) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(T.StructType.fromDDL(f"doc_id {key_type}")["doc_id"].dataType)  # a shard of null ids has it, too
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    placed = stash(manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))))
    shards = max(1, placed.count())

    def read(batches):
        for batch in batches:
            for path, before in zip(batch["shard"].to_pylist(), batch["before"].to_pylist(), strict=True):
                keys, lengths, matrix = unpack(read_file(path))
                ids = matrix.ids().astype("<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                columns = {"doc_id": pa.array(keys, kind), "start": pa.array(starts + before), "n_tokens": pa.array(lengths.astype(np.int64))}
                if wanted.startswith("ids_crc32"):
                    raw = memoryview(ids).cast("B")
                    columns["ids_crc32"] = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
                else:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    return placed.select("shard", "before").repartition(tasks or min(shards, 10_000), "shard").mapInArrow(read, f"doc_id {key_type}, start long, n_tokens long, {wanted}")


def read_digests(manifest: DataFrame, key_type: str = "long") -> DataFrame:
    """As read_shards, with the unsigned crc32 of the ids as little-endian unsigned 32-bit integers in place of them."""
    return _read(manifest, key_type, "ids_crc32 long")


def find(manifest: DataFrame, token: int) -> DataFrame:
    """Positions of a token, over all shards, from the files' rank and select: shard, position (in the shard)."""

    def look(batches):
        for batch in batches:
            for path in batch["shard"].to_pylist():
                found = unpack(read_file(path))[2].occurrences(token)
                yield pa.RecordBatch.from_pydict({"shard": pa.array([path] * len(found), pa.string()), "position": pa.array(found, pa.int64())})

    return manifest.select("shard").mapInArrow(look, "shard string, position long")
