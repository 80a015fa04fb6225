"""Token ids in sorted-string-table shards.

A shard holds the documents of one identifier range, ascending.  Layout (integers little-endian):

* data blocks of about ``BLOCK_BYTES``: entries ``shared u8, unshared u8, value length u32, key
  suffix, value``.  Keys are prefix-compressed against the entry before, except at every
  ``RESTART``-th entry; the block ends with the offsets of those entries (u32 each), their count
  (u32) and the block's crc32 (u32), so a block can be searched by bisection;
* the sparse index: for each block its last key (length u8, bytes), offset (u64) and size (u32);
* a Bloom filter over the keys (``BLOOM_BITS`` bits a key, ``BLOOM_HASHES`` probes);
* a footer of fixed size (``FOOTER``) with the places of index and filter and the totals.

A key is the identifier as eight bytes, big-endian with the sign bit flipped (byte order equals
numeric order); a null identifier has the empty key, which sorts first.  A value is a width byte
(2 or 4) and the ids in that many bytes each.  Each section is followed by one newline, because
Spark's text writer puts the sections into the file: so the shards reach any store that Spark
can write, and its commit protocol keeps out what lost or repeated tasks have written.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encoding import encoder, strings
from .shared import small_batches, written

MAGIC = b"PWSST\x00\x00\x01"
BLOCK_BYTES, RESTART, BLOOM_BITS, BLOOM_HASHES = 64 * 1024, 16, 10, 7
#: magic, shard, entries, ids, index offset, index size, filter offset, filter size, crc32.
FOOTER = struct.Struct("<8sqqqQIQII")
ENTRY, INDEX = struct.Struct("<BBI"), struct.Struct("<QI")
SHARD_BYTES = 128 << 20


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def pack_ids(ids: np.ndarray) -> bytes:
    if not len(ids) or int(ids.max()) < 1 << 16:
        return b"\x02" + ids.astype("<u2").tobytes()
    return b"\x04" + ids.astype("<u4").tobytes()


def unpack_ids(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype="<u2" if value[0] == 2 else "<u4", offset=1).astype("<u4")


def _probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & ((1 << 64) - 1), (h >> 64) | 1
    return [(a + i * b) % (1 << 64) % bits for i in range(BLOOM_HASHES)]


class BlockWriter:
    """One data block; entries are added in key order."""

    def __init__(self) -> None:
        self.body, self.restarts, self.count, self.last = bytearray(), [], 0, b""

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.count % RESTART == 0:
            self.restarts.append(len(self.body))
        else:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.body += ENTRY.pack(shared, len(key) - shared, len(value)) + key[shared:] + value
        self.count, self.last = self.count + 1, key

    def finish(self) -> bytes:
        body = bytes(self.body) + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
        return body + struct.pack("<I", zlib.crc32(body))


def build(entries: Iterable[tuple[int | None, np.ndarray]], shard: int = 0) -> Iterator[bytes]:
    """The sections of a shard, in file order; nothing for no entries. Holds one block, the index and the keys."""
    block, at, index, keys, total = BlockWriter(), 0, bytearray(), bytearray(), 0
    n = 0

    def closed() -> bytes:
        nonlocal at, block
        data = block.finish()
        index.extend(bytes([len(block.last)]) + block.last + INDEX.pack(at, len(data)))
        at, block = at + len(data) + 1, BlockWriter()
        return data

    for doc_id, ids in entries:
        key = key_of(doc_id)
        block.add(key, pack_ids(ids))
        keys += bytes([len(key)]) + key
        n, total = n + 1, total + len(ids)
        if len(block.body) >= BLOCK_BYTES:
            yield closed()
    if not n:
        return
    if block.count:
        yield closed()
    bits = max(64, n * BLOOM_BITS + 7 & ~7)
    bloom, p = np.zeros(bits, dtype=bool), 0
    while p < len(keys):
        bloom[_probes(bytes(keys[p + 1 : p + 1 + keys[p]]), bits)] = True
        p += 1 + keys[p]
    packed = np.packbits(bloom, bitorder="little").tobytes()
    yield bytes(index)
    yield packed
    head = FOOTER.pack(MAGIC, shard, n, total, at, len(index), at + len(index) + 1, len(packed), 0)
    yield head[:-4] + struct.pack("<I", zlib.crc32(head[:-4]))


def _entries(block: bytes) -> Iterator[tuple[bytes, bytes]]:
    body = block[:-4]
    if zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("a block of the sorted-string table is damaged")
    (restarts,) = struct.unpack("<I", body[-4:])
    end, at, key = len(body) - 4 - 4 * restarts, 0, b""
    while at < end:
        shared, unshared, size = ENTRY.unpack_from(body, at)
        at += ENTRY.size
        key = key[:shared] + body[at : at + unshared]
        yield key, body[at + unshared : at + unshared + size]
        at += unshared + size


class Reader:
    """A shard behind ``read(offset, size)``: lookups by bisection, or all entries in order.

    The footer is read at once, the index and the filter when they are first asked for, and a block
    when it is searched, so a lookup reads little of a large shard.
    """

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        foot = read(max(0, size - FOOTER.size - 1), FOOTER.size)
        if len(foot) < FOOTER.size:
            raise ValueError("not a sorted-string table")
        magic, self.shard, self.entries, self.ids, *self.parts, crc = FOOTER.unpack(foot)
        if magic != MAGIC or zlib.crc32(foot[:-4]) != crc:
            raise ValueError("not a sorted-string table, or its footer is damaged")
        self.read = read

    @classmethod
    def of(cls, content: bytes) -> "Reader":
        """A shard that lies in memory."""
        return cls(lambda at, size: content[at : at + size], len(content))

    @cached_property
    def index(self) -> tuple[list[bytes], list[tuple[int, int]]]:
        """The last key of each block, and the blocks' places."""
        index, p = self.read(*self.parts[:2]), 0
        keys, places = [], []
        while p < len(index):
            n = index[p]
            keys.append(index[p + 1 : p + 1 + n])
            places.append(INDEX.unpack_from(index, p + 1 + n))
            p += 1 + n + INDEX.size
        return keys, places

    @cached_property
    def bloom(self) -> bytes:
        return self.read(*self.parts[2:])

    def may_hold(self, key: bytes) -> bool:
        return all(self.bloom[b >> 3] >> (b & 7) & 1 for b in _probes(key, 8 * len(self.bloom)))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every entry with this identifier: filter, index bisection, restart bisection."""
        key, found = key_of(doc_id), []
        if not self.may_hold(key):
            return found
        last_keys, places = self.index
        for i in range(bisect_left(last_keys, key), len(places)):
            block = self.read(*places[i])
            (restarts,) = struct.unpack_from("<I", block, len(block) - 8)
            end = len(block) - 8 - 4 * restarts
            start = lambda r: struct.unpack_from("<I", block, end + 4 * r)[0]  # noqa: B023, E731
            first = lambda r: block[start(r) + ENTRY.size : start(r) + ENTRY.size + block[start(r) + 1]]  # noqa: B023, E731
            at, k = start(max(0, bisect_left(range(restarts), key, key=first) - 1)), b""
            while at < end:
                shared, unshared, size = ENTRY.unpack_from(block, at)
                k = k[:shared] + block[at + ENTRY.size : at + ENTRY.size + unshared]
                at += ENTRY.size + unshared
                if k > key:
                    return found
                if k == key:
                    found.append(unpack_ids(block[at : at + size]))
                at += size
        return found

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for place in self.index[1]:
            for key, value in _entries(self.read(*place)):
                yield id_of(key), unpack_ids(value)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, keeps_space: bool = True, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) and write one shard per identifier range.

    A null text is empty and so has only the end id.  Rows of one identifier stay adjacent, ordered by
    their texts; sampled splitters over (identifier, text hash) part them when one identifier is hot, so
    no task holds more than its share.  ``shards``: Spark's shuffle partitions, more if the plan's size
    estimate asks for it (``SHARD_BYTES`` each).  Empty input writes no shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    if shards is None:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // SHARD_BYTES, 1_000_000))
    tie = F.xxhash64("text").alias("tie")
    ordered = rows.select("doc_id", "text", tie).repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_space)
        end = np.array([end_id], dtype="<u4").tobytes()

        def entries() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode.encode(strings(batch.column("text")))):
                    yield doc_id, np.frombuffer(found + end, dtype="<u4")

        for section in build(entries(), TaskContext.get().partitionId()):
            yield pa.RecordBatch.from_arrays([pa.array([section])], names=["section"])

    made = ordered.select("doc_id", "text").mapInArrow(sections, "section binary")
    made.select(F.col("section").cast("string").alias("value")).write.text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("content")


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _scan(spark: SparkSession, path: str, last: str, kind: pa.DataType, of: Callable[[np.ndarray], bytes | int]) -> DataFrame:
    """Every document of the shards: doc_id, shard, shard_start, n_tokens, and ``of`` its ids as the column ``last``."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "shard", "shard_start", "n_tokens")] + [(last, kind)])

    def entries(content: bytes) -> Iterator[tuple]:
        shard, start = Reader.of(content), 0
        for doc_id, ids in shard:
            yield doc_id, shard.shard, start, len(ids), of(ids)
            start += len(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from _batches(entries(content.as_py()), schema)

    names = "doc_id long, shard long, shard_start long, n_tokens long"
    return _files(spark, path).mapInArrow(rows, f"{names}, {last} {'binary' if kind == pa.binary() else 'long'}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards under ``path``: doc_id, shard, shard_start (ids before it in its shard), n_tokens,
    and ids as little-endian uint32 bytes.  No shards give no rows."""
    return _scan(spark, path, "ids", pa.binary(), lambda ids: ids.tobytes())


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard.

    The shards are read once, and only their documents' figures leave the readers; a total per shard
    reaches the driver, which sums them up in shard order.  No shards give no rows.
    """
    docs = written(_scan(spark, path, "ids_crc32", pa.int64(), zlib.crc32), "shards")
    before, base = 0, []
    for shard, ids in sorted(map(tuple, docs.groupBy("shard").agg(F.sum("n_tokens")).collect())):
        base.append((shard, before))
        before += ids
    bases = spark.createDataFrame(base, "shard long, shard_base long")
    start = (F.col("shard_base") + F.col("shard_start")).alias("start")
    return docs.join(F.broadcast(bases), "shard").select("doc_id", start, "n_tokens", "ids_crc32", "shard")


class Table:
    """The shards under a path, in key order, for lookups from the driver.

    Ranged reads go through the Hadoop file system that holds the path.  A lookup bisects over the
    shards by the last keys of their sparse indexes, then searches one shard: footer, index and
    filter of some log2(shards) shards and one block are read, and kept for the next lookup.
    """

    def __init__(self, spark: SparkSession, path: str):
        jvm, where = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.bytes_of = jvm.org.apache.commons.io.IOUtils.toByteArray
        files = sorted((f.getPath().getName(), f.getPath(), f.getLen()) for f in self.fs.listStatus(where))
        self.files = [(p, size) for name, p, size in files if name.startswith("part-") and size]
        self.reader = lru_cache(1024)(self._reader)
        self.bytes_read = 0

    def _reader(self, i: int) -> Reader:
        path, size = self.files[i]

        def read(at: int, n: int) -> bytes:
            stream = self.fs.open(path)
            try:
                stream.seek(at)
                self.bytes_read += n
                return bytes(self.bytes_of(stream, n))
            finally:
                stream.close()

        return Reader(read, size)

    def get(self, doc_id: int | None) -> list[tuple[int, np.ndarray]]:
        """(shard, ids) of every entry with this identifier."""
        key, found = key_of(doc_id), []
        last = lambda i: self.reader(i).index[0][-1]
        for i in range(bisect_left(range(len(self.files)), key, key=last), len(self.files)):
            shard = self.reader(i)
            found += [(shard.shard, ids) for ids in shard.get(doc_id)]
            if last(i) > key:  # a hot identifier may go on in the next shard
                break
        return found


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents with the given identifiers (a stated list): doc_id, shard, n_tokens, ids; none for an empty table."""
    table = Table(spark, path)
    hits = [(i, shard, len(v), v.tobytes()) for i in doc_ids for shard, v in table.get(i)]
    return spark.createDataFrame(hits, "doc_id long, shard long, n_tokens long, ids binary")
