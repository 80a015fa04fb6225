"""Frequent word runs of all lengths, counted from compact tables of hashes and one sorted list of run texts.

* Only places where the shortest run is frequent matter.  Their hashes are counted in slices of the hash space, from
  sorted lists of a few bytes a run that each task makes, and end up as a table of bits; the stretches of text between
  places that fail it are written as segments, and nothing else is read again.
* A run that is always preceded by the same word is inside a longer one that is as frequent, and so is every longer run
  from the same place.  Some lengths are tested in rising order, each by a table of bits: where a length is rare or always
  preceded alike, the run that is followed from that place ends one word before it.  Of the copies of a text this leaves little.
* What is left from each place is sorted.  Where two neighbours part, a run that counts ends: a stack over the
  sorted list sums up each one's places, the words before it and those after it.  What may go on in the next
  range, the beginnings of a range's first and last text, is added up by its words.
* Runs of the greatest length have no longer ones and are counted by their hashes of 64 bits alone.

Bits that are set by chance, and hashes that meet, let a place through that is not wanted; they lose none, unless all words before a
run agree in 32 bits.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are hashed at a time, runs that a task holds before it gives them on, and runs of a slice, about.
CHUNK, HELD, SLICE = 1 << 20, 1 << 21, 1 << 20
#: Least and most bits of a table, as powers of two.
BITS = (20, 28)
#: Bits of a run's hash below those of its slice that stand for the run in a slice.
CODE = 40
LEAST, MOST = -(2**63), 2**63 - 1
#: Spark's setting by which a query's shuffle files go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.random.default_rng(19).integers(0, 2**64, 256, "uint64")
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"base": np.ones(1, "uint64"), "inverse": np.ones(1, "uint64")}


def _powers(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base or its inverse, modulo 2**64; kept and grown as needed."""
    if len(_POWERS[kind]) < n:
        step = np.full(max(n, CHUNK) * 5 // 4, _BASE if kind == "base" else pow(_BASE, -1, 2**64), "uint64")
        step[0] = 1
        _POWERS[kind] = np.cumprod(step)
    return _POWERS[kind][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts one after another: where they stand, their hashes, and those of runs of them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        """``raw``: the texts' bytes; ``offsets``: where each text begins, and where the last one ends."""
        inside = ~_WHITE[raw]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        for mask, at in ((first, offsets[offsets < len(raw)]), (last, offsets[offsets > 0] - 1)):  # a word ends with its text
            mask[at] = inside[at]
        self.raw, self.starts, self.ends = raw, np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(len(raw) + 1, "uint64")
        np.cumsum(_BYTES[raw] * _powers("base", len(raw)), out=sums[1:])
        n = len(self.starts)
        h = (sums[self.ends] - sums[self.starts]) * _powers("inverse", len(raw) + 1)[self.starts]
        self.hashes = _mixed(h + (self.ends - self.starts).astype("uint64"))
        self.sums = np.zeros(n + 1, "uint64")
        np.cumsum(self.hashes * _powers("base", n), out=self.sums[1:])
        self.bounds = np.searchsorted(self.starts, offsets)  # a text's words
        #: How many words a place's text has from there.
        self.room = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(n)

    def runs(self, places: np.ndarray, k) -> np.ndarray:
        """Hashes of the runs of k words (a number, or one for each place) from the places."""
        h = (self.sums[places + k] - self.sums[places]) * _powers("inverse", len(self.sums))[places]
        return _mixed(h + np.asarray(k).astype("uint64"))

    def text(self, place: int, k: int) -> bytes:
        return self.raw[self.starts[place] : self.ends[place + k - 1]].tobytes()


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries made and run in here leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def word_hash(word: bytes) -> int:
    """A word's hash as a signed number."""
    return int(Words(np.frombuffer(word, "uint8"), np.array([0, len(word)])).hashes.view("int64")[0])


def _chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[Words, int, int]]:
    """The batch's texts in parts of about ``CHUNK`` bytes, with the rows that each part is of; null counts as empty."""
    texts = batch.column(column).fill_null(b"").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, "int64")[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, "int64")
    data, low = np.frombuffer(data or b"", "uint8"), 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]), low, high
        low = high


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the keys, and where each distinct key begins in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1])))


class Bits:
    """A table of bits by a run's hash, in slices of the hash space; two bits stand for a run."""

    def __init__(self, slices: int, bits: int):
        self.slices, self.width, self.table = slices, bits - slices, np.zeros(1 << (bits - 3), "uint8")

    def put(self, number: int, part: bytes) -> None:
        size = 1 << (self.width - 3)
        self.table[number * size : (number + 1) * size] = np.frombuffer(part, "uint8")

    @staticmethod
    def places(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << width) - 1)
        return (codes & mask).astype("int64"), ((codes >> np.uint64(CODE // 2)) & mask).astype("int64")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        base = (hashes >> np.uint64(64 - self.slices)).astype("int64") << self.width
        found = np.ones(len(hashes), bool)
        for at in self.places(_codes(hashes, self.slices), self.width):
            at += base
            found &= (self.table[at >> 3] >> (7 - (at & 7)).astype("uint8") & 1).astype(bool)
        return found


def _codes(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - slices - CODE)) & np.uint64((1 << CODE) - 1)


_PARTS = ["low", "high", "n", "left", "mixed"]
_SLICES = "slice int, " + ", ".join(f"{c} binary" for c in _PARTS)


def _dealt(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], slices: int) -> pa.RecordBatch:
    """Runs (hash, word before, whether those differ) counted and dealt out by slice, a few bytes for each distinct one."""
    hashes, left, mixed = (np.concatenate(x) for x in zip(*found))
    order, at = _grouped(hashes)
    hashes, left, mixed = hashes[order[at]], left[order], mixed[order]
    n = np.diff(np.append(at, len(order))).astype("<u4")
    low, high = np.minimum.reduceat(left, at), np.maximum.reduceat(left, at)
    mixed = np.logical_or.reduceat(mixed, at) | (low != high)
    cuts = np.searchsorted(hashes >> np.uint64(64 - slices), np.arange((1 << slices) + 1, dtype="uint64"))
    codes = _codes(hashes, slices)
    columns = [codes.astype("<u4"), (codes >> np.uint64(32)).astype("uint8"), n, np.where(mixed, 0, low).astype("<u4"), mixed.astype("uint8")]
    full = np.flatnonzero(np.diff(cuts))
    blobs = [pa.array([c[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *blobs], names=["slice", *_PARTS])


def _table(rows: DataFrame, runs, slices: int, bits: int, least: int) -> Bits:
    """Bits of the runs that occur ``least`` times and not always after the same word; ``runs``: those of an Arrow batch."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for x in runs(batch):
                found.append(x)
                held += len(x[0])
                if held >= HELD:
                    yield _dealt(found, slices)
                    found, held = [], 0
        if held:
            yield _dealt(found, slices)

    def mark(frame: pd.DataFrame) -> pd.DataFrame:
        low, high, n, left, mixed = (np.frombuffer(b"".join(frame[c]), t) for c, t in zip(_PARTS, ("<u4", "uint8", "<u4", "<u4", "uint8")))
        order, at = _grouped(high.astype("uint64") << np.uint64(32) | low)
        codes = (high.astype("uint64") << np.uint64(32) | low)[order[at]]
        n, left, mixed = n[order].astype("int64"), left[order], mixed[order]
        differ = np.maximum.reduceat(mixed, at).astype(bool) | (np.minimum.reduceat(left, at) != np.maximum.reduceat(left, at))
        codes, part = codes[(np.add.reduceat(n, at) >= least) & differ], np.zeros(1 << (bits - slices), bool)
        for places in Bits.places(codes, bits - slices):
            part[places] = True
        return pd.DataFrame({"slice": frame["slice"].iloc[:1], "bits": [zlib.compress(np.packbits(part).tobytes(), 1)], "runs": [len(codes)]})

    out = Bits(slices, bits)
    with _cleaned(rows.sparkSession):
        for row in rows.mapInArrow(deal, _SLICES).groupBy("slice").applyInPandas(mark, "slice int, bits binary, runs long").filter("runs > 0").collect():
            out.put(row["slice"], zlib.decompress(row["bits"]))
    return out


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table below ``spark.checkpoint.dir``: cuts lineage."""
    spark = df.sparkSession
    top = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="placeweave-")
    path = f"{top.rstrip('/')}/placeweave-runs-{uuid.uuid4().hex}"
    with _cleaned(spark):
        df.select("*").write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _segments(texts: DataFrame, frequent, low: int) -> DataFrame:
    """Stretches of text in which each run of ``low`` words may be frequent: number, text, and whether its first word only stands before it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for words, _, _ in _chunks(batch):
                places = np.flatnonzero(words.room >= low)
                places = places[frequent.value.has(words.runs(places, low))]
                if not len(places):
                    continue
                begins = np.zeros(len(words.starts), bool)
                begins[words.bounds[:-1][np.diff(words.bounds) > 0]] = True
                at = np.flatnonzero(np.concatenate(([True], np.diff(places) > 1)) | begins[places])
                first, ends = places[at], places[np.append(at[1:], len(places)) - 1] + low
                after = ~begins[first]
                found = [words.text(a, b - a) for a, b in zip((first - after).tolist(), ends.tolist())]
                columns = [pa.array(range(number, number + len(at)), pa.int64()), pa.array(found, pa.binary()), pa.array(after), pa.array(ends - first, pa.int64())]
                number += len(at)
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "text", "after", "n_words"])

    return _written(texts.mapInArrow(cut, "segment long, text binary, after boolean, n_words long"))


class Followed:
    """The places of some segments, the greatest length followed from each, and which of them go on beyond the lengths tested."""

    def __init__(self, batch: pa.RecordBatch, words: Words, rows: slice, low: int, high: int, tested: list[tuple[int, Bits]]):
        after = np.asarray(batch.column("after").slice(rows.start, rows.stop - rows.start))
        fit = words.room >= low
        fit[words.bounds[:-1][after]] = False
        begins = np.zeros(len(fit) + 1, bool)
        begins[words.bounds[:-1][~after]] = True
        self.places = np.flatnonzero(fit)
        room = words.room[self.places]
        self.top, self.open = np.minimum(room, high - 1), np.arange(len(self.places))
        for k, bits in tested:
            self.open = self.open[room[self.open] >= k]
            passed = bits.has(words.runs(self.places[self.open], k))
            self.top[self.open[~passed]] = k - 1
            self.open = self.open[passed]
        self.begins = begins[self.places]


def _leaves(segments: DataFrame, low: int, high: int, tested) -> DataFrame:
    """The run followed from each place: its words, each followed by a space, how often, and the words before and after it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, a, b in _chunks(batch):
                followed = Followed(batch, words, slice(a, b), low, high, tested.value)
                kept = followed.top >= low
                places, top, begins = followed.places[kept], followed.top[kept], followed.begins[kept]
                if not len(places):
                    continue
                h = words.hashes.view("int64")
                left, ends = h[places - 1], places + top
                last = words.room[places] == top
                right = h[np.minimum(ends, len(h) - 1)]
                order, at = _grouped(words.runs(places, top))
                low_high = []
                for values, mixed in ((left, begins), (right, last)):
                    low_high += [np.minimum.reduceat(np.where(mixed, LEAST, values)[order], at), np.maximum.reduceat(np.where(mixed, MOST, values)[order], at)]
                keys = [b" ".join([*words.text(p, k).split(), b""]) for p, k in zip(places[order[at]].tolist(), top[order[at]].tolist())]
                columns = [pa.array(keys, pa.binary()), pa.array(np.diff(np.append(at, len(order)))), *map(pa.array, low_high)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", *_ENDS])

    return segments.mapInArrow(find, f"key binary, n long, {_ENDS_DDL}")


_ENDS = ["left_least", "left_most", "right_least", "right_most"]
_ENDS_DDL = ", ".join(f"{c} long" for c in _ENDS)


def _common(a: bytes, b: bytes) -> int:
    """The number of words with which both keys begin."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a.count(b" ", 0, low)


def closed_runs(rows: Iterator[tuple], low: int, least: int) -> Iterator[tuple]:
    """(term, n, words before, words after) of the runs at which sorted distinct keys part or end.

    Runs that lie wholly in these rows come only if they are frequent and no longer one is as frequent; those with
    which the first or the last key begins always come, as other rows may add to them.
    """
    stack: list[list] = []  # depth, n, left least and most, right least and most, whether the first key's, a key
    previous = None

    def term(key: bytes, depth: int) -> bytes:
        return b" ".join(key.split(b" ", depth)[:depth])

    def merge(node: list, child: list) -> None:
        node[1] += child[1]
        node[2], node[3] = min(node[2], child[2]), max(node[3], child[3])
        if node[6]:
            after = word_hash(child[7].split(b" ", node[0] + 1)[node[0]])
            node[4], node[5] = min(node[4], after), max(node[5], after)
        else:  # a node has a child only where keys part
            node[4], node[5] = LEAST, MOST

    for key, n, *ends in rows:
        depth = key.count(b" ")
        if previous is None:
            stack = [[d, 0, MOST, LEAST, MOST, LEAST, True, key] for d in range(low, depth)]
            stack.append([depth, n, *ends, True, key])
            previous = key
            continue
        common = _common(previous, key)
        while stack and stack[-1][0] > common:
            node = stack.pop()
            if node[6] or node[1] >= least and node[2] < node[3] and node[4] < node[5]:
                yield term(node[7], node[0]), *node[1:6]
            if common >= low and (not stack or stack[-1][0] < common):
                stack.append([common, 0, MOST, LEAST, LEAST, MOST, False, key])
            if stack:
                merge(stack[-1], node)
        stack.append([depth, n, *ends, False, key])
        previous = key
    while stack:
        node = stack.pop()
        yield term(node[7], node[0]), *node[1:6]
        for d in range(node[0] - 1, stack[-1][0] if stack else low - 1, -1):
            after = word_hash(node[7].split(b" ", d + 1)[d])
            yield term(node[7], d), *node[1:4], after, after
        if stack:
            merge(stack[-1], node)


def _shorter(segments: DataFrame, low: int, high: int, least: int, tested) -> DataFrame:
    """(term, n) for frequent runs of ``low`` to ``high`` - 1 words without those inside a longer one that is as frequent."""
    merged = [F.sum("n").alias("n"), *[(F.min if c.endswith("least") else F.max)(c).alias(c) for c in _ENDS]]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, names = [], ["term", "n", *_ENDS]
        arrays = lambda: pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if i else pa.binary()) for i, x in enumerate(zip(*found))], names=names)
        for row in closed_runs((r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])), low, least):
            found.append(row)
            if len(found) == 10_000:
                yield arrays()
                found = []
        if found:
            yield arrays()

    # Ranges of keys: equal keys lie together, so nothing is shuffled again.
    keys = _leaves(segments, low, high, tested).repartitionByRange("key").groupBy("key").agg(*merged).sortWithinPartitions("key")
    out = keys.mapInArrow(part, f"term binary, n long, {_ENDS_DDL}").groupBy("term").agg(*merged)
    return out.filter(F.col("n") >= least).filter("left_least < left_most and right_least < right_most").select(F.col("term").cast("string"), "n")


def _longest(segments: DataFrame, high: int, least: int) -> DataFrame:
    """(term, n) for frequent runs of ``high`` words."""
    segments = segments.filter(F.col("n_words") >= high)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.asarray(batch.column("segment"))
            for words, a, b in _chunks(batch):
                after = np.asarray(batch.column("after").slice(a, b - a))
                fit = words.room >= high
                fit[words.bounds[:-1][after]] = False
                places = np.flatnonzero(fit)
                if not len(places):
                    continue
                hashes = words.runs(places, high)
                order, at = _grouped(hashes)
                first = places[order[at]]
                row = np.searchsorted(words.bounds, first, "right") - 1
                columns = [hashes[order[at]].view("int64"), np.diff(np.append(at, len(order))), numbers[a + row], first - words.bounds[row]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["hash", "n", "segment", "place"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words, runs = text.as_py().split(), runs.as_py()
                for i in range(0, len(runs), 1000):
                    found = [(b" ".join(words[r["place"] : r["place"] + high]), r["n"]) for r in runs[i : i + 1000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.binary(), pa.int64()))], names=["term", "n"])

    counts = segments.select("segment", "text", "after").mapInArrow(find, "hash long, n long, segment long, place long")
    counts = counts.groupBy("hash").agg(F.sum("n").alias("n"), F.min(F.struct("segment", "place")).alias("at")).filter(F.col("n") >= least)
    wanted = counts.groupBy("at.segment").agg(F.collect_list(F.struct(F.col("at.place").alias("place"), "n")).alias("runs"))
    out = segments.join(_written(wanted), "segment").select("text", "runs").mapInArrow(read, "term binary, n long")
    return out.select(F.col("term").cast("string"), "n")


def frequent_ngrams(texts: DataFrame, column: str = "text", low: int = 3, high: int = 100, least: int = 6) -> DataFrame:
    """(term, n) for runs of ``low`` to ``high`` words that occur ``least`` times, without those inside a longer one that is as frequent.

    Words are parted by ASCII white space; null and empty texts have none.
    """
    spark = texts.sparkSession
    texts = texts.select(F.col(column).cast("binary").alias("text"))
    words = (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // 6
    slices = min(12, max(4, (words // SLICE).bit_length()))
    bits = min(BITS[1], max(BITS[0], (words // 2).bit_length()))

    def shortest(batch: pa.RecordBatch) -> Iterator[tuple]:
        for words, _, _ in _chunks(batch):
            places = np.flatnonzero(words.room >= low)
            yield words.runs(places, low), np.zeros(len(places), "uint32"), np.ones(len(places), bool)

    table = lambda rows, runs, bits: _table(rows, runs, slices, bits, least)
    segments = _segments(texts, spark.sparkContext.broadcast(table(texts, shortest, bits)), low)
    out = _longest(segments, high, least)
    if low == high:
        return out
    tested, k = [], low
    while k < high:
        known = spark.sparkContext.broadcast(tested)

        def longer(batch: pa.RecordBatch, k=k, known=known) -> Iterator[tuple]:
            for words, a, b in _chunks(batch):
                followed = Followed(batch, words, slice(a, b), low, high, known.value)
                open_ = followed.open[words.room[followed.places[followed.open]] >= k]
                places = followed.places[open_]
                yield words.runs(places, k), words.hashes[places - 1].astype("uint32"), followed.begins[open_]

        found = table(segments, longer, bits if k == low else max(BITS[0], bits - 2))
        tested = [*tested, (k, found)]
        if not found.table.any():
            break
        k = max(k + 1, k * 8 // 5)
    return _shorter(segments, low, high, least, spark.sparkContext.broadcast(tested)).unionByName(out)
